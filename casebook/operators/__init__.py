"""Reusable DataFrame operators (L1-L12 of the operator inventory)."""

from casebook.operators.calendar import calendar, date_at, dates_until, expand_calendar, stepped_dates, steps
from casebook.operators.flags import flag_since
from casebook.operators.intervals import state_at, state_intervals, transition
from casebook.operators.lists import explode_list, zip_lists
from casebook.operators.pairs import pair_histogram, pair_totals
from casebook.operators.ranking import dense_index, pick_ranked, pick_spread, rank_by_histogram, top_with_ties
from casebook.operators.sequence import along
from casebook.operators.shares import attach_scalars, percent_of, round_percent
from casebook.operators.sketches import daily_sketches, error_bound, merged_count

__all__ = [
    "along",
    "attach_scalars",
    "calendar",
    "daily_sketches",
    "date_at",
    "dates_until",
    "dense_index",
    "rank_by_histogram",
    "error_bound",
    "expand_calendar",
    "explode_list",
    "flag_since",
    "merged_count",
    "pair_histogram",
    "pair_totals",
    "percent_of",
    "pick_ranked",
    "pick_spread",
    "round_percent",
    "state_at",
    "state_intervals",
    "stepped_dates",
    "steps",
    "top_with_ties",
    "transition",
    "zip_lists",
]

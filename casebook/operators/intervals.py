"""State timelines.

A timeline is one row per state change: (entity, ts, state). The next row of
the same entity closes the interval, so the state holds on [ts, next_ts).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions._util import as_col
from casebook.operators.sequence import along


def state_intervals(
    df: DataFrame,
    entity: str,
    ts: str,
    state: str,
    tiebreak: Sequence[str] = (),
    next_state: str | None = "next_plan",
    next_ts: str | None = "next_date",
    method: str = "split",
) -> DataFrame:
    """Add the next state and the next change time per entity (LEAD)."""
    lead = {}
    if next_state:
        lead[next_state] = state
    if next_ts:
        lead[next_ts] = ts
    return along(df, [entity], [ts, *tiebreak], lead=lead, method=method)


def state_at(at, start: str = "start_date", next_: str = "next_date", closed: str = "neither") -> Column:
    """The interval [start, next) holds the instant ``at``; an open last interval never ends.

    ``closed="neither"`` is strict on both sides (start < at < next), as the
    source query; a change exactly on ``at`` then counts in neither state.
    ``closed="left"`` is the usual [start, next).
    """
    a = as_col(at) if not isinstance(at, str) else F.lit(at)
    s, n = as_col(start), as_col(next_)
    lower = (s < a) if closed == "neither" else (s <= a)
    if closed not in ("neither", "left"):
        raise ValueError("closed must be 'neither' or 'left'")
    return lower & (n.isNull() | (a < n))


def transition(state_col: str, next_col: str, frm, to) -> Column:
    """This state is ``frm`` and the next one is ``to``."""
    return (F.col(state_col) == F.lit(frm)) & (F.col(next_col) == F.lit(to))

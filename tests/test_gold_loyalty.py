"""J01-J12 on the loyalty fixtures against the published answers."""

import datetime as dt

import pytest
from conftest import rows, sortkey_sorted

from casebook.plans import loyalty
from casebook.sources import fixtures as fx


@pytest.fixture(scope="module")
def data(spark):
    return fx.sales(spark), fx.menu(spark), fx.members(spark)


def test_spend_per_customer(data):
    s, m, _ = data
    assert rows(loyalty.spend_per_customer(s, m)) == [("A", 76), ("B", 74), ("C", 36)]


def test_visit_days(data):
    s, _, _ = data
    assert rows(loyalty.visit_days(s)) == [("A", 4), ("B", 6), ("C", 2)]


def test_first_item_keeps_ties_and_duplicates(data):
    s, m, _ = data
    assert rows(loyalty.first_item(s, m)) == sortkey_sorted(
        [("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen"), ("C", "ramen")])


def test_top_item(data):
    s, m, _ = data
    assert rows(loyalty.top_item(s, m)) == [("ramen", 8)]


def test_favourite_item(data):
    s, m, _ = data
    assert rows(loyalty.favourite_item(s, m)) == sortkey_sorted(
        [("A", "ramen"), ("B", "ramen"), ("B", "sushi"), ("B", "curry"), ("C", "ramen")])


def test_first_after_join(data):
    s, m, mb = data
    assert rows(loyalty.first_after_join(s, m, mb)) == [("A", "curry"), ("B", "sushi")]


def test_last_before_join(data):
    s, m, mb = data
    assert rows(loyalty.last_before_join(s, m, mb)) == sortkey_sorted([("A", "sushi"), ("A", "curry"), ("B", "sushi")])


def test_pre_join_totals(data):
    s, m, mb = data
    assert rows(loyalty.pre_join_totals(s, m, mb)) == [("A", 2, 25), ("B", 3, 40)]


def test_points(data):
    s, m, _ = data
    assert rows(loyalty.points(s, m)) == [("A", 860), ("B", 940), ("C", 360)]


def test_bonus_window_points_includes_day_seven(data):
    s, m, mb = data
    # B's purchase on join date + 7 (2021-01-16) is doubled: 940, not 820.
    assert rows(loyalty.bonus_window_points(s, m, mb)) == [("A", 1370), ("B", 940)]


JOIN_ALL_GOLD = [
    ("A", "2021-01-01", "sushi", 10, "N"), ("A", "2021-01-01", "curry", 15, "N"),
    ("A", "2021-01-07", "curry", 15, "Y"), ("A", "2021-01-10", "ramen", 12, "Y"),
    ("A", "2021-01-11", "ramen", 12, "Y"), ("A", "2021-01-11", "ramen", 12, "Y"),
    ("B", "2021-01-01", "curry", 15, "N"), ("B", "2021-01-02", "curry", 15, "N"),
    ("B", "2021-01-04", "sushi", 10, "N"), ("B", "2021-01-11", "sushi", 10, "Y"),
    ("B", "2021-01-16", "ramen", 12, "Y"), ("B", "2021-02-01", "ramen", 12, "Y"),
    ("C", "2021-01-01", "ramen", 12, "N"), ("C", "2021-01-01", "ramen", 12, "N"),
    ("C", "2021-01-07", "ramen", 12, "N"),
]
RANK_GOLD = [None, None, 1, 2, 3, 3, None, None, None, 1, 2, 3, None, None, None]


def _dated(r):
    return (r[0], dt.date.fromisoformat(r[1]), *r[2:])


def test_join_all(data):
    s, m, mb = data
    assert rows(loyalty.join_all(s, m, mb)) == sortkey_sorted([_dated(r) for r in JOIN_ALL_GOLD])


def test_rank_members(data):
    s, m, mb = data
    expected = sortkey_sorted([(*_dated(r), k) for r, k in zip(JOIN_ALL_GOLD, RANK_GOLD)])
    assert rows(loyalty.rank_members(s, m, mb)) == expected

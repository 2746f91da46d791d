"""Dirty-text cleaning and list parsing."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions._util import as_col

# The sentinel spellings that mean "no value" in the delivery
# data. ``NaN`` is guarded for extras and cancellation but not for exclusions.
EXCLUSION_SENTINELS = ("", "null")
EXTRA_SENTINELS = ("", "null", "NaN")
CANCELLATION_SENTINELS = ("null", "NaN", "")
MISSING_SENTINELS = ("null",)


def null_sentinels(col, sentinels: Iterable[str]) -> Column:
    """Map sentinel strings to NULL; a real NULL stays NULL."""
    c = as_col(col)
    values = list(sentinels)
    return F.when(~c.isin(values), c)


def strip_units(col, data_type: str = "decimal(10,2)", sentinels: Iterable[str] = MISSING_SENTINELS) -> Column:
    """L2: drop lower-case unit words ('km', 'mins') and cast to a number.

    Sentinels become NULL first, so the ANSI cast never sees them. The blank
    left by '23.4 km' is trimmed before the cast.
    """
    cleaned = null_sentinels(col, sentinels)
    return F.trim(F.regexp_replace(cleaned, "[a-z]+", "")).cast(data_type)


def parse_int_list(col, sep: str = ", ", element_type: str = "int") -> Column:
    """C3 + C5: '1, 2, 3' -> array<int>. NULL stays NULL.

    ``split`` takes a regex, so the separator is escaped. Cast the array, not
    the exploded element (a generator nested in a cast is refused).
    """
    return F.split(as_col(col), re.escape(sep)).cast(f"array<{element_type}>")


def list_length(col, sep: str = ", ") -> Column:
    """Number of elements of a text list, NULL for NULL.

    The NULL guard is explicit: ``size(NULL)`` is -1 when a session runs
    with ANSI mode off.
    """
    c = as_col(col)
    return F.when(c.isNotNull(), F.size(F.split(c, re.escape(sep))))

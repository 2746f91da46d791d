"""Multi-valued text columns.

A cell like '1, 5' is a list of ids. Jobs explode it, join a dictionary and
fold names back into text. Labels that depend on list contents are computed
once per *distinct* combination and joined back (null-safe), so no row id is
needed, identical rows share one computation and the fold never groups more
than one combination's elements.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.text import parse_int_list


def explode_list(
    df: DataFrame,
    col: str,
    out: str,
    sep: str = ", ",
    element_type: str = "int",
    outer: bool = False,
    keep: Sequence[str] | None = None,
    position: str | None = None,
) -> DataFrame:
    """One row per list element. NULL (or no list) gives no row unless ``outer``."""
    arr = parse_int_list(col, sep, element_type) if element_type != "string" else F.split(F.col(col), re.escape(sep))
    kept = [F.col(c) for c in (keep if keep is not None else [c for c in df.columns if c != col])]
    if position:
        gen = F.posexplode_outer(arr) if outer else F.posexplode(arr)
        return df.select(*kept, gen.alias(position, out))
    gen = F.explode_outer(arr) if outer else F.explode(arr)
    return df.select(*kept, gen.alias(out))


def zip_lists(df: DataFrame, a: str, b: str, out_a: str, out_b: str, sep: str = ", ",
              element_type: str = "int", keep: Sequence[str] | None = None) -> DataFrame:
    """Unnest two lists side by side, the shorter padded with NULL.

    Two independent explodes would give their product; ``arrays_zip`` pairs
    elements by position. A NULL list counts as empty, and a row whose lists
    are both empty still yields one all-NULL pair (outer semantics).
    """
    kept = [F.col(c) for c in (keep if keep is not None else [c for c in df.columns if c not in (a, b)])]
    empty = F.array().cast(f"array<{element_type}>")
    la = F.coalesce(parse_int_list(a, sep, element_type), empty)
    lb = F.coalesce(parse_int_list(b, sep, element_type), empty)
    zipped = F.arrays_zip(la.alias(out_a), lb.alias(out_b))
    return df.select(*kept, F.inline_outer(zipped))

"""Column-level helpers (pure ``pyspark.sql.functions`` compositions).

Everything here returns a ``Column`` and stays inside whole-stage codegen; no
Python UDF is involved.
"""

from casebook.functions.numeric import (
    bucket_label,
    counted_random,
    exact_round_ratio,
    random_fraction,
    random_level,
    random_rating,
    stable_rating,
    width_bucket,
)
from casebook.functions.text import (
    list_length,
    null_sentinels,
    parse_int_list,
    strip_units,
)
from casebook.functions.timefn import (
    elapsed_minutes,
    elapsed_seconds,
    week_of_month,
    weekday_name,
)

__all__ = [
    "bucket_label",
    "counted_random",
    "elapsed_minutes",
    "elapsed_seconds",
    "exact_round_ratio",
    "list_length",
    "null_sentinels",
    "parse_int_list",
    "random_fraction",
    "random_level",
    "random_rating",
    "stable_rating",
    "strip_units",
    "week_of_month",
    "weekday_name",
    "width_bucket",
]

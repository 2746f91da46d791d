"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions._util import as_col


def exact_round_ratio(num, den, scale: int = 2, wide: bool = False) -> Column:
    """round(num / den, scale), half away from zero, computed exactly.

    ``num`` and ``den`` are integral columns and ``den > 0``. Rounding a
    double (or a decimal already rounded at a finer scale) can land on the
    wrong side of a .xx5 boundary; integer division cannot. Result type is
    decimal(38, scale). NULL in, NULL out; a zero denominator gives NULL.
    ``wide`` takes numbers beyond 64 bits (decimal(38,0)); the quotient itself must fit 64 bits.
    """
    whole = "decimal(38,0)" if wide else "long"
    n = as_col(num).cast(whole)
    d = as_col(den).cast(whole)
    factor = 10 ** scale
    digits = "decimal(38,0)" if wide else "decimal(20,0)"
    # Integer division: a decimal quotient would be rounded to a few places before the floor.
    doubled = F.abs(n).cast(digits) * F.lit(2 * factor).cast("decimal(12,0)") + d.cast(digits)
    q = F.call_function("div", doubled, d.cast(digits) * F.lit(2).cast("decimal(1,0)"))
    signed = F.when(n < 0, -q).otherwise(q)
    out = (signed.cast("decimal(38,0)") / F.lit(factor).cast("decimal(38,0)")).cast(f"decimal(38,{scale})")
    return F.when(d > 0, out)


def width_bucket(x, lo, hi, n: int) -> Column:
    """M6: equal-width bucket number; below lo -> 0, at or above hi -> n + 1."""
    return F.width_bucket(as_col(x).cast("double"), F.lit(lo).cast("double"), F.lit(hi).cast("double"), F.lit(n))


def bucket_label(bucket, width: int, lo: int = 0) -> Column:
    """The label of a histogram bucket that starts at ``lo + (b - 1) * width`` ('0-30', '360-390', '-30-0')."""
    b = as_col(bucket).cast("long")
    low = F.lit(lo) + (b - 1) * width
    return F.concat(low.cast("string"), F.lit("-"), (low + width).cast("string"))


def counted_random(seed, *keys) -> Column:
    """M5: 52 random bits of (seed, keys) as a long: the first 13 hex digits of the md5 of 'seed:key:key...'.

    A counter-based generator: the number belongs to the row's keys, so it does not depend on how rows are
    partitioned or ordered, a retried task draws it again, and any SQL engine with md5 gives the same bits. NULL keys count as '~'.
    """
    text = [F.lit(str(seed)), *[F.coalesce(as_col(k).cast("string"), F.lit("~")) for k in keys]]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *text)), 1, 13), 16, 10).cast("long")


def random_fraction(seed, *keys) -> Column:
    """M5: RANDOM(), a double in [0, 1) for the row's keys."""
    return counted_random(seed, *keys) / F.lit(float(1 << 52))


def random_level(levels: int, seed, *keys) -> Column:
    """M4 + M5: CEIL(RANDOM() * levels), 1 to ``levels`` alike often; whole numbers only, ``levels`` up to 2048."""
    return (F.shiftright(counted_random(seed, *keys) * levels, 52) + 1).cast("int")


def stable_rating(order_id, runner_id, levels: int = 5, seed="rating") -> Column:
    """A random but repeatable 1..levels score per delivery."""
    return random_level(levels, seed, order_id, runner_id)


def random_rating(seed: int, levels: int = 5) -> Column:
    """M4 + M5 as written in the source: ceil(random() * levels), seeded.

    The value of a row depends on how the data is partitioned, so a re-run
    on other partitions gives other ratings; ``stable_rating`` does not.
    """
    return F.greatest(F.lit(1), F.ceil(F.rand(seed) * levels)).cast("int")

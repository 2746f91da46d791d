"""Mixing sources to target weights by systematic sampling (operator 6, native).

Every document of a source has the same expected number of copies,
``target / source_size``. Within a source the documents are laid out by (size, id);
the running sum of expected copies plus one random offset of the source crosses an
integer boundary once for each copy. The sizes are sorted, so the words taken from a
source differ from its target by about one long document at most.

Defined results: a null text has size 0; a null source is a source of its own, last;
sources of size 0 have target 0 and give nothing; repeated rows are rows of their own;
ties in (size, id) get any order, which changes no row's values but those of equal
rows; an empty table gives an empty result. Columns of the input whose names clash
with the result's are left out of ``mix`` and kept by ``emit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm._common import WORD, cut, row_numbers

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2


def word_count(text: Column) -> Column:
    """Words of a whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _numbered_sources(sizes: DataFrame) -> DataFrame:
    """One row for each source: its place by code point (from 0, null last) and its size."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    keyed = sources.withColumn("_null", F.col("source").isNull().cast("int")).withColumn("_one", F.lit(0))
    return row_numbers(keyed, "_one", ["_null", "source"], "_place", "mix-sources").drop("_one", "_null")


def _level(sources: DataFrame, share: float, cap: int) -> float:
    """The water level: targets are ``least(cap * size, level * weight)``.

    Each step fixes the sources above their cap and shares the rest by weight; the
    fixed set only grows, so the loop ends. Every step brings one row to the driver.
    """
    whole = sources.agg(F.sum("source_size").alias("s"), F.sum("_weight").alias("w")).first()
    total, level, capped = share * (whole.s or 0), 0.0, -1
    if not whole.w:
        return 0.0
    level = total / whole.w
    while True:
        over = F.lit(float(cap)) * F.col("source_size") < F.lit(level) * F.col("_weight")
        r = sources.agg(
            F.count_if(over).alias("n"),
            F.sum(F.when(over, F.col("source_size")).otherwise(0)).alias("s"),
            F.sum(F.when(over, 0).otherwise(F.col("_weight"))).alias("w"),
        ).first()
        if r.n == capped or not r.w:
            return level
        capped, level = r.n, (total - cap * r.s) / r.w


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, _place) for each source of ``sizes`` (source, size)."""
    sources = _numbered_sources(sizes)
    cycle = F.array(*[F.lit(w) for w in weights])
    weight = F.get(cycle, ((F.col("_place") - 1) % len(weights)).cast("int"))
    sources = cut(sources.withColumn("_weight", weight), "mix-weights")  # one row per source, read by each step below
    level = _level(sources, share, cap)
    target = F.least(F.lit(float(cap)) * F.col("source_size"), F.lit(level) * F.col("_weight"))
    return sources.withColumn("target", target).drop("_weight", "_docs")


def _offset(source: Column, seed: str) -> Column:
    """One number in [0, 1) for each source, from a hash of its name: reruns agree."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int], share: float,
           cap: int, seed: str, whole_rows: bool) -> DataFrame:
    sizes = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_rows else []),
    )
    if not whole_rows:
        sizes = cut(sizes, "mix-sizes")
    sources = cut(targets(sizes, weights, share, cap).withColumnRenamed("source", "_source"), "mix-targets")
    rows = sizes.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    ranked = row_numbers(rows, "_place", ["size", "id"], "_rank", "mix-ranks")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = lambda k: F.floor(F.col("_u") + F.col("_rate") * k)
    return (
        ranked.withColumn("_rate", rate).withColumn("_u", _offset(F.col("source"), seed))
        .withColumn("copies", (at(F.col("_rank")) - at(F.col("_rank") - 1)).cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_place", "_rank", "_rate", "_u")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: str = "mix",
) -> DataFrame:
    """One row for each document: id, source, size, source_size, target, copies and taken words."""
    return _mixed(docs, id_col, text_col, source_col, weights, share, cap, seed, False).withColumnRenamed("id", id_col)


def emit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: str = "mix",
) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as its copies, with its own columns only."""
    mixed = _mixed(docs, id_col, text_col, source_col, weights, share, cap, seed, True)
    return (
        mixed.where("copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    )

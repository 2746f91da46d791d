"""Small helpers shared by the operators: shipping code, word rules, sorted row numbers."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.session import ensure_checkpoint_dir
from casebook.sources.sinks import freeze

# A word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "by_value", "lean", "warm_heap", "table", "cut", "shared_folder", "row_numbers", "shuffle_partitions"]


def by_value(module: str) -> None:
    """Ship a module's functions inside the task closures: executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def lean(run):
    """A task's function over batches that gives its memory back at the end: Python workers live on between tasks,
    and what their allocators keep would add up in an executor from stage to stage."""
    def over(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return over


def warm_heap() -> None:
    """For tasks that make arrays of up to some megabytes over and over: freeing one untouched block of 31 MB raises glibc's thresholds
    (mmap to 31 MB, trim to twice that), so later blocks come from memory the process has, not from the system page by page."""
    import numpy as np

    np.empty(31 << 20, np.uint8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table. Spark's reader only: the folder may be in a store that nothing else reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: the lineage ends there."""
    return freeze(df, name)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name inside the shared folder that every executor sees."""
    return os.path.join(ensure_checkpoint_dir(spark), name, uuid.uuid4().hex)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def row_numbers(df: DataFrame, group: str, order: Sequence[str], out: str, name: str) -> DataFrame:
    """``out``: 1, 2, ... within ``group`` by ``order``, without a task that holds a whole group.

    The rows are range-partitioned by (group, order), so a group with a third of all
    rows spans many tasks. Each partition numbers its sorted rows by itself; one count
    for each (partition, group) shifts these numbers. The numbered rows are written
    once, so both readers see the same partitions. ``group`` must not be null.
    """
    spark = df.sparkSession
    keys = [group, *order]
    numbered = cut(
        df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()),
        name,
    ).withColumn("_pid", F.shiftright("_at", 33))
    counts = numbered.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_pid", group, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        numbered.join(shifts, ["_pid", group])
        .withColumn(out, F.col("_at") - F.col("_first") + F.col("_before") + F.lit(1))
        .drop("_pid", "_at", "_first", "_before")
    )

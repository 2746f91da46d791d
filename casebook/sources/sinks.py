"""Sinks: append (S3), replace (S4) and freeze a result for reuse.

``append`` and ``replace`` change a stored table (``casebook.sources.store``) in one step. ``freeze`` writes
into the cluster's shared checkpoint folder (``spark.checkpoint.dir``) and
reads the files back, which cuts the lineage: later stages restart from the
files, not from the inputs, and a lost executor costs a re-read instead of a
recomputation. Never a machine-local folder on a cluster. Frozen files are removed when the driver ends.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from casebook.session import ensure_checkpoint_dir
from casebook.sources.files import Folder
from casebook.sources.store import StoredTable


def append(df: DataFrame, path: str, batch: str | None = None) -> int:
    """S3: add rows to a stored table (INSERT INTO), once for each ``batch`` id; the table's version."""
    return StoredTable(df.sparkSession, path).append(df, batch)


def replace(df: DataFrame, path: str, expected: int | None = None) -> int:
    """Drop and re-create (DROP TABLE IF EXISTS + CREATE TABLE AS) in one step; ``df`` may read the table."""
    return StoredTable(df.sparkSession, path).replace(df, expected=expected)


def read_back(df_like: DataFrame, path: str) -> DataFrame:
    """The stored table's rows with the columns of ``df_like``."""
    return StoredTable(df_like.sparkSession, path).read().select(*df_like.columns)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, removed when the driver ends."""
    path = os.path.join(ensure_checkpoint_dir(spark), "frozen", f"{name}-{uuid.uuid4().hex}")
    Folder(spark, path).delete_on_exit()
    return path


def freeze(df: DataFrame, name: str | None = None) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder and read it back.

    Use it for a result that several later steps read, or one whose inputs are expensive to recompute. Tables that
    several jobs share are better leased from ``casebook.sources.temp_tables``.
    """
    spark = df.sparkSession
    path = new_folder(spark, name or "result")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

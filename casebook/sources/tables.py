"""Scans of the generated parquet tables.

Every scan declares its schema, so no footer inference job runs, and Catalyst
prunes columns and pushes filters into the parquet reader for whatever the
job later selects.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from casebook.sources.schemas import GENERATED


class Tables:
    """Lazy accessor for the tables under one scale-factor folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def __call__(self, name: str) -> DataFrame:
        reader = self.spark.read
        schema = GENERATED.get(name)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self(name)

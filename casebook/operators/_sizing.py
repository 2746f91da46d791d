"""Partition counts and size checks from the optimizer's own statistics."""

from __future__ import annotations

import logging
import math
import re

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame

_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
          "t": 1 << 40, "tb": 1 << 40}
log = logging.getLogger(__name__)


def parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS.get(m.group(2).lower() or "b", 1)


def scanned_bytes(df: DataFrame) -> int | None:
    """Sum of the leaf relations' sizes in the optimized plan (what the job reads).

    Join estimates without CBO multiply their inputs, so the leaves are a
    steadier measure of the data volume than the root's estimate. None if a leaf
    has no statistics (an RDD, a Python list reports ``spark.sql.defaultSizeInBytes``)
    or the plan cannot be read; the reason is logged.
    """
    spark = df.sparkSession
    unknown = int(spark.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
        total = 0
        while leaves.hasNext():
            size = int(str(leaves.next().stats().sizeInBytes()))
            if size >= unknown:
                log.info("a leaf of the plan has no statistics; spark.sql.shuffle.partitions decides")
                return None
            total += size
        return total
    except Py4JError as e:
        log.warning("no statistics for the plan (%s); spark.sql.shuffle.partitions decides", e)
        return None


def partitions_for(df: DataFrame, minimum: int | None = None) -> int:
    """One partition per core at least, and enough partitions of
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` for the scanned bytes.

    The floor is the cluster's default parallelism (every core busy), not
    ``spark.sql.shuffle.partitions``: an explicit-count range exchange is
    never coalesced by AQE, so a large fixed count would stay large on
    small inputs.
    """
    spark = df.sparkSession
    floor = minimum or max(1, spark.sparkContext.defaultParallelism)
    target = parse_bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
    size = scanned_bytes(df)
    if size is None:
        return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return max(floor, math.ceil(size / target))

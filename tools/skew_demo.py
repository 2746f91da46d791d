"""Reproduce the skew table of the README: LEAD + ROW_NUMBER with one hot key.

Usage: python tools/skew_demo.py [rows]   (default 3,000,000)

A third of the rows belong to one key. The synthetic timeline is written to a
fresh scratch folder, then both strategies of ``along`` run twice each
(the second round is warm) and must agree.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from casebook.operators import along  # noqa: E402
from casebook.session import build_session  # noqa: E402


def main(argv):
    n = int(argv[1]) if len(argv) > 1 else 3_000_000
    spark = build_session(shuffle_partitions=16)
    folder = tempfile.mkdtemp(prefix="casebook-skew-")
    spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100000 + 1).alias("customer_id"),
        (F.col("id") * 7919 % 1000003).alias("ts"),
        F.col("id").alias("event_id"),
        (F.col("id") % 5).cast("int").alias("plan_id"),
    ).write.parquet(os.path.join(folder, "timeline"))
    df = spark.read.parquet(os.path.join(folder, "timeline"))
    results = {}
    for rnd in range(2):
        for method in ("window", "split"):
            out = along(df, ["customer_id"], ["ts", "event_id"], lead={"next_plan": "plan_id"}, row_number="rn",
                        method=method)
            t0 = time.perf_counter()
            check = tuple(out.agg(F.sum("rn"), F.count("next_plan")).first())
            print(f"round {rnd} {method:6s} {time.perf_counter() - t0:6.2f}s  check={check}", flush=True)
            results.setdefault(method, set()).add(check)
    assert results["window"] == results["split"], results
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

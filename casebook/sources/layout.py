"""Tables laid out by a shared key, so that joins on it need no shuffle.

Most jobs join the two fact tables on the order key. ``co_locate`` writes such tables once as bucketed Parquet, all with the same
number of buckets by the same key, and records the layout in a small table beside them; ``open_layout`` makes it known to a session
(external tables in its catalog) and gives a :class:`LaidOut` that reads like ``Tables``. Views and jobs take it
unchanged, and Spark plans their joins and groupings on the key without an exchange.

* A layout belongs to one state of its source files. A table whose files have changed is read from its source again.
* A bucket is one task, and a bucketed side cannot be split at run time. So rows per bucket are counted before anything is written
  (partial counts, one row a bucket); if the fullest would hold more than ``SKEW`` times the mean and more than ``SMALL`` bytes, the table
  keeps its plain form, whose joins AQE splits at a hot key.
* ``spark.casebook.layout.dir`` names a folder whose layouts :func:`tables_for` uses by itself when there is one for the tables.
"""

from __future__ import annotations

import hashlib
import logging
import math
import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators._sizing import parse_bytes, scanned_bytes
from casebook.session import ensure_checkpoint_dir
from casebook.sources.files import Folder, snapshot
from casebook.sources.tables import Tables

log = logging.getLogger(__name__)

ORDER_KEY = {"lineitem": "l_orderkey", "orders": "o_orderkey"}
BUCKET_BYTES = 320 << 20  # of the largest table, as rows in memory: a task sorts its bucket without spilling
SKEW = 4.0
SMALL = 1 << 30  # bytes of a bucket that any task can take
CONF = "spark.casebook.layout.dir"
_RECORD = "record"
_FIELDS = "name string, key string, buckets int, rows long, fullest long, schema string, source string, snapshot string"


@dataclass(frozen=True)
class Laid:
    """One table of a layout: ``buckets`` is 0 if it kept its plain form."""

    name: str
    key: str
    buckets: int
    rows: int
    fullest: int
    schema: str
    source: str
    snapshot: str


def bucket_counts(df: DataFrame, key: str, buckets: int) -> list[int]:
    """Rows of each bucket as Spark deals them: partial counts, at most ``buckets`` rows to the driver."""
    found = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).count().collect()
    return [r["count"] for r in found]


def row_bytes(df: DataFrame) -> int:
    """A row of ``df`` in a sort's memory, as Spark's own default sizes put it: null bits, a field of 8 bytes each, texts behind them, and its entry."""
    sizes = [f.dataType().defaultSize() for f in df._jdf.schema().fields()]
    return 8 * -(-len(sizes) // 64) + sum(8 + x if x > 8 else 8 for x in sizes) + 32


def bucket_number(t: Tables, keys: Mapping[str, str]) -> int:
    """A power of two, one bucket a core at least, and BUCKET_BYTES of rows in memory a bucket of the largest table. The files' bytes don't tell:
    they are encoded and compressed, a fifth of the rows in memory or less."""
    largest = max(t(name).count() * row_bytes(t(name)) for name in keys)
    want = max(t.spark.sparkContext.defaultParallelism, largest // BUCKET_BYTES + 1)
    return 1 << math.ceil(math.log2(want))


def _table_name(folder: str, name: str) -> str:
    return f"casebook_{hashlib.sha256(folder.encode()).hexdigest()[:16]}_{name}"


def co_locate(t: Tables, folder: str, keys: Mapping[str, str] = ORDER_KEY, buckets: int | None = None) -> LaidOut:
    """Writes the tables ``keys`` of ``t`` by their keys below ``folder`` and opens the layout."""
    n = buckets or bucket_number(t, keys)
    laid = []
    for name, key in keys.items():
        now, df = snapshot(t.spark, [t.path(name)]), t(name)
        counts = bucket_counts(df, key, n)
        rows, fullest = sum(counts), max(counts, default=0)
        scanned = (scanned_bytes(df) or 0) / max(rows, 1)
        hot = fullest > SKEW * rows / n and fullest * scanned > SMALL
        if hot:
            log.warning("%s is not laid out by %s: %d of %d rows would be in one of %d buckets", name, key, fullest, rows, n)
        else:
            writer = df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key)
            table = _table_name(folder, name)
            t.spark.sql(f"DROP TABLE IF EXISTS {table}")
            writer.option("path", os.path.join(folder, name)).format("parquet").saveAsTable(table)
        laid.append(Laid(name, key, 0 if hot else n, rows, fullest, ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), t.path(name), now))
    # The record comes last: a folder without it is no layout.
    t.spark.createDataFrame([tuple(vars(x).values()) for x in laid], _FIELDS).coalesce(1).write.mode("overwrite").parquet(
        os.path.join(folder, _RECORD))
    return open_layout(t.spark, folder)


def open_layout(spark: SparkSession, folder: str) -> LaidOut:
    """The layout recorded in ``folder``; its tables become external tables of the session's catalog if they are not yet."""
    laid = [Laid(**r.asDict()) for r in spark.read.parquet(os.path.join(folder, _RECORD)).collect()]
    for x in laid:
        if x.buckets:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {_table_name(folder, x.name)} ({x.schema}) USING parquet "
                      f"CLUSTERED BY (`{x.key}`) SORTED BY (`{x.key}`) INTO {x.buckets} BUCKETS LOCATION '{os.path.join(folder, x.name)}'")
    return LaidOut(spark, folder, laid)


class LaidOut(Tables):
    """Tables of which some are read by their layout, as long as it has the state of their sources."""

    def __init__(self, spark: SparkSession, folder: str, laid: list[Laid]):
        super().__init__(spark, os.path.dirname(laid[0].source))
        self.folder = folder
        self.laid = {x.name: x for x in laid}
        self._fresh: dict[str, bool] = {}

    def by_layout(self, name: str) -> bool:
        """Whether ``name`` is read by its layout; its source's state is looked up once."""
        if name not in self._fresh:
            x = self.laid.get(name)
            self._fresh[name] = x is not None and x.buckets > 0 and x.snapshot == snapshot(self.spark, [x.source])
        return self._fresh[name]

    def __call__(self, name: str) -> DataFrame:
        return self.spark.table(_table_name(self.folder, name)) if self.by_layout(name) else super().__call__(name)

    def remove(self) -> None:
        """Drops the tables and their files."""
        for name in self.laid:
            self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(self.folder, name)}")
        Folder(self.spark, self.folder).delete()
        self._fresh = dict.fromkeys(self.laid, False)


def _home(root: str) -> str:
    return hashlib.sha256(root.rstrip("/").encode()).hexdigest()[:16]


def tables_for(spark: SparkSession, root: str) -> Tables:
    """The tables of ``root``, by their layout if the folder ``spark.casebook.layout.dir`` has one, else plain."""
    home = spark.conf.get(CONF, None)
    if home:
        folder = os.path.join(home, _home(root))
        if Folder(spark, folder).exists(f"{_RECORD}/_SUCCESS"):
            return open_layout(spark, folder)
    return Tables(spark, root)


_SESSION: dict[tuple[str, str], LaidOut] = {}


def session_layout(spark: SparkSession, root: str, keys: Mapping[str, str] = ORDER_KEY) -> LaidOut:
    """A layout of ``root`` for this session: the recorded one, or one written below the shared folder by the first job that asks."""
    t = tables_for(spark, root)
    if isinstance(t, LaidOut) and all(t.by_layout(n) for n in keys):
        return t
    at = (spark.sparkContext.applicationId, root)
    found = _SESSION.get(at)
    if found is not None:
        found = LaidOut(spark, found.folder, list(found.laid.values()))
        if all(found.by_layout(n) or not found.laid[n].buckets for n in keys):
            return found
    folder = os.path.join(ensure_checkpoint_dir(spark), "layout", f"{at[0]}-{_home(root)}-{len(_SESSION)}")
    Folder(spark, folder).delete_on_exit()
    _SESSION[at] = co_locate(t, folder, keys)
    return _SESSION[at]

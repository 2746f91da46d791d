"""Neighbours along an ordered sequence per key: LEAD, LAG, ROW_NUMBER.

``along`` is the single entry point every timeline job uses. It has two
physical strategies with identical results:

``window``
    ``Window.partitionBy(keys).orderBy(order)``: one hash exchange on the
    keys, and every row of a key is sorted in one task.

``split`` (default)
    Skew-proof. The rows are range-partitioned on (keys, order), the way a
    global sort is, so a key holding a third of all rows is cut across many
    partitions. Each partition computes neighbours locally, streaming its
    Arrow batches through ``mapInArrow``: columns pass through untouched (any date,
    any 64-bit number), only keys and looked-up columns are worked on. What crosses partition borders
    is one summary row per partition (first row, last row, size of the last
    key run), computed by JVM aggregates over the same sorted exchange. That
    fix-up table is bounded by the partition count, so it is broadcast. No
    task ever holds more than one range partition.

``order`` must make the order total within a key (add a tiebreak column);
rows tied on every order column must agree on the looked-up columns.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.operators._sizing import partitions_for
from casebook.sources.sinks import freeze

# The local pass runs in Python workers. Shipping this module's functions by
# value means executors need pyarrow and numpy, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PID = "_seq_pid"
_FIRST = "_seq_is_first"
_LAST = "_seq_is_last"
_FIRST_RUN = "_seq_first_run"
_RN = "_seq_rn"


def keep(df: DataFrame, name: str = "sequence") -> DataFrame:
    """One evaluation of a range-partitioned pass for more than one consumer, in the shared checkpoint folder.

    Two reads of a range exchange may be planned as two exchanges that sample their bounds
    separately. The written pass has its partition numbers as a column, so every consumer agrees on
    them; the lineage ends there, and nothing stays cached in the session.
    """
    return freeze(df, name)


def along(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lead: dict[str, str] | None = None,
    lag: dict[str, str] | None = None,
    row_number: str | None = None,
    running: tuple[str, str] | None = None,
    method: str = "split",
    partitions: int | None = None,
) -> DataFrame:
    """Add LEAD(col, 1) / LAG(col, 1) / ROW_NUMBER() over (PARTITION BY keys ORDER BY order).

    ``lead`` and ``lag`` map output names to source columns. ``running=(out, column)`` adds the
    sum of ``column`` (whole, not negative, not NULL) over the key's rows up to the current one.
    """
    lead = dict(lead or {})
    lag = dict(lag or {})
    if row_number and running:
        raise ValueError("row_number or running, not both")
    if method == "window":
        return _along_window(df, list(keys), list(order), lead, lag, row_number, running)
    if method == "split":
        return _along_split(df, list(keys), list(order), lead, lag, row_number, running, partitions)
    raise ValueError(f"unknown method {method!r}")


def _along_window(df, keys, order, lead, lag, row_number, running):
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df
    for name, src in lead.items():
        out = out.withColumn(name, F.lead(src, 1).over(w))
    for name, src in lag.items():
        out = out.withColumn(name, F.lag(src, 1).over(w))
    if row_number:
        out = out.withColumn(row_number, F.row_number().over(w))
    if running:
        out = out.withColumn(running[0], F.sum(running[1]).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out


# ---------------------------------------------------------------------------
# split strategy
# ---------------------------------------------------------------------------

def _along_split(df, keys, order, lead, lag, row_number, running, partitions):
    base_cols = df.columns
    fields = {f.name: f for f in df.schema.fields}
    lead_src = list(dict.fromkeys(lead.values()))
    lag_src = list(dict.fromkeys(lag.values()))

    # Partitions must be consecutive ranges of (keys, order), in key order,
    # each sorted. An explicit-count range exchange gives that (AQE does not
    # coalesce it).
    n = partitions or partitions_for(df)
    sorted_df = (
        df.repartitionByRange(n, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(_PID, F.spark_partition_id())
    )

    # -- per-partition pass (Python, one pass, streaming) --------------------
    extra = [
        T.StructField(_FIRST, T.BooleanType(), False),
        T.StructField(_LAST, T.BooleanType(), False),
        T.StructField(_FIRST_RUN, T.BooleanType(), False),
        T.StructField(_RN, T.LongType(), False),
    ]
    extra += [T.StructField(f"_lead_{c}", fields[c].dataType, True) for c in lead_src]
    extra += [T.StructField(f"_lag_{c}", fields[c].dataType, True) for c in lag_src]
    out_schema = T.StructType(list(sorted_df.schema.fields) + extra)

    def local(batches):
        yield from local_neighbours(batches, keys, lead_src, lag_src, running[1] if running else None)

    # The rows and the per-partition summary must come from one evaluation
    # of one range exchange: two exchanges sample their bounds separately and
    # may cut the data differently. The local pass is therefore written once.
    local_df = keep(sorted_df.mapInArrow(local, out_schema))

    # -- per-partition summary: the first and the last row of each partition
    # (one scan of the written pass: at most two rows per partition survive
    # the filter, and each aggregate picks the one row it is flagged for)
    key_struct = F.struct(*[F.col(k) for k in keys])
    summary = (
        local_df.filter(F.col(_FIRST) | F.col(_LAST))
        .groupBy(_PID)
        .agg(
            F.max_by(F.struct(key_struct.alias("k"), *[F.col(c) for c in lead_src]), F.col(_FIRST).cast("int")).alias("first"),
            F.max_by(F.struct(key_struct.alias("k"), *[F.col(c) for c in lag_src]), F.col(_LAST).cast("int")).alias("last"),
            F.max(F.when(F.col(_LAST), F.col(_RN))).alias("last_run_n"),
        )
    )

    # One row per non-empty partition: the window below is bounded by the
    # partition count.
    wp = Window.orderBy(_PID)
    # A chain is a run of partitions sharing one last key K: its first member
    # may start K midway, every later member holds nothing but K. Within a
    # chain the running sum of last-run sizes counts K's rows so far, and a
    # partition starting with K continues from its predecessor's count.
    pure = F.col("first.k").eqNullSafe(F.col("last.k"))
    summary = (
        summary.withColumn("next_first", F.lead("first").over(wp))
        .withColumn("prev_last", F.lag("last").over(wp))
        .withColumn(
            "_brk",
            F.when(pure & F.col("prev_last.k").eqNullSafe(F.col("last.k")), F.lit(0)).otherwise(F.lit(1)),
        )
        .withColumn("_chain", F.sum("_brk").over(wp.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "_upto",
            F.sum("last_run_n").over(Window.partitionBy("_chain").orderBy(_PID).rowsBetween(Window.unboundedPreceding, 0)),
        )
        .withColumn("_prev_upto", F.lag("_upto").over(wp))
    )
    summary = summary.withColumn(
        "rn_offset",
        F.when(F.col("prev_last.k").eqNullSafe(F.col("first.k")), F.col("_prev_upto")).otherwise(F.lit(0)),
    )
    fixes = summary.select(
        _PID,
        F.col("next_first.k").eqNullSafe(F.col("last.k")).alias("_lead_ok"),
        F.col("prev_last.k").eqNullSafe(F.col("first.k")).alias("_lag_ok"),
        "rn_offset",
        *[F.col(f"next_first.{c}").alias(f"_fix_lead_{c}") for c in lead_src],
        *[F.col(f"prev_last.{c}").alias(f"_fix_lag_{c}") for c in lag_src],
    )

    joined = local_df.join(F.broadcast(fixes), _PID, "left")
    result = [F.col(c) for c in base_cols]
    for name, src in lead.items():
        fixed = F.when(F.col("_lead_ok"), F.col(f"_fix_lead_{src}"))
        result.append(F.when(F.col(_LAST), fixed).otherwise(F.col(f"_lead_{src}")).alias(name))
    for name, src in lag.items():
        fixed = F.when(F.col("_lag_ok"), F.col(f"_fix_lag_{src}"))
        result.append(F.when(F.col(_FIRST), fixed).otherwise(F.col(f"_lag_{src}")).alias(name))
    if row_number:
        offset = F.when(F.col(_FIRST_RUN), F.col("rn_offset")).otherwise(F.lit(0))
        result.append((F.col(_RN) + offset).cast("int").alias(row_number))
    if running:
        offset = F.when(F.col(_FIRST_RUN), F.col("rn_offset")).otherwise(F.lit(0))
        result.append((F.col(_RN) + offset).alias(running[0]))
    return joined.select(*result)


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Row by row equal, NULL equal to NULL (as in PARTITION BY), NaN equal to NaN."""
    equal = pc.fill_null(pc.equal(a, b), False)
    both = pc.and_(pc.is_null(a), pc.is_null(b))
    if pa.types.is_floating(a.type):
        both = pc.or_(both, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return np.asarray(pc.or_(equal, both))


def _shifted(column: pa.Array, edge: pa.Array, forward: bool, valid: np.ndarray) -> pa.Array:
    """The next (or previous) row's value, ``edge`` past the end, NULL where not ``valid``."""
    n = len(column)
    moved = pa.concat_arrays([column.slice(1), edge] if forward else [edge, column.slice(0, n - 1)])
    return pc.if_else(pa.array(valid), moved, pa.nulls(n, column.type))


def local_neighbours(batches, keys, lead_src, lag_src, weight=None):
    """Neighbours within one sorted partition, batch by batch (Arrow record batches).

    The running number counts rows, or adds up the column ``weight``. A batch waits until the next one shows the successor of its last row. The previous row and
    its running number carry across batches, as does whether the partition's first key run is
    still open. Exposed for unit tests.
    """
    wait = None          # (batch, its next row's one-row slice is still unknown)
    last = None          # one-row slice: the row before the current batch
    last_rn, first_run_open, first = 0, True, True

    def finish(batch, extra, following):
        n = batch.num_rows
        same_next = np.zeros(n, bool)
        if n > 1:
            same_next[:-1] = extra["same"][1:]
        if following is not None:
            same_next[-1] = _rows_same(batch.slice(n - 1), following, keys)
        columns = list(batch.columns)
        names = list(batch.schema.names)
        flags = np.zeros(n, bool)
        flags[0] = extra["first"]
        ends = np.zeros(n, bool)
        ends[-1] = following is None
        columns += [pa.array(flags), pa.array(ends), pa.array(extra["run"]), pa.array(extra["rn"])]
        names += [_FIRST, _LAST, _FIRST_RUN, _RN]
        for c in lead_src:
            column = batch.column(names.index(c))
            edge = following.column(names.index(c)) if following is not None else pa.nulls(1, column.type)
            columns.append(_shifted(column, edge, True, same_next))
        for c in lag_src:
            column = batch.column(names.index(c))
            edge = extra["before"].column(names.index(c)) if extra["before"] is not None else pa.nulls(1, column.type)
            columns.append(_shifted(column, edge, False, extra["same"]))
        out_names = names + [f"_lead_{c}" for c in lead_src] + [f"_lag_{c}" for c in lag_src]
        return pa.RecordBatch.from_arrays(columns, out_names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        if wait is not None:
            yield finish(*wait, batch.slice(0, 1))
        same = np.zeros(n, bool)
        if n > 1:
            same[1:] = _rows_same(batch.slice(1), batch.slice(0, n - 1), keys)
        same[0] = last is not None and bool(_rows_same(batch.slice(0, 1), last, keys)[0])
        run = np.cumsum(~same)
        starts = np.flatnonzero(~same)
        head = run == run[0] if same[0] else np.zeros(n, bool)
        size = np.ones(n, np.int64) if weight is None else np.asarray(
            batch.column(batch.schema.names.index(weight)).cast(pa.int64()))
        upto = np.cumsum(size)
        base = np.where(~same, upto - size, 0)
        rn = upto - np.maximum.accumulate(base)
        if same[0]:
            own = starts[0] if len(starts) else n
            rn[:own] += last_rn
        if last is None:
            open_run = run == run[0]
        else:
            open_run = head if first_run_open else np.zeros(n, bool)
        wait = (batch, {"same": same, "rn": rn.astype(np.int64), "run": open_run, "first": first, "before": last})
        first, first_run_open, last_rn, last = False, bool(open_run[-1]), int(rn[-1]), batch.slice(n - 1)
    if wait is not None:
        yield finish(*wait, None)


def _rows_same(a: pa.RecordBatch, b: pa.RecordBatch, keys) -> np.ndarray:
    out = np.ones(a.num_rows, bool)
    for k in keys:
        at = a.schema.names.index(k)
        out &= _same(a.column(at), b.column(at))
    return out

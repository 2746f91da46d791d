"""Exact top-k search by tiled matrix products (operator 10).

Vectors become whole numbers, floor(scale * x), and the score is their inner product. Rows are dealt into
candidate shards and query blocks of fixed size, packed as matrices. Every shard meets every query block once:
each block is sent to every run of ``RUN`` shards, and one task multiplies the block with the run's shards tile by
tile, selects the k best of each tile (a partial selection, not a sort) and merges them into the block's running top
list. The lists of the runs are merged per query by a ranked window, whose partial limit runs before its shuffle.

Products of whole numbers are exact in doubles while sums stay below 2^53; a tile that could go beyond is multiplied in
Python's integers. Scores outside a 64-bit integer are an error.

Defined results: vectors that are null, or hold null or non-finite components, take no part; vectors are only compared with
those of the same length (empty vectors with none); ties go to the smaller id; rows that share an id are candidates each by itself, and
a query skips all rows of its own id; an empty table or no query gives an empty result. Null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm._common import by_value, cut, lean

by_value(__name__)

BLOCK = 4096  # queries in a block
SHARD = 8192  # candidates in a shard
RUN = 16  # shards that one task merges for a block
FOUND = "query_id bigint, vec_id bigint, score bigint"


def usable(vec: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vec.isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, bad)


def _packer(size: int):
    """Rows (dim, id, vec) -> matrices of at most ``size`` rows of one dim: (dim, n, ids, data)."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            parts = wait.pop(dim)
            ids, data = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
                "ids": pa.array([ids.astype("<i8").tobytes()]), "data": pa.array([data.astype("<f8").tobytes()])})

        for batch in batches:
            dims = batch.column(0).to_numpy()
            ids, vecs = batch.column(1).to_numpy(), batch.column(2)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                data = vecs.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), dim)
                own = ids[rows]
                while len(own):
                    parts = wait.setdefault(dim, [])
                    room = size - sum(len(p[0]) for p in parts)
                    parts.append((own[:room], data[:room]))
                    own, data = own[room:], data[room:]
                    if sum(len(p[0]) for p in parts) == size:
                        yield out(dim)
        for dim in list(wait):
            yield out(dim)
    return run


def _matrix(row, scale: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(row["data"], "<f8").reshape(row["n"], row["dim"])
    return np.frombuffer(row["ids"], "<i8"), np.floor(data * scale)


def tile_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows: doubles while exact, else Python integers."""
    bound = q.shape[1] * (np.abs(q).max(initial=0) * np.abs(c).max(initial=0))
    if bound < 2.0**53:
        return q @ c.T
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object)
    return whole(q) @ whole(c).T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row by (score, smaller id); ``ids`` are per row or shared. -inf marks no candidate."""
    if ids.ndim == 1:
        if scores.shape[1] > 4 * k and scores.dtype != object:
            # The k-th best score bounds the choice; ties at it stay in, then the few left are sorted.
            kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
            rows, cols = np.nonzero(scores >= kth[:, None])
            count = np.bincount(rows, minlength=len(scores))
            width = int(count.max(initial=0))
            at = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            s, i = np.full((len(scores), width), -np.inf), np.zeros((len(scores), width), np.int64)
            s[rows, at], i[rows, at] = scores[rows, cols], ids[cols]
            scores, ids = s, i
        else:
            ids = np.broadcast_to(ids, scores.shape)
    order = np.argsort(ids, axis=1, kind="stable")
    scores, ids = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _merge(k: int, scale: int):
    @lean
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None  # (key, query ids, queries, scores, ids)

        def result() -> pd.DataFrame:
            _, ids, _, s, v = state
            real = np.array([[x != -np.inf for x in row] for row in s], bool).reshape(s.shape)
            rows, cols = np.nonzero(real)
            return pd.DataFrame({"query_id": ids[rows], "vec_id": v[rows, cols],
                                 "score": np.array([int(x) for x in s[rows, cols]], np.int64)})

        for batch in batches:
            for row in batch.to_dict("records"):
                key = (row["dim"], row["block"], row["run"])
                if state is None or state[0] != key:
                    if state is not None:
                        yield result()
                    if not row["is_query"]:
                        raise ValueError("a run's first row must be its query block")
                    ids, data = _matrix(row, scale)
                    state = (key, ids, data, np.zeros((len(ids), 0)), np.zeros((len(ids), 0), np.int64))
                if row["is_query"]:
                    continue
                key, ids, data, s, v = state
                cand, tile = _matrix(row, scale)
                scores = tile_scores(data, tile)
                own = ids[:, None] == cand[None, :]
                scores[own] = -np.inf
                ts, tv = best(scores, cand, k)
                state = (key, ids, data, *best(np.concatenate([s, ts], 1), np.concatenate([v, tv], 1), k))
        if state is not None:
            yield result()
    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each row where ``queries`` holds."""
    spark = vectors.sparkSession
    base = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col))).select(
        F.size(vec_col).alias("dim"), F.col(id_col).cast("long").alias("id"),
        F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(queries, F.lit(False)).alias("is_query"))
    packed = "dim int, n int, ids binary, data binary"
    number = F.monotonically_increasing_id()
    # Matrices are written once: their numbers must not change between their two uses.
    shards = cut(base.select("dim", "id", "vec").mapInArrow(_packer(SHARD), packed).withColumn("no", number), "topk-shards")
    asked = base.where("is_query").select("dim", "id", "vec")
    asked = asked.repartition(max(1, -(-asked.count() // BLOCK)))  # few blocks, filled, whatever the number of files
    blocks = cut(asked.mapInArrow(_packer(BLOCK), packed).withColumn("block", number), "topk-blocks")

    spread = max(1, -(-shards.count() // RUN))
    runs = shards.withColumn("run", F.pmod(F.xxhash64("no"), F.lit(spread)))
    by_block = blocks.select("dim", "block")
    left = runs.join(by_block, "dim").select("dim", "block", "run", F.lit(False).alias("is_query"), "n", "ids", "data")
    per_run = runs.select("dim", "run").distinct()
    right = blocks.join(per_run, "dim").select("dim", "block", "run", F.lit(True).alias("is_query"), "n", "ids", "data")
    keys = ["dim", "block", "run"]
    tasks = max(1, min(by_block.count() * spread, spark.sparkContext.defaultParallelism * 64))
    dealt = left.unionByName(right).repartition(tasks, *keys).sortWithinPartitions(*keys, F.desc("is_query"))
    found = dealt.mapInPandas(_merge(k, scale), FOUND)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

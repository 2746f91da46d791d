"""Centroid clustering over a vector-approximation file (operator 12).

Vectors become whole numbers, floor(scale * x), and go through Lloyd's rounds in exact arithmetic. They are written once as a
VA-file in blocks of ``BLOCK`` rows: every dimension's range is cut into ``2 ** BITS`` equal cells, a vector's cell numbers stand in
one byte string, its exact components in another. Each round works on a block as follows.

1. Lookup tables give, for each dimension, cell and centroid, the least and greatest squared difference that a component in
   that cell can have. Summing one table row per dimension gives a distance interval for every vector and centroid from the cells alone.
2. Centroids whose interval begins beyond the least upper end are out. Where one is left, the vector is assigned.
3. Only where intervals overlap, full vectors are fetched from the block and compared with the centroids that are left.

The update needs each cluster's exact sums: they are added up in the task, then by a grouped sum on Spark, so each round sends
k sums a task through one small shuffle and k centroids to the driver. No vector is ever shuffled, and no key groups rows, so equal
or very frequent vectors cost what others do.

Defined results: vectors that are null, hold null or non-finite components, or have another length take no part; equal distances go to
the smaller centroid number, and of equal centroids the first gets all; empty clusters keep their centroid; with fewer than k vectors
there are as many centroids as vectors; rows that share an id are vectors each by itself (start order: hash, then components); a null id
takes part and is hashed as the empty text; an empty table gives an empty result. Distances beyond a 64-bit integer are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm._common import by_value, cut, lean
from casebook.llm.topk import usable

by_value(__name__)

BITS = 6  # of a cell number
BLOCK = 2048  # rows in a block
CENTROIDS, ROUNDS, SCALE, DIM, SEED = 16, 3, 64, 64, 1


# --- the file ------------------------------------------------------------------------------------------------------------

def _pack(low: np.ndarray, width: np.ndarray):
    """Rows (id, components) -> blocks: (n, ids, cells, full); components are kept as distances from their dimension's least."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, held = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal ids, rows, held
            all_ids, full = pa.concat_arrays(ids), np.concatenate(rows)
            for a in range(0, len(full) if held else 0, BLOCK):
                own = full[a:a + BLOCK]
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([len(own)], pa.int32()),
                    "ids": pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), all_ids.slice(a, len(own))),
                    "cells": pa.array([(own // width).astype(np.uint8).tobytes()], pa.binary()),
                    "full": pa.array([own.astype("<u4").tobytes()], pa.binary())})
            ids, rows, held = [], [], 0

        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                whole = part.column(1).flatten().to_numpy().reshape(part.num_rows, len(low)).astype(np.int64)
                ids.append(part.column(0))
                rows.append(whole - low)
                held += part.num_rows
                if held >= BLOCK:
                    yield from out()
        if held:
            yield from out()
    return run


def lookup(centroids: np.ndarray, width: np.ndarray, top: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) squared difference by (dimension, cell, centroid); components and centroids from 0 to ``top``."""
    first = width[:, None] * np.arange(1 << bits)[None]
    last = np.minimum(first + width[:, None] - 1, np.maximum(top[:, None], first))
    q = centroids.T[:, None, :]
    below, above = first[:, :, None] - q, q - last[:, :, None]
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(first[:, :, None] - q), np.abs(last[:, :, None] - q))
    return near * near, far * far


def intervals(cells: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of the squared distances (row, centroid) from the rows' cells."""
    low = np.zeros((len(cells), least.shape[2]), np.int64)
    high = np.zeros_like(low)
    for d in range(cells.shape[1]):
        low += least[d][cells[:, d]]
        high += greatest[d][cells[:, d]]
    return low, high


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to its own centroid (arrays of equal shape)."""
    apart = rows.astype(np.int64) - centroids
    return np.einsum("ij,ij->i", apart, apart)


def assign(cells: np.ndarray, full: np.ndarray, centroids: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """(nearest centroid of each row, rows whose full vectors were fetched)."""
    low, high = intervals(cells, *tables)
    open_ = low <= high.min(axis=1)[:, None]
    nearest = np.argmax(open_, axis=1)
    fetched = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(fetched):
        exact = np.full((len(fetched), len(centroids)), np.iinfo(np.int64).max)
        for k in range(len(centroids)):
            own = np.flatnonzero(open_[fetched, k])
            exact[own, k] = distances(full[fetched[own]], centroids[k])
        nearest[fetched] = np.argmin(exact, axis=1)
    return nearest, len(fetched)


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        cells, full = batch.column("cells"), batch.column("full")
        for k in range(batch.num_rows):
            yield (batch, k, np.frombuffer(cells[k].as_buffer(), np.uint8).reshape(-1, dim),
                   np.frombuffer(full[k].as_buffer(), "<u4").reshape(-1, dim))


def _sums(centroids: np.ndarray, tables):
    """One row per centroid and task: (cluster, n, sums)."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for _, _, cells, full in _blocks(batches, centroids.shape[1]):
            nearest, _ = assign(cells, full, centroids, tables)
            for k in np.unique(nearest):
                own = full[nearest == k]
                n[k] += len(own)
                sums[k] += own.sum(axis=0, dtype=np.int64)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(range(len(n)), pa.int32()), "n": pa.array(n), "sums": pa.array(list(sums), pa.list_(pa.int64()))})
    return run


def _assigned(centroids: np.ndarray, tables):
    """(id, cluster, distance) of every row: of the full vector only the assigned centroid's distance is computed."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, cells, full in _blocks(batches, centroids.shape[1]):
            nearest, _ = assign(cells, full, centroids, tables)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("ids")[row].values, "cluster": pa.array(nearest.astype(np.int32)),
                "distance": pa.array(distances(full, centroids[nearest]))})
    return run


# --- the rounds ----------------------------------------------------------------------------------------------------------

def _edges(whole: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The least and greatest component of each dimension: ``dim`` rows, by partial aggregates; None without rows."""
    rows = whole.select(F.posexplode("vec").alias("at", "x")).groupBy("at").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r["at"])
    low, high = [int(r["lo"]) for r in rows], [int(r["hi"]) for r in rows]
    widest = max(h - lo for lo, h in zip(low, high))
    if dim * (widest + 1) ** 2 >= 1 << 63 or max(map(abs, low + high)) >= 1 << 62:
        raise ValueError("squared distances of these vectors do not fit 64-bit integers")
    return np.array(low, np.int64), np.array(high, np.int64)


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, seed: int = SEED,
            id_col: str = "vec_id", vec_col: str = "embedding", bits: int = BITS) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every vector that takes part."""
    spark = vectors.sparkSession
    out = vectors.schema[id_col].dataType.simpleString()
    whole = vectors.where(usable(F.col(vec_col)) & (F.size(vec_col) == dim)).select(
        F.col(id_col).alias("id"), F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale)).alias("vec"))
    edges = _edges(whole, dim)
    if edges is None:
        return spark.createDataFrame([], f"`{id_col}` {out}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
                                         "centroid array<bigint>")
    low, high = edges
    width = np.maximum(1, -((low - high - 1) // (1 << bits)))
    blocks = cut(whole.mapInArrow(_pack(low, width), f"n int, ids array<{out}>, cells binary, full binary"), "va-blocks")
    start = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = whole.withColumn("h", start).orderBy("h", "vec").limit(k).collect()
    centroids = np.array([r["vec"] for r in first], np.int64) - low

    for _ in range(rounds):
        tables = lookup(centroids, width, high - low, bits)
        parts = blocks.select("cells", "full").mapInArrow(_sums(centroids, tables), "cluster int, n bigint, sums array<bigint>")
        sums = parts.select("cluster", "n", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(
            F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).where("n > 0").collect()
        for r in sums:  # k * dim rows, whatever the table
            centroids[r["cluster"], r["at"]] = int(r["x"]) // r["n"]  # whole numbers from low: floor(sum / count) - low

    tables = lookup(centroids, width, high - low, bits)
    found = cut(blocks.select("ids", "cells", "full").mapInArrow(
        _assigned(centroids, tables), f"id {out}, cluster int, distance bigint"), "va-assigned")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    named = spark.createDataFrame(
        [(c, inertia[c], sum(inertia.values()), [int(x) for x in centroids[c] + low]) for c in sorted(inertia)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.join(F.broadcast(named), "cluster").select(  # at most k rows
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")

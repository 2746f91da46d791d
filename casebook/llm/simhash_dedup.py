"""SimHash near-duplicates over a Gray-order hierarchical index (operator 13).

A text's fingerprint has a bit set where more than half of its 4-word shingles' hashes (XXH64, seed 42) have it set. Texts link
when their fingerprints differ in at most ``APART`` bits, and classes are the components of these links.

1. Equal fingerprints become one node: copies are never compared, and their rows never meet in one task.
2. Dealing. Of ``APART`` + 1 disjoint parts of the 64 bits, two linked fingerprints agree on one whole part. So each
   node goes to ``APART`` + 1 groups, (mask of the part, its bits). A group of more than ``SPLIT`` nodes is dealt again by the parts of
   its bits that are still free, as often as needed: no task ever holds more, and with 17 free bits a group cannot.
3. In a task, each group's fingerprints are sorted by their rank in Gray code and ``FAN`` neighbours share an upper node, up to
   one root. A node keeps the bits on which all below agree; what its parent has already is left out of it.
4. A probe goes down the levels and adds up the bits in which it differs from each node's own pattern; beyond ``APART`` the whole
   subtree is left. So is a subtree that is in the probe's component already, which makes crowded groups cheap: links are joined at once
   by labels, and a group gives out at most one link per node (to its component's first), never its pairs.
5. Components over all groups' links; each node's class is the least id of its component.

Defined results: a null or empty text, or one without words, has fingerprint zero and links like any other; fewer than four words are
one shingle, their whole sequence; a bit with exactly half is not set; classes are named by the least id (nulls aside, null if there is no
other); repeated rows and ids come out as often as they stand; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import wordhash
from casebook.llm._common import by_value, cut, lean, shuffle_partitions
from casebook.llm.links import components, join_checked

by_value(__name__)

SIZE = 4  # words in a shingle
HASH_SEED = 42
APART = 4  # bits in which linked fingerprints differ at most
SPLIT = 50_000  # nodes of a group before it is dealt again
FREE = 17  # free bits at which a group cannot hold more than 2 ** FREE nodes and is left whole
FAN = 16
PROBES = 4096  # probes that go down together
PAIRS = 2_000_000  # (probe, node) pairs held at once, unless a single probe needs more
TASK_BYTES = 16 << 20
_ALL = (1 << 64) - 1
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


# --- fingerprints --------------------------------------------------------------------------------------------------------

def shingle_hashes(text: bytes, size: int = SIZE) -> np.ndarray:
    words = text.translate(_LOWER).split()  # at ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    joined, one = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([one(joined, HASH_SEED)], np.uint64)
    starts = np.append(0, ends[:-size] + 1).tolist()
    return np.array([one(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[size - 1:].tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority of each bit as an unsigned number; 0 without hashes."""
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[a:a + (1 << 16)]).astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


@lean
def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.zeros(batch.num_rows, np.uint64)
        for a, b, data, offsets in wordhash.byte_slices(batch.column(1)):
            raw = data.tobytes()
            for k in range(a, b):
                found[k] = fingerprint(shingle_hashes(raw[offsets[k - a]:offsets[k - a + 1]]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row; ``fp`` holds the 64 bits as a signed number."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_fingerprints, f"id {kind}, fp bigint")


# --- dealing -------------------------------------------------------------------------------------------------------------

def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def parts(mask: int) -> list[int]:
    """``mask`` with each of APART + 1 parts of its free bits, as even as possible."""
    free = [b for b in range(64) if not mask >> b & 1]
    n = APART + 1
    cuts = [len(free) * k // n for k in range(n + 1)]
    return [mask | sum(1 << b for b in free[cuts[k]:cuts[k + 1]]) for k in range(n)]


def _redealt(rows: DataFrame, masks: list[int]) -> DataFrame:
    if len(masks) == 1:
        return rows.select(F.explode(F.array(*[F.lit(signed(p)) for p in parts(masks[0])])).alias("mask"), "fp")
    table = rows.sparkSession.createDataFrame([(signed(m), signed(p)) for m in masks for p in parts(m)], "mask bigint, part bigint")
    return rows.join(F.broadcast(table), "mask").select(F.col("part").alias("mask"), "fp")  # 5 rows a mask


def _groups(nodes: DataFrame) -> DataFrame:
    """(mask, fp): every node in each of its groups; no group of more than SPLIT nodes that can be parted."""
    todo, masks, done = nodes.select(F.lit(0).cast("long").alias("mask"), "fp"), [0], []
    while True:
        todo = _redealt(todo, masks).withColumn("value", F.col("mask").bitwiseAND(F.col("fp")))
        hot = todo.groupBy("mask", "value").count().where(f"count > {SPLIT} and 64 - bit_count(mask) > {FREE}").select("mask", "value")
        hot = cut(hot, "simhash-hot")
        size = hot.count()  # at most rows / SPLIT
        if not size:
            return _union([*done, todo.select("mask", "fp")])
        todo = cut(todo, "simhash-dealt")
        done.append(todo.join(hot, ["mask", "value"], "left_anti").select("mask", "fp"))
        todo = join_checked(todo, hot, size, ["mask", "value"]).select("mask", "fp")
        masks = sorted(r["mask"] & _ALL for r in hot.select("mask").distinct().collect())  # a few hundred at most


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


# --- the index -----------------------------------------------------------------------------------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the reflected Gray sequence."""
    out = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class GrayIndex:
    """Forest over fingerprints sorted by (group, Gray rank). Level 0 are the fingerprints, the last level one root a group.

    ``own[l]`` is the mask of bits that a node of level l adds to those of its parent, ``pattern[l]`` its bits there;
    ``first[l]`` is where its children start on the level below (one more entry at the end).
    """

    def __init__(self, codes: np.ndarray, *groups: np.ndarray):
        order = np.lexsort((gray_rank(codes), *groups))
        self.codes = codes[order]
        new = np.zeros(len(order), bool)
        new[:1] = True
        for g in groups:
            new[1:] |= g[order][1:] != g[order][:-1]
        group = np.cumsum(new) - 1
        every, some = [self.codes], [self.codes]
        owners, self.first, self.span = [group], [None], [np.arange(len(order) + 1)]
        while len(owners[-1]) and len(owners[-1]) > owners[-1][-1] + 1:
            g = owners[-1]
            starts = np.flatnonzero(np.append(True, np.diff(g) != 0))
            at = np.arange(len(g)) - starts[g]
            cuts = np.flatnonzero(at % FAN == 0)
            every.append(np.bitwise_and.reduceat(every[-1], cuts))
            some.append(np.bitwise_or.reduceat(some[-1], cuts))
            self.first.append(np.append(cuts, len(g)))
            self.span.append(np.append(self.span[-1][cuts], len(order)))
            owners.append(g[cuts])
        self.root = group  # the place of each fingerprint's root on the last level
        shared = [~(a ^ b) for a, b in zip(every, some)]
        self.own, self.pattern = [], []
        for level, (mask, bits) in enumerate(zip(shared, every)):
            if level + 1 < len(shared):
                mask = mask & ~np.repeat(shared[level + 1], np.diff(self.first[level + 1]))
            self.own.append(mask)
            self.pattern.append(bits & mask)
        self.label = np.arange(len(order))
        self._relabel()

    def _relabel(self) -> None:
        """The one label of all below a node, or -1."""
        self.uniform = [self.label]
        for cuts in self.first[1:]:
            low, high = (f.reduceat(self.uniform[-1], cuts[:-1]) for f in (np.minimum, np.maximum))
            self.uniform.append(np.where(low == high, low, -1))

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up
        self._relabel()

    def _down(self, probes: np.ndarray) -> None:
        """Joins all links of the probes with fingerprints behind them."""
        top = len(self.own) - 1
        probe, node = probes, self.root[probes]
        apart = np.bitwise_count((self.codes[probe] ^ self.pattern[top][node]) & self.own[top][node]).astype(np.int64)
        for level in range(top, -1, -1):
            near = (apart <= APART) & (self.uniform[level][node] != self.label[probe]) & (self.span[level][node + 1] - 1 > probe)
            probe, node, apart = probe[near], node[near], apart[near]
            if not len(probe):
                return
            if level == 0:
                self._join(probe, node)
                return
            count = np.diff(self.first[level])[node]
            if count.sum() > PAIRS and len(probes) > 1:  # too many at once: in two halves, the second knowing the first's links
                half = len(probes) // 2
                self._down(probes[:half])
                self._down(probes[half:])
                return
            start = np.repeat(self.first[level][node] - np.cumsum(count) + count, count)
            child = start + np.arange(len(start))
            probe, apart = np.repeat(probe, count), np.repeat(apart, count)
            apart += np.bitwise_count((self.codes[probe] ^ self.pattern[level - 1][child]) & self.own[level - 1][child])
            node = child

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Each fingerprint that is not the first of its component within its group, and that first one."""
        for a in range(0, len(self.codes), PROBES):
            self._down(np.arange(a, min(a + PROBES, len(self.codes))))
        rest = np.flatnonzero(self.label != np.arange(len(self.codes)))
        return self.codes[rest], self.codes[self.label[rest]]


def _bucket_links(table: pa.Table) -> pa.Table:
    mask, fp = (table[c].to_numpy().view(np.uint64) for c in ("mask", "fp"))
    a, b = GrayIndex(fp, mask, mask & fp).links()
    return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that have the same components as all links."""
    dealt = cut(_groups(nodes.select("fp")), "simhash-groups")
    rows = dealt.count()
    buckets = max(shuffle_partitions(nodes.sparkSession), rows * 16 // TASK_BYTES + 1)
    key = F.pmod(F.xxhash64("mask", F.col("mask").bitwiseAND(F.col("fp"))), F.lit(buckets))
    return dealt.withColumn("bucket", key).groupBy("bucket").applyInArrow(_bucket_links, "a bigint, b bigint")


# --- classes -------------------------------------------------------------------------------------------------------------

def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row; ``fingerprint`` holds the 64 bits as a signed number."""
    rows = cut(fingerprints(docs, id_col, text_col), "simhash-rows")
    nodes = cut(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    found = cut(components(cut(links(nodes).distinct(), "simhash-links"), "simhash-components").select(
        F.col("node").alias("fp"), "component"), "simhash-components")
    linked = found.count()
    owned = join_checked(nodes, found, linked, ["fp"])
    least = owned.groupBy("component").agg(F.min("least").alias("component_id"))
    named = cut(join_checked(found, cut(least, "simhash-least"), linked, ["component"]).select("fp", "component_id"), "simhash-named")
    # Written: plain tables join by plain shuffles, which AQE can split at a fingerprint that very many rows have.
    classed = cut(join_checked(nodes, named, linked, ["fp"], "left").select(
        "fp", F.when(F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("least")).alias("component_id")), "simhash-classes")
    return join_checked(rows, classed, classed.count(), ["fp"]).select(
        F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id")

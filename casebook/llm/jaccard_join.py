"""N-gram Jaccard join with prefix trees (operator 5).

Documents are sets of five-word shingles (64-bit hashes). Two link when 100 * intersection >= 80 * union.

0. The rows are written once with a number each. Texts are found again by this number, never by their ids, which may be null or stand
   with any number of texts.
1. Equal sets become one node (128-bit fingerprint and size; its number is that of its first row), so copies are never compared.
2. One global order of shingles, rarest first: by the count of the shingle's rarest word, then of all its words, then
   by hash. The word counts cover all documents and live in ``COUNTERS`` hashed counters, a table of fixed size; they
   only shape the order, so their collisions cost time, never links.
3. Two linked sets share a shingle among the first n - ceil(0.8 n) + 1 of each (the prefix), and the first one they share leaves room for the
   needed overlap. Nodes are dealt by prefix shingle; groups of shingles that may be very frequent are salted.
4. In each group the node with the fewest rarer shingles is compared with the others (the hubs of salted groups among
   each other), which links groups of near copies without comparing all their pairs.
5. Components of these links are found; then the pairs of a group that are still in different components, fit
   by length and position and were not compared are compared as well, unless the parity bitmaps of the two sets (``BITS`` bits) differ
   in more bits than linked sets may differ in shingles: for each set its nearest few by bitmap first (``NEAREST``), which joins
   most components, and in the last round all that are left. No link between different components is lost.
6. Comparing: all partners of a node (in bounded parts) stand in a radix trie of their ordered sets. The node's set is
   counted along the trie, shared starts once, and a subtree is left when its longest set cannot reach the needed overlap.

Defined results: a null or empty text, or one without words, has no shingles and is its own class; fewer than five words make one
shingle; classes are named by the least id (nulls aside); rows that share an id, or have none, are told apart by their texts; repeated rows are equal
sets; an empty table gives an empty result. Columns other than id and text are not read by ``classes`` and kept by ``distinct_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm import wordhash
from casebook.llm._common import by_value, cut, lean, shuffle_partitions
from casebook.llm.links import components, join_checked

by_value(__name__)

SIZE = 5
SHARE = 80  # percent: intersection to union
COUNTERS = 1 << 20
CHUNK = 1 << 14  # counters in a row of the sketch
GROUP_ROWS = 200_000  # expected rows of a prefix group before it is salted
PART = 256  # partners of a node in one trie
BITS = 1024  # of a set's parity bitmap
NEAREST = (2, None)  # partners of a set in a group and round; None: all
_ENTRY = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<u4"), ("pos", "<u4"), ("salts", "<u4")])



# --- word counts -------------------------------------------------------------------------------------------------------

@lean
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for _, _, data, offsets in wordhash.byte_slices(batch.column(0)):
            at = (wordhash.Words(data, offsets).hashes % np.uint64(COUNTERS)).astype(np.int64)
            counts += np.bincount(at, minlength=COUNTERS)
    part = TaskContext.get().partitionId()
    yield _sparse(counts, part % 64)


def _sparse(counts: np.ndarray, salt: int, first: int = 0) -> pa.RecordBatch:
    chunks, places, values = [], [], []
    for c in range(len(counts) // CHUNK):
        own = counts[c * CHUNK:(c + 1) * CHUNK]
        at = np.flatnonzero(own)
        chunks.append(first + c)
        places.append(at.astype("<u2").tobytes())
        values.append(own[at].astype("<i8").tobytes())
    return pa.RecordBatch.from_pydict({
        "chunk": pa.array(chunks, pa.int32()), "salt": pa.array([salt] * len(chunks), pa.int32()),
        "places": pa.array(places, pa.binary()), "counts": pa.array(values, pa.binary())})


SKETCH = "chunk int, salt int, places binary, counts binary"


def _add(table: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK, np.int64)
    for places, counts in zip(table["places"].to_pylist(), table["counts"].to_pylist()):
        total[np.frombuffer(places, "<u2")] += np.frombuffer(counts, "<i8")
    return pa.Table.from_batches([_sparse(total, 0, table["chunk"][0].as_py())])


def word_ranks(docs: DataFrame, text_col: str) -> np.ndarray:
    """For each counter 4 * log2(count + 1), one byte; the counts of all words of all texts, summed in a tree."""
    sketch = docs.select(F.col(text_col).alias("text")).mapInArrow(_count_words, SKETCH)
    summed = sketch.groupBy("chunk", "salt").applyInArrow(_add, SKETCH).groupBy("chunk").applyInArrow(_add, SKETCH)
    counts = np.zeros(COUNTERS, np.int64)
    for r in summed.collect():  # COUNTERS / CHUNK rows, whatever the corpus
        counts[r.chunk * CHUNK + np.frombuffer(r.places, "<u2").astype(np.int64)] = np.frombuffer(r.counts, "<i8")
    return np.minimum(4 * np.log2(counts + 1.0), 255).astype(np.uint8)


# --- sets --------------------------------------------------------------------------------------------------------------

def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, wordhash.Words, np.ndarray]]:
    """(row, distinct shingles sorted by hash, their first word) of every row that has words."""
    for a, _, data, offsets in wordhash.byte_slices(column):
        words = wordhash.Words(data, offsets)
        hashes, text = wordhash.shingles(words, SIZE)
        bounds = np.searchsorted(text, np.arange(len(offsets)))
        for k in range(len(offsets) - 1):
            lo, hi = bounds[k], bounds[k + 1]
            if lo < hi:
                found, at = np.unique(hashes[lo:hi], return_index=True)
                yield a + k, found, words.docs[k] + at, words, words.docs[k + 1]


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over the set, as signed numbers."""
    one = int(wordhash.mix(shingles).sum(dtype=np.uint64))
    two = int(wordhash.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return tuple(x - (1 << 64) if x >> 63 else x for x in (one, two))


def _ordered(shingles: np.ndarray, first: np.ndarray, words: wordhash.Words, end: int, ranks: np.ndarray):
    """The set in the global order, and each shingle's rarest word's rank."""
    low = total = None
    for k in range(SIZE):
        at = np.minimum(first + k, end - 1)
        r = ranks[(words.hashes[at] % np.uint64(COUNTERS)).astype(np.int64)].astype(np.int64)
        low = r if low is None else np.minimum(low, r)
        total = r if total is None else total + r
    order = np.argsort((low << 16) | total, kind="stable")  # ties stay in the order of hashes
    return shingles[order], low[order]


def parity(shingles: np.ndarray) -> bytes:
    """A bitmap in which every shingle of the set turns over one bit: two bitmaps differ in no more bits than the sets do in shingles."""
    at = (wordhash.mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BITS)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=BITS) & 1).astype(bool)).tobytes()


def _fingerprints():
    """Appends f1, f2, n and the bitmap to rows whose first column is the text, which goes."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f1, f2, n = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            bits: list[bytes | None] = [None] * batch.num_rows
            for row, shingles, *_ in _sets(batch.column(0)):
                f1[row], f2[row] = fingerprint(shingles)
                n[row] = len(shingles)
                bits[row] = parity(shingles)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(f1), pa.array(f2), pa.array(n), pa.array(bits, pa.binary())],
                                             [*batch.schema.names[1:], "f1", "f2", "n", "bits"])
    return run


def prefix_length(n: int) -> int:
    return n - (-(-SHARE * n // 100)) + 1


def salt_of(rows: np.ndarray) -> np.ndarray:
    """The part of its shingle's group that an entry belongs to, in every step."""
    return wordhash.mix(rows["node"].view(np.uint64)) % rows["salts"].astype(np.uint64)


def _entries(ranks_of, buckets: int):
    """Rows (text, node, f1, f2) -> packed prefix entries by bucket."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of.value
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            rows = np.concatenate(held)
            bucket = (wordhash.mix(rows["token"] + salt_of(rows) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            firsts = np.flatnonzero(np.diff(bucket, prepend=-1))
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array(bucket[firsts]), "rows": pa.array([x.tobytes() for x in np.split(rows, firsts[1:])], pa.binary())})

        for batch in batches:
            nodes, f1, f2 = (batch.column(k).to_numpy() for k in (1, 2, 3))
            for row, shingles, first, words, end in _sets(batch.column(0)):
                if fingerprint(shingles) != (f1[row], f2[row]):
                    raise RuntimeError("a row number has another text than before")
                tokens, low = _ordered(shingles, first, words, end, ranks)
                p = prefix_length(len(tokens))
                e = np.zeros(p, _ENTRY)
                e["token"], e["node"], e["n"], e["pos"] = tokens[:p], nodes[row], len(tokens), np.arange(p)
                e["salts"] = np.ceil(np.exp2(low[:p] / 4) / GROUP_ROWS).clip(1)
                held.append(e)
                size += p
                if size >= 300_000:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()
    return run


# --- candidates --------------------------------------------------------------------------------------------------------

def fits(n1, p1, n2, p2):
    """Whether two sets that share their shingles at places p1, p2 as the first common one may link (arrays or columns)."""
    need = SHARE * (n1 + n2)  # 180 * overlap >= 80 * (n1 + n2)
    return (100 * n1 >= SHARE * n2) & (100 * n2 >= SHARE * n1) & ((100 + SHARE) * (n1 - p1) >= need) & (
        (100 + SHARE) * (n2 - p2) >= need)


def _stars(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries sorted by shingle and salt; the place of each one's hub; whether its group has others to compare with."""
    salt = salt_of(np.ascontiguousarray(rows))
    order = np.lexsort((rows["node"], rows["pos"], salt, rows["token"]))
    rows, salt = rows[order], salt[order]
    first = np.append(True, (rows["token"][1:] != rows["token"][:-1]) | (salt[1:] != salt[:-1]))
    group = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(rows)))
    keep = (sizes > 1)[group] | (rows["salts"] > 1)
    return rows, starts[group], keep


def _star_pairs(rows: np.ndarray, hubs: np.ndarray) -> np.ndarray:
    hub = rows[hubs]
    n1, p1, n2, p2 = (x.astype(np.int64) for x in (hub["n"], hub["pos"], rows["n"], rows["pos"]))
    good = fits(n1, p1, n2, p2) & (hub["node"] != rows["node"])
    pairs = np.stack([hub["node"][good], rows["node"][good]], 1)
    return np.unique(pairs, axis=0) if len(pairs) else pairs


STAR = "kind int, a bigint, b bigint, n bigint, pos bigint, token bigint, salts bigint, salt bigint"


def _star(table: pa.Table) -> pa.Table:
    """Of a bucket: pairs to compare (kind 0), hubs of salted groups (1), members of groups of three or more (2)."""
    rows = np.concatenate([np.frombuffer(x, _ENTRY) for x in table["rows"].to_pylist()])
    rows, hubs, keep = _stars(rows)
    pairs = _star_pairs(rows[keep], np.searchsorted(np.flatnonzero(keep), hubs[keep])) if keep.any() else np.zeros((0, 2), np.int64)
    sizes = np.bincount(hubs, minlength=len(rows))[hubs]
    salted = rows["salts"] > 1
    top = salted & (hubs == np.arange(len(rows)))
    more = salted | (sizes > 2)
    parts = []
    for kind, e in ((1, rows[top]), (2, rows[more])):
        parts.append((np.full(len(e), kind), e["node"], e["node"], e["n"], e["pos"], e["token"].view(np.int64), e["salts"], salt_of(e)))
    zero = np.zeros(len(pairs), np.int64)
    parts.append((zero, pairs[:, 0], pairs[:, 1], zero, zero, zero, zero, zero))
    columns = [np.concatenate([p[k].astype(np.int64) for p in parts]) for k in range(8)]
    return pa.table([pa.array(columns[0], pa.int32()), *map(pa.array, columns[1:])],
                    ["kind", "a", "b", "n", "pos", "token", "salts", "salt"])


def _hub_stars(found: DataFrame) -> DataFrame:
    """Pairs of the hubs of a salted shingle: each with the hub of them all. A minimum and a join, no gathering."""
    hubs = found.where("kind = 1").select(F.col("a").alias("node"), "n", "pos", "token")
    top = hubs.groupBy("token").agg(F.min(F.struct("pos", "node", "n")).alias("top"))
    pair = hubs.join(top, "token").where(F.col("top.node") != F.col("node"))
    return pair.where(fits(F.col("top.n"), F.col("top.pos"), F.col("n"), F.col("pos"))).select(
        F.col("top.node").alias("a"), F.col("node").alias("b"))


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()


CROSS = "x bigint, y bigint"


def _cross(nearest: int | None):
    """Of a bucket of groups (token, salt): pairs of a member outside the group's main component (guests of other salts too) and any
    other member, in different components, that fit by length, position and bitmap; with ``nearest`` so many for each member and salt."""
    def run(table: pa.Table) -> pa.Table:
        names = ("token", "salt", "node", "n", "pos", "component", "minor", "guest")
        c = {k: table[k].to_numpy() for k in names}
        order = np.lexsort((c["node"], c["salt"], c["token"]))
        c = {k: v[order] for k, v in c.items()}
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), "<u8").reshape(-1, BITS // 64)[order]
        cuts = np.flatnonzero(np.append(True, (c["token"][1:] != c["token"][:-1]) | (c["salt"][1:] != c["salt"][:-1])))
        found = [np.zeros((0, 2), np.int64)]
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            minor, own = a + np.flatnonzero(c["minor"][a:b]), a + np.flatnonzero(~c["guest"][a:b])
            hub = own[np.lexsort((c["node"][own], c["pos"][own]))[:1]]  # compared with all of its salt by _star, which has the same salts
            for x in np.split(minor, range(32, len(minor), 32)):
                kept = []
                for y in np.split(own, range(4096, len(own), 4096)):
                    n1, p1, n2, p2 = c["n"][x][:, None], c["pos"][x][:, None], c["n"][y][None], c["pos"][y][None]
                    i, j = np.nonzero(fits(n1, p1, n2, p2) & (c["component"][x][:, None] != c["component"][y][None]))
                    u, v = x[i], y[j]
                    new = ~(np.isin(v, hub) & ~c["guest"][u]) & ~np.isin(u, hub)
                    u, v = u[new], v[new]
                    apart = np.bitwise_count(bits[u] ^ bits[v]).sum(1, dtype=np.int64)
                    near = (100 + SHARE) * apart <= (100 - SHARE) * (c["n"][u] + c["n"][v])
                    kept.append(np.stack([u[near], apart[near], v[near]], 1))
                near = np.concatenate(kept)
                if nearest:
                    near = near[np.lexsort((near[:, 2], near[:, 1], near[:, 0]))]
                    near = near[np.arange(len(near)) - np.searchsorted(near[:, 0], near[:, 0]) < nearest]
                u, v = c["node"][near[:, 0]], c["node"][near[:, 2]]
                found.append(np.stack([np.minimum(u, v), np.maximum(u, v)], 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"x": pa.array(pairs[:, 0]), "y": pa.array(pairs[:, 1])})
    return run


def _remaining(found: DataFrame, nodes: DataFrame, compared: DataFrame, component: DataFrame, buckets: int,
               nearest: int | None) -> DataFrame | None:
    """(x, y): pairs of a group that are in different components, may link and were not compared; None if no group is split."""
    members = found.where("kind = 2").select(F.col("a").alias("node"), "n", "pos", "token", "salts", "salt")
    members = members.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    members = cut(members, "jaccard-members")
    top = members.groupBy("token").agg(
        F.min(F.struct("pos", "node", "component"))["component"].alias("top"),
        F.count_distinct("component").alias("parts"))
    split = members.join(top.where("parts > 1"), "token").withColumn("minor", F.col("component") != F.col("top"))
    split = cut(split.join(nodes.select("node", "bits"), "node").drop("top", "parts"), "jaccard-split")
    if split.isEmpty():
        return None
    own = split.withColumn("guest", F.lit(False))
    guests = split.where("minor and salts > 1").withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    guests = guests.where("to <> salt").withColumn("salt", F.col("to")).drop("to").withColumn("guest", F.lit(True))
    dealt = own.unionByName(guests).drop("salts").withColumn("bucket", F.pmod(F.xxhash64("token", "salt"), F.lit(buckets)))
    pairs = dealt.groupBy("bucket").applyInArrow(_cross(nearest), CROSS).distinct()
    return pairs.join(compared, ["x", "y"], "left_anti")


# --- comparing ---------------------------------------------------------------------------------------------------------

class Trie:
    """Radix trie of ordered sets. A node: its run of shingles, the greatest size below, children, sets that end there."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        order = sorted(range(len(sets)), key=lambda k: sets[k].byteswap().tobytes())
        self.root = self._build(order, 0)

    def _build(self, order: list[int], depth: int) -> list[tuple]:
        """Nodes (run, depth at its end, greatest size, children, sets) of the sets of ``order`` from ``depth`` on."""
        nodes, k = [], 0
        while k < len(order):
            own = [order[k]]
            token = self.sets[order[k]][depth]
            k += 1
            while k < len(order) and self.sets[order[k]][depth] == token:
                own.append(order[k])
                k += 1
            first, last = self.sets[own[0]], self.sets[own[-1]]  # sorted: these two share what all share
            m = min(min(len(self.sets[s]) for s in own), len(first), len(last))
            differ = np.flatnonzero(first[depth:m] != last[depth:m])
            end = depth + int(differ[0]) if len(differ) else m
            ends = [s for s in own if len(self.sets[s]) == end]
            rest = [s for s in own if len(self.sets[s]) > end]
            size = max(len(self.sets[s]) for s in own)
            nodes.append((first[depth:end], end, size, self._build(rest, end) if rest else [], ends))
        return nodes

    def linked(self, probe: np.ndarray, share: int = SHARE) -> list[int]:
        """The sets that link with the set ``probe``; its shingles in any order."""
        probe = np.sort(probe)
        n, out = len(probe), []
        todo = [(node, 0) for node in self.root]
        while todo:
            (run, depth, size, children, ends), overlap = todo.pop()
            at = np.minimum(np.searchsorted(probe, run), n - 1)
            overlap += int(np.count_nonzero(probe[at] == run))
            for s in ends:
                if 100 * overlap >= share * (n + depth - overlap):
                    out.append(s)
            # The longest set below gains at most size - depth more; shorter ones are further off.
            if (100 + share) * (overlap + size - depth) >= share * (n + size):
                todo += [(child, overlap) for child in children]
        return out


def _compare(ranks_of):
    """Rows (text, f1, f2, hub, part, role, node), sorted by (hub, part, role): role 0 is the hub. -> links (a, b)."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of.value
        key = probe = None
        wait: dict[int, np.ndarray] = {}
        links: list[tuple[int, int]] = []

        def close() -> None:
            if wait and probe is not None:
                nodes = list(wait)
                links.extend((key[0], nodes[k]) for k in Trie([wait[x] for x in nodes]).linked(probe))
            wait.clear()

        for batch in batches:
            f1, f2, hub, part, role, node = (batch.column(k).to_numpy() for k in range(1, 7))
            for row, shingles, first, words, end in _sets(batch.column(0)):
                if fingerprint(shingles) != (f1[row], f2[row]):
                    raise RuntimeError("a row number has another text than before")
                if key != (hub[row], part[row]):
                    close()
                    key, probe = (int(hub[row]), int(part[row])), None
                if role[row] == 0:
                    probe = shingles
                else:
                    wait[int(node[row])] = _ordered(shingles, first, words, end, ranks)[0]
        close()
        yield pa.RecordBatch.from_pydict({
            "a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})
    return run


def _compared(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, ranks_of) -> DataFrame:
    """The links among ``pairs`` (x, y). A node's partners are dealt into parts, each with the node's own text."""
    degree = pairs.select(F.explode(F.array("x", "y")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("d"))
    degree = cut(degree, "jaccard-degrees")
    sided = pairs.join(degree.select(F.col("v").alias("x"), F.col("d").alias("dx")), "x").join(
        degree.select(F.col("v").alias("y"), F.col("d").alias("dy")), "y")
    more = F.col("dx") >= F.col("dy")  # the node with more pairs probes: fewer texts travel
    sided = sided.select(F.when(more, F.col("x")).otherwise(F.col("y")).alias("hub"),
                         F.when(more, F.col("y")).otherwise(F.col("x")).alias("node"), F.greatest("dx", "dy").alias("d"))
    sided = cut(sided.select("hub", "node", F.pmod(F.xxhash64("node"), F.ceil(F.col("d") / PART)).alias("part")), "jaccard-pairs")
    wanted = sided.select("node", "hub", "part", F.lit(1).alias("role")).unionByName(
        sided.select(F.col("hub").alias("node"), "hub", "part", F.lit(0).alias("role")).distinct())
    named = cut(wanted.join(nodes.select("node", "f1", "f2"), "node"), "jaccard-wanted")
    texts = join_checked(docs, named, named.count(), ["node"])
    dealt = texts.select("text", "f1", "f2", "hub", "part", "role", "node").repartition(
        shuffle_partitions(docs.sparkSession), "hub", "part").sortWithinPartitions("hub", "part", "role")
    return dealt.mapInArrow(_compare(ranks_of), "a bigint, b bigint")


# --- the join ----------------------------------------------------------------------------------------------------------

def _least(id_, number) -> Column:
    """Orders rows by id, nulls last, then by number."""
    return F.struct(F.col(id_).isNull().alias("unknown"), F.col(id_).alias("id"), F.col(number).alias("row"))


def _nodes(members: DataFrame) -> DataFrame:
    """Distinct sets: ``node`` is the number of a set's first row, ``id`` its least id and ``row`` the first row of that id."""
    sets = members.where("n > 0").groupBy("f1", "f2", "n").agg(
        F.min("row").alias("node"), F.min(_least("id", "row")).alias("least"), F.min("bits").alias("bits"))
    return cut(sets.select("node", "f1", "f2", "n", "bits", "least.id", "least.row"), "jaccard-nodes")


def _node_components(docs: DataFrame, nodes: DataFrame, ranks: np.ndarray) -> DataFrame:
    """(node, component) of the nodes that have links. ``docs``: (text, node) of every row, by its number."""
    spark = docs.sparkSession
    ranks_of = spark.sparkContext.broadcast(ranks)  # COUNTERS bytes
    size = nodes.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.expr("n div 5 + 1")).alias("entries")).first()
    buckets = max(shuffle_partitions(spark), int((size.entries or 0) * _ENTRY.itemsize // (32 << 20)) + 1)
    texts = join_checked(docs, nodes.select("node", "f1", "f2"), size.rows, ["node"])
    packed = texts.select("text", "node", "f1", "f2").mapInArrow(_entries(ranks_of, buckets), "bucket bigint, rows binary")
    found = cut(packed.groupBy("bucket").applyInArrow(_star, STAR), "jaccard-stars")
    first = cut(_pairs(found.where("kind = 0").select("a", "b").unionByName(_hub_stars(found))), "jaccard-first")
    links = cut(_compared(docs, nodes, first, ranks_of), "jaccard-links")
    component = cut(components(links), "jaccard-components")
    compared = first
    for nearest in NEAREST:
        rest = _remaining(found, nodes, compared, component, buckets, nearest)
        if rest is None:
            break
        rest = cut(rest, "jaccard-rest")
        more = cut(_compared(docs, nodes, rest, ranks_of), "jaccard-more")
        compared = compared.unionByName(rest)
        if more.isEmpty():
            continue
        known = component.select(F.col("node").alias("a"), F.col("component").alias("b"))
        component = cut(components(known.unionByName(more)), "jaccard-components")
    return component


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written once, with a number each in a column of a new name."""
    number = "_row"
    while number.lower() in [c.lower() for c in docs.columns]:
        number += "_"
    return cut(docs.withColumn(number, F.monotonically_increasing_id()), "jaccard-rows"), number


def _classed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: id, row, f1, f2, n of every row (text, id, row); classes: f1, f2, n, id, row, node and component of every distinct set)."""
    members = cut(rows.mapInArrow(_fingerprints(), "id bigint, row bigint, f1 bigint, f2 bigint, n bigint, bits binary"), "jaccard-members")
    nodes = _nodes(members)
    component = _node_components(rows.select("text", F.col("row").alias("node")), nodes, word_ranks(rows, "text"))
    named = nodes.drop("bits").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return members.drop("bits"), cut(named, "jaccard-classes")


def _rows(numbered: DataFrame, number: str, id_col: str, text_col: str) -> DataFrame:
    return numbered.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"), F.col(number).alias("row"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    numbered, number = _numbered(docs.select(id_col, text_col))
    members, classed = _classed(_rows(numbered, number, id_col, text_col))
    least = classed.groupBy("component").agg(F.min("id").alias("component_id"))
    keys = ["f1", "f2", "n"]
    named = cut(classed.join(least, "component").select(*keys, "component_id"), "jaccard-named")
    return members.join(named, keys, "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the first row with the least id; rows without words stay."""
    numbered, number = _numbered(docs)
    members, classed = _classed(_rows(numbered, number, id_col, text_col))
    stay = cut(classed.groupBy("component").agg(F.min(_least("id", "row"))["row"].alias("row")).select("row"), "jaccard-stay")
    gone = cut(members.where("n > 0").join(stay, "row", "left_anti").select(F.col("row").alias(number)), "jaccard-gone")
    return join_checked(numbered, gone, gone.count(), [number], "left_anti").select(*docs.columns)

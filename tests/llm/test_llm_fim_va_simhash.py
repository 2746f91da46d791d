"""Fill-in-middle, centroid clustering and SimHash near-duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casebook.llm import fill_middle, simhash_dedup, va_clusters

DOC = "doc_id long, text string, n int, form string, fp string"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t, 1, "x", "y") for k, t in enumerate(texts)], DOC)


# --- fill in middle ------------------------------------------------------------------------------------------------------

def fim_brute(doc_id, text, rate=100, spm=50, seed=7, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in marks) or h[2] % 100 >= rate:
        return (doc_id, len(units), "plain", None, None, text)
    if h[3] % 100 < spm:
        return (doc_id, len(units), "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m)
    return (doc_id, len(units), "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m)


FIM_TEXTS = [None, "", "\n", "one", "one\n", "a\nb\nc", "\n\n\n", "x\r\ny z\x85w\n", "has <P> mark\nand more", "<S", "a<\n<P\nS>\n<\nM>", "한글 \U0001f600\nline two\n",
             "long " * 50_000 + "\n" + "word\n" * 20_000, "a|b\\E\\Q.*\n$1\n"] + [f"l{k}\n" * (k % 7) + "end" * (k % 3) for k in range(60)]


@pytest.mark.parametrize("slice_bytes,rate,spm", [(2_000_000, 100, 50), (10, 60, 30)])
def test_fill_middle(spark, monkeypatch, slice_bytes, rate, spm):
    monkeypatch.setattr(fill_middle.slices, "__defaults__", (slice_bytes,))
    df = docs_of(spark, FIM_TEXTS).unionByName(spark.createDataFrame([(None, "n\nn\nn", 1, "", ""), (5, "a\nb\nc", 1, "", "")], DOC)).repartition(3)
    got = fill_middle.transform(df, rate=rate, spm=spm)
    rows = got.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    want = [fim_brute(r.doc_id, r.text, rate, spm) for r in df.collect()]
    key = lambda r: tuple((x is None, "" if x is None else x) for x in r)
    assert sorted((tuple(r)[:6] for r in rows), key=key) == sorted(want, key=key)
    texts = {(r.doc_id, r.text or "") for r in df.collect()}
    assert {(r.doc_id, r.back) for r in rows} == texts
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert got.limit(0).count() == fill_middle.transform(df.limit(0)).count() == 0


def test_marks_that_could_arise_are_refused(spark):
    df = docs_of(spark, ["a"])
    for marks in (("<P", "<P>", "<M>"), ("<<", "<S>", "<M>"), ("", "<S>", "<M>"), ("<P>", "<P>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.transform(df, marks=marks)


# --- centroids -----------------------------------------------------------------------------------------------------------

def lloyd(rows, k, rounds, scale, dim, seed=1):
    kept = [(i, tuple(int(np.floor(scale * float(x))) for x in v)) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    cents = [list(v) for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        for n, vs in own.items():
            cents[n] = [sum(x) // len(vs) for x in zip(*vs)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {n: sum(d for _, m, d in out if m == n) for _, n, _ in out}
    return [(i, n, d, inertia[n], sum(inertia.values()), cents[n]) for i, n, d in out]


@pytest.mark.parametrize("bits,block,dim,k", [(6, 2048, 5, 4), (1, 7, 5, 6), (2, 100, 3, 300), (8, 50, 1, 2)])
def test_va_clusters(spark, monkeypatch, bits, block, dim, k):
    monkeypatch.setattr(va_clusters, "BLOCK", block)
    rng = np.random.default_rng(bits)
    centre = rng.standard_normal((5, dim)) * 3
    rows = [(n, [float(np.float32(x)) for x in centre[n % 5] + rng.standard_normal(dim).round(1)]) for n in range(200)]
    rows += [(300, None), (301, [None] * dim), (302, [float("nan")] * dim), (303, [float("-inf")] * dim), (304, []), (305, [1.0] * (dim + 1)),
             (7, rows[7][1]), (8, rows[9][1]), (None, [0.5] * dim), (306, [-1000.25] * dim)] + [(400 + n, [2.0] * dim) for n in range(40)]
    df = spark.createDataFrame([(i, v, 3, "z") for i, v in rows], "vec_id long, embedding array<float>, cluster int, id string").repartition(4)
    got = [tuple(r) for r in va_clusters.cluster(df, k=k, rounds=3, scale=64, dim=dim, bits=bits).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(lloyd(rows, k, 3, 64, dim), key=key)
    assert va_clusters.cluster(df.limit(0), dim=dim).count() == 0
    one = va_clusters.cluster(df.where("vec_id = 306"), k=k, dim=dim, bits=bits).collect()
    assert [(r.cluster, r.distance) for r in one] == [(0, 0)]


def test_intervals_hold_the_exact_distances():
    rng = np.random.default_rng(1)
    for bits in (1, 3, 6):
        top = rng.integers(0, 300, 9)
        full = np.stack([rng.integers(0, t + 1, 500) for t in top], 1)
        cents = np.stack([rng.integers(0, t + 1, 8) for t in top], 1)
        width = np.maximum(1, -((-top - 1) // (1 << bits)))
        cells = (full // width).astype(np.uint8)
        assert cells.max() < 1 << bits
        tables = va_clusters.lookup(cents, width, top, bits)
        low, high = va_clusters.intervals(cells, *tables)
        exact = ((full[:, None] - cents[None]) ** 2).sum(2)
        assert (low <= exact).all() and (exact <= high).all()
        nearest, fetched = va_clusters.assign(cells, full, cents, tables)
        assert (nearest == exact.argmin(1)).all() and fetched <= len(full)
    assert fetched < len(full) / 2  # fine cells leave few rows open


def test_distances_that_do_not_fit_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30]), (2, [0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        va_clusters.cluster(df, dim=1)


# --- SimHash -------------------------------------------------------------------------------------------------------------

def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(codes):
    parent = list(range(len(codes)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, x in enumerate(codes):
        for j in range(i):
            if (x ^ codes[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(x) for x in range(len(codes))]


SIM_TEXTS = [None, "", " \t\n", "one", "One", "one two three", "a b c d", "A B C D", "a b c d e", "Ä ä x b c d e", "x\x0by\x0cz\rw v"]


def test_simhash_classes(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(120)) for _ in range(30)]
    texts = SIM_TEXTS + base
    for _ in range(150):
        words = rng.choice(base).split(" ")
        words[rng.randrange(len(words))] = "new"
        texts.append("  ".join(words))
    texts += [base[0]] * 20 + ["word " * 30_000]
    df = docs_of(spark, texts, 100).repartition(5)
    got = {r.doc_id: r for r in simhash_dedup.classes(df).collect()}
    codes = [simhash(t) for t in texts]
    assert [got[100 + k].fingerprint & (1 << 64) - 1 for k in range(len(texts))] == codes
    assert [got[100 + k].component_id - 100 for k in range(len(texts))] == brute_classes(codes)
    assert len({r.component_id for r in got.values()}) < len(set(codes))
    assert simhash_dedup.classes(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b", 1, "", ""), (9, "a b", 1, "", ""), (9, "a b", 1, "", ""), (None, "q", 1, "", "")], DOC)
    rows = sorted((r.doc_id is None, r.component_id or 0) for r in simhash_dedup.classes(odd).collect())
    assert rows == [(False, 9), (False, 9), (True, 0), (True, 9)]


def code_cloud(rng, n, centres, flips):
    """Codes near a few centres, and as many anywhere."""
    hubs = [rng.getrandbits(64) for _ in range(centres)]
    out = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(n):
        x = rng.choice(hubs)
        for b in rng.sample(range(64), rng.randrange(flips + 1)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("split,fan,probes,pairs", [(50_000, 16, 4096, 2_000_000), (20, 2, 64, 200), (60, 4, 7, 50)])
def test_links_give_the_components_of_all_pairs(spark, monkeypatch, split, fan, probes, pairs):
    for name, value in (("SPLIT", split), ("FAN", fan), ("PROBES", probes), ("PAIRS", pairs)):
        monkeypatch.setattr(simhash_dedup, name, value)
    rng = random.Random(split)
    codes = code_cloud(rng, 400, 3, 5)
    nodes = spark.createDataFrame([(simhash_dedup.signed(c),) for c in codes], "fp long")
    found = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash_dedup.links(nodes).collect()]
    at = {c: k for k, c in enumerate(codes)}
    parent = list(range(len(codes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in found:
        a, b = sorted((root(at[x]), root(at[y])))
        parent[b] = a
    assert [root(k) for k in range(len(codes))] == brute_classes(codes)


def test_parts_cover_every_pair():
    rng = random.Random(2)
    for mask in (0, 0xFFF, (1 << 47) - 1):
        made = simhash_dedup.parts(mask)
        assert all(p & mask == mask for p in made)
        rest = [p & ~mask for p in made]
        assert sum(p.bit_count() for p in rest) == 64 - mask.bit_count() and np.bitwise_or.reduce(np.array(rest, np.uint64)) == ~np.uint64(mask)
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(200):
            apart = sum(1 << b for b in rng.sample(free, 4))
            assert any(not apart & p for p in made)


def test_gray_rank_and_pruning():
    rank = simhash_dedup.gray_rank(np.array([k ^ k >> 1 for k in range(64)], np.uint64))
    assert rank.tolist() == list(range(64))
    rng = np.random.default_rng(6)
    codes = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    index = simhash_dedup.GrayIndex(codes, np.zeros(len(codes), np.int64))
    every = ~np.uint64(0)
    for level in range(len(index.own) - 1):  # a node's own mask and its parent's do not overlap
        up = np.repeat(index.own[level + 1], np.diff(index.first[level + 1]))
        assert not (index.own[level] & up).any()
    assert (index.own[0] != every).any()
    a, b = index.links()
    assert len(a) == 0 and len(b) == 0

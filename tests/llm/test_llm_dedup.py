"""Jaccard join, suffix arrays and language model against brute force; the pipeline."""

import collections
import hashlib
import math
import os
import re
import subprocess
import sys
import zlib

import numpy as np
import pytest

from casebook.llm import attention, jaccard_join, links, lm_scoring, suffix_dedup
from casebook.llm.license_scan import text_shingles, text_words

ROW = "doc_id long, text string, lang string, source string, n_chars long, component_id string, n string"


def row(k, t):
    return (k, t, "en", f"s{k or 0 % 3}", len(t or ""), "clash", None)


def corpus():
    rng = np.random.default_rng(4)
    vocabulary = [f"v{k}" for k in range(400)]
    make = lambda n: [vocabulary[k] for k in rng.integers(0, 400, n)]
    passage = " ".join(make(30))
    texts = [None, "", "one", "One", "one two three four", "one two three four", "a b c d e", "A b C d e", "a b c d e f"]
    for _ in range(25):
        base = make(int(rng.integers(20, 160)))
        texts.append(" ".join(base))
        for _ in range(int(rng.integers(0, 6))):
            other = list(base)
            for at in rng.integers(0, len(base), int(rng.integers(0, 4))):
                other[at] = "edit%d" % rng.integers(0, 50)
            texts.append(" ".join(other))
    texts += [f"{passage} tail{k} end{k}" for k in range(30)] + [" ".join(make(40)) + " " + passage + " " + " ".join(make(40)) for _ in range(12)]
    chain = make(100)  # each links with the next ones only
    for k in range(12):
        texts.append(" ".join(chain))
        chain = [*chain[3:], *(f"c{k}x{j}" for j in range(3))]
    texts += ["same text again and again here"] * 8 + ["x" * 3000 + " y z w q r " + "long " * 3000]
    order = rng.permutation(len(texts))
    return [row(int(10 * k), texts[i]) for k, i in enumerate(order)]


def brute_classes(rows):
    sets = []
    for r in rows:
        w = text_words(r[1] or "")
        sets.append(text_shingles(w) if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0], len(sets[i]), least[find(i)] if sets[i] else r[0]) for i, r in enumerate(rows))


@pytest.mark.parametrize("salted", [False, True])
def test_jaccard_classes(spark, monkeypatch, salted):
    if salted:  # every group of a word seen more than three times is salted, tries are small
        monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 3)
        monkeypatch.setattr(jaccard_join, "PART", 2)
    rows = corpus()
    df = spark.createDataFrame(rows, ROW).repartition(6)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.classes(df).collect())
    assert got == brute_classes(rows)
    kept = jaccard_join.distinct_documents(df)
    assert kept.columns == df.columns
    want = sorted(k for k, n, c in brute_classes(rows) if k == c or not n)
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_jaccard_links_within_salted_groups(spark, monkeypatch):
    """Sets u, v, w with the same leading shingles of which only v and w link; the groups of all have two salts."""
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 2)  # words seen three times: 4 / 2 salts
    rng = np.random.default_rng(9)
    common = lambda: [f"c{k}" for k in rng.integers(0, 20, 40)]
    texts = []
    for k in range(60):
        key, body = [f"k{k}x{j}" for j in range(14)], common()
        texts += [" ".join(key + common()), " ".join(key + body), " ".join(key + body[:-1] + ["c20"])]
    order = rng.permutation(len(texts))
    rows = [row(int(k), texts[i]) for k, i in enumerate(order)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.classes(spark.createDataFrame(rows, ROW)).collect())
    assert got == brute_classes(rows)
    assert len({c for _, _, c in got}) == 120


def test_jaccard_edges(spark):
    rows = [row(1, "a b c d e f"), row(1, "a b c d e f"), row(1, "other words in this one"), row(2, "a b c d e f"), row(None, "p q r s t"), row(None, None)]
    df = spark.createDataFrame(rows, ROW)
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id or -1) for r in jaccard_join.classes(df).collect())
    assert got == [(-1, 0, -1), (-1, 1, -1), (1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert jaccard_join.distinct_documents(df).count() == 4
    assert jaccard_join.classes(df.limit(0)).count() == 0 and jaccard_join.distinct_documents(df.limit(0)).count() == 0


def test_jaccard_null_and_repeated_ids(spark):
    """Many texts without an id, and many with the same one: each stands for itself, and texts are found by row, not by id."""
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(100):
        base = [f"v{k}" for k in rng.integers(0, 500, 60)]
        texts += [" ".join(base), " ".join(["edit", *base[1:]])]
    texts += [texts[0]] * 5
    ids = [None if k % 4 < 2 else 7 if k % 4 == 2 else 1000 + k for k in range(len(texts))]
    want = []
    parts = {k: c for k, _, c in brute_classes([row(k, t) for k, t in enumerate(texts)])}
    for k, t in enumerate(texts):
        own = [ids[j] for j in parts if parts[j] == parts[k] and ids[j] is not None]
        want.append((ids[k] or 0, len(set(text_shingles(text_words(t)))), min(own, default=0)))
    df = spark.createDataFrame([row(i, t) for i, t in zip(ids, texts)], ROW).repartition(5)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard_join.classes(df).collect())
    assert got == sorted(want)
    kept = jaccard_join.distinct_documents(df).collect()
    assert len(kept) == len(set(parts.values()))
    by_text = {t: parts[k] for k, t in enumerate(texts)}
    assert {by_text[r.text] for r in kept} == set(parts.values())


@pytest.mark.parametrize("same", [None, 5])
def test_jaccard_work_does_not_grow_with_rows_of_an_id(spark, monkeypatch, same):
    """3,000 texts of one id: every text is cut into shingles as often as with ids of their own."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 30)) for _ in range(3000)]
    spread = jaccard_join.join_checked
    joined = []

    def counted(left, right, rows, on, how="inner"):
        out = spread(left, right, rows, on, how)
        if "text" in left.columns:
            joined.append((out.count(), rows))
        return out

    monkeypatch.setattr(jaccard_join, "join_checked", counted)
    df = spark.createDataFrame([row(same, t) for t in texts], ROW).repartition(8)
    assert jaccard_join.classes(df).count() == 3000
    assert joined and all(n == rows for n, rows in joined)


def test_trie_finds_exactly_the_linked_sets():
    rng = np.random.default_rng(2)
    for _ in range(50):
        base = np.sort(rng.choice(10**6, 40, replace=False)).astype(np.uint64)
        sets = [np.sort(np.unique(np.concatenate([rng.choice(base, int(rng.integers(20, 41)), replace=False),
                                                  rng.choice(10**6, int(rng.integers(0, 12))).astype(np.uint64)]))) for _ in range(12)]
        sets += [sets[0][:-3], sets[0]]
        got = set(jaccard_join.Trie(sets).linked(base))
        want = {k for k, s in enumerate(sets) if 100 * len(set(s) & set(base)) >= 80 * len(set(s) | set(base))}
        assert got == want


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a, b = (set(rng.integers(0, 500, 300).tolist()) for _ in range(2))
        bits = [np.frombuffer(jaccard_join.parity(np.array(sorted(x), np.uint64)), "<u8") for x in (a, b)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(a ^ b)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 107), (107, 103), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in links.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 107: 100, 103: 100}
    assert links.components(edges.limit(0)).count() == 0


def brute_removed(rows, n=50):
    data = [(math.inf if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    least = {}
    for k, b in data:
        for a in range(len(b) - n + 1):
            w = b[a:a + n]
            least[w] = min(least.get(w, math.inf), k)
    out = []
    for (k, b), r in zip(data, rows):
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - n + 1):
            if least[b[a:a + n]] < k:
                gone[a:a + n] = True
        edges = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((-1 if r[0] is None else r[0], len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("shard", [1 << 20, 700])
def test_repeated_passages(spark, monkeypatch, tmp_path, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    rng = np.random.default_rng(6)
    letters = lambda n, m=26: "".join(chr(97 + k) for k in rng.integers(0, m, n))
    passage, other = letters(130), "éü" * 40
    texts = [None, "", letters(49), letters(50)] + [letters(int(rng.integers(0, 90))) + passage[int(rng.integers(0, 60)):] + letters(20) for _ in range(14)]
    texts += [other + letters(5), "x" + other, letters(400, 2), letters(300, 2), "ab" * 400, "ab" * 90, passage, passage, letters(2000) + passage]
    rows = [row(k, t) for k, t in enumerate(texts)] + [row(None, passage + "end"), row(4, texts[5]), row(3, texts[3])]
    spark.createDataFrame(rows, ROW).repartition(4).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.starts), r.kept_sha256) for r in suffix_dedup.spans(df).collect())
    assert got == brute_removed(rows)
    if shard > 1000:
        out = suffix_dedup.strip(df)
        assert out.columns == df.columns and out.count() == len(rows)
        by = {r.doc_id: r.text for r in out.collect()}
        assert by[0] is None and by[1] == "" and by[3] == texts[3]
        spark.createDataFrame([], ROW).write.parquet(str(tmp_path / "e"))
        assert suffix_dedup.spans(spark.read.parquet(str(tmp_path / "e"))).count() == 0


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(1)
    for m in (2, 3, 26):
        data = rng.integers(97, 97 + m, 600).astype(np.uint8)
        data[300:420] = data[100:220]
        order, new = suffix_dedup.suffix_array(data)
        keys = [data[k:k + 50].tobytes() for k in range(600)]
        assert order.tolist() == sorted(range(600), key=lambda k: (keys[k], k))
        assert [bool(x) for x in new[1:]] == [keys[a] != keys[b] for a, b in zip(order[1:], order[:-1])]
        ends = np.full(600, 600)
        same = suffix_dedup.common_prefixes(data, ends, order, new)
        assert [bool(x) for x in same[1:]] == [len(keys[a]) == 50 and keys[a] == keys[b] for a, b in zip(order[1:], order[:-1])]


def test_attention_gradient_and_scores():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) + 0.05 * rng.standard_normal(v.shape) for k, v in attention.start().items()}
    follow = rng.standard_normal((attention.CLASSES, attention.GROUPS))
    inside = rng.standard_normal((attention.CLASSES, attention.GROUPS, attention.MEMBERS)) * 0.1
    model = attention.Model(w, follow - np.log(np.exp(follow).sum(1, keepdims=True)), inside)
    classes = rng.integers(0, attention.CLASSES, 200)
    firsts = np.repeat([0, 60, 63], [60, 3, 137])
    batch = attention.windows(classes, firsts, 0)
    loss, g = model.gradient(*batch)
    assert -model.log_probabilities(classes, firsts, 0).mean() == pytest.approx(loss, rel=1e-5)
    for k in attention.SHAPES:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old, e = w[k][at], 1e-4
        w[k][at] = old + e
        up = model.gradient(*batch)[0]
        w[k][at] = old - e
        down = model.gradient(*batch)[0]
        w[k][at] = old
        assert (up - down) / (2 * e) == pytest.approx(float(g[k][at]), rel=2e-2, abs=1e-7), k
    # Causal and separate: later classes and other texts change nothing before.
    changed = classes.copy()
    changed[150:] = 5
    a, b = (model.log_probabilities(x, firsts, 0) for x in (classes, changed))
    assert np.allclose(a[:150], b[:150])
    lengths = np.array([60, 3, 137])
    stream, starts, places = attention.aligned(classes, lengths, 0)
    together = model.log_probabilities(stream, starts, 0)[places]
    alone = [model.log_probabilities(*attention.aligned(x, np.array([len(x)]), 0)[:2], 0)[:len(x)] for x in np.split(classes, [60, 63])]
    assert np.allclose(together, np.concatenate(alone), atol=1e-5)
    before = model.gradient(*batch)[0]
    attention.train(model, *batch, rate=3e-3, batch=4)
    assert model.gradient(*batch)[0] < before


@pytest.mark.parametrize("shift", [0.0, -300.0, 300.0])
def test_attention_shares_in_and_beyond_single_precision(shift):
    """Sums by products with ones, from the greatest score only where it must be: the shares are those of the definition."""
    rng = np.random.default_rng(3)
    scores = (rng.standard_normal((5, attention.SCORED, attention.SPAN)) * 3 + shift).astype(np.float32)
    scores += np.where(attention._CAUSAL, np.float32(0), np.float32(-1e9))
    seen = np.zeros((5, attention.SCORED), np.int64)
    seen[2] = attention.CONTEXT
    exact = np.where(attention._SLOT < seen[:, :, None], -1e9, scores.astype(np.float64))
    want = np.exp(exact - exact.max(2, keepdims=True))
    want /= want.sum(2, keepdims=True)
    got, total = attention._shares(scores, seen)
    assert np.allclose(got / total.reshape(5, -1, 1), want, atol=1e-5)


def test_language_model_counts_and_scores(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lm_scoring, "PACK", 3000)
    rng = np.random.default_rng(3)
    texts = [None, "", "  ", "The THE the É é"] + [" ".join(["The", "cat", "sat."][k] for k in rng.integers(0, 3, int(rng.integers(1, 90)))) for _ in range(120)]
    texts += ["z" * 9000, "rare words only in one text " * 3]
    rows = [row(k, t) for k, t in enumerate(texts)] + [row(None, "no id"), row(7, texts[7])]
    spark.createDataFrame(rows, ROW).repartition(3).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    got = collections.Counter()
    out = lm_scoring.score(df).collect()
    for r in out:
        got[r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)] += 1
        assert math.isfinite(r.score) and r.score < 0
    low = {k: k + 32 for k in range(65, 91)}
    words = [[*re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(low)), None] for _, t, *_ in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    counts = collections.Counter(x for w, h in zip(words, held) if not h for x in w)
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter(
        (r[0], h, len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
        for r, w, h in zip(rows, words, held))
    assert got == want
    alike = [r.score for r in out if r.doc_id == 7]
    assert len(alike) == 2 and alike[0] == pytest.approx(alike[1], abs=1e-4)
    again = {(r.doc_id, r.n_tokens, round(r.score, 3)) for r in lm_scoring.score(df).collect()}
    assert again == {(r.doc_id, r.n_tokens, round(r.score, 3)) for r in out}
    easy = [r.score / r.n_tokens for r in out if r.n_known == r.n_tokens > 40]
    hard = [r.score / r.n_tokens for r in out if r.n_tokens == 2 and r.doc_id == 124]
    assert np.mean(easy) > np.mean(hard)
    spark.createDataFrame([], ROW).write.parquet(str(tmp_path / "e"))
    assert lm_scoring.score(spark.read.parquet(str(tmp_path / "e"))).count() == 0


def test_language_model_learns_from_all_teaching_windows(spark, monkeypatch, tmp_path):
    """At production parameters: every window in every round; held-out texts score better than by the add-one model."""
    rng = np.random.default_rng(5)
    words = ["the", "cat", "sat", "on", "a", "mat"]
    rows = [row(k, " ".join(words[(int(a) + j) % 6] for j in range(int(n)))) for k, (a, n) in enumerate(zip(rng.integers(0, 6, 300), rng.integers(1, 200, 300)))]
    spark.createDataFrame(rows, ROW).repartition(2).write.parquet(str(tmp_path / "d"))
    tree, seen = lm_scoring._tree, []

    def counted(rows_, add):
        out = tree(rows_, add)
        if add is lm_scoring._add_rows:
            seen.append(int(np.frombuffer(out, "<i8")[-2]) >> 20)
        return out

    monkeypatch.setattr(lm_scoring, "_tree", counted)
    out = lm_scoring.score(spark.read.parquet(str(tmp_path / "d"))).collect()
    windows = sum(-(-r.n_tokens // attention.SCORED) for r in out if not r.held_out)
    assert len(seen) == 1 and seen[0] % windows == 0 and seen[0] // windows * (-(-windows // lm_scoring.BATCH) + 1) >= lm_scoring.STEPS
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_in_turns(spark, monkeypatch, tmp_path):
    """Many groups and turns: every window once a pass, the same scores whatever the number of cores or shuffle partitions."""
    for name, value in (("LESSON", 4), ("TASK", 2), ("STEPS", 60), ("BATCH", 2)):
        monkeypatch.setattr(lm_scoring, name, value)
    rng = np.random.default_rng(6)
    rows = [row(k, " ".join(f"w{x}" for x in rng.integers(0, 9, 40))) for k in range(80)]
    spark.createDataFrame(rows, ROW).repartition(2).write.parquet(str(tmp_path / "d"))
    tree, seen = lm_scoring._tree, []

    def counted(rows_, add):
        out = tree(rows_, add)
        if add is lm_scoring._add_rows:
            seen.append(int(np.frombuffer(out, "<i8")[-2]) >> 20)
        return out

    monkeypatch.setattr(lm_scoring, "_tree", counted)
    runs = []
    for shuffle in ("8", "3"):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        runs.append({r.doc_id: r for r in lm_scoring.score(spark.read.parquet(str(tmp_path / "d"))).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert all(abs(runs[0][k].score - runs[1][k].score) < 1e-4 for k in runs[0])
    counted_ = lm_scoring.attention.SCORED
    words = {k: len(lm_scoring_ids(r[1])) + 1 for k, r in enumerate(rows)}
    windows = sum(-(-n // counted_) for k, n in words.items() if not runs[0][k].held_out)
    turns, parts = lm_scoring.plan(sum(n for k, n in words.items() if not runs[0][k].held_out) // counted_ + 1)
    assert turns > 1 and parts > 1 and len(seen) % (2 * turns) == 0
    assert sum(seen) % windows == 0 and sum(seen) >= 2 * windows


def test_language_model_makes_its_lessons_once(spark, monkeypatch, tmp_path):
    """Neither a range exchange's sampling nor anything else runs the scan that cuts the lessons a second time."""
    spark.createDataFrame([row(k, f"a b c{k % 5} d " * 9) for k in range(60)], ROW).repartition(3).write.parquet(str(tmp_path / "d"))
    folder, made = tmp_path / "runs", lm_scoring._count_and_teach
    folder.mkdir()

    def counting(*args):
        run, marks = made(*args), str(folder)

        def over(batches):
            import uuid

            open(f"{marks}/{uuid.uuid4().hex}", "w").close()
            yield from run(batches)
        return over

    monkeypatch.setattr(lm_scoring, "_count_and_teach", counting)
    df = spark.read.parquet(str(tmp_path / "d"))
    assert lm_scoring.score(df).count() == 60
    assert len(list(folder.iterdir())) == df.rdd.getNumPartitions()


STEPS_AND_FAULTS = """
import resource
import numpy as np
from casebook.llm import attention
from casebook.llm._common import warm_heap
warm_heap()
rng = np.random.default_rng(0)
follow, inside = np.zeros((attention.CLASSES, attention.GROUPS)), np.zeros((attention.CLASSES, attention.GROUPS, attention.MEMBERS))
model, state = attention.Model(attention.start(), follow, inside), {}
batch = attention.windows(rng.integers(0, attention.CLASSES, 256 * attention.SCORED), np.zeros(256 * attention.SCORED, np.int64), 0)
faults = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_minflt
for _ in range(3):
    attention.train(model, *batch, rate=3e-3, state=state)
before = faults()
for _ in range(10):
    attention.train(model, *batch, rate=3e-3, state=state)
print((faults() - before) / 10)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="thresholds of glibc")
def test_training_steps_reuse_their_memory():
    """A step's arrays come from memory that the process has: some 2,000 page faults a step took over a quarter of the time."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", STEPS_AND_FAULTS], cwd=root, env={**os.environ, "OMP_NUM_THREADS": "1"},
                         capture_output=True, text=True, check=True, timeout=120)
    assert float(out.stdout) < 400


def lm_scoring_ids(text):
    import public_tokenizers

    with open(public_tokenizers.path(lm_scoring.VOCABULARY), "rb") as f:
        encoder = lm_scoring._encoder(f.read(), public_tokenizers.PATTERN)
    return [i for w in text.split() for i in encoder.encode_ordinary(" " + w)]


def test_lessons_are_the_windows_of_the_texts(monkeypatch):
    monkeypatch.setattr(lm_scoring, "LESSON", 3)
    rng = np.random.default_rng(1)
    lengths = np.array([1, 24, 25, 200, 7, 48])
    c = rng.integers(0, attention.CLASSES, lengths.sum())
    c[np.cumsum(lengths) - 1] = 0
    filled, firsts, places = attention.aligned(c, lengths, 0)
    inputs, targets, seen = attention.windows(filled, firsts, 0)
    real = np.zeros(targets.size, bool)
    real[places] = True
    want = inputs, np.where(real.reshape(targets.shape), targets, -1), seen
    cut = int(lengths[:4].sum())
    rows = list(lm_scoring.lessons([(c[:cut], lengths[:4]), (c[cut:], lengths[4:])]))  # lessons go on from stream to stream
    got = list(zip(*map(lm_scoring.lesson_windows, rows)))
    assert {len(x) for x in got[0][:-1]} == {3}
    for x, y in zip(got, want):
        assert (np.concatenate(x) == y).all()


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeats", "mix", "pack"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    first = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        got = docs.collect()
        if k < 4:
            assert docs.columns == first.columns
        if name == "quality":
            from casebook.llm import quality
            assert {r.doc_id for r in got} == {r.doc_id for r in quality.judge(first).collect() if r.kept}
        if name == "near_copies":
            want = brute_classes([(r.doc_id, r.text) for r in before.values()])
            assert sorted(r.doc_id for r in got) == sorted(i for i, n, c in want if i == c or not n)
        if name == "repeats":
            removed = {x[0]: x for x in brute_removed([(r.doc_id, r.text) for r in before.values()])}
            for r in got:
                if hashlib.sha256(r.text.encode()).hexdigest() != removed[r.doc_id][4]:
                    assert len(r.text.encode()) < removed[r.doc_id][1] - removed[r.doc_id][2] + 6  # cut characters go whole
                assert r.n_chars == len(r.text)
        if name == "mix":
            assert {r.doc_id for r in got} <= set(before) and max(collections.Counter(r.doc_id for r in got).values()) <= 2
        if name == "pack":
            assert sum(r.length for r in got if r.start == 0) > 0 and {r.doc_id for r in got} == set(before)

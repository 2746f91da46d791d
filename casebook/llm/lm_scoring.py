"""Scoring texts with a causal self-attention model over subword ids (operator 7).

Texts are lower-cased (A-Z) words and one end mark each. Documents whose crc32 of the id as text is 2 modulo 7 are held out; all others teach.

1. Every pack of rows sends its different words once, with their counts in teaching documents; per bucket of words the counts
   are added up and each word is cut into subword ids. The packs get both back. The counts of words and of subwords so
   cover all teaching documents.
2. The most frequent subwords become the model's classes (the rest share one, spread by their counts; the end mark has its own). Each pack counts which class
   follows which, and gives away all windows of its teaching text as lessons of up to ``LESSON`` windows (two bytes a class).
3. The lessons are dealt to groups of ``TASK``, and the groups to turns. In a turn each group trains the attention model from the common weights and
   moments over its lessons, one at a time; then weights and moments are averaged by the windows that were seen. Groups per turn and turns
   both grow with the corpus (``plan``). A pass over all lessons is repeated only while there were fewer than ``STEPS`` steps in sequence.
   The lessons are written once, sorted by turn and group, so a turn reads its own files and shuffles nothing.
4. Every text is scored: overlapping context windows, each subword scored once, batched masked attention.

``base_score`` is the add-one word model. The packs are those of one scan, read three times; answers come back by Arrow files in the shared folder, each with a checksum of its pack.

Defined results: a null or empty text is its end mark alone; a null id counts as empty text (it teaches); repeated rows are scored alike and
teach as often as they stand; an empty table gives an empty result. Scores do not depend on the number of cores, but on how the input is
split into scan partitions, which decides what stands in a lesson.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import attention, wordhash
from casebook.llm._common import by_value, cut, lean, shared_folder, shuffle_partitions, warm_heap
from casebook.llm.arrow_output import store
from casebook.llm.suffix_dedup import _write_answers

by_value(__name__)

VOCABULARY = "byte_bpe_50k.tiktoken"
PACK = 5_000_000  # bytes of text in a pack: a task holds one at a time
STEPS = 1000  # in sequence, at least: small corpora are gone over again
TRUST = 20.0  # pairs that the class counts alone stand for beside the counts after a class
RATE = 3e-3
LESSON = 2048  # windows in a training row
TASK = 64  # lessons of a group: what is trained on before the weights are averaged
BATCH = 256  # windows of a step
LESSON_BYTES = 32 << 20  # of a file of lessons, unless that is less than a group
STREAM = 300_000  # subwords worked on at a time
OTHER = attention.CLASSES - 1
HOLD = 7, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- packs -------------------------------------------------------------------------------------------------------------

class Pack:
    """Consecutive rows: ids, words of the texts, which texts teach, and the different words in the order of (bucket, hash)."""

    def __init__(self, no: int, rows: list[pa.RecordBatch], buckets: int):
        self.no = no
        self.ids = pa.concat_arrays([r.column(1).cast(pa.int64()) for r in rows])
        texts = pa.concat_arrays([r.column(0).cast(pa.large_string()) for r in rows])
        hashes, counts = [], []
        self.slices = []
        for _, _, data, offsets in wordhash.byte_slices(texts):
            words = wordhash.Words(data, offsets)
            self.slices.append((data, words.starts, words.ends))
            hashes.append(words.hashes)
            counts.append(words.counts)
        self.hashes = np.concatenate(hashes)
        self.counts = np.concatenate(counts)
        self.bounds = np.append(0, np.cumsum(self.counts))
        self.sum = int(self.hashes.sum(dtype=np.uint64) >> np.uint64(1))
        keys = ["" if x is None else str(x) for x in self.ids.to_pylist()]
        self.held = np.array([zlib.crc32(k.encode()) % HOLD[0] == HOLD[1] for k in keys], bool)
        self.teaches = np.repeat(~self.held, self.counts)
        order = np.argsort(self.hashes)
        ordered = self.hashes[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[:len(order)])
        self.words = ordered[first]
        self.place = np.empty(len(order), np.int64)  # of each word among the different ones
        self.place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        self.sample = order[first]  # one occurrence of each
        bucket = (self.words % np.uint64(buckets)).astype(np.int64)
        self.by_bucket = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.by_bucket]

    def spellings(self) -> list[bytes]:
        """The bytes of each different word, lower-cased."""
        out = []
        sizes = np.cumsum([len(s) for _, s, _ in self.slices])
        which = np.searchsorted(sizes, self.sample, "right")
        bytes_ = [_LOWER[d].tobytes() for d, _, _ in self.slices]
        firsts = sizes - np.diff(sizes, prepend=0)
        for k, s in zip(which.tolist(), self.sample.tolist()):
            _, starts, ends = self.slices[k]
            at = s - firsts[k]
            out.append(bytes_[k][starts[at]:ends[at]])
        return out


def packs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[Pack]:
    from pyspark import TaskContext

    part, count, rows, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(0)), 0), np.int64)
        a = 0
        upto = np.cumsum(lengths)
        while a < len(lengths):
            room = PACK - size + (upto[a - 1] if a else 0)
            b = int(np.searchsorted(upto, room, "right"))
            if b == a and not size:
                b = a + 1  # a row longer than a pack is a pack
            if b > a:
                rows.append(batch.slice(a, b - a))
                size += int(upto[b - 1] - (upto[a - 1] if a else 0))
                a = b
            if a < len(lengths):
                yield Pack((part << 32) + count, rows, buckets)
                count, rows, size = count + 1, [], 0
    if rows:
        yield Pack((part << 32) + count, rows, buckets)


# --- step 1: words -----------------------------------------------------------------------------------------------------

WORDS = "bucket bigint, pack bigint, sum bigint, hashes binary, counts binary, sizes binary, letters binary"


def _send_words(buckets: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in packs(batches, buckets):
            counts = np.bincount(pack.place, pack.teaches, len(pack.words)).astype("<u4")
            letters = pack.spellings()
            order = pack.by_bucket
            firsts = np.flatnonzero(np.diff(pack.bucket, prepend=-1))
            rows = {k: [] for k in ("bucket", "pack", "sum", "hashes", "counts", "sizes", "letters")}
            for at in np.split(order, firsts[1:]) if len(firsts) else []:
                own = [letters[k] for k in at.tolist()]
                rows["bucket"].append(int(pack.words[at[0]] % np.uint64(buckets)))
                rows["pack"].append(pack.no)
                rows["sum"].append(pack.sum)
                rows["hashes"].append(pack.words[at].tobytes())
                rows["counts"].append(counts[at].tobytes())
                rows["sizes"].append(_narrow(np.array([len(x) for x in own], np.int64)))
                rows["letters"].append(b"".join(own))
            kinds = [pa.int64()] * 3 + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], list(rows))
    return run


ANSWERS = "part int, shard bigint, sum bigint, bucket bigint, rows binary"


def _encoder(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("casebook", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _answer_words(ranks: bytes, pattern: str):
    """Per bucket: for each pack the total counts and subword ids of its words; one row with totals (part -1)."""
    def run(table: pa.Table) -> pa.Table:
        encoder = _encoder(ranks, pattern)
        lists = [np.frombuffer(x, "<u8") for x in table["hashes"].to_pylist()]
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in table["counts"].to_pylist()])
        sizes = np.concatenate([_wide(x, len(y)) for x, y in zip(table["sizes"].to_pylist(), lists)])
        letters = b"".join(table["letters"].to_pylist())
        stops = np.cumsum(sizes)
        all_ = np.concatenate(lists)
        known, first, place = np.unique(all_, return_index=True, return_inverse=True)
        total = np.bincount(place, counts, len(known)).astype(np.int64)
        words = [" " + letters[stops[k] - sizes[k]:stops[k]].decode("utf-8", "replace") for k in first.tolist()]
        ids = [encoder.encode_ordinary(w) for w in words]
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        used = np.bincount(flat, np.repeat(total, lengths)).astype(np.int64)
        at = np.flatnonzero(used)
        stat = np.concatenate([[np.count_nonzero(total), total.sum(), len(at)], at, used[at]]).astype("<i8").tobytes()
        answers, a = [], 0
        for x in lists:
            own = place[a:a + len(x)]
            a += len(x)
            n = lengths[own]
            take = np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            size, ids_ = _narrow(n), _narrow(flat[take])
            answers.append(np.array([len(size), len(take)], "<i8").tobytes() + total[own].astype("<i8").tobytes() + size + ids_)
        bucket = table["bucket"][0].as_py()
        packs_ = table["pack"].to_pylist()
        return pa.table({
            "part": pa.array([p >> 32 for p in packs_] + [-1], pa.int32()), "shard": pa.array([*packs_, 0], pa.int64()),
            "sum": pa.array([*table["sum"].to_pylist(), 0], pa.int64()), "bucket": pa.array([bucket] * (len(packs_) + 1), pa.int64()),
            "rows": pa.array([*answers, stat], pa.binary())})
    return run


def _sum_stats(table: pa.Table) -> pa.Table:
    """Adds the totals of several buckets: (different words, words, subword ids and their counts)."""
    words = total = 0
    counts: dict[int, int] = {}
    for row in table["rows"].to_pylist():
        x = np.frombuffer(row, "<i8")
        words, total, n = words + int(x[0]), total + int(x[1]), int(x[2])
        for k, c in zip(x[3:3 + n].tolist(), x[3 + n:].tolist()):
            counts[k] = counts.get(k, 0) + c
    at = sorted(counts)
    out = np.array([words, total, len(at), *at, *[counts[k] for k in at]], "<i8").tobytes()
    return pa.table({"salt": pa.array([0], pa.int32()), "rows": pa.array([out], pa.binary())})


class Vocabulary:
    """The packs' answers of one scan partition."""

    def __init__(self, folder: str, buckets: int):
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        self.buckets = buckets
        fs, root = store(folder)
        path = f"{root}/{TaskContext.get().partitionId():07d}.arrow"
        self.rows: dict[int, dict[int, tuple[int, bytes]]] = {}
        if fs.get_file_info(path).type != pafs.FileType.NotFound:
            with fs.open_input_file(path) as source:
                for r in pa.ipc.open_file(source).read_all().to_pylist():
                    self.rows.setdefault(r["shard"], {})[r["bucket"]] = (r["sum"], r["rows"])

    def of(self, pack: Pack) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(count, first id, number of ids) of each different word, and the ids."""
        n = len(pack.words)
        counts, first, size = (np.zeros(n, np.int64) for _ in range(3))
        ids, held = [], 0
        cuts = np.flatnonzero(np.diff(pack.bucket, prepend=-1))
        for at in np.split(pack.by_bucket, cuts[1:]) if len(cuts) else []:
            total, rows = self.rows[pack.no][int(pack.words[at[0]] % np.uint64(self.buckets))]
            if total != pack.sum:
                raise RuntimeError("the scan gave other rows than before; write the input to a table first")
            m = len(at)
            sizes, k = (int(x) for x in np.frombuffer(rows, "<i8", 2))
            counts[at] = np.frombuffer(rows, "<i8", m, 16)
            own = _wide(rows[16 + 8 * m:16 + 8 * m + sizes], m)
            flat = _wide(rows[16 + 8 * m + sizes:], k).astype(np.uint32)
            size[at], first[at] = own, held + np.cumsum(own) - own
            ids.append(flat)
            held += len(flat)
        return counts, first, size, np.concatenate(ids) if ids else np.zeros(0, np.uint32)


# --- steps 2 to 4: the model -------------------------------------------------------------------------------------------

class Classes:
    """Subword id -> class, and log10 p(id | class) for ids that share the class ``OTHER``. Class 0: the end mark."""

    def __init__(self, counts: np.ndarray, end_count: int):
        order = np.lexsort((np.arange(len(counts)), -counts))[:attention.CLASSES - 2]
        self.of = np.full(len(counts), OTHER, np.int64)
        self.of[order] = np.arange(1, len(order) + 1)
        rest = self.of == OTHER
        within = np.log10((counts + 1) / max(int(counts[rest].sum() + rest.sum()), 1))
        self.within = np.where(rest, within, 0.0)
        totals = np.bincount(self.of, counts, attention.CLASSES) + 1.0
        totals[0] = end_count + 1
        self.shares = totals / totals.sum()

    def logits(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log p(group | class before), log p(member | class before, group)) from the counts of pairs."""
        p = pairs.reshape(attention.CLASSES, attention.CLASSES) + TRUST * self.shares
        p = p.reshape(attention.CLASSES, attention.GROUPS, attention.MEMBERS)
        groups = p.sum(2)
        return (np.log(groups / groups.sum(1, keepdims=True)).astype(np.float32),
                np.log(p / groups[:, :, None]).astype(np.float32))


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers as 2 bytes each if all fit, else 4; ``_wide`` tells by the length."""
    return values.astype("<u2" if not len(values) or values.max() < 1 << 16 else "<u4").tobytes()


def _wide(row: bytes, n: int) -> np.ndarray:
    return np.frombuffer(row, "<u2" if len(row) == 2 * n else "<u4").astype(np.int64)


def _stream(pack: Pack, first: np.ndarray, size: np.ndarray, ids: np.ndarray, a: int, b: int, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(subword ids with -1 as end mark, texts' lengths) of the texts a to b that are in ``keep``."""
    counts, place = pack.counts[a:b], pack.place[pack.bounds[a]:pack.bounds[b]]
    if not keep[a:b].all():
        place = place[np.repeat(keep[a:b], counts)]
        counts = counts[keep[a:b]]
    n = size[place]
    take = np.repeat(first[place] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    upto = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(counts))]
    lengths = np.diff(upto)
    out = np.full(len(take) + len(lengths), -1, np.int64)
    real = np.ones(len(out), bool)
    real[np.cumsum(lengths + 1) - 1] = False
    out[real] = ids[take]
    return out, lengths + 1


def _classes(ids: np.ndarray, classes: Classes) -> np.ndarray:
    return np.where(ids < 0, 0, classes.of[np.maximum(ids, 0)])


def _streams(pack: Pack, first: np.ndarray, size: np.ndarray, ids: np.ndarray, keep: np.ndarray):
    """(first text, last text, ids, lengths) of consecutive texts of the pack, ``STREAM`` subwords at a time, whole texts; of those in ``keep``."""
    n = len(pack.counts)
    own = np.bincount(np.repeat(np.arange(n), pack.counts), size[pack.place], n) * keep
    upto = np.cumsum(own)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + STREAM, "right")))
        stream, lengths = _stream(pack, first, size, ids, a, b, keep)
        if len(stream):
            yield a, b, stream, lengths
        a = b


COUNTED = "kind int, turn int, part int, no bigint, rows binary"


def plan(windows: int) -> tuple[int, int]:
    """(turns, groups of a turn) for about so many windows: groups grow with the square of the turns."""
    groups = max(1, -(-windows // (LESSON * TASK)))
    turns = max(1, round(groups ** (1 / 3)))
    return turns, -(-groups // turns)


def lessons(streams: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[bytes]:
    """All windows of the texts of all streams (classes, lengths): the classes of the window before and of ``LESSON`` windows (2 bytes each),
    then a byte a window: its number of real places, and 32 if a text starts there. Only the last lesson may be shorter."""
    span = attention.SCORED
    held, marks = np.zeros(span, "<i2"), np.zeros(0, np.uint8)

    def row(n: int) -> bytes:
        return held[:(n + 1) * span].tobytes() + marks[:n].tobytes()

    for c, lengths in streams:
        filled, _, places = attention.aligned(c, lengths, 0)
        count = -(-lengths // span)
        own = np.bincount(places // span, minlength=int(count.sum())).astype(np.uint8)
        own[np.cumsum(count) - count] += 32
        held, marks = np.concatenate([held, filled.astype("<i2")]), np.concatenate([marks, own])
        while len(marks) >= LESSON:
            yield row(LESSON)
            held, marks = held[LESSON * span:], marks[LESSON:]
    if len(marks):
        yield row(len(marks))


def lesson_windows(row: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, seen) of a lesson, as ``attention.windows`` has them; -1 for targets past a text's end."""
    span = 2 * attention.SCORED
    n = (len(row) - span) // (span + 1)
    classes = np.frombuffer(row, "<i2", (n + 1) * attention.SCORED).astype(np.int64)
    marks = np.frombuffer(row, np.uint8, n, (n + 1) * span)
    before = classes[attention.SCORED - attention.CONTEXT - 1:]
    inputs = np.lib.stride_tricks.sliding_window_view(before, attention.SPAN)[::attention.SCORED][:n]
    targets = classes[attention.SCORED:].reshape(n, attention.SCORED)
    targets = np.where(np.arange(attention.SCORED) < (marks & 31)[:, None], targets, -1)
    seen = np.repeat(np.where(marks & 32, attention.CONTEXT, 0)[:, None], attention.SCORED, 1)
    return inputs, targets, seen


def _count_and_teach(buckets: int, folder: str, classes_of, turns: int, parts: int):
    """Kind 0: how often each class follows each; kind 1: lessons, dealt to turns and their groups."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary, classes = Vocabulary(folder, buckets), classes_of.value
        pairs = np.zeros(attention.CLASSES ** 2, np.int64)

        def row(kind: int, no: int, data: bytes) -> pa.RecordBatch:
            slot = zlib.crc32(b"%d" % no) % (turns * parts)
            return pa.RecordBatch.from_pydict({
                "kind": pa.array([kind], pa.int32()), "turn": pa.array([slot % turns], pa.int32()), "part": pa.array([slot // turns], pa.int32()),
                "no": pa.array([no], pa.int64()), "rows": pa.array([data], pa.binary())})

        def streams(pack: Pack, *spelled: np.ndarray):
            for _, _, stream, lengths in _streams(pack, *spelled, ~pack.held):
                c = _classes(stream, classes)
                np.add.at(pairs, np.append(0, c[:-1]) * attention.CLASSES + c, 1)
                yield c, lengths

        for pack in packs(batches, buckets):
            for count, lesson in enumerate(lessons(streams(pack, *vocabulary.of(pack)[1:]))):
                yield row(1, (pack.no << 12) + count, lesson)
        yield row(0, TaskContext.get().partitionId(), _sparse(pairs))
    return run


def _sparse(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts)
    return np.concatenate([at, counts[at]]).astype("<i8").tobytes()


def _dense(row: bytes, size: int) -> np.ndarray:
    at, counts = np.split(np.frombuffer(row, "<i8"), 2)
    return np.bincount(at, counts, size)


def _add_pairs(table: pa.Table) -> pa.Table:
    total = np.zeros(attention.CLASSES ** 2)
    for row in table["rows"].to_pylist():
        total += _dense(row, len(total))
    return pa.table({"salt": pa.array([0], pa.int32()), "rows": pa.array([_sparse(total.astype(np.int64))], pa.binary())})


def _add_rows(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, "<i8") for x in table["rows"].to_pylist())
    return pa.table({"salt": pa.array([0], pa.int32()), "rows": pa.array([total.tobytes()], pa.binary())})


def _tree(rows: DataFrame, add) -> bytes | None:
    """Adds up rows of numbers, first in salted parts; one row of fixed size comes to the driver."""
    salted = rows.select(F.pmod(F.monotonically_increasing_id(), F.lit(64)).cast("int").alias("salt"), "rows")
    schema = "salt int, rows binary"
    out = salted.groupBy("salt").applyInArrow(add, schema).groupBy("salt").applyInArrow(add, schema)
    out = out.withColumn("salt", F.lit(0)).groupBy("salt").applyInArrow(add, schema).collect()
    return bytes(out[0].rows) if out else None


def _train_parts(model_of, start_of, pass_no: int, rate: float, step: int, least: int):
    """Each group's pass over its lessons (or passes, until there were ``least`` steps) from the common weights and moments ->
    (both * windows, windows, steps * windows), summed for the task (64-bit fixed point). A task's rows come group by group."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        warm_heap()
        weights, moments = model_of.value
        total, group, held = None, None, []

        def taught() -> np.ndarray:
            held.sort()
            model, state = attention.Model(attention.shaped(weights), *start_of.value), attention.state_of(moments, step)
            seen, own = 0, pass_no
            while not seen or state["step"] - step < least:
                for k in np.random.default_rng(own).permutation(len(held)):
                    windows = lesson_windows(held[k][1])
                    attention.train(model, *windows, rate, BATCH, seed=own, state=state)
                    seen += len(windows[0])
                own += 1
            out = np.concatenate([attention.flat(model.w), attention.moments(state), [1, state["step"] - step]])
            return np.round(out.astype(np.float64) * seen * (1 << 20)).astype("<i8")  # whole numbers: sums don't depend on the order

        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != group and held:
                    total, held = taught() + (0 if total is None else total), []
                group = r["part"]
                held.append((r["no"], r["rows"]))
        if held:
            total = taught() + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([total.tobytes()], pa.binary())})
    return run


def _trained(taught: DataFrame, turns: int, parts: int, start_of) -> np.ndarray:
    """The model's weights after all turns: one job a turn over the turn's own files; a row of fixed size comes back.
    A corpus of a single group repeats its passes in that group's task."""
    sc = taught.sparkSession.sparkContext
    weights = attention.flat(attention.start())
    moments, done, pass_no = np.zeros(2 * len(weights), np.float32), 0.0, 0
    while True:
        before = done
        for turn in range(turns):
            model_of = sc.broadcast((weights, moments))
            rate = RATE / (1 + done / (4 * STEPS)) ** 0.5
            run = _train_parts(model_of, start_of, pass_no, rate, round(done), STEPS if turns * parts == 1 else 0)
            total = _tree(taught.where(F.col("turn") == turn).select("part", "no", "rows").mapInArrow(run, "rows binary"), _add_rows)
            if total is not None:
                total = np.frombuffer(total, "<i8").astype(np.float64)
                weights, moments = np.split((total[:-2] / total[-2]).astype(np.float32), [len(weights)])
                done += total[-1] / total[-2]
            model_of.unpersist()
        pass_no += 1
        if done >= STEPS or done == before:
            return weights


def _score(buckets: int, folder: str, classes_of, start_of, model_of, totals: tuple[int, int, int]):
    n_total, v, ends = totals

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        warm_heap()
        vocabulary, classes = Vocabulary(folder, buckets), classes_of.value
        model = attention.Model(attention.shaped(model_of.value), *start_of.value)
        below = math.log10(n_total + (v + 1))
        for pack in packs(batches, buckets):
            counts, first, size, ids = vocabulary.of(pack)
            bounds = pack.bounds
            per_word = (np.log10(counts + 1.0) - below)[pack.place]
            sums = lambda x: np.array([x[a:b].sum() for a, b in zip(bounds[:-1], bounds[1:])])
            base = sums(per_word) + (math.log10(ends + 1) - below)
            known = sums((counts > 0)[pack.place].astype(np.int64)) + (ends > 0)
            score = np.zeros(len(pack.counts))
            for a, b, stream, lengths in _streams(pack, first, size, ids, np.ones(len(score), bool)):
                c = _classes(stream, classes)
                starts = np.cumsum(lengths) - lengths
                filled, firsts, places = attention.aligned(c, lengths, 0)
                logp = model.log_probabilities(filled, firsts, 0)[places] / math.log(10)
                logp += np.where(stream < 0, 0.0, classes.within[np.maximum(stream, 0)])
                score[a:b] = np.add.reduceat(logp, starts)
            yield pa.RecordBatch.from_pydict({
                "id": pack.ids, "held_out": pa.array(pack.held), "n_tokens": pa.array(pack.counts.astype(np.int64) + 1),
                "n_known": pa.array(known.astype(np.int64)), "train_tokens": pa.array(np.full(len(score), n_total, np.int64)),
                "base_score": pa.array(base), "score": pa.array(score)})
    return run


SCORED = ("id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
          pattern: str | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text; see the module's text.

    ``docs`` must be a table as read, with narrow steps only: it is scanned three times and must give the same rows.
    """
    import public_tokenizers

    spark = docs.sparkSession
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = f.read()
    pattern = pattern or public_tokenizers.PATTERN
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"))
    buckets = max(shuffle_partitions(spark), rows.rdd.getNumPartitions())

    folder = shared_folder(spark, "lm-words")
    words = rows.mapInArrow(_send_words(buckets), WORDS)
    answers = cut(words.groupBy("bucket").applyInArrow(_answer_words(ranks, pattern), ANSWERS), "lm-answers")
    answers.where("part >= 0").groupBy("part").applyInArrow(_write_answers(folder), "part int").write.format("noop").mode("overwrite").save()
    stat = _tree(answers.where("part < 0").select("rows"), _sum_stats)
    x = np.frombuffer(stat, "<i8") if stat else np.zeros(3, np.int64)
    n = int(x[2])
    ends = docs.select(F.count_if(F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(HOLD[0])) != HOLD[1])
                       .alias("n")).first().n
    subwords = np.zeros(max(len(ranks.splitlines()), int(x[3:3 + n].max(initial=0)) + 1), np.int64)
    subwords[x[3:3 + n]] = x[3 + n:]
    classes = Classes(subwords, ends)
    classes_of = spark.sparkContext.broadcast(classes)  # a few arrays of the vocabulary's size

    # A few windows more than these: texts end in part of a window.
    windows = (int(subwords.sum()) + ends) // attention.SCORED + 1
    turns, parts = plan(windows)
    lesson_rows = rows.mapInArrow(_count_and_teach(buckets, folder, classes_of, turns, parts), COUNTED)
    files = max(shuffle_partitions(spark), min(turns * parts, 4096), windows * (2 * attention.SCORED + 1) // LESSON_BYTES)
    found = shared_folder(spark, "lm-windows")
    # A group's file follows from its number: ranges would be found by making all lessons once more.
    file = F.floor((F.col("turn").cast("long") * parts + F.col("part")) * files / (turns * parts)).cast("int")
    lesson_rows.repartitionById(files, file).sortWithinPartitions("kind", "turn", "part").write.partitionBy(
        "kind", "turn").parquet(found)
    found = spark.read.schema(COUNTED).parquet(found)
    counted = _tree(found.where("kind = 0").select("rows"), _add_pairs)  # the classes' pairs at most
    pairs = _dense(counted, attention.CLASSES ** 2) if counted else np.zeros(attention.CLASSES ** 2)
    start_of = spark.sparkContext.broadcast(classes.logits(pairs))
    weights = _trained(found.where("kind = 1"), turns, parts, start_of)
    model_of = spark.sparkContext.broadcast(weights)
    totals = (int(x[1]) + ends, int(x[0]) + (ends > 0), ends)
    return rows.mapInArrow(_score(buckets, folder, classes_of, start_of, model_of, totals), SCORED).withColumnRenamed("id", id_col)

"""Order-preserving packing by dynamic programming (operator 8).

The documents in id order are one stream of token ids. Windows of at most ``max_len`` tokens are cut from it at document
ends, at sentence ends, and, where a sentence is longer than ``STEP`` tokens, at every ``STEP`` of it. With f(j) the
least cost of the stream up to cut j,

    f(j) = penalty(j) + min over i with cut(j) - cut(i) <= max_len of f(i) + padding(cut(j) - cut(i)).

A window is padded to ``max_len``, so its padding is linear in cut(i) and the least f(i) + cut(i) of the sliding
range stands at the head of a monotone queue: each cut enters and leaves it once. Windows whose length is one of ``EXACT`` (powers of
two) need no padding and are looked up by their place. Cuts inside a document cost a truncation penalty.

Tasks hold ranges of documents and pack each by itself, streaming: after ``SEGMENT`` tokens the best path is kept up to
its last cut and the rest is carried on. Sequence ids are the range's number and a count within it.

Defined results: a null or empty text is its end id alone; rows that share an id are packed one after the other, in any
order; null ids come first; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import tokens
from casebook.llm._common import by_value, lean, shuffle_partitions

by_value(__name__)

VOCABULARY = "word_bpe_49k.json"
MAX_LEN = 2048
EXACT = (256, 512, 1024, 2048)  # lengths without padding
SENTENCE_CUT = 8  # truncation penalty in tokens: at a sentence end inside a document
HARD_CUT = 64  # inside a sentence
STEP = 128
SEGMENT = 500_000
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def best_cuts(cuts: np.ndarray, penalty: np.ndarray, max_len: int = MAX_LEN, exact: tuple[int, ...] = EXACT):
    """(costs, previous cut) of every cut; ``cuts[0]`` is the stream's start, gaps are at most ``max_len``."""
    c, pen = cuts.tolist(), penalty.tolist()
    at = {x: k for k, x in enumerate(c)}
    exact = tuple(x for x in exact if x <= max_len)
    f, back, g = [0.0] * len(c), [0] * len(c), [0.0] * len(c)
    g[0] = f[0] + c[0]
    queue = deque([0])
    for j in range(1, len(c)):
        here = c[j]
        while c[queue[0]] < here - max_len:
            queue.popleft()
        i = queue[0]
        best = g[i] + max_len - here
        for length in exact:
            k = at.get(here - length)
            if k is not None and f[k] < best:
                best, i = f[k], k
        best += pen[j]
        f[j], back[j], g[j] = best, i, best + here
        while queue and g[queue[-1]] >= g[j]:
            queue.pop()
        queue.append(j)
    return f, back


def allowed_cuts(n: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, step: int = STEP):
    """Sorted cut places in [0, n] and their penalties; long sentences are cut at every ``step``."""
    kind = np.full(n + 1, np.inf)
    kind[sentence_ends] = SENTENCE_CUT
    kind[doc_ends] = 0
    kind[0] = kind[n] = 0
    known = np.flatnonzero(np.isfinite(kind))
    gaps = np.diff(known)
    for k in np.flatnonzero(gaps > step):
        kind[np.arange(known[k] + step, known[k + 1], step)] = HARD_CUT
    cuts = np.flatnonzero(np.isfinite(kind))
    return cuts, kind[cuts]


def chosen(cuts: np.ndarray, penalty: np.ndarray, last: bool, max_len: int = MAX_LEN) -> list[int]:
    """The windows' ends on the best path. Before the end of the stream only those whose windows are settled."""
    f, back = best_cuts(cuts, penalty, max_len)
    j = len(cuts) - 1
    if not last:  # any later window starts at one of the last cuts: take the cheapest so far
        near = np.flatnonzero(cuts > cuts[-1] - max_len)
        j = int(near[np.argmin(np.array(f)[near] + cuts[near])])
    path = []
    while j:
        path.append(int(cuts[j]))
        j = back[j]
    return path[::-1]


class _Packer:
    def __init__(self, part: int, stops: np.ndarray):
        self.next_id = part << 32
        self.stops = stops
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []  # (doc_id, first place of the document in the wait, its tokens)
        self.ends: list[int] = []
        self.held = 0

    def add(self, keys: list, ids: np.ndarray, lengths: np.ndarray) -> Iterator[list[tuple]]:
        ends = self.held + np.cumsum(lengths)
        self.docs += zip(keys, (ends - lengths).tolist(), lengths.tolist())
        self.ends += ends.tolist()
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= SEGMENT:
            yield self.flush(False)

    def flush(self, last: bool) -> list[tuple]:
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint32)
        if not len(ids):
            return []
        sentences = np.flatnonzero(self.stops[ids]) + 1
        cuts, penalty = allowed_cuts(len(ids), np.array(self.ends), sentences)
        path = chosen(cuts, penalty, last)
        bounds, out, k = [0, *path], [], 0
        for a, b in zip(bounds, path):
            while k < len(self.docs):
                doc, first, n = self.docs[k]
                lo, hi = max(a, first), min(b, first + n)
                if lo >= b:
                    break
                out.append((doc, lo - first, hi - lo, zlib.crc32(ids[lo:hi].astype("<u4")), n, self.next_id, lo - a))
                if first + n > b:
                    break
                k += 1
            self.next_id += 1
        done = bounds[-1]
        self.ids, self.held = [ids[done:]], len(ids) - done
        self.docs = [(d, first - done, n) for d, first, n in self.docs[k:]]
        self.ends = [e - done for e in self.ends if e > done]
        return out


def _pack(spec: str, end_id: int, reuse: bool):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        table = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 7)], names)
        encoder = packer = None
        for batch in batches:
            if encoder is None:
                encoder = (tokens.worker_encoder if reuse else tokens.ChunkEncoder)(spec, spaced=False)
                packer = _Packer(TaskContext.get().partitionId(), sentence_stops(encoder.plain))
            keys = batch.column(0).to_pylist()
            for a, b, ids, lengths in encoder.slices(batch.column(1)):
                ids, lengths = tokens.with_end(ids, lengths, end_id)
                yield from map(table, packer.add(keys[a:b], ids, lengths))
        if packer:
            yield table(packer.flush(True))
    return run


def sentence_stops(tokenizer) -> np.ndarray:
    """For each id: whether a sentence may end after it (its characters are stops)."""
    out = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, k in tokenizer.get_vocab().items():
        text = token.removesuffix("</w>")
        out[k] = bool(text) and token.endswith("</w>") and set(text) <= set(".!?")
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         end_id: int = 1, reuse: bool = True) -> DataFrame:
    """One row for each piece of a document in a sequence: see ``PIECES``.

    ``reuse``: Python workers keep their encoder for later tasks, faster but some 150 MB that other stages of a long job lack.
    """
    spec = tokens.load(vocabulary or tokens.vocabulary_path(VOCABULARY))
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(shuffle_partitions(docs.sparkSession), "id").sortWithinPartitions("id")
    )
    return ordered.mapInArrow(_pack(spec, end_id, reuse), PIECES)

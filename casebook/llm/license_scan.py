"""License scans by MinHash over overlapping text windows (operator 4).

Punctuation, typographic quotes and comment marks count as white space. A text's five-word shingles stand in units of ``BASE`` * 2^k, at most
an eighth of the template (or one ``BASE``). Windows start at every unit and have as many units as any occurrence of the template
needs to lie whole inside one; so a text is covered by overlapping windows for every template, short notices too. A window's MinHash signature has
bands of one row. A window that holds ``threshold`` of a template's shingles
has at least Jaccard similarity s with it, so some of b bands collides with probability 1 - (1 - s)^b; b is chosen for each template so that this is
at least 1 - ``MISS``. Windows of all sizes share the minima of units. Windows that collide with a template in any of
its bands are checked exactly: the distinct five-word shingles of the template, as words, that occur in the window.

Defined results: a null or empty text matches nothing; repeated rows give repeated results; an empty table gives an empty
result; of a text's windows with equal counts the first is reported; a template needs five words at least.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import wordhash
from casebook.llm._common import by_value, lean
from casebook.llm.licenses import LICENSES

by_value(__name__)

SIZE = 5
MISS = 1e-9  # greatest chance that a window is not retrieved
THRESHOLD = 80  # percent of a template's distinct shingles
FOUND = "doc_id bigint, license string, matched bigint, shingles bigint, first_word bigint"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {k: k + 32 for k in range(65, 91)}


def text_words(text: str) -> list[str]:
    return [w.translate(_LOWER) for w in _WORD.findall(text)]


def text_shingles(words: Sequence[str]) -> set[tuple[str, ...]]:
    return {tuple(words[k:k + SIZE]) for k in range(len(words) - SIZE + 1)}


# --- license texts -----------------------------------------------------------------------------------------------------

BASE = 4  # shingles of the smallest unit
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[k for k in range(33, 127) if not chr(k).isalnum()]] = True


def plain_bytes(data: np.ndarray) -> np.ndarray:
    """The bytes of a text with ASCII punctuation, typographic quotes and dashes as white space (comment marks too)."""
    out = np.where(_PUNCTUATION[data], np.uint8(32), data)
    at = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] >= 0x90) & (data[2:] <= 0xA7)) if len(data) > 2 else []
    for k in range(3):
        out[np.asarray(at, np.int64) + k] = 32
    return out


def plain_words(text: str) -> list[str]:
    return text_words(plain_bytes(np.frombuffer(text.encode(), np.uint8)).tobytes().decode("utf-8", "replace"))


def window_of(shingles: int) -> tuple[int, int]:
    """(shingles of a unit, units of a window) for a template of so many shingles in a row."""
    unit = BASE
    while 16 * unit <= shingles:
        unit *= 2
    return unit, -(-(shingles + unit - 1) // unit)


def bands_for(shingles: int, window: int, threshold: int = THRESHOLD, miss: float = MISS) -> int:
    """Bands that retrieve a window of ``window`` shingles which holds ``threshold`` percent of so many, but for a chance of ``miss``."""
    held = -(-shingles * threshold // 100)
    similar = held / (shingles + window - held)
    return math.ceil(math.log(miss) / math.log(1 - similar)) if similar < 1 else 1


class _Licenses:
    """Templates: (license, family, (unit, units), shingles) in ``known``; their bands and the lowest value of each."""

    def __init__(self, licenses: Sequence[tuple[str, str, str]], threshold: int, miss: float):
        self.known, hashed = [], []
        self.classes: dict[int, dict[int, list[int]]] = {}  # unit -> units of a window -> templates
        for name, family, text in licenses:
            words = plain_words(text)
            if len(words) < SIZE:
                raise ValueError(f"a template of {name!r} has fewer than {SIZE} words")
            (_, _, data, offsets), = wordhash.byte_slices(pa.array([" ".join(words)]))
            hashed.append(np.unique(wordhash.shingles(wordhash.Words(data, offsets), SIZE)[0]).astype(np.uint32))
            window = window_of(len(words) - SIZE + 1)
            self.classes.setdefault(window[0], {}).setdefault(window[1], []).append(len(self.known))
            self.known.append((name, family, window, text_shingles(words)))
        self.bands = [bands_for(len(k[3]), k[2][0] * k[2][1], threshold, miss) for k in self.known]
        rng = np.random.default_rng(7)
        # 32 bits of a hash: different shingles that share them only give windows to check in vain.
        self.odd = rng.integers(0, 1 << 31, max(self.bands, default=0), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.lows = [[(h * o).min() for o in self.odd[:b]] for h, b in zip(hashed, self.bands)]

    def span(self, t: int) -> int:
        """Words of a window of the template ``t``."""
        unit, units = self.known[t][2]
        return unit * units + SIZE - 1

    def windows(self, hashes: np.ndarray, text: np.ndarray, place: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, first word, template) of the windows to check."""
        hashes = hashes.astype(np.uint32)
        base = np.flatnonzero(place % BASE == 0)
        hits = []
        for unit, of in self.classes.items():
            starts = np.flatnonzero(place[base] % unit == 0)
            own = text[base[starts]]
            same = [own[j:] == own[:max(len(own) - j, 0)] for j in range(max(of))]  # whether j units on it is the same text: a window ends with it
            hits.append((starts, same, {units: [(t, np.zeros(len(starts), bool)) for t in ts] for units, ts in of.items()}))
        for k, odd in enumerate(self.odd):
            low = np.minimum.reduceat(hashes * odd, base)
            for starts, same, of in hits:
                wanted = {units: [(t, hit) for t, hit in ts if k < self.bands[t]] for units, ts in of.items()}
                most = max((units for units, ts in wanted.items() if ts), default=0)
                if not most:
                    continue
                first = low if len(starts) == len(low) else np.minimum.reduceat(low, starts)
                window = first.copy()
                for units in range(1, most + 1):  # the minimum of so many units from each on
                    j = units - 1
                    if 0 < j < len(first):
                        np.minimum(window[:-j], first[j:], out=window[:-j], where=same[j])
                    for t, hit in wanted.get(units, ()):
                        hit |= window == self.lows[t][k]
        found = set()
        for starts, _, of in hits:
            for ts in of.values():
                for t, hit in ts:
                    found.update((int(text[base[s]]), int(place[base[s]]), t) for s in starts[hit].tolist())
        return found

    def best(self, matches: list[tuple[int, int, int]], threshold: int) -> list[tuple[str, int, int, int]]:
        """Of a text's (template, matched, first word): one (license, matched, shingles, first word) for each license, without
        those whose window overlaps that of a better match of the same family."""
        good = [(n / len(self.known[t][3]), n, -first, t) for t, n, first in matches if 100 * n >= threshold * len(self.known[t][3])]
        rows, spans = {}, []
        for share, n, first, t in sorted(good, reverse=True):
            name, family, _, shingles = self.known[t]
            lo, hi = -first, -first + self.span(t)
            if name in rows or any(family == f and name != m and share < s and lo < b and a < hi for f, m, s, a, b in spans):
                continue
            rows[name] = (name, n, len(shingles), lo)
            spans.append((family, name, share, lo, hi))
        return list(rows.values())


def _scan_licenses(licenses: Sequence[tuple[str, str, str]], threshold: int, miss: float):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Licenses(licenses, threshold, miss)
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            rows: list[tuple] = []
            for a, b, data, offsets in wordhash.byte_slices(batch.column(1)):
                data = plain_bytes(data)
                words = wordhash.Words(data, offsets)
                hashes, text = wordhash.shingles(words, SIZE)
                keep = words.counts[text] >= SIZE
                hashes, text = hashes[keep], text[keep]
                if not len(hashes):
                    continue
                place = np.arange(len(text)) - np.searchsorted(text, text)
                best: dict[int, dict[int, tuple[int, int]]] = {}
                for doc, first, t in sorted(known.windows(hashes, text, place)):
                    lo = words.docs[doc] + first
                    hi = min(lo + known.span(t), words.docs[doc + 1])
                    seen = data[words.starts[lo]:words.ends[hi - 1]].tobytes().decode("utf-8", "replace")
                    n = len(known.known[t][3] & text_shingles(text_words(seen)))
                    of = best.setdefault(doc, {})
                    if n > of.get(t, (0, 0))[0]:
                        of[t] = (n, first)
                for doc, of in best.items():
                    rows += [(a + doc, *r) for r in known.best([(t, n, first) for t, (n, first) in of.items()], threshold)]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids.take(at), "license": pa.array([r[1] for r in rows], pa.string()),
                "matched": pa.array([r[2] for r in rows], pa.int64()),
                "shingles": pa.array([r[3] for r in rows], pa.int64()),
                "first_word": pa.array([r[4] for r in rows], pa.int64())})
    return run


def licenses(docs: DataFrame, texts: Sequence[tuple[str, str, str]] = LICENSES, threshold: int = THRESHOLD, miss: float = MISS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, matched, shingles, first_word): one row for each text and license it holds; ``texts`` are (license, family, text).

    ``matched`` of a template's ``shingles`` distinct shingles stand in the window of words from ``first_word`` on. Of a license's texts the
    best match counts; of a family's licenses that match in one place, the best. No shuffle: the templates go to the tasks.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scan_licenses(tuple(texts), threshold, miss), FOUND)

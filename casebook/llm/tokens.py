"""Subword ids of whole texts with the ``tokenizers`` library, each distinct chunk encoded once.

The tokenizers used here never join characters across certain spaces, so a text's ids are the
ids of its chunks one after the other. ``ChunkEncoder`` cuts a slice of an Arrow column into chunks, finds the different ones by
a 64-bit hash, and keeps the ids of those seen so far (a bounded cache; when it is full, chunks seen once are dropped). It gives
``Tokenizer.encode(text, add_special_tokens=False)`` with special tokens read as plain text.

With byte-level BPE (``spaced``) a chunk is a space and what follows up to the next
space; a text in which a space is followed by white space or by the end is
encoded in one call. The other kind drops white space, and a space or line break ends a chunk.

New chunks are cut into pre-tokens by the tokenizer file's own pattern and mapped to the byte alphabet here; new
pre-tokens go to the library many at a time. Its model is several times faster on text that only needs splitting at a mark.
A Python worker keeps its encoder for its next tasks.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa

from casebook.llm import wordhash
from casebook.llm._common import by_value

by_value(__name__)

CACHE_CHUNKS = 1_000_000
CACHE_IDS = 8_000_000
GROUP = 50  # pre-tokens joined into one string for the library


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str) -> str:
    """The tokenizer file's text, read on the driver and shipped with the closure (a few MB, fixed)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


# The patterns of the two tokenizer files.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
UNSPACED = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
PUNCTUATION = "".join(chr(k) for k in range(33, 127) if not chr(k).isalnum())
CUT = "\x01"  # between pre-tokens


# White space as patterns see it, in UTF-8: one byte; the lead bytes of the longer ones; those of two and of three bytes.
_SPACE_BYTES, _SPACE_LEADS = np.zeros(256, bool), np.zeros(256, bool)
_SPACE_BYTES[[*range(9, 14), *range(28, 33)]] = True
_SPACE_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_SPACE_PAIRS = np.array([0xC285, 0xC2A0])
_SPACE_CODES = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])


def byte_alphabet() -> dict[int, str]:
    """Byte -> its character in byte-level vocabularies: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Ragged:
    """Arrays of ids by place."""

    def __init__(self):
        self.flat = np.zeros(0, np.uint32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.flat = np.concatenate([self.flat, flat])

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[places] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at], sizes


class ChunkEncoder:
    def __init__(self, spec: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.spaced = spaced
        self.plain = Tokenizer.from_str(spec)
        self.plain.encode_special_tokens = True
        d = json.loads(spec)
        d |= {"added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": CUT}}
        self.split_only = Tokenizer.from_str(json.dumps(d))
        self.find = regex.compile(SPACED if spaced else UNSPACED).findall
        self.alphabet = byte_alphabet() | {1: CUT}
        space = self.alphabet[32]
        # Where one pre-token's ids end and the next one's start: at a leading space, or after a word end.
        self.edge = np.zeros(self.split_only.get_vocab_size(), bool)
        for token, k in self.split_only.get_vocab().items():
            self.edge[k] = token.startswith(space) if spaced else token.endswith("</w>")
        self.table = wordhash.case_table() if spaced else wordhash.lower_table()
        self._drop()

    def _drop(self) -> None:
        self.known, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted hashes, their places
        self.ids, self.hits = _Ragged(), np.zeros(0, np.int64)
        self.signs, self.sign_ids = {}, _Ragged()

    def _trim(self) -> None:
        """Forgets the chunks seen once, or all if that leaves too much."""
        stay = self.hits > 1
        left = stay[self.places]
        known, old = self.known[left], self.places[left]
        flat, sizes = self.ids.take(np.flatnonzero(stay))
        self._drop()
        if 2 * len(known) <= CACHE_CHUNKS and 2 * len(flat) <= CACHE_IDS:
            self.known, self.places = known, (np.cumsum(stay) - 1)[old]
            self.ids.add(flat, sizes)
            self.hits = np.zeros(len(known), np.int64)

    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that must be encoded whole: with the marks in them or, spaced, white space or the end after a space."""
        n = len(data)
        bad = data <= 1
        if self.spaced and n:
            after = np.append(data[1:], 32)
            after[offsets[1:][offsets[1:] > 0] - 1] = 32  # the end of a text counts as white space
            space = data == 32
            bad |= space & _SPACE_BYTES[after]
            lead = np.flatnonzero(space & _SPACE_LEADS[after])
            if len(lead):  # white space of two or three bytes
                tail = np.append(data, np.zeros(4, np.uint8))
                code = (tail[lead + 1].astype(np.int64) << 16) | (tail[lead + 2].astype(np.int64) << 8) | tail[lead + 3]
                bad[lead[np.isin(code, _SPACE_CODES) | np.isin(code >> 8, _SPACE_PAIRS)]] = True
        at = np.flatnonzero(bad)
        return np.unique(np.searchsorted(offsets, at, "right") - 1) if len(at) else at

    def _chunks(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of the chunks of all texts but the odd ones."""
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        if self.spaced:
            starts = np.flatnonzero((data == 32) | edge[:n])
            ends = np.append(starts[1:], n)
        else:
            word = (data != 32) & (data != 10)
            starts = np.flatnonzero(word & (np.append(True, ~word[:-1])[:n] | edge[:n]))
            ends = np.flatnonzero(word & (np.append(~word[1:], True)[:n] | edge[1:])) + 1
        if len(odd):
            keep = ~np.isin(np.searchsorted(offsets, starts, "right") - 1, odd)
            starts, ends = starts[keep], ends[keep]
        return starts, ends

    def _pretokens(self, text: str) -> list[str]:
        if not self.spaced:
            text = text.lower() if text.isascii() else self.plain.normalizer.normalize_str(text).strip(" ")
        word = text.rstrip(PUNCTUATION)
        if word.lstrip(" ").isalpha() and word.count(" ") <= 1:  # letters, then signs: two pre-tokens at most
            return [word, text[len(word):]] if len(word) < len(text) else [word]
        return self.find(text)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        mapped = [t.encode().decode("latin1").translate(self.alphabet) for t in texts]
        return [e.ids for e in self.split_only.encode_batch_fast(mapped, add_special_tokens=False)]

    def _many(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of pre-tokens whose ends show in the ids: many go to a string."""
        ids = [np.array(x, np.uint32) for x in self._encode([CUT.join(parts[a:a + GROUP]) for a in range(0, len(parts), GROUP)])]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        edges = np.flatnonzero(self.edge[flat])
        return flat, np.diff(edges, append=len(flat)) if self.spaced else np.diff(edges, prepend=-1)

    def _learn(self, texts: list[str]) -> None:
        """Appends the ids of chunks, in order."""
        many: list[str] = []
        refs: list[int] = []
        counts = np.ones(len(texts), np.int64)
        for k, text in enumerate(texts):
            if self.spaced and text[0] == " " and text[1:].isalpha():
                refs.append(len(many))
                many.append(text)
                continue
            parts = self._pretokens(text)
            counts[k] = len(parts)
            for part in parts:
                if not self.spaced or (part[0] == " " and " " not in part[1:]):
                    refs.append(len(many))
                    many.append(part)
                else:  # signs and first words: few, kept, encoded alone
                    if part not in self.signs:
                        self.signs[part] = len(self.signs)
                    refs.append(-1 - self.signs[part])
        if len(self.sign_ids.sizes) < len(self.signs):
            ids = self._encode(list(self.signs)[len(self.sign_ids.sizes):])
            self.sign_ids.add(np.array([k for x in ids for k in x], np.uint32), np.array([len(x) for x in ids], np.int64))
        table = _Ragged()
        table.add(*self._many(many))
        table.add(self.sign_ids.flat, self.sign_ids.sizes)
        places = np.array(refs, np.int64)
        flat, sizes = table.take(np.where(places < 0, len(many) - 1 - places, places))
        upto = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
        self.ids.add(flat, np.diff(upto))

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHE_CHUNKS or len(self.ids.flat) > CACHE_IDS or len(self.signs) > CACHE_CHUNKS:
            self._trim()
        odd = self._odd(data, offsets)
        starts, ends = self._chunks(data, offsets, odd)
        hashes = wordhash.span_hashes(data, starts, ends, self.table)
        order = np.argsort(hashes)
        ordered = hashes[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[:len(order)])
        found = ordered[first]
        at = np.searchsorted(self.known, found)
        new = np.append(self.known, np.uint64(0))[at] != found
        new |= at == len(self.known)
        if new.any():
            raw = data.tobytes()
            sample = order[first[new]]
            self._learn([raw[a:b].decode() for a, b in zip(starts[sample].tolist(), ends[sample].tolist())])
            count = len(self.hits)
            self.known = np.insert(self.known, at[new], found[new])
            self.places = np.insert(self.places, at[new], np.arange(count, count + len(sample)))
            self.hits = np.append(self.hits, np.zeros(len(sample), np.int64))
            at = np.searchsorted(self.known, found)
        place, often = self.places[at], np.diff(np.append(first, len(order)))
        self.hits[place] += often
        r = np.empty(len(order), np.int64)
        r[order] = np.repeat(place, often)
        ids, sizes = self.ids.take(r)
        counts = np.diff(np.searchsorted(starts, offsets))
        upto = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
        lengths = np.diff(upto)
        if len(odd):
            raw, parts = data.tobytes(), np.split(ids, upto[1:-1])
            for k in odd.tolist():
                text = raw[offsets[k]:offsets[k + 1]].decode()
                parts[k] = np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)
            ids, lengths = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return ids, lengths

    def slices(self, texts: pa.Array | list[str | None]):
        """Yields (first, last, ids, lengths): the ids of ``texts[first:last]`` one after the other; nulls are empty."""
        column = texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string())
        for a, b, data, offsets in wordhash.byte_slices(column):
            yield a, b, *self._slice(data, offsets)


def worker_encoder(spec: str, spaced: bool) -> ChunkEncoder:
    """This Python worker's encoder. It is kept on the library's module, which outlives a task."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_casebook_encoders", {})
    key = (zlib.crc32(spec.encode()), len(spec), spaced)
    if key not in kept:
        kept.clear()
        kept[key] = ChunkEncoder(spec, spaced)
    return kept[key]


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Appends the id ``end`` to each text."""
    out = np.full(len(ids) + len(lengths), end, np.uint32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(lengths + 1) - 1] = False
    out[keep] = ids
    return out, lengths + 1

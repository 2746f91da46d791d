"""Removal of passages that repeat across documents, with suffix arrays (operator 3).

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id. Strings are
judged on the input. Texts are dealt into shards of at most ``SHARD`` bytes in the order of the scan.

1. *Within a shard*: a suffix array by Larsson-Sadakane refinement (keys of a few bytes first, then doubling, only groups that
   are not yet told apart are sorted again), common prefixes by Kasai's rule, and classes of equal strings with their least id.
2. *Across shards*: of the grams of ``GRAM`` bytes in a string the one with the least hash is its anchor, wherever the string stands.
   Strings that follow each other with one anchor are a run. Each shard sends one 64-bit record for each different anchor hash; the
   sorted lists of the shards are merged by binary search, which tells each shard which of its anchors other shards have, and whether
   always inside the same run.
3. For those anchors the shards send (fingerprint, least id) of their different runs, or, where the runs differ, of their different
   strings. The lists are merged, and one bit tells a shard whether another has a smaller id. Every shard sends a key once, so a
   passage in a third of all documents costs a row for each shard, not for each document.

Shards are read three times by the same scan; every answer carries a checksum of its shard, so a changed scan is an error. The answers for
a scan partition are written to one Arrow file in the shared folder.

Defined results: a null or empty text has no bytes and loses none; a null id counts as larger than any other; documents
with equal ids take nothing from each other; repeated rows are judged alike; an empty table gives an empty
result; other columns are kept by ``strip`` and not read by ``spans``. Texts longer than a shard are cut into overlapping parts.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm._common import by_value, lean, shared_folder
from casebook.llm.arrow_output import store
from casebook.llm.wordhash import mix
from casebook.operators._sizing import scanned_bytes

by_value(__name__)

LENGTH = 50
GRAM = 32
SHARD = 1 << 20
BUCKET_BYTES = 16 << 20  # scanned for each bucket of the merging: some 32 MB of rows
_BITS = 20  # of a place in a shard
_LAST = np.iinfo(np.int64).max
_TABLES = np.random.default_rng(50).integers(1, 1 << 64, (2, 256), dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_POWERS: dict[int, np.ndarray] = {}


# --- suffix array of a shard -------------------------------------------------------------------------------------------

def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, first byte highest; zeros past the end."""
    out = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):
        out = (out[:-k] << np.uint64(8 * k)) | out[k:]
    return out[:len(data)]


def _first_keys(data: np.ndarray) -> tuple[np.ndarray, int]:
    """(key, h): the next h bytes of each place as one number of 43 bits at most. Bytes are numbered by those in use; 0 is the end."""
    used = np.flatnonzero(np.bincount(data, minlength=256))
    code = np.zeros(256, np.int64)
    code[used] = np.arange(1, len(used) + 1)
    bits = int(len(used)).bit_length()
    h = (63 - _BITS) // bits
    codes = np.concatenate([code[data], np.zeros(h, np.int64)])
    key = codes[:len(data)].copy()
    for k in range(1, h):
        key <<= bits
        key |= codes[k:k + len(data)]
    return key, h


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(order, new) of the places of a shard by their next ``depth`` bytes, ties by place; new: differs from the one before.

    Larsson-Sadakane refinement: sorted by h bytes, a suffix is ordered by h + s bytes by the pair of its group and the group of the
    suffix s <= h further on. Groups of one are done. A group is named by the position of its first member, so it is refined within
    its own stretch. The pair and the place are packed into one number: each refinement is a plain sort.
    """
    n = len(data)
    if n > 1 << _BITS:
        raise ValueError(f"a shard has {1 << _BITS} bytes at most")
    key, h = _first_keys(data)
    packed = np.sort((key << _BITS) | np.arange(n))
    order = packed & ((1 << _BITS) - 1)
    packed >>= _BITS
    new = np.append(True, packed[1:] != packed[:-1])[:n]
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.zeros(n + depth, np.int64)  # group + 1 by place; 0 past the end
    rank[order] = group + 1
    while h < depth:
        step = min(h, depth - h)
        at = np.flatnonzero(~new | ~np.append(new[1:], True)[:n])  # positions in groups of several
        if not len(at):
            break
        places = order[at]
        packed = np.sort((group[at] << (2 * _BITS + 1)) | (rank[places + step] << _BITS) | places)
        places = packed & ((1 << _BITS) - 1)
        packed >>= _BITS
        order[at] = places  # groups keep their stretches
        fresh = np.append(True, packed[1:] != packed[:-1])
        new[at] = fresh
        own = np.maximum.accumulate(np.where(fresh, at, 0))
        group[at] = own
        rank[places] = own + 1
        h += step
    return order, new


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray, new: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """For each position of the order: whether its place shares ``depth`` bytes, inside its text, with the one before.

    Kasai: going through the text, a common prefix is at most one shorter than that of the place before. So after a long one, found at the first
    place of a repeated stretch, the next places need no comparison while the bound stays at ``depth``. ``ends``: for each place the end of its text.
    """
    n = len(data)
    out = np.zeros(n, bool)
    at = np.flatnonzero(~new)
    here, before = order[at], order[at - 1]
    room = np.minimum(ends[here] - here, ends[before] - before)
    keep = room >= depth
    at, here, before, room = at[keep], here[keep], before[keep], room[keep]
    if not len(at):
        return out
    text_order = np.argsort(here)
    at, i, j, room = at[text_order], here[text_order], before[text_order], room[text_order]
    key = _words(data)

    def extent(which: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common bytes of the pairs ``which``, up to ``most``; all step together, those that differ drop out."""
        a, b, got = i[which], j[which], np.zeros(len(which), np.int64)
        live = np.arange(len(which))
        while len(live):
            step = got[live]
            x, y = np.minimum(a[live] + step, n - 1), np.minimum(b[live] + step, n - 1)
            same = (key[x] == key[y]) & (step + 8 <= most[live])
            stop = live[~same]
            if len(stop):  # the last, shorter piece by bytes
                c, open_ = got[stop], np.ones(len(stop), bool)
                for _ in range(8):
                    p, q = np.minimum(a[stop] + c, n - 1), np.minimum(b[stop] + c, n - 1)
                    open_ &= (c < most[stop]) & (data[p] == data[q])
                    c = c + open_
                got[stop] = c
            live = live[same]
            got[live] += 8
        return got

    heads = np.append(True, i[1:] != i[:-1] + 1)
    first = np.flatnonzero(heads)
    length = extent(first, room[first])
    run = np.cumsum(heads) - 1
    long = length[run] - (i - i[first][run]) >= depth
    rest = np.flatnonzero(~long)
    long[rest] = extent(rest, np.full(len(rest), depth)) >= depth
    out[at] = long
    return out


def repeated_in_shard(data: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each place the least id among equal strings of the shard (its own if the string is cut off by the text's end)."""
    least = ids.copy()
    if len(data) < LENGTH:
        return least
    order, new = suffix_array(data)
    same = common_prefixes(data, ends, order, new)
    several = np.flatnonzero(~new | ~np.append(new[1:], True))
    # A place whose string is cut off may stand between equal whole ones (the bytes after it are another text's).
    several = several[ends[order[several]] - order[several] >= LENGTH]
    if len(several):
        group = np.cumsum(new)[several]
        first = np.append(True, group[1:] != group[:-1])
        first[1:] &= ~(same[several][1:] & (several[1:] == several[:-1] + 1))
        places = order[several]
        starts = np.flatnonzero(first)
        least[places] = np.minimum.reduceat(ids[places], starts)[np.cumsum(first) - 1]
    return least


# --- shards ------------------------------------------------------------------------------------------------------------

class Shard:
    """Texts (or parts of a long one): bytes, the end of each place's text, ids, and for each part its row and first byte there."""

    def __init__(self, no: int, parts: list[tuple[int, int, np.ndarray]], ids: np.ndarray):
        self.no = no
        sizes = np.array([len(x) for _, _, x in parts])
        self.data = np.concatenate([x for _, _, x in parts]) if parts else np.zeros(0, np.uint8)
        self.firsts = np.cumsum(sizes) - sizes
        self.rows, self.offsets = [r for r, _, _ in parts], [o for _, o, _ in parts]
        self.ends = np.repeat(self.firsts + sizes, sizes)
        self.ids = np.repeat(ids[self.rows] if parts else ids[:0], sizes)
        self.sum = zlib.crc32(self.data)

    def prints(self, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit fingerprints of the bytes of each [start, stop)."""
        out = []
        for k in range(2):
            running, back = self._running(k)
            out.append(mix((running[stops] - running[starts]) * back[starts] + (stops - starts).astype(np.uint64)))
        return out[0], out[1]

    def _running(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.data)
        for key, base in ((k, _BASES[k]), (k + 2, pow(_BASES[k], -1, 1 << 64))):
            if key not in _POWERS or len(_POWERS[key]) <= n:
                powers = np.full(max(n + 1, SHARD + 1), base, np.uint64)
                powers[0] = 1
                _POWERS[key] = np.cumprod(powers, dtype=np.uint64)
        if not hasattr(self, "_sums"):
            self._sums: dict[int, np.ndarray] = {}
        if k not in self._sums:
            running = np.zeros(n + 1, np.uint64)
            np.cumsum(_TABLES[k][self.data] * _POWERS[k][:n], dtype=np.uint64, out=running[1:])
            self._sums[k] = running
        return self._sums[k], _POWERS[k + 2]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, last, anchor) of each run: the strings from first to last share the anchor place."""
        n = len(self.data)
        if n < LENGTH:
            return (np.zeros(0, np.int64),) * 3
        running, back = self._running(0)
        h = (running[GRAM:] - running[:-GRAM]) * back[:n - GRAM + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        low = (h & ~np.uint64((1 << _BITS) - 1)) | np.arange(len(h), dtype=np.uint64)
        width = LENGTH - GRAM + 1
        size = 1
        while size * 2 <= width:  # least value of the next 2, 4, 8, 16 grams, then of all ``width``
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if width > size:
            low = np.minimum(low[:len(low) - (width - size)], low[width - size:])
        anchor = (low & np.uint64((1 << _BITS) - 1)).astype(np.int64)
        valid = self.ends[:len(anchor)] - np.arange(len(anchor)) >= LENGTH
        start = valid & (np.append(True, anchor[1:] != anchor[:-1]) | np.append(True, ~valid[:-1]))
        first = np.flatnonzero(start)
        stop = valid & np.append(start[1:] | ~valid[1:], True)
        self.hashes = h
        return first, np.flatnonzero(stop), anchor[first]


def _texts(column: pa.Array) -> list[np.ndarray]:
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, list[Shard]]]:
    """(row slices, texts, shards) of consecutive rows, the same whatever the batches; columns 0 and 1 are text and id."""
    from pyspark import TaskContext

    part, count = TaskContext.get().partitionId(), 0
    rows: list[pa.RecordBatch] = []
    texts: list[np.ndarray] = []
    size = 0

    def close():
        nonlocal count
        ids = np.concatenate([np.asarray(r.column(1).cast(pa.int64()).fill_null(_LAST)) for r in rows])
        shards, parts, held = [], [], 0
        for k, text in enumerate(texts):
            for a in range(0, max(1, len(text) - LENGTH + 1), SHARD - LENGTH + 1):
                piece = text[a:a + SHARD]
                if held + len(piece) > SHARD:
                    shards.append(Shard((part << 32) + count, parts, ids))
                    count, parts, held = count + 1, [], 0
                parts.append((k, a, piece))
                held += len(piece)
        shards.append(Shard((part << 32) + count, parts, ids))
        count += 1
        return rows, texts, shards

    for batch in batches:
        found = _texts(batch.column(0))
        a = 0
        for b, text in enumerate(found):
            if size + len(text) > SHARD and (size or b > a):
                rows.append(batch.slice(a, b - a))
                texts += found[a:b]
                if texts:
                    yield close()
                rows, texts, size, a = [], [], 0, b
            size += len(text)
        if len(found) > a:
            rows.append(batch.slice(a))
            texts += found[a:]
    if texts:
        yield close()


# --- step 2: which anchors other shards have ---------------------------------------------------------------------------

_CTX = 30
ROWS = "bucket bigint, shard bigint, sum bigint, rows binary"


def _rows(bucket: list, shard: Shard, rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array(bucket, pa.int64()), "shard": pa.array([shard.no] * len(rows), pa.int64()),
        "sum": pa.array([shard.sum] * len(rows), pa.int64()), "rows": pa.array(rows, pa.binary())})


def _by_bucket(bucket: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Rows dealt by bucket, in their order."""
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], rows[order]
    firsts = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[firsts].tolist(), np.split(rows, firsts[1:]) if len(firsts) else []


def _keyed_runs(shard: Shard, buckets: int):
    """(first, last, anchor, bucket, hash of 34 bits, fingerprints) of a shard's runs."""
    first, last, anchor = shard.runs()
    if not len(first):
        none = np.zeros(0, np.uint64)
        return first, last, anchor, first, none, (none, none)
    h = shard.hashes[anchor]
    lead = (anchor - first).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    f1, f2 = shard.prints(first, last + LENGTH)
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    return first, last, anchor, bucket, h >> np.uint64(_CTX), (f1 + lead, f2 ^ lead)


def _anchors(buckets: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, shards in packs(batches):
            for shard in shards:
                _, _, _, bucket, h, (f1, _) = _keyed_runs(shard, buckets)
                if not len(h):
                    continue
                ctx = np.maximum(f1 >> np.uint64(64 - _CTX), np.uint64(1))
                key = (bucket.astype(np.uint64) << np.uint64(64 - _CTX)) | h
                order = np.argsort(key)
                bucket, h, ctx, key = bucket[order], h[order], ctx[order], key[order]
                starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                low, high = np.minimum.reduceat(ctx, starts), np.maximum.reduceat(ctx, starts)
                ctx = np.where(low == high, low, np.uint64(0))  # 0: different runs in this shard
                b, r = _by_bucket(bucket[starts], (h[starts] << np.uint64(_CTX)) | ctx)
                yield _rows(b, shard, [x.tobytes() for x in r])
    return run


ANSWERS = "part int, shard bigint, sum bigint, bucket bigint, rows binary"


def _answer(table: pa.Table, answers: list[bytes]) -> pa.Table:
    keep = [k for k, a in enumerate(answers) if a]
    shards = table["shard"].to_numpy()[keep]
    return pa.table({
        "part": pa.array(shards >> 32, pa.int32()), "shard": pa.array(shards),
        "sum": table["sum"].take(pa.array(keep, pa.int64())), "bucket": table["bucket"].take(pa.array(keep, pa.int64())),
        "rows": pa.array([answers[k] for k in keep], pa.binary())})


def _shared(table: pa.Table) -> pa.Table:
    """For each shard the hashes that others have too, and whether their runs differ (lowest bit)."""
    lists = [np.frombuffer(x, np.uint64) for x in table["rows"].to_pylist()]
    all_ = np.sort(np.concatenate(lists))
    h, ctx = all_ >> np.uint64(_CTX), all_ & np.uint64((1 << _CTX) - 1)
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    stops = np.append(starts[1:], len(h)) - 1
    mixed = (ctx[starts] == 0) | (ctx[starts] != ctx[stops])
    many = stops > starts  # a shard sends a hash once
    known, mixed = h[starts][many], mixed[many]
    answers = []
    for x in lists:
        own = x >> np.uint64(_CTX)
        at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
        hit = known[at] == own if len(known) else np.zeros(len(own), bool)
        answers.append(((own[hit] << np.uint64(1)) | mixed[at[hit]]).tobytes())
    return _answer(table, answers)


# --- step 3: smaller ids elsewhere -------------------------------------------------------------------------------------

_ITEM = np.dtype([("f1", "<u8"), ("f2", "<u4"), ("id", "<i8")])  # 96 bits of fingerprint


def pack_items(items: np.ndarray) -> bytes:
    """14 bytes an item: ids are numbered within the shard."""
    ids, at = np.unique(items["id"], return_inverse=True)
    kind = "<u2" if len(ids) <= 1 << 16 else "<u4"
    return b"".join([np.array([len(items), len(ids)], "<u4").tobytes(), items["f1"].tobytes(), items["f2"].tobytes(),
                     at.astype(kind).tobytes(), ids.astype("<i8").tobytes()])


def unpack_items(row: bytes) -> np.ndarray:
    n, m = (int(x) for x in np.frombuffer(row, "<u4", 2))
    out = np.zeros(n, _ITEM)
    out["f1"] = np.frombuffer(row, "<u8", n, 8)
    out["f2"] = np.frombuffer(row, "<u4", n, 8 + 8 * n)
    at = np.frombuffer(row, "<u2" if m <= 1 << 16 else "<u4", n, 8 + 12 * n)
    out["id"] = np.frombuffer(row[len(row) - 8 * m:], "<i8")[at]
    return out


class _Items:
    """The different runs and strings of a shard that others may have: sorted fingerprints, least ids, and the places of each."""

    def __init__(self, shard: Shard, buckets: int, shared: dict[int, np.ndarray]):
        first, last, _, bucket, h, (f1, f2) = _keyed_runs(shard, buckets)
        known, mixed = np.zeros(len(h), bool), np.zeros(len(h), bool)
        for b, rows in shared.items():
            at = np.flatnonzero(bucket == b) if len(shared) < 8 else None
            if at is None:
                at = self._at(bucket, b)
            keys = rows >> np.uint64(1)
            order = np.argsort(keys)
            keys = keys[order]
            k = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
            hit = keys[k] == h[at]
            known[at[hit]] = True
            mixed[at[hit]] = (rows[order][k[hit]] & np.uint64(1)).astype(bool)
        runs = np.flatnonzero(known & ~mixed)
        lengths = last - first + 1
        loose = np.flatnonzero(known & mixed)
        single = np.repeat(first[loose] - (np.cumsum(lengths[loose]) - lengths[loose]), lengths[loose]) + np.arange(lengths[loose].sum())
        s1, s2 = shard.prints(single, single + LENGTH) if len(single) else (np.zeros(0, np.uint64),) * 2
        f1 = np.concatenate([f1[runs], s1])
        f2 = (np.concatenate([f2[runs], s2]) >> np.uint64(32)).astype(np.uint32)
        start = np.concatenate([first[runs], single])
        self.start, self.stop = start, np.concatenate([last[runs], single])
        order = np.lexsort((f2, f1))
        new = np.append(True, (f1[order][1:] != f1[order][:-1]) | (f2[order][1:] != f2[order][:-1]))[:len(order)]
        self.item = np.empty(len(order), np.int64)
        self.item[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        self.rows = np.zeros(len(heads), _ITEM)
        if len(heads):
            self.rows["f1"], self.rows["f2"] = f1[order][heads], f2[order][heads]
            self.rows["id"] = np.minimum.reduceat(shard.ids[start[order]], heads)

    def _at(self, bucket: np.ndarray, b: int) -> np.ndarray:
        if not hasattr(self, "_order"):
            self._order = np.argsort(bucket, kind="stable")
            self._sorted = bucket[self._order]
        return self._order[np.searchsorted(self._sorted, b):np.searchsorted(self._sorted, b, "right")]

    def buckets(self, buckets: int) -> np.ndarray:
        return ((self.rows["f1"] >> np.uint64(7)) % np.uint64(buckets)).astype(np.int64)


def _items(buckets: int, shared: str):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(shared)
        for _, _, shards in packs(batches):
            for shard in shards:
                items = _Items(shard, buckets, answers.of(shard, np.uint64))
                if len(items.rows):
                    b, r = _by_bucket(items.buckets(buckets), items.rows)
                    yield _rows(b, shard, [pack_items(x) for x in r])
    return run


def _smaller(table: pa.Table) -> pa.Table:
    """For each shard a bit for each of its items, in order: another shard has it with a smaller id."""
    lists = [unpack_items(x) for x in table["rows"].to_pylist()]
    all_ = np.concatenate(lists)
    order = np.lexsort((all_["id"], all_["f2"], all_["f1"]))
    s = all_[order]
    new = np.append(True, (s["f1"][1:] != s["f1"][:-1]) | (s["f2"][1:] != s["f2"][:-1]))
    hit = np.empty(len(s), bool)
    hit[order] = s["id"][np.flatnonzero(new)][np.cumsum(new) - 1] < s["id"]
    answers, a = [], 0
    for x in lists:
        own = hit[a:a + len(x)]
        a += len(x)
        answers.append(np.packbits(own).tobytes() if own.any() else b"")
    return _answer(table, answers)


# --- answers in the shared folder --------------------------------------------------------------------------------------

def _write_answers(folder: str):
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        fs, root = store(folder)
        fs.create_dir(root, recursive=True)
        name = f"{root}/{part:07d}.arrow"
        own = f"{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as sink, pa.ipc.new_file(sink, table.schema) as writer:
            writer.write_table(table.combine_chunks())
        fs.move(own, name)  # attempts write the same rows
        return pa.table({"part": pa.array([part], pa.int32())})
    return run


class Answers:
    """A scan partition's answers, by shard."""

    def __init__(self, folder: str):
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        fs, root = store(folder)
        path = f"{root}/{TaskContext.get().partitionId():07d}.arrow"
        self.rows: dict[int, list[dict]] = {}
        if fs.get_file_info(path).type != pafs.FileType.NotFound:
            with fs.open_input_file(path) as source:
                table = pa.ipc.open_file(source).read_all()
            for r in table.to_pylist():
                self.rows.setdefault(r["shard"], []).append(r)

    def of(self, shard: Shard, kind) -> dict[int, np.ndarray]:
        rows = self.rows.get(shard.no, [])
        if any(r["sum"] != shard.sum for r in rows):
            raise RuntimeError("the scan gave other rows than before; write the input to a table first")
        return {r["bucket"]: np.frombuffer(r["rows"], kind) for r in rows}


def _exchange(rows: DataFrame, merge: Callable, buckets: int, name: str) -> str:
    """Merges the shards' rows by bucket and writes the answers of each scan partition to the shared folder.

    As many tasks as buckets, whatever the session's shuffle partitions: a task reads about one bucket at any size of the input.
    """
    folder = shared_folder(rows.sparkSession, name)
    answers = rows.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(merge, ANSWERS)
    answers.groupBy("part").applyInArrow(_write_answers(folder), "part int").write.format("noop").mode("overwrite").save()
    return folder


# --- the operator ------------------------------------------------------------------------------------------------------

def _covered(shard: Shard, items: _Items, smaller: dict[int, np.ndarray], buckets: int) -> np.ndarray:
    """The bytes of the shard to remove."""
    n = len(shard.data)
    least = repeated_in_shard(shard.data, shard.ends, shard.ids)
    hit = least < shard.ids
    if smaller and len(items.rows):
        less = np.zeros(len(items.rows), bool)
        bucket = items.buckets(buckets)
        for b, bits in smaller.items():
            at = np.flatnonzero(bucket == b)
            less[at] = np.unpackbits(bits)[:len(at)].astype(bool)
        # The other's id is smaller than the least of this shard: smaller than all that have the item here.
        own = less[items.item]
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, items.start[own], 1)
        np.add.at(step, items.stop[own] + 1, -1)
        hit |= np.cumsum(step)[:n] > 0
    seen = np.cumsum(hit)
    seen[LENGTH:] = seen[LENGTH:] - seen[:-LENGTH].copy() if n > LENGTH else seen[LENGTH:]
    return seen > 0


def _result(buckets: int, shared: str, smaller: str, emit: Callable):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, ids = Answers(shared), Answers(smaller)
        for rows, texts, shards in packs(batches):
            gone = [np.zeros(len(t), bool) for t in texts]
            for shard in shards:
                items = _Items(shard, buckets, anchors.of(shard, np.uint64))
                covered = _covered(shard, items, ids.of(shard, np.uint8), buckets)
                for row, offset, a in zip(shard.rows, shard.offsets, shard.firsts):
                    size = min(SHARD, len(texts[row]) - offset)
                    gone[row][offset:offset + size] |= covered[a:a + size]
            a = 0
            for part in rows:
                yield emit(part, texts[a:a + part.num_rows], gone[a:a + part.num_rows])
                a += part.num_rows
    return run


def _run_edges(gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _emit_spans(rows: pa.RecordBatch, texts: list, gone: list) -> pa.RecordBatch:
    starts, stops, removed, sums = [], [], [], []
    for text, g in zip(texts, gone):
        a, b = _run_edges(g)
        starts.append(a.tolist())
        stops.append(b.tolist())
        removed.append(int(g.sum()))
        sums.append(hashlib.sha256(text[~g].tobytes()).hexdigest())
    return pa.RecordBatch.from_pydict({
        "id": rows.column(1).cast(pa.int64()), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
        "n_removed": pa.array(removed, pa.int64()), "starts": pa.array(starts, pa.list_(pa.int64())),
        "stops": pa.array(stops, pa.list_(pa.int64())), "kept_sha256": pa.array(sums, pa.string())})


def _emit_rows(rows: pa.RecordBatch, texts: list, gone: list) -> pa.RecordBatch:
    kept = [text[~g].tobytes().decode("utf-8", "ignore") for text, g in zip(texts, gone)]
    missing = rows.column(0).is_null().to_pylist()
    return pa.RecordBatch.from_arrays(
        [rows.column(2), pa.array([None if m else k for k, m in zip(kept, missing)], pa.string())], ["row", "kept"])


def bucket_count(rows: DataFrame) -> int:
    """Buckets by the scanned bytes, not by how these are split into partitions; a task for each core at least."""
    scanned = scanned_bytes(rows)
    by_size = rows.rdd.getNumPartitions() if scanned is None else scanned // BUCKET_BYTES + 1
    return max(rows.sparkSession.sparkContext.defaultParallelism, by_size)


def _scan_all(rows: DataFrame, emit: Callable, schema: str) -> DataFrame:
    """``rows``: text, id and what ``emit`` needs; a plain scan, read three times."""
    buckets = bucket_count(rows)
    shared = _exchange(rows.mapInArrow(_anchors(buckets), ROWS), _shared, buckets, "suffix-anchors")
    smaller = _exchange(rows.mapInArrow(_items(buckets, shared), ROWS), _smaller, buckets, "suffix-ids")
    return rows.mapInArrow(_result(buckets, shared, smaller, emit), schema)


SPANS = "id bigint, n_bytes bigint, n_removed bigint, starts array<bigint>, stops array<bigint>, kept_sha256 string"


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, starts, stops, kept_sha256): the removed stretches of every text, in bytes.

    ``docs`` must be a table as read, with narrow steps only: it is scanned three times and must give the same rows.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"))
    return _scan_all(rows, _emit_spans, SPANS).withColumnRenamed("id", id_col)


def strip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of the texts, all columns kept; a character cut in two goes as a whole."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, kept string"
    out = _scan_all(rows, _emit_rows, schema)
    return out.select(*[F.col("kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])

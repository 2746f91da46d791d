"""Fill-in-middle transformation (operator 11).

Each text is cut into lines (a line keeps its newline); two cut places drawn from a hash of the id part them into prefix,
middle and suffix, which are put together again behind marks, in the order prefix, suffix, middle (``psm``) or suffix, prefix,
middle (``spm``). The draw depends on nothing but seed and id, so reruns and other layouts agree.

The cutting is a pyarrow.compute pipeline per batch, without a loop over texts: split the texts at newlines into list arrays,
flatten them with the index of their parent, number the lines within their text, filter by role (before the first cut, between,
after), rebuild a list array for each role and join it, then join the three pieces and the marks element by element. Batches are cut by
bytes (``SLICE_BYTES``), so a task holds some slices of text however many rows a batch has; nothing is shuffled.
``restored`` undoes it as a column expression: marks never stand in a transformed text, so splitting at them is exact.

Defined results: a null text counts as empty; empty texts, texts that hold a mark and texts that the rate leaves out stay as they
are (``plain``, null lengths); a null id is hashed as the empty text; repeated ids draw equal cuts, repeated rows give equal rows; a text without
newline is one line, of which one piece is whole and the others are empty; an empty table gives an empty result. Only id and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm._common import by_value, lean

by_value(__name__)

RATE = 100  # percent of the texts that are transformed
SPM = 50  # percent of those with the suffix first
SEED = 7
MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix, middle
SLICE_BYTES = 2_000_000
OUT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(id_col: Column, seed: int, count: int = 4) -> list[Column]:
    """Unsigned numbers from the first 8-digit groups of the hex sha256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(count)]


def lines(texts: pa.StringArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(lines of all texts in order, the text of each, its ordinal within the text)."""
    split = pc.split_pattern(texts, "\n")
    parent = pc.list_parent_indices(split).to_numpy()
    flat = pc.list_flatten(split)
    ordinal = np.arange(len(flat)) - split.offsets.to_numpy()[parent].astype(np.int64) + int(split.offsets[0].as_py())
    last = pa.array(ordinal == pc.list_value_length(split).to_numpy()[parent] - 1)
    units = pc.binary_join_element_wise(flat, pc.if_else(last, "", "\n"), "")
    # What stands after a text's last newline is a line only if there is something.
    there = pc.or_(pc.invert(last), pc.not_equal(flat, ""))
    kept = there.to_numpy(zero_copy_only=False)
    return units.filter(there), parent[kept], ordinal[kept]


def _role(units: pa.Array, parent: np.ndarray, mask: np.ndarray, rows: int) -> pa.Array:
    """For each text its lines of one role as one piece."""
    offsets = np.zeros(rows + 1, np.int32)
    np.cumsum(np.bincount(parent[mask], minlength=rows), out=offsets[1:])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), units.filter(pa.array(mask))), "")


def cut_texts(texts: pa.StringArray, h: Sequence[np.ndarray], rate: int, spm: int, marks: Sequence[str]) -> dict[str, pa.Array]:
    """The columns of ``OUT`` for a slice of texts without nulls."""
    rows = len(texts)
    units, parent, ordinal = lines(texts)
    n = np.bincount(parent, minlength=rows).astype(np.int64)
    first, second = h[0] % (n + 1), h[1] % (n + 1)
    a, b = np.minimum(first, second)[parent], np.maximum(first, second)[parent]
    prefix, middle, suffix = (_role(units, parent, mask, rows) for mask in (ordinal < a, (ordinal >= a) & (ordinal < b), ordinal >= b))
    plain = pc.or_(pc.equal(texts, ""), pa.array(h[2] % 100 >= rate))
    for mark in marks:
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    ahead = pa.array(h[3] % 100 < spm)
    p, s, m = marks
    output = pc.if_else(ahead, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, ""),
                        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, ""))
    none = pa.scalar(None, pa.int64())
    return {
        "n": pa.array(n), "form": pc.if_else(plain, "plain", pc.if_else(ahead, "spm", "psm")),
        "prefix_chars": pc.if_else(plain, none, pc.utf8_length(prefix).cast(pa.int64())),
        "middle_chars": pc.if_else(plain, none, pc.utf8_length(middle).cast(pa.int64())),
        "output": pc.if_else(plain, texts, output)}


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text; a row is never split."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, "right")))
        yield a, b
        a = b


def _transform(id_name: str, rate: int, spm: int, marks: Sequence[str]):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            h = [batch.column(2 + k).to_numpy() for k in range(4)]
            for a, b in slices(texts):
                own = texts.slice(a, b - a).cast(pa.string()).fill_null("")
                found = cut_texts(own, [x[a:b] for x in h], rate, spm, marks)
                yield pa.RecordBatch.from_pydict({id_name: ids.slice(a, b - a), **found})
    return run


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm: int = SPM,
              seed: int = SEED, marks: Sequence[str] = MARKS) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row.

    No mark may begin another one, and a mark's first character may stand nowhere else in the marks: then none arises across a seam.
    """
    if any(not x or x[0] in y[1:] for x in marks for y in marks) or any(
            x.startswith(y) for i, x in enumerate(marks) for j, y in enumerate(marks) if i != j):
        raise ValueError("marks must not begin each other, nor hold their first characters again")
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), *[x.alias(f"_h{k}") for k, x in enumerate(draws(F.col(id_col), seed))])
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_transform(id_col, rate, spm, tuple(marks)), f"`{id_col}` {kind}, {OUT}")


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that ``output`` was made of."""
    parts = F.split(output, "|".join(re.escape(m) for m in marks), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

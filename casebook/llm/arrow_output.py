"""Token ids in Arrow files of equal-length sequences (operator 9).

The documents, in ascending id order, are one stream of token ids, each closed by the end id. The stream is
cut into sequences of ``seq_len`` ids and written as Arrow files (the format with a footer) whose batches hold
two fixed-size-list columns: ``ids`` and ``mask`` (true where an id stands, false where the last sequence
of a file is padded). All batches of a file but the last hold ``BATCH`` sequences, so sequence ``s`` is row ``s % BATCH`` of
batch ``s // BATCH`` and is read from the mapped file without a copy. Beside each token file a second Arrow file lists its
documents: id, first place in the file's stream, number of ids.

Each task writes the range of documents it holds, streaming; the driver sees one manifest row for each file.
File names are new for each attempt, and only the names of attempts that ended well are in the manifest, so
lost executors and retries leave files that nobody reads, not wrong ones.

Defined results: a null or empty text has the end id only; null ids come first; rows that share an id keep one entry each, in
any order; an empty table gives an empty manifest.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import tokens
from casebook.llm._common import by_value, lean, shared_folder, shuffle_partitions

by_value(__name__)

SEQ_LEN = 2048
BATCH = 256  # sequences in a batch
VOCABULARY = "byte_bpe_50k.json"
MANIFEST = "part int, tokens_file string, docs_file string, docs bigint, tokens bigint"


def store(uri: str):
    """(file system, path) of a URI or a plain path; any store that Arrow reads and writes."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri.replace("file:/", "file:///") if uri.startswith("file:/") and "//" not in uri else uri)
    return fs.LocalFileSystem(), uri


def id_type(vocabulary_size: int) -> pa.DataType:
    return pa.uint16() if vocabulary_size <= 1 << 16 else pa.uint32()


class _Sequences:
    """Writes a stream of ids as batches of equal-length sequences."""

    def __init__(self, sink, kind: pa.DataType, seq_len: int):
        self.kind, self.seq_len = kind, seq_len
        schema = pa.schema([("ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.writer = pa.ipc.new_file(sink, schema)
        self.wait: list[np.ndarray] = []
        self.held = 0

    def add(self, ids: np.ndarray) -> None:
        self.wait.append(ids.astype(self.kind.to_pandas_dtype()))
        self.held += len(ids)
        full = BATCH * self.seq_len
        if self.held >= full:
            ids = np.concatenate(self.wait)
            n = len(ids) // full * full
            for a in range(0, n, full):
                self._write(ids[a:a + full], full)
            self.wait, self.held = [ids[n:]], len(ids) - n

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len)
        self.writer.write_batch(pa.record_batch([lists(ids), lists(mask)], schema=self.writer_schema()))

    def writer_schema(self) -> pa.Schema:
        return pa.schema([("ids", pa.list_(self.kind, self.seq_len)), ("mask", pa.list_(pa.bool_(), self.seq_len))])

    def close(self) -> None:
        ids = np.concatenate(self.wait) if self.wait else np.zeros(0, np.uint16)
        if len(ids):
            whole = -(-len(ids) // self.seq_len) * self.seq_len
            self._write(np.concatenate([ids, np.zeros(whole - len(ids), ids.dtype)]), len(ids))
        self.writer.close()


def _file_writer(spec: str, folder: str, end_id: int, seq_len: int, kind: pa.DataType):
    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = sinks = None
        docs = total = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
                encoder = tokens.worker_encoder(spec, spaced=True)
                fs, root = store(folder)
                fs.create_dir(root, recursive=True)
                paths = [f"{folder}/{part:07d}-{name}.{x}.arrow" for x in ("tokens", "docs")]
                sinks = [fs.open_output_stream(store(p)[1]) for p in paths]
                out = _Sequences(sinks[0], kind, seq_len)
                schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("tokens", pa.int64())])
                index = pa.ipc.new_file(sinks[1], schema)
            keys = batch.column(0).cast(pa.int64())
            for a, b, ids, lengths in encoder.slices(batch.column(1)):
                ids, lengths = tokens.with_end(ids, lengths, end_id)
                starts = total + np.cumsum(lengths) - lengths
                index.write_batch(pa.record_batch([keys.slice(a, b - a), pa.array(starts), pa.array(lengths)], schema=schema))
                out.add(ids)
                docs, total = docs + b - a, total + len(ids)
        if sinks:
            out.close()
            index.close()
            for s in sinks:
                s.close()
            row = {"part": [part], "tokens_file": [paths[0]], "docs_file": [paths[1]], "docs": [docs], "tokens": [total]}
            yield pa.RecordBatch.from_pydict(row, pa.schema([
                ("part", pa.int32()), ("tokens_file", pa.string()), ("docs_file", pa.string()),
                ("docs", pa.int64()), ("tokens", pa.int64())]))
    return write


def write_sequences(
    docs: DataFrame,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = 0,
    seq_len: int = SEQ_LEN,
) -> DataFrame:
    """Writes the files and returns the manifest in order: part, files, docs, tokens, first_token (those before it)."""
    spark = docs.sparkSession
    spec = tokens.load(vocabulary or tokens.vocabulary_path(VOCABULARY))
    from tokenizers import Tokenizer

    kind = id_type(max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1))
    folder = folder or shared_folder(spark, "arrow-sequences")
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(shuffle_partitions(spark), "id").sortWithinPartitions("id")
    )
    # One row for each file: as many as partitions, whatever the number of documents.
    rows = sorted(ordered.mapInArrow(_file_writer(spec, folder, end_id, seq_len, kind), MANIFEST).collect())
    first, out = 0, []
    for r in rows:
        out.append((*r, first))
        first += r.tokens
    return spark.createDataFrame(out, MANIFEST + ", first_token bigint")


class SequenceFile:
    """Random access to one token file: sequences, masks and runs of ids, without copies when the file is mapped."""

    def __init__(self, uri: str):
        from pyarrow import fs

        where, path = store(uri)
        source = pa.memory_map(path) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        self.seq_len = self.reader.schema.field("ids").type.list_size
        self._held: tuple[int, pa.RecordBatch] | None = None

    def _batch(self, k: int) -> pa.RecordBatch:
        if self._held is None or self._held[0] != k:
            self._held = (k, self.reader.get_batch(k))
        return self._held[1]

    def sequence(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        batch, row = self._batch(s // BATCH), s % BATCH
        at = slice(row * self.seq_len, (row + 1) * self.seq_len)
        return batch.column(0).flatten().to_numpy()[at], batch.column(1).flatten().to_numpy(zero_copy_only=False)[at]

    def run(self, start: int, length: int) -> np.ndarray:
        """``length`` ids from place ``start`` of the file's stream; a view unless it spans batches."""
        parts, size = [], BATCH * self.seq_len
        while length > 0:
            ids = self._batch(start // size).column(0).flatten().to_numpy()
            part = ids[start % size:start % size + length]
            parts.append(part)
            start, length = start + len(part), length - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


@lean
def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for row in batch.to_pylist():
            where, path = store(row["docs_file"])
            index = pa.ipc.open_file(where.open_input_file(path))
            file = SequenceFile(row["tokens_file"])
            for k in range(index.num_record_batches):
                docs = index.get_batch(k)
                starts, lengths = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                crc = [zlib.crc32(file.run(s, n).astype("<u4")) for s, n in zip(starts.tolist(), lengths.tolist())]
                yield pa.record_batch(
                    [docs.column(0), pa.array(starts + row["first_token"]), docs.column(2), pa.array(crc, pa.int64())],
                    schema=schema)


def read_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; one task reads a file at a time."""
    files = manifest.select("docs_file", "tokens_file", "first_token")
    return files.repartition(max(1, manifest.count())).mapInArrow(_read, READ)

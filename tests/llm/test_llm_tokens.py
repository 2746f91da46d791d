"""Chunk encoder, Arrow files and packing against the library and brute force."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from casebook.llm import arrow_output, packing, tokens

TEXTS = [None, "", " ", "a  b", "x <|endoftext|> y", " lead", "trail ", "a\n b\t c\n\n d", "nul\x00 \x00 a\x01b", "it's they'll 'd x2 3rd (z)...!?",
         "é x́ ́y ﬁ İΣ ΣΑΣ Å", "xx\n\n yy \x1c z\x85　q  r  s “quoted”", "日本語 テキスト", "word " * 3000, "z" * 5000,
         "One. Two! Three? Four.", "\r\n", "<|startoftext|>", "aa bb aa bb"]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunks_give_the_librarys_ids(monkeypatch, name, spaced):
    encoder = tokens.ChunkEncoder(tokens.load(tokens.vocabulary_path(name)), spaced)
    for limit in (tokens.CACHE_CHUNKS, 5):
        monkeypatch.setattr(tokens, "CACHE_CHUNKS", limit)
        for _ in range(3):
            for a, b, ids, lengths in encoder.slices(TEXTS):
                ends = np.cumsum(lengths)
                for k in range(a, b):
                    want = encoder.plain.encode(TEXTS[k] or "", add_special_tokens=False).ids
                    assert ids[ends[k - a] - lengths[k - a]:ends[k - a]].tolist() == want, TEXTS[k]


def docs(spark):
    rows = [(k, t, "clash") for k, t in enumerate(TEXTS)] + [(None, "no id here", None), (3, "a  b", "x"), (-5, "first", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, tokens string").repartition(5)


def truth(df, name, spaced, end):
    plain = tokens.ChunkEncoder(tokens.load(tokens.vocabulary_path(name)), spaced).plain
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.doc_id), r.text or "") for r in df.collect())
    return [(k[2], [*plain.encode(t, add_special_tokens=False).ids, end]) for k, t in rows]


def test_arrow_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(arrow_output, "BATCH", 3)
    df = docs(spark)
    want = truth(df, arrow_output.VOCABULARY, True, 0)
    manifest = arrow_output.write_sequences(df, seq_len=16)
    got = sorted(arrow_output.read_documents(spark, manifest).collect(), key=lambda r: r.start)
    start = 0
    for r, (k, ids) in zip(got, want, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, start, len(ids), zlib.crc32(np.array(ids, "<u4")))
        start += len(ids)
    stream = list(itertools.chain.from_iterable(ids for _, ids in want))
    for m in manifest.orderBy("part").collect():
        file = arrow_output.SequenceFile(m.tokens_file)
        assert isinstance(file.reader.schema.field("ids").type, pa.FixedSizeListType)
        own = stream[m.first_token:m.first_token + m.tokens]
        back = []
        for s in range(-(-m.tokens // 16)):
            ids, mask = file.sequence(s)
            assert len(ids) == len(mask) == 16
            back += ids[mask].tolist()
        assert back == own
        first = file.reader.get_batch(0).column(0).flatten()
        assert first.to_numpy(zero_copy_only=True)[0] == own[0]
    empty = arrow_output.write_sequences(df.limit(0))
    assert empty.count() == 0 and arrow_output.read_documents(spark, empty).count() == 0


@pytest.mark.parametrize("segment", [500_000, 300])
def test_packing_covers_every_id_once(spark, monkeypatch, segment):
    monkeypatch.setattr(packing, "SEGMENT", segment)
    df = docs(spark)
    want = truth(df, packing.VOCABULARY, False, 1)
    pieces = packing.pack(df).collect()
    assert packing.pack(df.limit(0)).count() == 0
    left = {}
    for k, ids in want:
        left.setdefault(k, []).append(ids)
    total = 0
    for p in pieces:
        assert any(p.doc_tokens == len(x) and p.ids_crc32 == zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4")) for x in left[p.doc_id])
        total += p.length
    assert total == sum(len(x) for _, x in want)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.MAX_LEN


def test_dynamic_program_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = int(rng.integers(3, 40))
        cuts = np.concatenate([[0], np.cumsum(rng.integers(1, 30, n))])
        penalty = rng.choice([0.0, 8.0, 64.0], n + 1)
        f, back = packing.best_cuts(cuts, penalty, 64, (16, 32, 64))
        best = [0.0] + [float("inf")] * n
        for j in range(1, n + 1):
            for i in range(j):
                size = cuts[j] - cuts[i]
                if size <= 64:
                    best[j] = min(best[j], best[i] + (0 if size in (16, 32, 64) else 64 - size) + penalty[j])
        assert f == pytest.approx(best) and all(b < k for k, b in enumerate(back) if k)


def test_allowed_cuts_bound_gaps():
    cuts, penalty = packing.allowed_cuts(1000, np.array([900, 1000]), np.array([100, 130, 890]))
    assert np.diff(cuts).max() <= packing.STEP and cuts[0] == 0 and cuts[-1] == 1000
    assert dict(zip(cuts.tolist(), penalty.tolist()))[130] == packing.SENTENCE_CUT

"""Binary records and SentencePiece against the libraries."""

import os
import struct
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

public_tokenizers = pytest.importorskip("public_tokenizers")
from matchday.llm import sentencepiece_stream as sps  # noqa: E402
from matchday.llm import token_records as tr  # noqa: E402
from matchday.llm.scratch import importable  # noqa: E402

WORDS = public_tokenizers.path(tr.TOKENIZER)
PIECES = public_tokenizers.path(sps.MODEL)
TEXTS = [
    "", " ", "  a  b ", "The cat's 3.14 C++ don't\n\n\tstop.", "İstanbul ΣΑΣ ſ ﬁ ß. ßen É", "<|endoftext|> a <|startoftext|>b", "日本語テキスト 😀😀 ①",
    "a" * 3000, "abc" * 700 + " def", "▁x▁ y", "https://www.example.com/index.html?a=1&b=2", "    four  spaces", "e\u0301 x", "naïve café — “quoted”…",
    "x\u00a0y\u2003z\u3000w", "\r\n\x0b\x0c", "1234567890 12 3",
]


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


def _all_texts(spark):
    return TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]


def test_word_ids_equal_the_library(spark):
    from tokenizers import Tokenizer

    texts = _all_texts(spark)
    ids, n = tr.encode_texts(pa.array(texts, pa.large_string()), WORDS)
    want = [e.ids + [2] for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want


def test_records_round_trip(spark, tmp_dir):
    from tokenizers import Tokenizer

    rows = [(i * 7 % 31, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (5, None), (5, "twice"), (5, "twice")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int").repartition(3)
    out = tmp_dir + "/records"
    index = tr.write_records(df, out, WORDS)
    back = tr.read_records(index, out).orderBy("shard", "first").collect()
    tokenizer = Tokenizer.from_file(WORDS)
    want = sorted((repr(d), zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())) for d, t in rows)
    assert sorted((repr(r.doc_id), r.ids_crc32) for r in back) == want
    assert [r.doc_id for r in back] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    # the files alone: frames follow each other, and the index holds their offsets
    shard = sorted({r.shard for r in back})[0]
    raw, at, offsets = open(f"{out}/{shard}", "rb").read(), 0, []
    while at < len(raw):
        (n,) = struct.unpack_from("<Q", raw, at)
        assert struct.unpack_from("<I", raw, at + 8)[0] == tr.masked(raw[at : at + 8])
        assert struct.unpack_from("<I", raw, at + 12 + n)[0] == tr.masked(raw[at + 12 : at + 12 + n])
        offsets.append(at)
        at += n + 16
    assert offsets == np.fromfile(f"{out}/{shard[:-3]}idx", "<u8").tolist()
    some = index.where("offset > 0")
    assert tr.read_records(some, out).count() == some.count()


def test_a_damaged_record_is_found(tmp_path):
    import pyarrow.fs as pafs

    body = tr._DOC.pack(2, 1, 7) + np.array([1, 2], "<u2").tobytes()
    head = tr._HEAD.pack(len(body))
    record = head + tr._SUM.pack(tr.masked(head)) + body + tr._SUM.pack(tr.masked(body))
    for i in (None, 0, 9, 14, len(record) - 1):
        raw = bytearray(record)
        if i is not None:
            raw[i] ^= 1
        path = tmp_path / f"{i}.rec"
        path.write_bytes(bytes(raw))
        data = pafs.LocalFileSystem().open_input_file(str(path))
        if i is None:
            doc, ids = tr.record_at(data, 0, len(record))
            assert doc == 7 and ids.tolist() == [1, 2]
        else:
            with pytest.raises(ValueError):
                tr.record_at(data, 0, len(record))


def test_records_query(spark):
    got = tr.op5_token_records(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    assert len(got) == 200
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_no_documents_no_records(spark, tmp_dir):
    df = spark.createDataFrame([], "doc_id long, text string")
    index = tr.write_records(df, tmp_dir + "/none", WORDS)
    assert index.count() == 0 and tr.read_records(index, tmp_dir + "/none").count() == 0


def test_pieces_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = sps.pieces_of(PIECES)
    texts = _all_texts(spark)
    for t in TEXTS:
        assert model.encode(t) == sp.encode(t), t
    ids, n = sps.encode_texts(pa.array(texts, pa.large_string()), model)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == sp.encode(texts)
    assert sps.decode_texts(ids, n, model) == [t.replace(sps.MARK, " ") for t in texts]


def test_pieces_are_committed_while_a_text_runs():
    model, seen = sps.pieces_of(PIECES), 0

    def characters():
        nonlocal seen
        for c in sps.MARK + "internationalisation" * 200:
            seen += 1
            yield c

    first = next(model.stream(characters()))
    assert first and seen <= 4 * model.longest


def test_encode_and_decode_tables(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, " a\n"), (3, " a\n")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")
    ids = sps.encode(df, PIECES)
    assert sorted((repr(r.doc_id), len(r.ids)) for r in ids.collect()) == [("1", 0), ("2", 0), ("3", 3), ("3", 3), ("None", 2)]
    assert sorted((repr(r.doc_id), r.text) for r in sps.decode(ids, PIECES).collect()) == sorted((repr(d), t or "") for d, t in rows)
    assert all(r.round_trip for r in sps.token_digests(df, PIECES).collect())
    assert sps.encode(df.limit(0), PIECES).collect() == []

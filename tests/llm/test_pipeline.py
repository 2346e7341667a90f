"""The corpus pipeline against a plain Python version of its stages."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from matchday.llm import quality, secret_scan, sentencepiece_stream  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def _redacted(text):
    import re

    found = []
    for nth, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), nth, m.end(), rule.kind))
    out, at = "", 0
    for start, _, end, kind in sorted(found):
        if start >= at:
            out += f"{text[at:start]}[{kind}]"
        at = max(at, end)
    return out + text[at:]


def test_pipeline_equals_brute_force(spark):
    import sentencepiece

    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = brute.quality([(t, s) for _, t, s in rows], quality.LINE_TEXTS, quality.LINE_SHARE, quality.LEAST_LEFT)
    docs = [(d, clean) for (d, _, _), (kept, clean) in zip(rows, judged) if kept]
    docs = [(d, t) for (d, t), (_, _, first) in zip(docs, brute.components(docs)) if d == first]
    docs = [(d, t) for d, t in docs if max(brute.coverage(t, i) for i in items) < 0.8]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepiece_stream.MODEL))
    want = sorted((d, sp.encode(_redacted(t))) for d, t in docs)
    assert sorted((r.doc_id, list(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()) == want


def test_stages_take_odd_rows_and_empty_tables(spark):
    prose = " ".join(f"word{i}" for i in range(30))
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    rows = [(1, prose, "en", "a", 5, "x"), (1, prose, "en", "a", 5, "x"), (None, prose + " z", None, None, None, None), (3, None, "en", "a", 0, "x"),
            (4, "", "en", "a", 0, "x"), (5, prose[::-1] + " token=abcdefgh", "en", "b", 1, "x")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"], name
        got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert sorted(repr(r.doc_id) for r in got) == (["5", "None"] if data else [])
    assert len(corpus_pipeline.STAGES) == 5


def test_near_copies_of_five_words_and_four_fifths_go(spark):
    base = [f"word{i}" for i in range(300)]
    spread = [f"long{i}" for i in range(500)]
    texts = [
        base, base[:100] + [f"new{i}" for i in range(28)] + base[128:],  # 0.805 on five words, 0.811 on four
        base[:100] + [f"far{i}" for i in range(60)] + base[160:],  # a copy of too little
        spread, [f"other{i}" if i % 45 == 3 and i < 490 else w for i, w in enumerate(spread)],  # 11 words apart: 0.800 and 0.837
        [f"tail{i}" for i in range(400)], [f"tail{i}" for i in range(400)] + [f"added{i}" for i in range(86)],  # 0.82 on both
    ]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(100 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    want = [d for (d, _), (_, _, first) in zip(rows, brute.components(rows, k=5, percent=80)) if d == first]
    assert [d for d in want if d < 100] == [0, 2, 3, 5]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == sorted(want)


def test_extra_columns_keep_their_values(spark):
    prose = " ".join(f"word{i}" for i in range(30))
    names = ["kept", "n_words", "_clean", "_c", "found", "Base_Failed", "_blob", "n.symbols"]
    docs = spark.createDataFrame(
        [(1, prose + " token=abcdefgh", "a", 5, *names)], "doc_id long, text string, source string, n_chars long, " + ", ".join(f"`{x}` string" for x in names))
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.secret_scans):
        out = stage(spark, docs, SF)
        row = out.first()
        assert out.columns == docs.columns and list(row[4:]) == names and row["n_chars"] == len(row["text"])
    assert row["text"] == prose + " [assign]"

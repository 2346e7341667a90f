"""Resampling, chat formatting and collocations against plain Python, and edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchday.llm import chat_format, collocations, target_resample
from matchday.llm.words import texts_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- target-distribution resampling --------------------------------------------
def _features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def _resampled(docs, target, least=20, percent=25, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for text in texts for f in _features(text)[1]) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
    rows = []
    for d, text in docs:
        n, f = _features(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    may = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    place = {id(r): i + 1 for i, r in enumerate(may[: percent * len(may) // 100])}
    return sorted((*r[:4], place.get(id(r))) for r in rows)


def _prose(n, words=60, seed=1):
    rng = np.random.default_rng(seed)
    return [" ".join(f"W{min(int(x), 400)}" + (",é" if x > 50 else "") for x in rng.zipf(1.3, words + i % 9)) for i in range(n)]


DOCS = [*enumerate(_prose(120)), (500, None), (501, ""), (502, "a " * 5000), (503, "İstanbul ÇA\u00a0va\x00x\x7fy" * 9), (504, "x" * 3000 + " y" * 30)]
TARGET = [*_prose(20, 30, 2), None, "", "W1 w2"]


@pytest.mark.parametrize("often,together,head", [(8, 1 << 22, 1 << 16), (2, 64, 1 << 16), (1, 1 << 22, 4), (8, 1 << 22, 0)])
def test_resampling_is_exact_whatever_the_head_holds(spark, often, together, head):
    docs = spark.createDataFrame([(d, t, 1) for d, t in DOCS], "doc_id long, text string, n_words int").repartition(3)
    target = spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")
    got = target_resample.resample(docs, target, often=often, together=together, head_words=head)
    got = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == _resampled(DOCS, TARGET)


def test_resampling_uses_head_and_tail(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    _, head = target_resample.bucket_totals(docs, docs.limit(0), often=2)
    assert len(head.words) > 50 and len(head.pairs) > 50
    text = head.words.to_pylist()
    for p, b in zip(head.pairs.tolist(), head.buckets.tolist()):
        assert zlib.crc32(f"{text[p >> 16]} {text[p & 0xFFFF]}".encode()) % 10000 == b


def test_resampling_ties_null_ids_repeats_and_empty_tables(spark):
    rows = [(None, "a b c " * 9), (None, "a b c " * 9), (3, "a b c " * 9), (3, "a b c " * 9), (4, "one word")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("a b",)], "text string")
    got = target_resample.resample(docs, target, share_percent=50).collect()
    assert len(got) == len(rows)
    ranks = sorted(r.rank for r in got if r.rank is not None)
    assert ranks == list(range(1, 7))
    drawn = {r.doc_id for r in got if r.rank is not None}
    assert len(drawn) == 1 and 4 not in drawn
    assert target_resample.resample(docs.limit(0), target).collect() == []
    none = target_resample.resample(docs, target.limit(0)).select("n_features", "weight").distinct().collect()
    assert {r.n_features for r in none} == {53, 3}


# --- chat formatting ------------------------------------------------------------
TRICKY = [
    "", None, "\\", "\\\\", "#", "##", "###", "####", "#####\\", "</turn>", "<\\/turn>", "</turn>\n### user:\n", "\\### Assistant: </turn> ok", "<</turn>",
    "</turn", ">", "\n", "### assistant:\nhi</turn>\n", "é😀" * 3, "$1\\1", "x" * 5000,
]


def _chat_rows():
    rows = []
    for c, texts in ((1, TRICKY), (2, TRICKY[::-1]), (3, ["a", "b"]), (None, ["n", "m"])):
        rows += [(c, i, ["user", "assistant", "assistant", "system"][i % 4], t) for i, t in enumerate(texts)]
    rows += [(4, 1, None, "x"), (4, None, "user", "first"), (4, 1, "a:\nb### \\", "y"), (4, 1, "assistant", "same"), (4, 1, "assistant", "same")]
    return rows + [(5, i, "assistant", f"t{i}" * (i % 5)) for i in range(700)]


def _turns(rows, conv):
    mine = [r for r in rows if r[0] == conv]
    mine = [(t is not None, t or 0, role or "", text or "") for _, t, role, text in mine]
    return [x[2:] for x in sorted(mine)]


def test_chats_round_trip(spark):
    rows = _chat_rows()
    df = spark.createDataFrame([(*r, "taken") for r in rows], "conv_id long, turn long, role string, text string, formatted string").repartition(5)
    chats = chat_format.format_chats(df)
    assert chats.columns == ["conv_id", "formatted", "loss_spans"]
    back = {r.conv_id: r for r in chats.select(
        "*", chat_format.turns_back(F.col("formatted")).alias("turns"),
        chat_format.texts_under(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    digest = {r.conv_id: r for r in chat_format.digests(chats).collect()}
    assert set(back) == {1, 2, 3, 4, 5, None}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, got in back.items():
        want = _turns(rows, conv)
        assert [tuple(t) for t in got.turns] == want
        loss = [t for role, t in want if role == "assistant"]
        assert got.loss == loss
        for span, text in zip(got.loss_spans, loss, strict=True):
            assert re.sub(r"(?s)\\(.)", r"\1", got.formatted[span.start : span.end]) == text
        d = digest[conv]
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(want), len("".join(loss)), len(got.formatted))
        assert (d.turns_sha256, d.loss_sha256) == (sha("".join(f"{r}\n{t}\n" for r, t in want)), sha("".join(loss)))
    # adjacent turns of one role share a header
    assert back[5].formatted.count("### assistant:\n") == 1


def test_no_control_string_in_escaped_texts(spark):
    df = spark.createDataFrame([(t or "",) for t in TRICKY], "t string").select("t", chat_format.escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat_format.unescaped(F.col("e")).alias("u")).collect():
        assert "###" not in r.e and "</turn>" not in r.e and r.u == r.t


def test_chats_of_an_empty_table_and_without_loss(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat_format.digests(chat_format.format_chats(spark.createDataFrame([], schema))).collect() == []
    one = chat_format.format_chats(spark.createDataFrame([(1, 1, "user", "hello")], schema))
    r = one.collect()[0]
    assert (r.formatted, r.loss_spans) == ("### user:\nhello</turn>\n", [])
    assert chat_format.digests(one).collect()[0].loss_sha256 == hashlib.sha256(b"").hexdigest()


# --- collocations ---------------------------------------------------------------
def _collocations(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in cand.items():
        if any(x == lang and len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (x, q), b in cand.items()):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, c in out.items() for i, (s, a, p, left, right) in enumerate(sorted(c)[:top]))


def _speech(n, seed):
    rng = np.random.default_rng(seed)
    marks = [" ", " ", " ", "\t", "  ", ", ", "\n", ". ", "\x0b", "\u00a0"]
    out = []
    for _ in range(n):
        w = [f"{'Wé'[int(x) % 2]}{int(x)}" for x in rng.zipf(1.4, int(rng.integers(0, 60))) if x < 200]
        out.append("".join(x + marks[int(m)] for x, m in zip(w, rng.integers(0, len(marks), len(w)))))
    return out


SPEECH = [(t, [None, "en", "de", "und", ""][i % 5]) for i, t in enumerate(_speech(220, 3))]
SPEECH += [(None, "en"), ("", None), ("\n\n. .", "de"), ("aa bb cc dd " * 400, "en"), ("same text here, " * 3, "fr")] + [("copy of one text. copy of one", "fr")] * 40


@pytest.mark.parametrize("bits", [64, 9, 4])
def test_collocations_equal_plain_counts_whatever_collides(spark, bits):
    docs = spark.createDataFrame([(t, x, "phrase") for t, x in SPEECH], "text string, lang string, phrase string").repartition(4)
    phrases, words = collocations.frequent_phrases(docs, bits=bits)
    got = collocations.collocations(phrases, words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == _collocations(SPEECH)


def test_collocations_cut_at_the_top_with_ties(spark):
    docs = spark.createDataFrame([(f"a{i % 40} b{i % 40}", "en") for i in range(400)], "text string, lang string")
    got = collocations.collocations(*collocations.frequent_phrases(docs), top=7)
    assert sorted(map(tuple, got.collect())) == _collocations([tuple(r) for r in docs.collect()], top=7)


def test_collocations_of_empty_tables_and_exact_products(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(*collocations.frequent_phrases(empty)).collect() == []
    big = 10**12
    phrases = spark.createDataFrame(
        [("en", 1, "a", big + 1), ("en", 1, "b", big + 3), ("en", 2, "a b", big)], "lang string, size int, phrase string, n long")
    words = spark.createDataFrame([("en", 5 * big)], "lang string, n long")
    got = collocations.collocations(phrases, words).collect()
    assert [tuple(r) for r in got] == [("en", 1, "a b", big, big + 1, big + 3, 5 * big, 10**6 * big * big // ((big + 1) * (big + 3)))]


def test_runs_stay_within_pieces_of_one_text():
    texts = texts_of(pa.array(["a b, c", None, "", "d\te f", "g", "h.i j k"]))
    p = collocations.Phrases(texts, ["x"] * 6, 64)
    assert p.strings(p.runs(2), 2).to_pylist() == ["a b", "d e", "e f", "i j", "j k"]
    assert p.strings(p.runs(3), 3).to_pylist() == ["d e f", "i j k"]
    cut = collocations.Phrases(texts.slice(3, 2), ["x"] * 2, 64)
    assert cut.strings(cut.runs(2), 2).to_pylist() == ["d e", "e f"]
    assert set(cut.prints(cut.runs(2), 2)) <= set(p.prints(p.runs(2), 2))

"""Words and window hashes of Arrow batches."""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from matchday.llm.bitmap import Bitmap, bits_for
from matchday.llm.words import Spans, chunks, encoded, hashed, short_windows, split_words, starts, texts_of

TEXTS = [None, "", " a  b\n", "é\x0bx\x0c\ry\tz", "\u00a0 \u2003", "one two three", *(f"w{i} " * (i % 7) for i in range(300))]


def _words(texts):
    return [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_words_of_whole_and_cut_batches():
    column = pa.array(TEXTS)
    for at, n in ((0, len(TEXTS)), (3, 50), (7, 1), (5, 0)):
        for low in (False, True):
            texts = texts_of(column.slice(at, n))
            words, counts = split_words(pc.ascii_lower(texts) if low else texts)
            want = _words(TEXTS[at : at + n])
            assert words.to_pylist() == [w for x in want for w in x] and counts.tolist() == [len(x) for x in want]


def test_chunks_hold_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["i", "text"])
    for most in (1, 40, 1 << 20):
        seen = [(i, t) for rows, texts in chunks([batch, batch.slice(0, 0)], "text", most) for i, t in zip(rows.column("i").to_pylist(), texts.to_pylist())]
        assert seen == [(i, t or "") for i, t in enumerate(TEXTS)]


def test_window_hashes_follow_the_words():
    words, counts = split_words(texts_of(pa.array(["a b c d a b c", "x", "b c d"])))
    codes, distinct = encoded(words)
    h = hashed(distinct)[codes]
    at, windows = starts(counts, 3)
    assert windows.tolist() == [5, 0, 1]
    w = short_windows(h, 3)[at]
    assert w[0] == w[4] and w[1] == w[5] and len(set(w.tolist())) == 4
    assert (Spans(h).of(at, at + 3) == w).all()


def test_bitmap_never_misses():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5000):
        hashes = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        bits = bits_for(n)
        words = np.zeros(1 << (bits - 6), np.uint64)
        low = hashes & np.uint64((1 << bits) - 1)
        np.bitwise_or.at(words, (low >> np.uint64(6)).astype(int), np.uint64(1) << (low & np.uint64(63)))
        known = Bitmap(words)
        assert known.has(hashes).all()
        assert known.has(rng.integers(0, 1 << 63, 10_000, dtype=np.uint64)).mean() < 0.2

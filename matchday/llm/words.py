"""Words, word hashes and word-window hashes of Arrow batches (numpy inside Spark tasks).

A word is a longest run of characters other than ``\\x20`` and ``\\x09``-``\\x0D``. A word's hash is 64 bits long, a
window's hash a polynomial of its words' hashes modulo 2**64, so that equal windows have equal hashes in any batch, task
and run, and different ones collide with probability 2**-64 a pair.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd multiplier of the window hashes, and its inverse modulo 2**64.
_M = 0x9E3779B97F4A7C15
_M_INV = pow(_M, -1, 1 << 64)
_ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def texts_of(column) -> pa.LargeStringArray:
    """A string column of a batch, null as the empty text, with 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.offset:
        # a copy whose values begin at 0: some kernels of pyarrow take a cast slice's first offset for 0
        column = pa.concat_arrays([column, column.slice(0, 0)])
    return pc.fill_null(column.cast(pa.large_string()), "")


def split_words(texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and each text's number of words."""
    lists = pc.ascii_split_whitespace(texts)
    flat, at = lists.flatten(), np.asarray(lists.offsets)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    seen = np.concatenate([[0], np.cumsum(full)])
    counts = seen[at[1:] - at[0]] - seen[at[:-1] - at[0]]
    return (flat if full.all() else flat.filter(pa.array(full))), counts.astype(np.int64)


def encoded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words, and the distinct words that they number."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def hashed(distinct: pa.Array) -> np.ndarray:
    """64-bit hash of each string."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads a window hash over all bits, as order and bitmap need it."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def short_windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of ``k`` words, for a small ``k``; windows may cross texts (see ``starts``)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, m = np.zeros(n, np.uint64), 1
    for j in range(k):
        out += h[j : j + n] * np.uint64(m)
        m = m * _M % (1 << 64)
    return mixed(out)


class Spans:
    """Hashes of arbitrary spans of one word-hash sequence, from running sums."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        with np.errstate(over="ignore"):
            power = np.full(n + 1, _M, np.uint64)
            power[0] = 1
            power = np.multiply.accumulate(power)
            back = np.full(n + 1, _M_INV, np.uint64)
            back[0] = 1
            self._back = np.multiply.accumulate(back)
            self._sum = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(h * power[:n])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self._sum[end] - self._sum[start]) * self._back[start])


def starts(counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the flat words at which a whole ``k``-word window of one text starts, and the windows of each text."""
    windows = np.maximum(counts - k + 1, 0)
    first = np.cumsum(counts) - counts
    inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    return np.repeat(first, windows) + inside, windows


def plain(distinct: pa.Array) -> pa.Array:
    """Words lower-cased, without ASCII punctuation at their ends."""
    return pc.utf8_trim(pc.utf8_lower(distinct), _ASCII_PUNCTUATION)


def long_lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """An Arrow column of lists of 64-bit integers from flat values and each row's number of them."""
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.ascontiguousarray(values).view(np.int64)))


def chunks(batches, column: str, most: int = 4 << 20):
    """Slices of the batches whose texts hold ``most`` bytes at most (a longer text is a slice of its own).

    Yields the slice and its texts; memory follows ``most`` and the longest text, not the number of rows in a batch.
    """
    for batch in batches:
        texts = texts_of(batch.column(column))
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            full = (ends[at - 1] if at else 0) + most
            end = max(at + 1, int(np.searchsorted(ends, full, side="right")))
            yield batch.slice(at, end - at), texts.slice(at, end - at)
            at = end


class IdPool:
    """Lists of ids by string, packed."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self._ids, self._ends = array("i"), array("q", [0])

    def add(self, key: str, ids: Iterable[int]) -> int:
        self._ids.extend(ids)
        self._ends.append(len(self._ids))
        self.at[key] = len(self._ends) - 2
        return self.at[key]

    def get(self, place: int) -> array:
        return self._ids[self._ends[place] : self._ends[place + 1]]

    def lists(self) -> pa.LargeListArray:
        return pa.LargeListArray.from_arrays(pa.array(np.array(self._ends)), pa.array(np.array(self._ids)))

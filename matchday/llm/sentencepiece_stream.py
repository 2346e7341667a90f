"""SentencePiece encoding and decoding by streaming Viterbi.

The encoder walks over the characters and keeps, for each of the last positions (as many as the longest piece has
characters), the last piece of the best path that ends there. For a BPE model the best path of a prefix is its merge result:
exactly one piece that ends at a position can follow the path at its start, namely the one whose pair with that path's last
piece merges to these two pieces again. Whenever the paths of all kept positions meet in one boundary, the ids before it are
committed and forgotten, so memory is bounded by the window however long a text is. The ids equal those of the library.

The distinct words of a slice are laid end to end in some thousand streams, which advance together, one character a step, on
arrays: pieces are found by hashes of the characters before a position, pairs in a table of those judged before, and the
boundary that all paths share by intersecting the sets of positions on them, bits of a 64-bit word. Pieces hold no white
space mark after their first other character, so paths also meet before each word, and a word's ids do not depend on where it lies.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.scratch import frugal
from matchday.llm.tables import table
from matchday.llm.words import Spans, chunks, encoded

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Pairs of pieces that a Python worker remembers (9 bytes each, in a table twice as large), and characters walked at once.
PAIRS, BLOCK = 1 << 18, 1 << 20
#: Streams that advance together; words longer than the second take the walk over one stream.
LANES, LONG = 8192, 256
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")
_U = np.uint64


class HashTable:
    """Positive integers by 64-bit keys, by open addressing on arrays; the key 0 is none."""

    def __init__(self, bits: int, kind):
        self._shift, self._mask = _U(64 - bits), (1 << bits) - 1
        self.keys, self.values, self.n = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, kind), 0

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def add(self, key: int, value: int) -> None:
        at = int(self._first(np.array([key], np.uint64))[0])
        while self.keys[at] and self.keys[at] != key:
            at = (at + 1) & self._mask
        self.n += not self.keys[at]
        self.keys[at], self.values[at] = key, value

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, 0 where there is none."""
        at = self._first(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], 0)
        left = np.flatnonzero((found != keys) & (found != 0))
        at = at[left]
        while len(left):
            at = (at + 1) & self._mask
            found = self.keys[at]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[hit]]
            go = ~hit & (found != 0)
            left, at = left[go], at[go]
        return out


class Pieces:
    """A BPE model with byte fallback and no normalisation but the space mark and a mark in front."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes = {}
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        raw = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
                raw.append(piece.replace(MARK, " ").encode())
        if len(self.bytes) != 256 or any(MARK in x.lstrip(MARK) for x in self.ids):
            raise ValueError("only models with byte fallback, and pieces with marks in front, are supported")
        probe = "  AÄﬁ① b  c\t "
        if self.decode(sp.encode(probe)) != probe or sp.encode("A b")[0] != sp.encode(" A b")[1]:
            raise ValueError("models that normalise texts, or put no mark in front, are not supported")
        self.raw = pa.array(raw, pa.large_binary())
        self.longest = max(map(len, self.ids))
        self._halves: dict[str, tuple[str, str] | None] = {}
        # pieces that their characters merge to, by number from 1 on; a character that is no piece has the number after them
        self.whole = [x for x in self.ids if len(x) == 1 or self._split(x) is not None]
        self.number = {x: i + 1 for i, x in enumerate(self.whole)}
        self.other = len(self.whole) + 1
        self.length = np.array([0, *map(len, self.whole), 1], np.int64)
        self.id_of = np.array([0, *(self.ids[x] for x in self.whole), 0], np.int32)
        self._places = HashTable(max(4, (4 * len(self.whole)).bit_length()), np.int32)
        for x, h in zip(self.whole, _hashes([x for x in self.whole]).tolist()):
            self._places.add(h, self.number[x])
        self._pairs = HashTable((2 * PAIRS - 1).bit_length(), np.int8)
        self.commits = 0

    def merged(self, text: str, steps: list | None = None) -> list[str]:
        """Merges of a short text: always the pair whose piece has the best score, of equal ones the first. ``steps`` gets them."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            if steps is not None:
                steps.append((parts[at], parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces that merge to a piece last; None if the piece is not the merge result of its characters."""
        if len(piece) == 1:
            return None
        if piece not in self._halves:
            steps: list[tuple[str, str]] = []
            self._halves[piece] = steps[-1] if self.merged(piece, steps) == [piece] else None
        return self._halves[piece]

    def _meet(self, a: str, b: str) -> bool:
        """Whether ``a`` and ``b`` side by side stay apart: goes back through the merges of both, the latest first, and looks
        whether the pieces at their border would have merged before one of them was used up."""
        score, limit = self.score, None
        while True:
            joined = score.get(a + b)
            if joined is not None and (limit is None or joined > limit[0] or (joined == limit[0] and limit[1])):
                return False
            # a piece made by a merge is later than its parts; of equal ones the left is made first
            late_a, late_b = (score[a] if len(a) > 1 else None), (score[b] if len(b) > 1 else None)
            if late_a is None and late_b is None:
                return True
            if late_b is None or (late_a is not None and late_a < late_b):
                limit, a = (late_a, False), self._split(a)[1]
            else:
                limit, b = (late_b, True), self._split(b)[0]

    def _follows(self, a: str, b: str) -> bool:
        # pieces of marks have one score, which says nothing of their order
        return self.merged(a + b) == [a, b] if MARK in (a[-1], b[-1]) else self._meet(a, b)

    def follow(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether pieces, by number, stay apart side by side."""
        key = (before.astype(np.uint64) << _U(32)) | after.astype(np.uint64)
        known = self._pairs.get(key)
        if len(missing := np.unique(key[known == 0])):
            if self._pairs.n + len(missing) > PAIRS:
                self._pairs = HashTable((2 * PAIRS - 1).bit_length(), np.int8)
            for k in missing.tolist()[:PAIRS]:
                a, b = k >> 32, k & 0xFFFFFFFF
                apart = self.other in (a, b) or self._follows(self.whole[a - 1], self.whole[b - 1])
                self._pairs.add(k, 2 if apart else 1)
            return self.follow(before, after)
        return known == 2

    def _last(self, text: str, i: int, last: list[str], done: str) -> str:
        """The last piece of the path that ends at place ``i``."""
        for at in range(max(0, i - self.longest), i):
            piece = text[at:i]
            if piece not in self.number and at < i - 1:
                continue
            before = last[at] if at else done
            if not before:
                return piece
            a, b = (self.number.get(x, self.other) for x in (before, piece))
            if self.follow(np.array([a]), np.array([b]))[0]:
                return piece
        raise AssertionError("a path ends at every place")

    def stream(self, characters: Iterable[str]) -> Iterator[str]:
        """The pieces of a marked text, as soon as they are certain."""
        size = self.longest
        text = ""  # the characters since the last committed boundary
        last: list[str] = [""]  # last piece of the path that ends at each position of the text
        done = ""  # the last committed piece
        for c in characters:
            text += c
            i = len(text)
            last.append(self._last(text, i, last, done))
            if i >= 4 * size:
                live = set(range(i - size + 1, i + 1))
                while len(live) > 1:
                    latest = max(live)
                    live.remove(latest)
                    live.add(latest - len(last[latest]))
                if boundary := live.pop():
                    path = self._path(last, boundary)
                    self.commits += 1
                    yield from path
                    done, text, last = path[-1], text[boundary:], ["", *last[boundary + 1 :]]
        yield from self._path(last, len(text))

    @staticmethod
    def _path(last: list[str], at: int) -> list[str]:
        out = []
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def ids_of(self, pieces: Iterable[str]) -> list[int]:
        out = []
        for x in pieces:
            i = self.ids.get(x)
            out += [i] if i is not None else [self.bytes[b] for b in x.encode("utf-8", "replace")]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, equal to the library's."""
        return self.ids_of(self.stream(MARK + text.replace(" ", MARK))) if text else []

    def decode(self, ids: Iterable[int]) -> str:
        raw = getattr(self, "raw", None)
        if raw is None:  # while loading
            back = {v: k.replace(MARK, " ").encode() for k, v in self.ids.items()} | {v: bytes([k]) for k, v in self.bytes.items()}
            out = b"".join(back.get(i, b"") for i in ids)
        else:
            out = b"".join(raw.take(pa.array(ids, pa.int64())).to_pylist())
        return out.decode("utf-8", "replace").removeprefix(" ")

    def _matches(self, codes: np.ndarray, inside: np.ndarray) -> list[np.ndarray]:
        """For each length, the number of the piece that ends behind each character, 0 where there is none."""
        spans, out = Spans(codes.astype(np.uint64)), []
        for n in range(1, self.longest + 1):
            ends = np.flatnonzero(inside >= n) + 1
            found = np.zeros(len(codes), np.int16 if self.other < 1 << 15 else np.int32)
            found[ends - 1] = self._places.get(spans.of(ends - n, ends) | _U(1))
            if n == 1:
                found[found == 0] = self.other
            out.append(found)
        return out

    def walk(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces of all words (``codes``: their characters, one word after the other): where each piece ends, its
        number, and the words whose paths did not meet within a stream's window."""
        ends = np.cumsum(lengths)
        inside = np.arange(1, len(codes) + 1) - np.repeat(ends - lengths, lengths)
        matches = self._matches(codes, inside)
        # streams of whole words, the longest first
        cuts = np.unique(np.concatenate([[0], ends[np.searchsorted(ends, np.arange(1, LANES + 1) * len(codes) // LANES)]]))
        begin, size = cuts[:-1], np.diff(cuts)
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        n = len(begin)
        window = self.longest
        last = np.zeros((64, n), np.int32)
        passed = np.zeros((64, n), np.uint64)  # the positions on the path to a position, by their number modulo 64
        passed[0] = 1
        base, lost = np.zeros(n, np.int64), np.zeros(n, bool)
        places, pieces = [], []

        def emit(lanes: np.ndarray, at: np.ndarray) -> None:
            """The paths from the committed boundaries of these streams up to ``at``."""
            while len(lanes):
                piece = last[at & 63, lanes]
                places.append(begin[lanes] + at)
                pieces.append(piece)
                at = at - self.length[piece]
                go = at > base[lanes]
                lanes, at = lanes[go], at[go]

        active = n
        for t in range(1, int(size[0]) + 1 if n else 0):
            here = begin[:active] + t - 1
            open_ = np.arange(active)
            row_last, row_passed = last[t & 63], passed[t & 63]
            for k in range(min(window, t), 0, -1):
                if not len(open_):
                    break
                piece = matches[k - 1][here[open_]]
                some = np.flatnonzero(piece)
                if not len(some):
                    continue
                lanes, piece = open_[some], piece[some].astype(np.int64)
                ok = inside[here[lanes]] == k  # a word's first piece follows anything
                rest = np.flatnonzero(~ok)
                if len(rest):
                    ok[rest] = self.follow(last[(t - k) & 63, lanes[rest]], piece[rest])
                lanes, piece, some = lanes[ok], piece[ok], some[ok]
                row_last[lanes] = piece
                # bits of positions older than the path's last 64 stand for later ones now
                keep = ~_U((((1 << k) - 1) << ((t - k + 1) & 63) | ((1 << k) - 1) >> (64 - ((t - k + 1) & 63))) & (2**64 - 1))
                row_passed[lanes] = (passed[(t - k) & 63, lanes] & keep) | _U(1 << (t & 63))
                open_ = np.delete(open_, some)
            if t % 16 == 0 and t > window:
                common = np.bitwise_and.reduce(passed[(np.arange(t - window + 1, t + 1) & 63)[:, None], np.arange(active)[None, :]], axis=0)
                first = t - window + 1  # the earliest kept position: a boundary lies there or before
                turn = (63 - first) % 64
                turned = (common << _U(turn)) | (common >> _U((64 - turn) % 64)) if turn else common
                # position ``first`` is the top bit; 40 before it count
                high = np.frexp((turned >> _U(23)).astype(np.float64))[1]
                boundary = first - (41 - high)
                lanes = np.flatnonzero((high > 0) & (boundary > base[:active]) & ~lost[:active])
                if len(lanes):
                    emit(lanes, boundary[lanes])
                    base[lanes] = boundary[lanes]
                    self.commits += len(lanes)
                lost[:active] |= t + 16 - base[:active] > 63
            active = int(np.searchsorted(-size[:active], -t, "left"))
        # a stream that has ended keeps its last positions
        emit(np.flatnonzero(~lost), size[~lost])
        at = np.concatenate([*places, np.zeros(0, np.int64)])
        piece = np.concatenate([*pieces, np.zeros(0, np.int32)])
        again = np.zeros(len(ends), bool)
        for lane in np.flatnonzero(lost):
            again[np.searchsorted(ends, begin[lane], "right") : np.searchsorted(ends, begin[lane] + size[lane], "left") + 1] = True
        if again.any():
            keep = ~again[np.searchsorted(ends, at)]
            at, piece = at[keep], piece[keep]
        order = np.argsort(at)
        return at[order], piece[order], again

    def _ids_at(self, codes: np.ndarray, at: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces that end at places of the text, and each piece's number of ids (bytes, if it is no piece)."""
        n = np.ones(len(at), np.int64)
        odd = np.flatnonzero(piece == self.other)
        chars, which = np.unique(codes[at[odd] - 1], return_inverse=True)
        raw = [self.ids_of([chr(c)]) for c in chars.tolist()]
        n[odd] = np.array([len(x) for x in raw], np.int64)[which] if len(odd) else 0
        out = np.repeat(self.id_of[piece], n)
        starts = np.cumsum(n) - n
        for i, w in zip(starts[odd].tolist(), which.tolist()):
            out[i : i + len(raw[w])] = raw[w]
        return out, n

    def lists(self, units: pa.Array) -> pa.LargeListArray:
        """The ids of each marked word."""
        lengths = pc.utf8_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
        short = lengths <= LONG
        counts, found = np.zeros(len(units), np.int64), []
        by_hand = np.flatnonzero(~short).tolist()
        some = np.flatnonzero(short)
        ends = np.cumsum(lengths[some])
        begin = 0
        while begin < len(some):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + BLOCK, "right")))
            mine = some[begin:stop]
            text = "".join(units.take(pa.array(mine)).to_pylist())
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            at, piece, again = self.walk(codes, lengths[mine])
            ids, n = self._ids_at(codes, at, piece)
            word = mine[np.searchsorted(np.cumsum(lengths[mine]), at)]
            counts += np.bincount(word, n, len(units)).astype(np.int64)
            found.append((np.repeat(word, n), ids))
            by_hand += mine[again].tolist()
            begin = stop
        for i in by_hand:
            ids = np.array(self.ids_of(self.stream(units[i].as_py())), np.int32)
            counts[i] = len(ids)
            found.append((np.full(len(ids), i), ids))
        words = np.concatenate([*[w for w, _ in found], np.zeros(0, np.int64)])
        flat = np.concatenate([*[x for _, x in found], np.zeros(0, np.int32)]).astype(np.int32)
        if len(found) > 1:
            flat = flat[np.argsort(words, kind="stable")]
        return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)])), pa.array(flat))


def _hashes(words: list[str]) -> np.ndarray:
    """A hash of each word, as spans of any text that holds it have."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(w) for w in words])
    return Spans(codes).of(ends - np.array([len(w) for w in words]), ends) | _U(1)


_LOADED: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _units(texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray]:
    """All marked words in order, and each text's number of them; runs of marks belong to the word that follows."""
    odd = np.asarray(pc.match_substring_regex(texts, f"^ |  | $|{MARK}"))
    lists = pc.split_pattern(pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts), " ")
    flat = pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), lists.flatten(), pa.scalar("", pa.large_string()))
    at = np.asarray(lists.offsets)
    counts = np.diff(at)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if not (odd | empty).any():
        return flat, counts
    # texts with runs of spaces or marks of their own, and empty ones
    parts, begin, counts = [], 0, counts.copy()
    for i in np.flatnonzero(odd | empty):
        parts.append(flat.slice(at[begin] - at[0], at[i] - at[begin]))
        own = _UNIT.findall(MARK + texts[i].as_py().replace(" ", MARK)) if odd[i] else []
        parts.append(pa.array(own, pa.large_string()))
        counts[i], begin = len(own), i + 1
    parts.append(flat.slice(at[begin] - at[0]))
    return pa.concat_arrays(parts), counts


def encode_texts(texts: pa.LargeStringArray, model: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and each text's number of ids."""
    units, counts = _units(texts)
    codes, distinct = encoded(units)
    taken = model.lists(distinct).take(pa.array(codes))
    ends = np.asarray(taken.offsets)[np.cumsum(counts)] if len(counts) else np.zeros(0, np.int64)
    return taken.values.to_numpy(), np.diff(np.concatenate([[0], ends]))


def decode_texts(ids: np.ndarray, counts: np.ndarray, model: Pieces) -> list[str]:
    """The text of each list of ids; ids of no text (control, unknown) add nothing, broken UTF-8 becomes U+FFFD."""
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))
    flat = pa.LargeListArray.from_arrays(ends, model.raw.take(pa.array(ids.astype(np.int64))))
    joined = pc.binary_join(flat, pa.scalar(b"", pa.large_binary()))
    return [x.decode("utf-8", "replace").removeprefix(" ") for x in joined.to_pylist()]


def _encoded_rows(batches, path: str) -> Iterator[pa.RecordBatch]:
    model = pieces_of(path)
    for batch, texts in chunks(batches, "text"):
        ids, n = encode_texts(texts, model)
        at = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(at, pa.array(ids))], ["doc_id", "ids"])


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, ids. ``model`` is the path of a model file that executors can read.

    A null text counts as empty and has no ids. Repeated rows and null ids stay; an empty table gives an empty result; other
    columns are not looked at. A lone mark character in a text reads as a space, as in the library.
    """
    frugal(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole.alias("text")).mapInArrow(
        lambda b: _encoded_rows(b, model), f"doc_id {kind}, ids array<int>")


def _decoded_rows(batches, path: str) -> Iterator[pa.RecordBatch]:
    model = pieces_of(path)
    for batch in batches:
        lists = batch.column("ids")
        texts = decode_texts(lists.flatten().to_numpy(), np.diff(np.asarray(lists.offsets)), model)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(rows: DataFrame, model: str) -> DataFrame:
    """doc_id, text of rows with doc_id, ids. No ids (or null) give the empty text."""
    frugal(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()
    some = rows.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return some.mapInArrow(lambda b: _decoded_rows(b, model), f"doc_id {kind}, text string")


def _digests(batches, path: str) -> Iterator[pa.RecordBatch]:
    model = pieces_of(path)
    for batch, texts in chunks(batches, "text"):
        ids, n = encode_texts(texts, model)
        back = decode_texts(ids, n, model)
        same = [x == y.replace(MARK, " ") for x, y in zip(back, texts.to_pylist(), strict=True)]
        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in np.split(ids, np.cumsum(n)[:-1])] if len(n) else []
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
            ["doc_id", "n_tokens", "ids_crc32", "round_trip"])


def token_digests(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), and whether the decoded ids give
    the text again. Encodes and decodes in one pass; edge cases as in ``encode``."""
    frugal(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole.alias("text")).mapInArrow(
        lambda b: _digests(b, model), f"doc_id {kind}, n_tokens bigint, ids_crc32 bigint, round_trip boolean")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))

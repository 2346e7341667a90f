"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

Documents are range-partitioned and sorted by id; each partition becomes a shard ``part-00000.rec`` with its index
``part-00000.idx``. All numbers are little-endian.

    record:  u64 length | u32 masked checksum of these 8 bytes | payload | u32 masked checksum of the payload
    payload: u8 width of an id in bytes (2 or 4) | u8 1 if the document has an id, else 0 | i64 document id | ids
    index:   u64 offset of each record
    masked checksum: CRC-32, rotated right by 15 bits, plus 0xA282EAD8, modulo 2**32

Files appear under their names when they are whole, so a task that runs again, after a lost executor, replaces them by equal ones.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchday.llm.scratch import importable, written
from matchday.llm.tables import table
from matchday.llm.words import IdPool, chunks, encoded, split_words
from matchday.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Distinct letter runs that a Python worker remembers.
MEMORY = 1 << 18
_HEAD, _SUM, _DOC = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BBq")
#: Words of Latin letters and ASCII punctuation without the apostrophe: the tokenizer parts the two and lower-cases each letter.
_SIMPLE = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[!-&(-/:-@\[-`{-~]*$"
_LETTERS, _PUNCTUATION = "^[a-zß-öø-ÿ]+", "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


class Units:
    """Ids of strings that the tokenizer treats by themselves, remembered up to ``MEMORY`` of them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self._tokenizer.get_vocab_size()
        self._ends = np.zeros(self.vocabulary, bool)
        for token, i in self._tokenizer.get_vocab().items():
            self._ends[i] = token.endswith("</w>")
        self._clear()

    def _clear(self) -> None:
        self._pool = IdPool()
        self._pool.add("", ())

    def of(self, simple: list[str], other: list[str]) -> tuple[pa.LargeListArray, np.ndarray, np.ndarray]:
        """A pool of id lists, and the places in it of the simple strings (one pre-token each) and of the others."""
        if len(self._pool.at) > MEMORY:
            self._clear()
        pool, at = self._pool, self._pool.at
        new = list(dict.fromkeys(x for x in simple if x not in at))
        for i in range(0, len(new), 1000):
            some = new[i : i + 1000]
            ids = self._tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            begin = 0
            for x, end in zip(some, (np.flatnonzero(self._ends[ids]) + 1).tolist(), strict=True):
                pool.add(x, ids[begin:end])
                begin = end
        strange = list(dict.fromkeys(x for x in other if x not in at))
        for i in range(0, len(strange), 1000):
            some = strange[i : i + 1000]
            for x, e in zip(some, self._tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                pool.add(x, e.ids)
        return pool.lists(), np.array([at[x] for x in simple], np.int64), np.array([at[x] for x in other], np.int64)


_UNITS: dict[str, Units] = {}


def units(path: str) -> Units:
    if path not in _UNITS:
        _UNITS[path] = Units(path)
    return _UNITS[path]


def encode_texts(texts: pa.LargeStringArray, path: str, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, as the tokenizer encodes each whole text (``end_id`` after each), and each text's number of ids.

    The tokenizer drops white space and its tokens never span any, so each distinct word is encoded once.
    """
    unit = units(path)
    words, counts = split_words(texts)
    codes, distinct = encoded(words)
    easy = pc.match_substring_regex(distinct, _SIMPLE)
    lower = pc.utf8_lower(distinct.filter(easy))
    first, first_of = (lambda d: (d.dictionary.to_pylist(), d.indices.to_numpy()))(pc.utf8_rtrim(lower, _PUNCTUATION).dictionary_encode())
    second, second_of = (lambda d: (d.dictionary.to_pylist(), d.indices.to_numpy()))(pc.replace_substring_regex(lower, _LETTERS, "").dictionary_encode())
    pool, places, strange = unit.of(first + second, distinct.filter(pc.invert(easy)).to_pylist())
    a, b = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
    mask = np.asarray(easy)
    a[mask], b[mask] = places[first_of], places[len(first):][second_of]
    a[~mask] = strange
    parts = pool.take(pa.array(np.stack([a, b], 1).ravel()))
    ends = np.asarray(parts.offsets)[::2]
    of_word = pa.LargeListArray.from_arrays(pa.array(ends), parts.values)
    taken = of_word.take(pa.array(codes))
    ids, at = taken.values.to_numpy(), np.asarray(taken.offsets)
    text_ends = at[np.cumsum(counts)] if len(counts) else np.zeros(0, np.int64)
    n = np.diff(np.concatenate([[0], text_ends]))
    if end_id is None:
        return ids, n
    return np.insert(ids, text_ends, end_id), n + 1


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if re.match(r"\w+:", uri) else f"file://{uri}")


def _write_shard(batches, out: str, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Writes the task's documents as one shard; yields its offset index."""
    files, folder = _file_system(out)
    shard = f"part-{TaskContext.get().partitionId():05d}"
    width = 2 if units(path).vocabulary <= 1 << 16 else 4
    mine = f"{folder}/_{shard}-{uuid.uuid4().hex}"
    at = seen = 0
    offsets: list[int] = []
    data = None
    for batch, texts in chunks(batches, "text"):
        if data is None:
            files.create_dir(folder, recursive=True)
            data = files.open_output_stream(f"{mine}.rec")
        ids, n = encode_texts(texts, path, end_id)
        payload = ids.astype(f"<u{width}")
        ends = np.cumsum(n)
        begin, size, first = [], [], []
        for doc, end, k in zip(batch.column("doc_id").to_pylist(), ends.tolist(), n.tolist(), strict=True):
            body = _DOC.pack(width, doc is not None, doc or 0) + payload[end - k : end].tobytes()
            head = _HEAD.pack(len(body))
            record = head + _SUM.pack(masked(head)) + body + _SUM.pack(masked(body))
            data.write(record)
            begin.append(at)
            size.append(len(record))
            first.append(seen)
            at, seen = at + len(record), seen + k
        offsets += begin
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{shard}.rec"] * len(n)), pa.array(begin, pa.int64()), pa.array(size, pa.int64()), pa.array(first, pa.int64()),
             pa.array(n, pa.int64())], ["shard", "offset", "size", "first", "n_tokens"])
    if data is not None:
        data.close()
        with files.open_output_stream(f"{mine}.idx") as index:
            index.write(np.array(offsets, "<u8").tobytes())
        for kind in ("idx", "rec"):
            files.move(f"{mine}.{kind}", f"{folder}/{shard}.{kind}")


_INDEX = "shard string, offset bigint, size bigint, first bigint, n_tokens bigint"


def write_records(docs: DataFrame, out: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Writes the token ids of all documents below ``out`` in ascending id order, and returns the offset index as a table:
    shard, offset, size (bytes), first (ids before the record in its shard), n_tokens.

    ``tokenizer`` is the path of a tokenizer file that executors can read; ``out`` a folder or URI that they share. A null text
    is empty and gives a record of the end id alone; null ids come first; rows with the same id stand in the order of a hash of
    their texts. An empty table writes no file. Other columns are not looked at.
    """
    importable(docs.sparkSession)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = (
        docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("tie"))
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    )
    return written(rows.mapInArrow(lambda b: _write_shard(b, out, tokenizer, end_id), _INDEX), "record-index")


def record_at(data, offset: int, size: int) -> tuple[int | None, np.ndarray]:
    """The document id and the ids of the record at ``offset``; a wrong length or checksum raises."""
    raw = data.read_at(size, offset)
    head, body = raw[:8], raw[12:-4]
    if len(raw) != size or _HEAD.unpack(head)[0] != len(body) or _SUM.unpack(raw[8:12])[0] != masked(head) or _SUM.unpack(raw[-4:])[0] != masked(body):
        raise ValueError(f"damaged record at {offset}")
    width, known, doc = _DOC.unpack(body[: _DOC.size])
    return (doc if known else None), np.frombuffer(body, f"<u{width}", offset=_DOC.size)


def _read(batches, out: str) -> Iterator[pa.RecordBatch]:
    files, folder = _file_system(out)
    name, data = None, None
    for batch in batches:
        docs, n, crc = [], [], []
        for shard, offset, size in zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "size")), strict=True):
            if shard != name:
                name, data = shard, files.open_input_file(f"{folder}/{shard}")
            doc, ids = record_at(data, offset, size)
            docs.append(doc)
            n.append(len(ids))
            crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), batch.column("shard"), batch.column("first"), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "shard", "first", "n_tokens", "ids_crc32"])


def read_records(index: DataFrame, out: str) -> DataFrame:
    """Reads the records that ``index`` lists (any rows of it, in any order), and checks them:
    doc_id, shard, first, n_tokens, ids_crc32 (of the ids as unsigned 32-bit integers)."""
    shards = index.select("shard").distinct().count()
    rows = index.repartition(max(shards, 1), "shard").sortWithinPartitions("shard", "offset")
    return rows.mapInArrow(lambda b: _read(b, out), "doc_id bigint, shard string, first bigint, n_tokens bigint, ids_crc32 bigint")


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = scratch_path(spark, "llm-records")
    index = write_records(table(spark, sf_dir, "documents"), out, public_tokenizers.path(TOKENIZER))
    # one row a shard: a few numbers for each 64 MB or so of input
    shards = index.groupBy("shard").agg(F.max(F.col("first") + F.col("n_tokens")).alias("n"))
    # by number: beyond 100,000 shards names are longer
    by_number = Window.orderBy(F.length("shard"), "shard")
    before = shards.select("shard", (F.sum("n").over(by_number) - F.col("n")).alias("before"))
    return read_records(index, out).join(before, "shard").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")

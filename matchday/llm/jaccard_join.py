"""N-gram Jaccard join with a token-group matrix, exact.

A document is the set of its word shingles; equal sets are one class. A class's prefix is its first ``n - ceil(t n) + 1``
shingles in an order that all classes share (shingles of few classes by hash, then those of many, by powers of four of their
classes and by hash), so that classes which link share a prefix shingle.

Classes are partitioned into groups of similar ones: at first each by itself, then the components of the links found. The
matrix holds, for each shingle, the groups in whose union of prefixes it is. A query's overlap with a group is bounded by its
own size less its prefix shingles outside the group's union: a group that shares none cannot qualify, and a shingle of one
group only has nothing to open. Of the two places where a pair that links first meets, one at least is early, in the first half of
those where a link may begin: a bucket's members are compared with its early ones only, and a bucket without any has nothing to open.
Few early members are taken at once, of more of them 4 at first; members that a link joined meanwhile are not compared. Pairs whose
horizons (the first shingles in hash order, at hand for every class) rule a link out need no text; the others are compared whole.

A large bucket in which several groups are left is dealt anew by differences. Its members are compared with one pivot, the class of
most links in any of their groups, so that the buckets of many near copies have few pivots; a member's difference is what is in one of
the two sets only. The sets of x and y differ in
``|Dx| + |Dy| - 2 |Dx & Dy|`` shingles, so a pair that links shares so many shingles of its differences that their prefixes meet (in an
order by how many differences of the pivot hold a shingle), unless both members link with the pivot and are of one group anyway.
What a bucket's members have in common is in no difference, so that near copies that do not link hardly ever meet again. Buckets of
pivots whose members are unlike them by their horizons, and large ones of differences, are compared with 16 times as many early members
in each further turn.
Nothing is cut off. Shingles are compared by 64-bit hashes, sets by 128-bit ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchday.llm.bitmap import bitmap
from matchday.llm.components import components
from matchday.llm.scratch import frugal, written
from matchday.llm.tables import table
from matchday.llm.words import Spans, chunks, encoded, hashed, long_lists, short_windows, split_words, starts, texts_of

SHINGLE, PERCENT = 4, 85
#: Per cent of a set beyond its prefix that the first pass hands on in hash order, so that most prefixes can be taken from it.
_SPARE = 5
#: A shingle of so many classes comes late in the order, one of four times as many later, and so on.
_FREQUENT = 64
#: So many early classes of a bucket are taken at once; of more of them, so many at first.
_SMALL, _FIRST = 16, 4
#: Large buckets are dealt anew by differences if this share of two horizons is common to members and pivot.
_ALIKE = 0.5


def shingle_sets(texts: pa.LargeStringArray, k: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes: A-Z lower-cased; with fewer than ``k`` words all of them as one."""
    words, counts = split_words(pc.ascii_lower(texts))
    codes, distinct = encoded(words)
    h = hashed(distinct)[codes]
    at, windows = starts(counts, k)
    each = np.split(short_windows(h, k)[at], np.cumsum(windows)[:-1]) if len(counts) else []
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        spans, ends = Spans(h), np.cumsum(counts)
        for i, x in zip(short, spans.of((ends - counts)[short], ends[short]), strict=True):
            each[i] = np.array([x], np.uint64)
    return [np.unique(x) for x in each]


def _prefix(n, percent: int):
    return n - -(-percent * n // 100) + 1


def _name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(batches, k: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches, "text"):
        sets = shingle_sets(texts, k)
        n = np.array([len(x) for x in sets], np.int64)
        most = np.minimum(n, np.maximum(-(-(100 - percent + _SPARE) * n // 100), _prefix(n, percent)))
        near = [x[:m] for x, m in zip(sets, most, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n), pa.array([_name(x) if len(x) else None for x in sets], pa.binary()),
             long_lists(np.concatenate([*near, np.zeros(0, np.uint64)]), np.where(n > 0, most, 0))],
            ["doc_id", "n", "class", "near"])


def _ordered(x: np.ndarray, frequent: list[Broadcast]) -> tuple[np.ndarray, int]:
    late = np.sum([m.value.has(x) for m in frequent], axis=0)
    return x[np.argsort(late, kind="stable")], int((late == 0).sum())


def _prefixes(batches, frequent: list[Broadcast], percent: int) -> Iterator[pa.RecordBatch]:
    """Prefixes out of the horizons; null where a horizon has too few shingles of few classes."""
    for batch in batches:
        out = []
        for x, n in zip(batch.column("near"), batch.column("n").to_pylist(), strict=True):
            x = x.values.to_numpy().view(np.uint64)
            order, early = _ordered(x, frequent)
            need = _prefix(n, percent)
            out.append(order[:need].view(np.int64) if early >= need or len(x) == n else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("class"), batch.column("n"), pa.array(out, pa.list_(pa.int64()))], ["class", "n", "prefix"])


def _some(batches, wanted: Broadcast):
    """The rows whose id hash is in the bitmap."""
    for batch in batches:
        hit = wanted.value.has(batch.column("id_hash").to_numpy().view(np.uint64))
        if hit.any():
            yield batch.filter(pa.array(hit))


def _whole_prefixes(batches, wanted: Broadcast, frequent: list[Broadcast], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    for _, texts in chunks(_some(batches, wanted), "text"):
        sets = [x for x in shingle_sets(texts, k) if len(x)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_name(x) for x in sets], pa.binary()), pa.array([len(x) for x in sets], pa.int64()),
             pa.array([_ordered(x, frequent)[0][: _prefix(len(x), percent)].view(np.int64) for x in sets], pa.list_(pa.int64()))],
            ["class", "n", "prefix"])


def _shared(batches, maps: list[Broadcast]) -> Iterator[pa.RecordBatch]:
    """The prefix shingles that may be in another prefix, with their places."""
    for batch in batches:
        names, n, at, tokens = [], [], [], []
        for name, size, x in zip(batch.column("class"), batch.column("n"), batch.column("prefix"), strict=True):
            x = x.values.to_numpy()
            keep = np.flatnonzero(np.logical_or.reduce([m.value.has(x.view(np.uint64)) for m in maps]))
            names += [name.as_py()] * len(keep)
            n += [size.as_py()] * len(keep)
            at.append(keep)
            tokens.append(x[keep])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)])), pa.array(names, pa.binary()), pa.array(n, pa.int64()),
             pa.array(np.concatenate([*at, np.zeros(0, np.int64)]))], ["token", "class", "n", "at"])


def _texts(batches, wanted: Broadcast, k: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(_some(batches, wanted), "text"):
        names = [_name(x) if len(x) else None for x in shingle_sets(texts, k)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), batch.column("text")], ["class", "text"])


def _known(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int, int]]:
    """Of each pair: the sets' sizes, how much of each is known up to the end of the shorter horizon, and what is common there."""
    for x, n, y, m in zip(*(batch.column(c) for c in ("near_a", "n_a", "near_b", "n_b")), strict=True):
        x, y, n, m = x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64), n.as_py(), m.as_py()
        ends = [z[-1] for z, size in ((x, n), (y, m)) if len(z) < size]
        known_x, known_y = (len(z) if not ends else int(np.searchsorted(z, min(ends), side="right")) for z in (x, y))
        yield n, m, known_x, known_y, len(np.intersect1d(x[:known_x], y[:known_y], assume_unique=True))


def _possible(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs that their horizons do not rule out."""
    for batch in batches:
        keep = [(100 + percent) * (both + min(n - x, m - y)) >= percent * (n + m) for n, m, x, y, both in _known(batch)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _alike(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shares = [both / max(1, x + y - both) for _, _, x, y, both in _known(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shares, pa.float64())], ["a", "b", "alike"])


def _links(batches, k: int, percent: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in chunks(batches, "text_a", most=2 << 20):
        a, b = shingle_sets(texts, k), shingle_sets(texts_of(rows.column("text_b")), k)
        both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b, strict=True)], np.int64)
        either = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], np.int64) - both
        yield rows.select(["a", "b"]).filter(pa.array(100 * both >= percent * either))


def _deltas(batches, k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """What is in one of the sets of a class and its pivot only, and whether the two link."""
    for rows, texts in chunks(batches, "text", most=2 << 20):
        sets = shingle_sets(texts, k)
        of_pivot = texts_of(rows.column("pivot_text")).dictionary_encode()
        distinct = shingle_sets(of_pivot.dictionary, k)
        pivots = [distinct[i] for i in of_pivot.indices.to_pylist()]
        deltas = [np.setxor1d(x, y, assume_unique=True) for x, y in zip(sets, pivots, strict=True)]
        n, m, d = (np.array([len(x) for x in z], np.int64) for z in (sets, pivots, deltas))
        yield pa.RecordBatch.from_arrays(
            [rows.column("pivot"), rows.column("class"), pa.array(n), pa.array((100 + percent) * d <= (100 - percent) * (n + m)),
             long_lists(np.concatenate([*deltas, np.zeros(0, np.uint64)]), d)], ["pivot", "class", "n", "linked", "delta"])


def _dealt(deltas: DataFrame, percent: int) -> DataFrame:
    """The rows of a matrix of differences: each shingle of a difference's prefix that another one of the same pivot has.

    Two sets that link differ in ``(100 - percent) / percent`` of the smaller one at most, and a prefix need not be longer.
    """
    shingles = deltas.select(
        "pivot", "class", "n", F.size("delta").cast("long").alias("len"), F.explode("delta").alias("shingle"))
    often = shingles.groupBy("pivot", "shingle").agg(F.count("*").alias("times")).where("times > 1")
    own = Window.partitionBy("pivot", "class")
    # those that no other difference has come first
    at = F.col("len") - F.count("*").over(own) + F.row_number().over(own.orderBy("times", "shingle")) - 1
    return (
        shingles.join(often, ["pivot", "shingle"]).withColumn("at", at)
        .where(percent * F.col("at") <= (100 - percent) * F.col("n"))
        .select(F.xxhash64("pivot", "shingle").alias("token"), "class", "n", "len", "at", F.lit(_SMALL).alias("parts"))
    )


def _early(percent: int) -> Column:
    """Whether a row's place is in the first half of those where it may first meet one that links.

    What two sets do not share is ``(100 - percent) / percent`` of either at most. What stands before the first shingle that both
    prefixes have is in one of them only, so that at one of the two places half of that stands at most.
    """
    return 2 * percent * F.col("at") <= (100 - percent) * F.col("n")


def _opened(matrix: DataFrame, groups: DataFrame | None, percent: int) -> DataFrame:
    """The rows of buckets that hold several groups and an early row, with group, whether they are early, and how many are."""
    named = matrix.withColumn("group", F.col("class")) if groups is None else (
        matrix.join(groups.select(F.col("node").alias("class"), F.col("root").alias("group")), "class", "left")
        .withColumn("group", F.coalesce("group", "class")))
    named = named.withColumn("early", _early(percent))
    several = (
        named.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi"), F.count_if("early").alias("size"))
        .where("lo <> hi AND size > 0").select("token", "size"))
    return named.join(several, "token")


def _merged(groups: DataFrame | None, links: DataFrame | None) -> DataFrame | None:
    """Groups (node, root) after further links."""
    if links is None:
        return groups
    if groups is not None:
        links = links.unionByName(groups.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return components(links)


def _pairs(rows: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Classes of different groups that meet in a bucket, less those whose sizes or places rule a link out.

    The bound on places holds for the first shingle that two prefixes share, and each pair that links meets there too. ``len`` is
    the length of what the prefix was taken from: the set, or its difference from a pivot.
    """
    p = pivots.select("token", *[F.col(c).alias(f"p_{c}") for c in ("class", "n", "len", "at", "group")])
    rest = F.least(F.col("len") - F.col("at"), F.col("p_len") - F.col("p_at"))
    differ = (100 - percent) * (F.col("n") + F.col("p_n"))
    return (
        rows.join(p, "token")
        .where((F.col("class") != F.col("p_class")) & (F.col("group") != F.col("p_group")))
        .where(100 * F.least("n", "p_n") >= percent * F.greatest("n", "p_n"))
        .where((100 + percent) * F.abs(F.col("len") - F.col("p_len")) <= differ)
        .where((100 + percent) * (F.col("len") + F.col("p_len") - 2 * rest) <= differ)
        .select(F.least("class", "p_class").alias("a"), F.greatest("class", "p_class").alias("b"))
    )


def _with_both(pairs: DataFrame, of_class: DataFrame) -> DataFrame:
    """The pairs with the columns of their two classes, under the names ``_a`` and ``_b``."""
    for side in "ba":
        named = of_class.select(*[F.col(c).alias(side if c == "class" else f"{c}_{side}") for c in of_class.columns])
        pairs = pairs.join(named, side)
    return pairs


def _texts_of(wanted: DataFrame, classes: DataFrame, n_classes: int, source: DataFrame, k: int) -> DataFrame:
    """class, text of the classes wanted. Only rows with their ids are shuffled."""
    ids = wanted.distinct().join(classes.select("class", "doc_id"), "class")
    some = bitmap(ids.select(F.xxhash64("doc_id").alias("id_hash")), "id_hash", n_classes)
    return written(
        source.mapInArrow(lambda b: _texts(b, some, k), "class binary, text string")
        .groupBy("class").agg(F.first("text").alias("text")), "texts")


def _horizons(wanted: DataFrame, classes: DataFrame, n_classes: int) -> DataFrame:
    """class, n, near of the classes wanted, and of few others."""
    some = bitmap(wanted.select(F.xxhash64("class").alias("id_hash")), "id_hash", n_classes)
    return classes.select("class", "n", "near", F.xxhash64("class").alias("id_hash")).mapInArrow(
        lambda b: _some(b, some), "class binary, n bigint, near array<bigint>, id_hash bigint").drop("id_hash")


def _with_pivots(left: DataFrame, links: DataFrame | None, groups: DataFrame | None, classes: DataFrame, n_classes: int) -> DataFrame:
    """The rows of large buckets with a pivot, the class of most links in any of the bucket's groups; null if its members are unlike it."""
    named = left.select("token", "group", F.lit(0).cast("long").alias("links"), F.col("class").alias("hub"))
    if links is not None:
        degrees = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
        hubs = (
            degrees.join(groups.select(F.col("node").alias("class"), "root"), "class", "left")
            .groupBy(F.coalesce("root", "class").alias("group")).agg(F.max(F.struct("links", "class")).alias("h")))
        named = named.join(hubs, "group", "left").select(
            "token", F.coalesce("h.links", "links").alias("links"), F.coalesce("h.class", "hub").alias("hub"))
    best = named.groupBy("token").agg(F.max(F.struct("links", "hub")).alias("m"))
    rows = left.join(best.select("token", F.col("m.hub").alias("pivot")), "token")
    pairs = written(rows.where("class <> pivot").select(F.col("class").alias("a"), F.col("pivot").alias("b")).distinct(), "pivots")
    near = _horizons(pairs.select(F.explode(F.array("a", "b")).alias("class")), classes, n_classes)
    alike = (
        _with_both(pairs, near).mapInArrow(_alike, "a binary, b binary, alike double")
        .groupBy("b").agg(F.avg("alike").alias("alike")).where(F.col("alike") >= _ALIKE))
    like = alike.select(F.col("b").alias("pivot"), F.lit(True).alias("like"))
    return written(
        rows.join(like, "pivot", "left").withColumn("pivot", F.when(F.col("like"), F.col("pivot")))
        .drop("like", "group", "early", "size"), "with-pivots")


def _differences(pairs: DataFrame, classes: DataFrame, n_classes: int, source: DataFrame, k: int, percent: int) -> DataFrame:
    """pivot, class, n, linked, delta of pairs of a class and a pivot."""
    texts = _texts_of(pairs.select(F.explode(F.array("class", "pivot")).alias("class")), classes, n_classes, source, k)
    both = (
        pairs.join(texts, "class")
        .join(texts.select(F.col("class").alias("pivot"), F.col("text").alias("pivot_text")), "pivot"))
    return written(
        both.mapInArrow(
            lambda b: _deltas(b, k, percent), "pivot binary, class binary, n bigint, linked boolean, delta array<bigint>"), "deltas")


def _verified(pairs: DataFrame, classes: DataFrame, n_classes: int, source: DataFrame, k: int, percent: int) -> DataFrame | None:
    """The pairs that link (None: none does). Only rows of classes in question are shuffled."""
    def wanted(of: DataFrame) -> DataFrame:
        return of.select(F.explode(F.array("a", "b")).alias("class"))

    near = _horizons(wanted(pairs), classes, n_classes)
    possible = written(
        _with_both(pairs, near).mapInArrow(lambda b: _possible(b, percent), "a binary, b binary"), "possible")
    if possible.isEmpty():
        return None
    texts = _texts_of(wanted(possible), classes, n_classes, source, k)
    links = written(_with_both(possible, texts).mapInArrow(lambda b: _links(b, k, percent), "a binary, b binary"), "links")
    return None if links.isEmpty() else links


def link_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (the smallest id that links reach, its own included).

    Two documents link when ``100 * shared >= percent * all`` of their distinct ``k``-word shingles. A null or blank text has an
    empty set and links with nothing. Rows with a null id link like others, and have a null component unless it holds an id.
    Repeated rows stay and link. An empty table gives an empty result; other columns are not looked at.
    """
    frugal(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{doc_id}`")).alias("id_hash"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sets = written(
        source.select("doc_id", "text").mapInArrow(
            lambda b: _sets(b, k, percent), f"doc_id {kind}, n bigint, class binary, near array<bigint>"), "sets")
    classes = written(
        sets.where("class IS NOT NULL").groupBy("class")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("near").alias("near")), "classes")
    n_classes = classes.count()
    common = written(
        classes.select(F.explode("near").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "common")
    levels, most = [_FREQUENT], common.agg(F.max("n")).first()[0] or 0
    while 4 * levels[-1] <= most:
        levels.append(4 * levels[-1])
    sizes = common.agg(*[F.count_if(F.col("n") >= x) for x in levels]).first()
    frequent = [bitmap(common.where(F.col("n") >= x), "token", size) for x, size in zip(levels, sizes, strict=True)]
    maps = [bitmap(common, "token", common.count())]
    prefixes = classes.mapInArrow(lambda b: _prefixes(b, frequent, percent), "class binary, n bigint, prefix array<bigint>")
    late = written(prefixes.where("prefix IS NULL").select("class").join(classes.select("class", "doc_id"), "class"), "late")
    regular = prefixes.where("prefix IS NOT NULL")
    n_late = late.count()
    if n_late:
        # mostly frequent shingles: their prefixes need the whole texts
        wanted = bitmap(late.select(F.xxhash64("doc_id").alias("id_hash")), "id_hash", n_late)
        whole = written(
            source.mapInArrow(lambda b: _whole_prefixes(b, wanted, frequent, k, percent), "class binary, n bigint, prefix array<bigint>")
            .join(late.select("class"), "class", "left_semi").dropDuplicates(["class"]), "late-prefixes")
        tokens = whole.select(F.explode("prefix").alias("token"))
        maps.append(bitmap(tokens, "token", tokens.count()))
        regular = regular.unionByName(whole)
    rows = written(regular.mapInArrow(lambda b: _shared(b, maps), "token bigint, class binary, n bigint, at bigint"), "prefix-rows")
    matrix = written(
        rows.join(rows.groupBy("token").agg(F.count("*").alias("classes")).where("classes > 1").select("token"), "token")
        .select("token", "class", "n", F.col("n").alias("len"), "at", F.lit(_FIRST).alias("parts")), "matrix")
    groups = links = None  # node, root; a, b
    first = True
    while True:
        opened = written(_opened(matrix, groups, percent), "opened")
        if opened.isEmpty():
            break
        member = F.struct("class", "n", "len", "at", "group").alias("m")
        few, many = opened.where(F.col("size") <= _SMALL), opened.where(F.col("size") > _SMALL)
        pivots = (
            many.where("early").groupBy("token", F.pmod(F.xxhash64("class"), F.col("parts")).alias("part")).agg(F.min(member).alias("m"))
            .select("token", "m.*"))
        met = written(_pairs(many, pivots, percent).unionByName(_pairs(few, few.where("early"), percent)).distinct(), "pairs")
        found = _verified(met, classes, n_classes, source, k, percent)
        groups = _merged(groups, found)
        links = found if links is None else links if found is None else links.unionByName(found)
        matrix = (
            many.join(pivots.select("token", "class"), ["token", "class"], "left_anti")
            .select("token", "class", "n", "len", "at", (_SMALL * F.col("parts")).alias("parts")))
        if first:
            left = written(_opened(matrix, groups, percent), "left")
            if left.isEmpty():
                break
            left = _with_pivots(left, links, groups, classes, n_classes)
            matrix = left.where("pivot IS NULL").drop("pivot")
            pairs = left.where("class <> pivot").select("class", "pivot").distinct()
            if not pairs.isEmpty():
                deltas = _differences(pairs, classes, n_classes, source, k, percent)
                groups = _merged(groups, deltas.where("linked").select(F.col("class").alias("a"), F.col("pivot").alias("b")))
                matrix = matrix.unionByName(written(_dealt(deltas, percent), "matrix"))
        first = False

    ids = sets.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first"))
    rooted = (
        ids.withColumn("root", F.col("class")) if groups is None else
        ids.join(groups.select(F.col("node").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class")))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("class", "root").join(lowest, "root").select("class", "component_id")
    linked = sets.where("class IS NOT NULL").join(named, "class")
    alone = sets.where("class IS NULL").withColumn("component_id", F.col("doc_id"))
    out = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*out).unionByName(alone.select(*out))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"))

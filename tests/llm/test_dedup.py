"""Substring dedup, Jaccard components and decontamination against plain Python."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from matchday.llm import jaccard_join  # noqa: E402
from matchday.llm.components import components  # noqa: E402
from matchday.llm.decontaminate import find_leaks, tiles  # noqa: E402
from matchday.llm.jaccard_join import link_components  # noqa: E402
from matchday.llm.scratch import importable  # noqa: E402
from matchday.llm.substring_dedup import remove_repeats  # noqa: E402


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


def _rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def _repetitive(seed, n):
    """Texts over few words, with copies, shared passages and odd rows."""
    rng = random.Random(seed)
    vocabulary = ["a", "b", "é", "Dd", "x."]
    passage = [rng.choice(vocabulary) + str(i) for i in range(30)]
    rows = []
    for i in range(n):
        w = [rng.choice(vocabulary) + (str(rng.randint(0, 3)) if rng.random() < 0.7 else "") for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            at = rng.randint(0, 20)
            w[len(w) // 2 : len(w) // 2] = passage[at : at + rng.randint(3, 30)]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(w)))
    rows += [(n + 1, rows[0][1]), (0, rows[0][1]), (n + 2, None), (n + 3, ""), (n + 4, " \n"), (None, rows[1][1]), (-5, rows[2][1]), (3, "q " * 80)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    rows = _repetitive(seed, 60)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, words int").repartition(4)
    got = remove_repeats(df, least=8, anchor=4)
    assert _rows(got, "doc_id", "n_words", "n_removed", "kept") == sorted(brute.repeats(rows, 8), key=repr)
    assert remove_repeats(df.limit(0)).collect() == []


def test_long_repeats_and_periodic_text(spark):
    rng = random.Random(5)
    long = [f"w{rng.randint(0, 9)}" for _ in range(3000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[500:900])), (3, "same " * 500), (4, "other " + "same " * 200), (5, " ".join(long[100:149]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(remove_repeats(df), "doc_id", "n_words", "n_removed", "kept") == sorted(brute.repeats(rows, 50), key=repr)


def _families(seed):
    rng = random.Random(seed)
    rows, n = [], 0
    line = [f"common{i}" for i in range(12)]
    for family in range(12):
        base = [f"f{family}w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 4, 8, 40, 120]))]
        if rng.random() < 0.6:
            base += line
        for _ in range(rng.choice([1, 2, 5, 30])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"new{rng.randint(0, 9**9)}"
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n, "  ".join(line)), (n + 1, " ".join(line).upper()), (n + 2, None), (n + 3, ""), (n + 4, "a"), (n + 5, "A"), (0, rows[0][1]), (None, rows[0][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [3, 4])
def test_components_equal_brute_force(spark, seed):
    rows = _families(seed)
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, class string, n int").repartition(5)
    assert _rows(link_components(df), "doc_id", "n_shingles", "component_id") == sorted(brute.components(rows), key=repr)


def _near_copies(seed, sizes, edits, pool):
    """Groups of near copies that share a line; few of a group's texts link, most miss the threshold by little."""
    rng = random.Random(seed)
    line, rows = [f"common{i}" for i in range(20)], []
    for group, size in enumerate(sizes):
        base = [f"g{group}w{i}" for i in range(110)] + line
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice(edits)):
                w[rng.randrange(110)] = f"new{rng.randint(0, pool)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "sizes", "edits", "pool", "k", "percent"), [
    (5, [150, 90, 30], [1, 2, 2, 3], 10**9, 4, 85), (6, [120, 120], [2, 3], 3, 4, 85), (7, [200], [3, 4, 5], 2, 5, 80)])
def test_large_groups_of_near_copies_equal_brute_force(spark, seed, sizes, edits, pool, k, percent):
    rows = _near_copies(seed, sizes, edits, pool)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = _rows(link_components(df, k=k, percent=percent), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components(rows, k, percent), key=repr)
    assert len({c for _, _, c in got}) > 2


def test_near_copies_that_do_not_link_are_not_compared_pair_by_pair(spark, monkeypatch):
    rows, made = _near_copies(8, [320], [2], 10**9), []

    def counted(df, name, write=jaccard_join.written):
        out = write(df, name)
        made.append(out.count() if name in ("pairs", "pivots") else 0)
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _rows(link_components(df), "doc_id", "n_shingles", "component_id") == sorted(brute.components(rows), key=repr)
    assert sum(made) < 40 * len(rows)  # all pairs: 51,040


def _edited_copies(seed, size, most):
    """Copies of one text with up to ``most`` words changed, some of them cut short."""
    rng, base, rows = random.Random(seed), [f"w{i}" for i in range(150)], []
    for i in range(size):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(150)] = f"new{rng.randint(0, 10**9)}"
        rows.append((i, " ".join(w[: rng.choice([150, 150, 150, rng.randint(60, 150)])])))
    return rows


def test_large_group_of_edited_copies_takes_few_pairs_and_differences(spark, monkeypatch):
    rows, made = _edited_copies(9, 600, 16), {"pairs": 0, "deltas": 0}

    def counted(df, name, write=jaccard_join.written):
        out = write(df, name)
        if name in made:
            made[name] += out.count()
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = _rows(link_components(df, k=5, percent=80), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components(rows, 5, 80), key=repr)
    assert len({c for _, _, c in got}) > 100
    assert made["pairs"] < 8 * len(rows) and made["deltas"] < 2 * len(rows)


def test_components_of_no_links_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, None), (3, "v w x y z")], "doc_id long, text string")
    assert _rows(link_components(df), "doc_id", "n_shingles", "component_id") == [(1, 2, 1), (2, 0, 2), (3, 2, 3)]
    assert link_components(df.limit(0)).collect() == []


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (50, 51), (51, 51), (60, 62), (62, 61)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in [*range(1, 41), 100]}, 51: 50, 61: 60, 62: 60}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_tiles_cover_like_plain_greedy_tiling():
    rng = random.Random(6)
    for _ in range(150):
        item = [rng.randint(1, 6) for _ in range(rng.randint(0, 40))]
        text = [rng.randint(1, 6) for _ in range(rng.randint(0, 60))]
        if item and rng.random() < 0.6:
            cut = rng.randrange(len(item))
            text[10:10] = item[cut:] + [0] + item[:cut]
        got = tiles(item, text, 4)
        for p, t, n in got:
            assert n >= 4 and item[p : p + n] == text[t : t + n]
        places = [i for p, _, n in got for i in range(p, p + n)]
        assert len(places) == len(set(places))
        # longest first: lengths agree with the version that searches all places again for each tile
        assert sorted(n for _, _, n in got)[-1:] == sorted(n for _, _, n in brute.tiles(item, text, 4))[-1:]
    item = list(range(1, 31))
    assert sum(n for _, _, n in tiles(item, item[15:] + [0] + item[:15])) == 30
    assert tiles([], [1, 2]) == tiles([1] * 4, [1] * 9) == []


def test_leaks(spark):
    rng = random.Random(8)
    text = lambda n: [f"t{rng.randint(0, 10**6)}" for _ in range(n)]
    items = [(i, text(30)) for i in range(6)] + [(6, text(4)), (7, None)]
    items += [(8, items[0][1])]
    shared = text(12)
    items += [(10 + i, shared + text(30)) for i in range(5)]
    a, b = items[0][1], items[1][1]
    docs = [
        (1, text(50) + a + text(50)), (2, text(20) + a[15:] + text(9) + a[:15]), (3, text(5) + a[:20] + text(5)), (4, text(60)), (5, None), (6, []),
        (7, items[6][1] + text(20)), (8, a + b), (9, [x.upper() + "," for x in b]), (10, shared + text(10)), (11, items[-1][1]), (1, text(50)),
        (12, [x for i in range(0, 30, 5) for x in a[25 - i : 30 - i]]), (None, a),
    ]
    join = lambda w: None if w is None else " ".join(w)
    bench = spark.createDataFrame([(i, join(w), 1) for i, w in items], "item_id long, text string, seeds int")
    df = spark.createDataFrame([(i, join(w), "x") for i, w in docs], "doc_id long, text string, part string")
    got = _rows(find_leaks(df, bench), "doc_id", "contaminated")
    want = sorted(((d, max((brute.coverage(join(w), join(x)) for _, x in items if x and len(x) >= 5), default=0) >= 0.8) for d, w in docs), key=repr)
    assert got == want
    assert {d for d, c in got if c} == {1, 2, 8, 9, 11, 12, None}
    best = {r.doc_id: (r.item_id, r.n_items) for r in find_leaks(df, bench).where("contaminated").collect()}
    assert best[8] == (0, 2) and best[2] == (0, 1)
    assert find_leaks(df, bench.limit(0)).where("contaminated").count() == 0
    assert find_leaks(df.limit(0), bench).collect() == []


def test_coverage_and_item_of_documents_below_the_threshold(spark):
    rng = random.Random(6)
    phrase = " ".join(f"both{i}" for i in range(10))
    items = [(i, f"{phrase} " + " ".join(f"item{i}x{j}" for j in range(32))) for i in range(12)]
    tail = lambda i, n: " ".join(items[i][1].split()[-n:])
    docs = [(0, f"some words {phrase} others"), (1, f"{phrase} then {tail(4, 8)}"), (2, f"{tail(5, 12)} {phrase}"), (3, items[7][1]), (4, "nothing of it"), (5, tail(3, 6))]
    docs += [(10 + i, " and ".join([phrase[: rng.randint(0, 70)], tail(rng.randrange(12), rng.randint(1, 32)), tail(rng.randrange(12), rng.randint(1, 9))])) for i in range(30)]
    want = []
    for d, text in docs:
        best = min((-brute.coverage(text, x), i) for i, x in items)
        want.append((d, -best[0] >= 0.8, best[1] if best[0] else None, round(-best[0], 9)))
    assert want[0] == (0, False, 0, round(10 / 42, 9)) and want[1][2] == 4
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id, r.contaminated, r.item_id, round(r.coverage, 9)) for r in found) == sorted(want)

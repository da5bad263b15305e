"""Components, Jaccard groups and near vectors against brute force."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import jaccard, vector_dedup
from lexmill.llm.components import connected_components


def reach(nodes, links):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        low[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    rnd = random.Random(2)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    mixed = [(rnd.randint(1000, 1100), rnd.randint(1000, 1100)) for _ in range(70)]
    links = [*path, *star, *mixed, (7, 7), (100, 101), (None, 4), (4, None)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    plain = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    want = reach({x for pair in plain for x in pair}, plain)
    assert got == {n: r for n, r in want.items() if n != r}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 4:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 85 * len(a | b)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(4)
    word = lambda: f"v{rnd.randint(0, 400)}"
    passage = [word() for _ in range(60)]
    texts = ["", None, "  ", "one", "One", "one two three", "x y z", " ".join(passage)]
    for size in (8, 12, 30, 80, 300):
        for _ in range(3):
            base = [word() for _ in range(size)]
            for _ in range(9):
                copy = list(base)
                for _ in range(rnd.randint(0, max(1, size // 40))):
                    copy[rnd.randrange(len(copy))] = word()
                if rnd.random() < 0.3:
                    copy = copy[: len(copy) - rnd.randint(0, size // 10)]
                texts.append(" ".join(copy))
    for _ in range(30):
        texts.append(" ".join([word() for _ in range(rnd.randint(3, 40))] + passage + [word() for _ in range(rnd.randint(3, 40))]))
    texts += texts[20:30]
    return texts


@pytest.mark.parametrize("chunk", [512, 4])
def test_jaccard_components(spark, corpus, chunk):
    rows = [(i + 10, t, 1, 2, "x", "y") for i, t in enumerate(corpus)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n int, token int, key string, root string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame, chunk=chunk).collect()}
    sets = [shingles(t) for t in corpus]
    want = reach(range(len(sets)), [(i, j) for i in range(len(sets)) for j in range(i) if linked(sets[i], sets[j])])
    assert got == {i + 10: (len(sets[i]), want[i] + 10) for i in range(len(sets))}


def test_one_of_each_keeps_columns_and_rows_without_id(spark, corpus):
    rows = [(i + 10, t, "s", "b") for i, t in enumerate(corpus)]
    rows += [rows[50], rows[50], (None, corpus[60], "s", "b"), (None, "no id", "s", "b")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _doubtful string")
    frame = frame.select("*", *[F.lit(1).alias(c) for c in ("_bit0", "_nth", "_key", "_root", "key", "root", "weight", "n")])
    kept = jaccard.one_of_each(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    sets = [shingles(t) for t in corpus]
    want = reach(range(len(sets)), [(i, j) for i in range(len(sets)) for j in range(i) if linked(sets[i], sets[j])])
    assert collections.Counter(ids) == collections.Counter([i + 10 for i in range(len(sets)) if want[i] == i] + [None, None])
    assert jaccard.one_of_each(frame.limit(0)).collect() == []


def test_one_of_each_decides_by_row_where_ids_repeat(spark):
    text = lambda seed: " ".join(f"{seed}{i}" for i in range(30))
    rows = [(1, text("a")), (2, text("a")), (2, text("b")), (5, text("c")), (5, text("d")), (7, None), (7, ""), (7, " "), (8, text("e")), (8, text("e"))]
    rows += [(9, text("f") + " x"), (None, text("f")), (3, text("f") + " y")]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    want = [rows[i] for i in (0, 2, 3, 4, 5, 6, 7, 8, 11, 12)]
    assert collections.Counter(tuple(r) for r in kept.collect()) == collections.Counter(want)


def test_components_with_repeated_and_missing_ids(spark):
    text = lambda seed: " ".join(f"{seed}{i}" for i in range(30))
    rows = [(None, text("a")), (4, text("a")), (4, text("b")), (6, text("b")), (None, None), (6, "")]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == collections.Counter(
        [(None, 27, 4), (4, 27, 4), (4, 27, 4), (6, 27, 4), (None, 0, None), (6, 0, 6)]
    )


def test_signature_tree_loses_no_link():
    rnd = random.Random(6)
    for _ in range(20):
        sets = []
        for _ in range(rnd.randint(1, 12)):
            base = [rnd.getrandbits(64) for _ in range(rnd.randint(1, 60))]
            for _ in range(rnd.randint(1, 8)):
                sets.append(frozenset(rnd.getrandbits(64) if rnd.random() < 0.03 else x for x in base))
        links = jaccard.link_sets(sets)
        assert all(linked(sets[i], sets[j]) for i, j in links)
        every = [(i, j) for i in range(len(sets)) for j in range(i) if linked(sets[i], sets[j])]
        assert reach(range(len(sets)), links) == reach(range(len(sets)), every)
    assert jaccard.link_sets([]) == [] and jaccard.link_sets([frozenset()]) == []


def vector_rows():
    rng = np.random.default_rng(8)
    rows = []
    for label in (0, 1, 2):
        for _ in range(60):
            rows.append((rng.standard_normal(24), label))
    for i in range(0, 180, 3):
        for _ in range(3):
            rows.append((rows[i][0] + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.3]), rows[i][1]))
    rows += [(rows[0][0], 1), (rows[0][0] * 2, 0)]
    rows = [([float(np.float32(x)) for x in v], label) for v, label in rows]
    rows += [(None, 0), ([0.0] * 24, 0), ([math.nan] * 24, 0), ([math.inf] + [1.0] * 23, 0), ([None] + [1.0] * 23, 0), (rows[0][0], None), ([1.0, 2.0], 0), ([1.0, 2.0], 0), ([], 0)]
    return [(1000 - i, v, label, "m", "c") for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("chunk", [1024, 16])
def test_near_vectors(spark, chunk, monkeypatch):
    monkeypatch.setattr(vector_dedup, "LEAF", 30)
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, members string, class string").repartition(3)
    got = {r.vec_id: r for r in vector_dedup.near_duplicate_vectors(frame, chunk=chunk).collect()}
    assert len(got) == len(rows)

    def usable(v, label):
        return v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = {i: (np.array(v) / np.linalg.norm(v), label) for i, v, label, *_ in rows if usable(v, label)}
    links = [
        (a, b) for a in units for b in units
        if a < b and units[a][1] == units[b][1] and len(units[a][0]) == len(units[b][0]) and units[a][0] @ units[b][0] >= 0.93
    ]
    degree = collections.Counter(x for pair in links for x in pair)
    want = reach([r[0] for r in rows], links)
    found = sum(r.n_links for r in got.values())
    assert found >= 0.95 * 2 * len(links)
    for i, row in got.items():
        assert row.n_links <= degree[i] and row.kept == (row.vec_id == row.component_id)
        assert want[row.component_id] == want[i]
        if i not in units:
            assert (row.n_links, row.component_id) == (0, i)
    assert vector_dedup.near_duplicate_vectors(frame.limit(0)).collect() == []


def test_vectors_with_repeated_ids_and_extreme_numbers(spark):
    rows = [
        (1, [1e-200, 1e-200], 0), (2, [1.0, 0.1], 0), (3, [1e200, 1e200], 0), (3, [2e200, 2e200], 0), (None, [1.0, 1.0], 0), (5, [5e-324, 0.0], 1), (6, [3.0, 0.0], 1),
    ]
    got = vector_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in got) == collections.Counter(
        [(1, 3, 1), (2, 0, 2), (3, 3, 1), (3, 3, 1), (None, 3, 1), (5, 1, 5), (6, 1, 5)]
    )


def test_leaves_hold_every_point():
    rng = np.random.default_rng(1)
    points = vector_dedup.unit(rng.standard_normal((500, 16)))
    forest = vector_dedup.grow_forest(points[:200], 500, 40, trees=3)
    placed = vector_dedup.leaves_of(forest, points)
    assert all(len(p) >= 3 and p == sorted(set(p)) for p in placed)
    same = vector_dedup.grow_forest(np.repeat(points[:1], 100, axis=0), 10_000, 10, trees=1)
    assert same == [0]

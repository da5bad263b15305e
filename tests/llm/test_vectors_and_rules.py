"""Vector codes, whitening and quality rules against brute force, with odd rows of every kind."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest

from lexmill.llm import quality_rules, spectra, vector_codes, whitening
from lexmill.llm.skew import look_up

ODD = [
    (None, [0.5] * 16, 1), (3, None, 1), (3, [0.1] * 15 + [None], 2), (4, [math.nan] + [0.0] * 15, None), (4, [math.inf] * 16, None),
    (5, [-0.25] * 16, None), (5, [-0.25] * 16, None), (6, [0.0] * 16, 7), (7, [1e200] * 16, 7), (8, [1.5, -2.5, 0.75], 7), (9, [], 7),
]


def test_equal_average_search_equals_a_full_search():
    rng = np.random.default_rng(5)
    for width, count, spread in [(8, 16, 3), (8, 16, 4000), (1, 5, 2), (3, 1, 9), (4, 16, 1), (0, 3, 1)]:
        points = rng.integers(-spread, spread + 1, (400, width))
        book = rng.integers(-spread, spread + 1, (count, width))
        apart = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
        entry, best = vector_codes.nearest_entries(points, book)
        assert (entry == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


def coded(rows, parts=8, entries=16, rounds=6):
    """(codes and errors by row, digest) of rows (id, vector) of one length, in plain loops."""
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    length = len(rows[0][1])
    cuts = [p * length // parts for p in range(parts + 1)]
    books = [[r[1][a:b] for r in first] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def near(p, vector):
        part = vector[cuts[p] : cuts[p + 1]]
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, vector in rows:
                groups[near(p, vector)[1]].append(vector[cuts[p] : cuts[p + 1]])
            for i, members in groups.items():
                books[p][i] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [[near(p, vector) for p in range(parts)] for _, vector in rows]
    text = ",".join(str(x) for book in books for e in book for x in e)
    return [("".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for f in found], hashlib.sha256(text.encode()).hexdigest()


def test_vector_codes(spark):
    rnd = random.Random(3)
    centres = [[rnd.uniform(-1, 1) for _ in range(16)] for _ in range(12)]
    rows = [(100 + i, [c + rnd.uniform(-0.05, 0.05) for c in centres[rnd.randrange(12)]], rnd.randrange(3)) for i in range(150)]
    rows += rows[:5] + ODD
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, n int, code string").repartition(3)
    got = vector_codes.compress_vectors(frame).collect()
    usable = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) and abs(x) < 1e6 for x in r[1])]
    want = Counter()
    for length in {len(r[1]) for r in usable}:
        own = [(r[0], [math.floor(4096 * x) for x in r[1]], r[2]) for r in usable if len(r[1]) == length]
        codes, digest = coded([r[:2] for r in own])
        want.update((r[0], r[2], *c, digest) for r, c in zip(own, codes, strict=True))
    errors = Counter()
    for (_, label, _, error, _), times in want.items():
        errors[label] += error * times
    assert Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == Counter(
        {(i, code, error, errors[label], digest): 0 for i, label, code, error, digest in want}
    ) + Counter([(i, code, error, errors[label], digest) for (i, label, code, error, digest), n in want.items() for _ in range(n)])
    assert vector_codes.compress_vectors(frame.limit(0)).collect() == []


def test_rank_one_updates_equal_a_full_decomposition():
    rng = np.random.default_rng(2)
    cases = [
        rng.standard_normal((120, 12)), rng.integers(0, 2, (80, 9)).astype(float), np.repeat(rng.integers(-5, 5, (6, 10)), 8, axis=0).astype(float),
        np.ones((6, 4)), np.eye(7)[rng.integers(0, 7, 60)] * 9, rng.standard_normal((40, 6)) * np.geomspace(1e6, 1e-3, 6), rng.standard_normal((9, 1)),
    ]
    for rows in cases:
        half = len(rows) // 3
        parts = []
        for some in (rows[:half], rows[half:]):
            now = spectra.empty_spectrum(rows.shape[1])
            for vector in some:
                now = spectra.add_vector(now, vector)
            parts.append(now)
        both = spectra.combine(*parts)
        apart = rows - rows.mean(axis=0)
        scatter = apart.T @ apart
        size = max(np.abs(scatter).max(), 1e-300)
        assert both.n == len(rows) and np.abs(both.mean - rows.mean(axis=0)).max() <= 1e-12 * np.abs(rows).max()
        assert np.abs(both.vectors @ np.diag(both.values) @ both.vectors.T - scatter).max() <= 1e-12 * size
        assert np.abs(both.vectors.T @ both.vectors - np.eye(rows.shape[1])).max() <= 1e-12
        assert (np.diff(both.values) >= 0).all()


def test_whitening(spark, monkeypatch):
    monkeypatch.setattr(whitening, "VECTORS_PER_TASK", 12)
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rnd = random.Random(8)
    rows = [(100 + i, [rnd.gauss(0, 1 + 5 / (1 + d)) for d in range(16)], 1) for i in range(120)]
    rows += rows[:7] + ODD
    frame = spark.createDataFrame([(*r, 5, 0.5) for r in rows], "vec_id bigint, embedding array<double>, label int, n int, mean double").repartition(3)
    got = whitening.whiten_vectors(frame).collect()
    usable = [(r[0], [math.floor(256 * x) for x in r[1]]) for r in rows if r[1] is not None and all(x is not None and abs(x) < 1e6 for x in r[1])]
    usable = [r for r in usable if r[1] and len(r[1]) == 16]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    apart = np.array(fit, dtype=float) - np.array(sums) / n
    values, axes = np.linalg.eigh(apart.T @ apart / n)
    long = [r for r in got if r.n == n]
    assert Counter((r.vec_id, r.component) for r in long) == Counter((i, c) for i, _ in usable for c in (1, 2, 3, 4))
    of = {x: i for i, x in usable if i is not None and i >= 100 for x in [tuple(x)]}
    ids = {i: x for x, i in of.items()}
    signs = {}
    for r in long:
        if r.vec_id not in ids:
            continue
        x, k = ids[r.vec_id], -r.component
        assert r.deviation == Decimal(sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)))
        white = (np.array(x) - np.array(sums) / n) @ axes[:, k] / math.sqrt(values[k])
        signs.setdefault(r.component, math.copysign(1, white * r.whitened))
        assert r.whitened == pytest.approx(signs[r.component] * white, abs=1e-9)
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9) and r.identity_error < 1e-9
    # One vector of three components: no variance. Empty vectors have no components.
    alone = sorted((r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got if r.vec_id == 8)
    assert alone == [(c, 1, 0, None, None, 0.0) for c in (1, 2, 3)]
    huge = sorted((r.component, r.whitened) for r in got if r.vec_id == 7)
    assert huge == [] and not any(r.vec_id in (3, 4, 9) for r in got)
    assert whitening.whiten_vectors(frame.limit(0)).collect() == []


def test_whitening_of_large_numbers_is_exact(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [-(2.0**40), 3.0]), (3, [5.0, 2.0**30])]
    got = whitening.whiten_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    whole = [[math.floor(256 * x) for x in v] for _, v in rows]
    sums = [sum(c) for c in zip(*whole, strict=True)]
    want = {i: sum((3 * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for (i, _), x in zip(rows, whole, strict=True)}
    assert {(r.vec_id, int(r.deviation)) for r in got} == set(want.items())


BLANK = re.compile(r"[\x20\x09-\x0D]+")


def judged(rows, most, least_left):
    """(id, counts, failed, lost, kept) of rows (id, text, host), in plain loops."""
    split = [(i, t or "", h, [w for w in BLANK.split(t or "") if w]) for i, t, h in rows]
    lines = {t: [x for x in t.split("\n") if BLANK.sub("", x)] for _, t, _, _ in split}
    form = lambda line: re.sub(r"[\x20\x09-\x0D0-9]+", "", line.lower())
    texts = defaultdict(set)
    for _, t, h, _ in split:
        for line in lines[t]:
            texts[h, form(line)].add(t)
    out = Counter()
    for i, t, h, words in split:
        runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        repeated = {j for k in range(len(words) - 4) if runs[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
        chars, lost = sum(map(len, lines[t])), sum(len(x) for x in lines[t] if len(texts[h, form(x)]) > most)
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        out[
            i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines[t]) - len(set(lines[t])), len(repeated), failed, lost,
            not failed and not 100 * (chars - lost) < least_left * chars,
        ] += 1
    return out


def rule_rows():
    rnd = random.Random(6)
    line = lambda n: " ".join(rnd.choice(["alpha", "béta", "gam#ma", "délta*", "e", "Zeta", "42"]) + str(rnd.randrange(60)) for _ in range(n))
    common = ["Share  this page 17", "All about\tus", "Été news of the day &"]
    rows = [(None, None, None), (1, "", "h0"), (1, " \n\t\r\n", None), (2, "one two three four", "h0")]
    for i in range(90):
        body = [line(rnd.randint(1, 12)) for _ in range(rnd.randint(1, 6))]
        for c in common:
            if rnd.random() < 0.4:
                body.insert(rnd.randrange(len(body) + 1), c.upper() if rnd.random() < 0.3 else c.replace("17", str(i)))
        if rnd.random() < 0.2:
            body += body[:2]
        rows.append((i if i % 9 else None, rnd.choice(["\n", "\n\n"]).join(body), rnd.choice(["h0", "h0", "h1", None])))
    rows += [(200, "a b c d e " * 3, "h1"), (201, "x x x x x x x x x x x x", "h1"), (202, "very long " * 3000 + "tail", "h0"), (203, " ".join(f"w{i}" for i in range(5000)), "h0")]
    return rows + [rows[10]] * 30 + [rows[20]] * 3


@pytest.mark.parametrize(("most", "least_left"), [(20, 30), (3, 80)])
def test_quality_rules(spark, most, least_left):
    rows = rule_rows()
    frame = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id bigint, text string, source string, lost int, host string").repartition(4)
    got = quality_rules.judge_documents(frame, most=most, least_left=least_left)
    assert Counter(tuple(r) for r in got.collect()) == judged(rows, most, least_left)


def test_clean_documents_take_frequent_lines_out(spark):
    rows = rule_rows()
    names = ["doc_id", "text", "source", "_key_a", "_gone", "copies", "host"]
    frame = spark.createDataFrame([(*r, 1, 2, 3, "q") for r in rows], "doc_id bigint, text string, source string, _key_a int, _gone int, copies int, host string")
    got = quality_rules.clean_documents(frame.repartition(3), most=5, least_left=60)
    assert got.columns == names
    kept = Counter({(k[0], k[1]): n for k, n in Counter((k[0], k[8]) for k in judged(rows, 5, 60).elements()).items()})
    assert Counter(r.doc_id for r in got.collect()) == Counter({i: n for (i, ok), n in kept.items() if ok})
    form = lambda line: re.sub(r"[\x20\x09-\x0D0-9]+", "", line.lower())
    texts = defaultdict(set)
    for _, t, h in rows:
        for line in (t or "").split("\n"):
            if BLANK.sub("", line):
                texts[h, form(line)].add(t)
    cut = lambda t, h: "\n".join(x for x in t.split("\n") if not BLANK.sub("", x) or len(texts[h, form(x)]) <= 5)
    assert {(r.doc_id, r.text, r.source) for r in got.collect()} <= {(i, cut(t or "", h), h) for i, t, h in rows}
    assert quality_rules.clean_documents(frame.limit(0)).collect() == []
    assert quality_rules.judge_documents(frame.limit(0)).collect() == []


def test_look_up_with_hot_and_null_keys(spark):
    keys = ["hot"] * 700 + [None] * 300 + [f"k{i}" for i in range(1200)] + ["missing"] * 9
    rows = spark.createDataFrame([(k, i, i, i) for i, k in enumerate(keys)], "key string, _0 int, _hot int, value2 int").repartition(5)
    table = spark.createDataFrame([(k, f"v{k}", n) for k, n in Counter(keys).items() if k != "missing"], "key string, value string, n bigint")
    got = look_up(rows, table, ["key"], "n", len(keys))
    assert got.columns == ["key", "_0", "_hot", "value2", "value"]
    assert sorted((r["_0"], r["value"]) for r in got.collect()) == [(i, None if k == "missing" else f"v{k}") for i, k in enumerate(keys)]

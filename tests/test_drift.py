"""Digest trees, done-sets as bitmaps, and staleness through the stage graph."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import drift as D
from lexmill.operators import ledger as G
from lexmill.operators import stages as S
from lexmill.plans import dictionary_stages as DS


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_drift_finds_exactly_what_differs(spark):
    shape = "k int, part string, v string"
    base = [(i, p, f"v{i}") for i in range(300) for p in ("x", None)] + [(None, "x", "n"), (7, "dup", "d"), (7, "dup", "d"), (8, "dup", "e")]
    other = [r for r in base if r[:2] not in ((5, "x"), (None, "x"))] + [(1000, "x", "new"), (None, None, "n2")]
    other = [(k, p, None) if (k, p) == (9, None) else (k, p, "") if (k, p) == (10, "x") else (k, p, v) for k, p, v in other]
    other.remove((7, "dup", "d"))
    other.append((8, "dup", "e"))
    a, b = spark.createDataFrame(base, shape).repartition(5), spark.createDataFrame(other[::-1], shape).repartition(3)
    want = [(5, "x", "missing"), (None, "x", "missing"), (1000, "x", "extra"), (None, None, "extra"), (9, None, "changed"), (10, "x", "changed"), (7, "dup", "changed"), (8, "dup", "changed")]
    assert rows(D.drift_rows(a, b, ["k", "part"])) == sorted(want, key=str)
    assert rows(D.drift_rows(a, a, ["k", "part"])) == [] and rows(D.drift_rows(a.limit(0), a.limit(0), ["k"])) == []
    assert D.differing_leaves(D.digest_tree(a, ["k"], 3), D.digest_tree(a, ["k"], 3), 3).count() == 0
    levels = {r["level"]: r["n"] for r in D.digest_tree(a, ["k"], 3).groupBy("level").agg(F.sum("n").alias("n")).collect()}
    assert levels == dict.fromkeys(range(4), len(base))
    with pytest.raises(ValueError, match="same columns"):
        D.drift_rows(a, b.drop("v"), ["k"])


def test_bitmaps_equal_the_anti_join(spark):
    ids = [1, 2, 2, 8, 32_768, 32_769, 1_000_000, None, 0, -5, 2**40]
    done = [spark.createDataFrame([(i,) for i in part], "word_id bigint") for part in (ids[:4], ids[3:8], ids[8:])]
    merged = G.merge_bitmaps(*[G.done_bitmaps(d) for d in done])
    targets = spark.createDataFrame([(i, "x") for i in [*ids, 3, 32_767, 65_536, -4, 2**40 + 1]], "word_id bigint, bits string")
    left = G.resume_by_bitmap(targets, merged)
    assert left.columns == targets.columns
    assert rows(left, "word_id") == sorted([(None,), (3,), (32_767,), (65_536,), (-4,), (2**40 + 1,)], key=str)
    assert G.count_done(merged).first()["done"] == len({i for i in ids if i is not None})
    empty = G.done_bitmaps(done[0].limit(0))
    assert G.resume_by_bitmap(targets, empty).count() == targets.count() and G.count_done(empty).first()["done"] == 0


def test_staleness_equals_what_a_rerun_does(spark):
    def stage(name, upstream=(), version="1", prompt=None):
        fn = lambda df: df.select("word_id", F.lit("{}").alias("payload"))
        return S.Stage(name, upstream, fn, parser_version=version, prompt_hash=prompt)

    def chain(b="1", d=None):
        return [stage("a"), stage("b", ("a",), b), stage("c", ("b", "a")), stage("d", ("a",), prompt=d), stage("e", ("d", "c"))]

    words = spark.range(12).withColumnRenamed("id", "word_id")
    first = S.stage_chain(chain(), words.where("word_id < 9"), spark.createDataFrame([], DS.EMPTY_ARTIFACTS))
    assert rows(S.stale_closure(chain(), words.where("word_id < 9"), first.artifacts)) == []
    for changed in (chain("2"), chain(d="p"), chain("2", "p")):
        told = rows(S.stale_closure(changed[::-1], words, first.artifacts), "word_id", "stage_name")
        again = S.stage_chain(changed, words, first.artifacts)
        assert told == rows(again.ledger, "word_id", "stage_name")
    reasons = {(r.stage_name, r.reason) for r in S.stale_closure(chain("2"), words.where("word_id < 9"), first.artifacts).collect()}
    assert reasons == {("b", "changed"), ("c", "upstream"), ("e", "upstream")}
    with pytest.raises(ValueError, match="circle"):
        S.stale_closure([stage("a", ("b",)), stage("b", ("a",))], words, first.artifacts)

"""Tables that grow are not sent to all tasks by way of the driver because their files are small."""

import pytest
from pyspark.sql import functions as F

from lexmill import session
from lexmill.operators import cells, edits, export, inference, numbering, review, stages
from lexmill.plans import dictionary_stages as DS
from lexmill.session import cut_lineage
from lexmill.sources import buckets
from lexmill.sources.buckets import BucketedTable


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans of everything that is written, where no file is small enough to be sent."""
    seen, put = [], BucketedTable._put_in_place

    def cut(df):
        seen.append(plan(df))
        return cut_lineage(df)

    for module in (cells, edits, export, inference, numbering, review, stages, buckets):
        monkeypatch.setattr(module, "cut_lineage", cut)
    monkeypatch.setattr(BucketedTable, "_put_in_place", lambda self, dealt, at: (seen.append(plan(dealt)), put(self, dealt, at))[1])
    monkeypatch.setattr(session, "PACKED", 0, raising=False)
    return seen


def stored(df, tmp_path, name):
    df.write.parquet(str(tmp_path / name))
    return df.sparkSession.read.parquet(str(tmp_path / name))


def sent(plans):
    return [p for p in plans if "BroadcastHashJoin" in p or "BroadcastNestedLoopJoin" in p]


def vocabulary(spark, tmp_path):
    key = F.col("id")
    meanings = spark.range(60).select(
        key.alias("meaning_id"), F.expr("id div 3").alias("word_id"), F.concat(F.lit("cn"), key).alias("cn_paraphrase"), F.lit("e").alias("en_paraphrase"),
    )
    sentences = spark.range(120).select(
        key.alias("sentence_id"), F.expr("id div 2").alias("meaning_id"), F.concat(F.lit("f"), key).alias("form"), F.lit("t").alias("translation"),
    )
    words = spark.range(20).select(key.alias("word_id"), F.concat(F.lit("w"), key).alias("form"), F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"))
    mnemonics = spark.range(20).select(key.alias("mnemonic_id"), key.alias("word_id"), F.concat(F.lit("m"), key).alias("text"))
    tables = {"words": words, "meanings": meanings, "sentences": sentences, "mnemonics": mnemonics}
    return {k: BucketedTable.create(stored(v, tmp_path, k), str(tmp_path / f"table-{k}"), [v.columns[0]], 4) for k, v in tables.items()}


def test_packed_tables_are_matched_by_a_shuffle(spark, monkeypatch):
    # 200,000 ids in order: a file far below Spark's limit for sending a table.
    packed = cut_lineage(spark.range(0, 200_000, 1, 1).select(F.col("id").alias("k"), F.lit("the same text in each row").alias("v")))
    size = int(str(packed._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    assert size < 10 << 20
    rows = cut_lineage(spark.range(300_000).select(F.col("id").alias("k")))
    monkeypatch.setattr(session, "PACKED", size - 1)
    joined = rows.join(session.by_rows(packed), "k")
    assert "BroadcastHashJoin" not in plan(joined) and joined.count() == 200_000
    monkeypatch.setattr(session, "PACKED", size)
    assert "BroadcastHashJoin" in plan(rows.join(session.by_rows(packed), "k"))
    # A size that is only known when it runs is Spark's to judge.
    assert session.by_rows(spark.createDataFrame(spark.sparkContext.emptyRDD(), "k bigint")).columns == ["k"]


def test_changes_in_place_send_no_table(spark, tmp_path, plans):
    tables = {k: v for k, v in vocabulary(spark, tmp_path).items() if k in ("words", "meanings")}
    changes = stored(
        spark.range(20).select(
            F.col("id").alias("word_id"), F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, "words.form").otherwise("meanings.cn_paraphrase").alias("field_path"),
            (F.col("id") * 3).alias("target_id"), F.lit("update").alias("op"), F.when(F.col("id") == 5, "drifted").alias("old_value"),
            F.concat(F.lit("n"), "id").alias("new_value"), F.lit(1).alias("editor_id"),
        ), tmp_path, "changes",
    )
    plans.clear()
    done = edits.apply_changes_in_place(tables, changes, F.lit("2024-05-05").cast("timestamp_ntz"))
    assert plans and not sent(plans)
    assert [tuple(r) for r in done["refused"].collect()] == [(5, 5, "drift")]
    assert sorted(r["form"] for r in tables["words"].read().collect()) == sorted(f"n{i}" if i % 2 == 0 else f"w{i}" for i in range(20))
    changed = {r["meaning_id"]: r["cn_paraphrase"] for r in tables["meanings"].read().collect()}
    assert changed == {m: f"n{m // 3}" if m % 3 == 0 and m // 3 % 2 == 1 and m != 15 else f"cn{m}" for m in range(60)}


def test_patches_in_place_send_no_table(spark, tmp_path, plans):
    tables = {k: v for k, v in vocabulary(spark, tmp_path).items() if k != "words"}
    patches = stored(
        spark.range(20).select(
            F.col("id").alias("word_id"), F.col("id").alias("seq"), F.when(F.col("id") % 4 == 3, "delete").otherwise("update").alias("op"),
            F.when(F.col("id") % 4 == 0, "meanings[1].cn_paraphrase").when(F.col("id") % 4 == 1, "meanings[0].examples[1].cn")
            .when(F.col("id") % 4 == 2, "mnemonic.text").otherwise("meanings[2]").alias("path"),
            F.lit(None).cast("string").alias("old_value"), F.concat(F.lit("n"), "id").alias("new_value"),
        ), tmp_path, "patches",
    )
    plans.clear()
    done = review.apply_patches_in_place(tables, patches)
    assert plans and not sent(plans) and not sent([plan(done["outcomes"])])
    assert [r["status"] for r in done["outcomes"].collect()] == ["applied"] * 20
    gone = {3 * w + 2 for w in range(3, 20, 4)}
    got = {r["meaning_id"]: r["cn_paraphrase"] for r in done["meanings"].collect()}
    assert got == {m: f"n{m // 3}" if m % 3 == 1 and m // 3 % 4 == 0 else f"cn{m}" for m in range(60) if m not in gone}
    got = {r["sentence_id"]: r["translation"] for r in done["sentences"].collect()}
    assert got == {s: f"n{s // 6}" if s % 6 == 1 and s // 6 % 4 == 1 else "t" for s in range(120) if s // 2 not in gone}
    assert {r["word_id"]: r["text"] for r in done["mnemonics"].collect()} == {w: f"n{w}" if w % 4 == 2 else f"m{w}" for w in range(20)}


@pytest.mark.parametrize("kept", [True, False])
def test_stages_send_no_table(spark, tmp_path, plans, monkeypatch, kept):
    monkeypatch.setattr(stages, "FEW", -1)
    # So many that the product of two files, by which Spark judges a joined side, is above its limit.
    words = stored(spark.range(30_000).withColumnRenamed("id", "word_id"), tmp_path, "words")
    empty = spark.createDataFrame([], DS.EMPTY_ARTIFACTS)

    def run(df):
        lost = F.col("word_id") % 10 == 3
        return df.select("word_id", F.when(~lost, "{}").alias("payload"), F.when(lost, "none").alias("error"))

    chain = [stages.Stage("a", (), run), stages.Stage("b", ("a",), run), stages.Stage("c", ("a", "b"), run)]
    store = stages.ArtifactStore(spark, str(tmp_path / "artifacts"), empty.schema, 4) if kept else empty
    first = stages.stage_chain(chain, words, store)
    assert first.report == [("a", 27_000, 3000, 0), ("b", 27_000, 0, 0), ("c", 27_000, 0, 0)]
    again = stages.stage_chain(chain, words, store if kept else stored(first.artifacts, tmp_path, "made"))
    assert again.report == [("a", 0, 3000, 27_000), ("b", 0, 0, 27_000), ("c", 0, 0, 27_000)]
    assert plans and not sent(plans) and first.artifacts.count() == 81_000


def test_calls_send_a_short_list_only(spark, tmp_path, plans, monkeypatch):
    given = stored(
        spark.range(40).select(
            "id", F.lit("k").alias("kind"), F.lit("gpt-5-mini").alias("model"), F.lit("{}").alias("params_json"),
            F.concat(F.lit("p"), F.col("id") % 30).alias("prompt"), F.lit("{}").alias("input_json"),
        ), tmp_path, "calls",
    )
    kept = stored(spark.createDataFrame([], DS.EMPTY_CACHE), tmp_path, "kept")
    for most in (500_000, 0):
        plans.clear()
        monkeypatch.setattr(inference, "LISTED", most, raising=False)
        out = inference.cached_inference(given, kept, inference.digest_model, "id", partitions=2)
        asked = [p for p in plans if "MapInPandas" in p]
        assert len(asked) == 1 and ("BroadcastHashJoin" in asked[0]) == (most > 0)
        assert not sent([p for p in plans if p not in asked] + [plan(out.results)])
        assert out.results.count() == 40 and out.new_cache.count() == 30


def test_records_and_serving_rows_send_no_table(spark, tmp_path, plans):
    ids = spark.range(30).withColumnRenamed("id", "word_id")
    blobs = stored(ids.withColumn("form", F.concat(F.lit("w"), "word_id")), tmp_path, "blobs")
    gathered = stored(ids.select("word_id", F.array(F.lit("dull")).alias("issues"), F.lit(None).cast("string").alias("check_error")), tmp_path, "gathered")
    proposed = stored(ids.where("word_id % 2 = 0").select("word_id", F.lit(None).cast("string").alias("fix_error")), tmp_path, "proposed")
    outcomes = stored(ids.select("word_id", F.when(F.col("word_id") % 3 == 0, "applied").otherwise("drift").alias("status")), tmp_path, "outcomes")
    records = review.review_records(blobs, gathered, proposed, outcomes)
    assert not sent([plan(records)]) and [tuple(r) for r in records.groupBy().agg(F.count("*"), F.sum("applied"), F.sum("drift_skipped")).collect()] == [(30, 10, 20)]

    tables = {k: v.read() for k, v in vocabulary(spark, tmp_path).items()}
    none = F.lit(None).cast("string")
    tables["words"] = tables["words"].withColumns(
        {c: none for c in ("phonetic_us", "phonetic_uk", "audio_us", "audio_uk")} | {"type": F.lit(1), "status": F.lit(1), "quality_flag": F.lit("none")}
    )
    tables["meanings"] = tables["meanings"].withColumns({"pos": F.lit(1).cast("smallint"), "pos_sub": F.lit(None).cast("smallint")})
    tables["sentences"] = tables["sentences"].withColumn("source", F.lit("s"))
    tables["mnemonics"] = tables["mnemonics"].withColumns({"type": F.lit(1).cast("smallint"), "kind": F.lit("phonetic")})
    tables["phrases"] = stored(ids.select(F.col("word_id").alias("phrase_id"), F.col("word_id").alias("owner_word_id"), F.lit("p").alias("form"), F.lit("m").alias("meaning")), tmp_path, "phrases")
    packages = stored(ids.select(F.lit(1).cast("bigint").alias("package_id"), F.lit(2).cast("bigint").alias("unit_id"), "word_id", F.lit(1.0).alias("sort_order"), F.lit(1).alias("importance")), tmp_path, "packages")
    plans.clear()
    refresh = export.serving_refresh(stored(ids.where("word_id < 9"), tmp_path, "changed"), tables, packages)
    assert not sent([*plans, plan(refresh["upsert"]), plan(refresh["remove"])])
    assert refresh["upsert"].count() == 9 and refresh["remove"].count() == 0

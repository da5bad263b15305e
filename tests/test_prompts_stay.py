"""Prompts and children that are not moved where counts or ids do."""

from pyspark.sql import functions as F

from lexmill.operators import documents as D
from lexmill.operators import inference as I
from lexmill.operators import numbering as O
from lexmill.plans import dictionary_stages as DS
from lexmill.session import cut_lineage


def calls(spark, prompts, ids=None):
    data = [(i, "k", "gpt-5", "{}", p, "{}") for i, p in zip(ids or range(len(prompts)), prompts, strict=True)]
    rows = spark.createDataFrame(data, "id bigint, kind string, model string, params_json string, prompt string, input_json string")
    return rows.repartition(4)


def answered(df):
    return sorted((r["prompt"], r["id"] if r["id"] is not None else -1, r["text"], r["hit"], str(r["spent_usd"])) for r in df.collect())


def test_prompts_of_a_first_run_are_not_shuffled(spark, monkeypatch):
    plans = []

    def cut(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df)

    monkeypatch.setattr(I, "cut_lineage", cut)
    for prompts in ([f"p{i}" for i in range(40)], [f"p{i % 39}" for i in range(40)]):
        plans.clear()
        given = cut_lineage(calls(spark, prompts))
        out = I.cached_inference(given, spark.createDataFrame([], DS.EMPTY_CACHE), I.digest_model, "id", partitions=2)
        assert out.results.count() == 40 and out.new_cache.count() == len(set(prompts))
        asking = [p for p in plans if "MapInPandas" in p]
        assert len(asking) == 1 and asking[0].count("Exchange") == asking[0].count("BroadcastExchange")


def test_rows_are_told_by_the_shorter_list(spark):
    rows = cut_lineage(spark.range(100).select(F.col("id").alias("_row"), F.col("id").cast("string").alias("prompt")))
    for size in (0, 3, 50, 97, 100):
        wanted = cut_lineage(spark.range(size).select(F.col("id").alias("_row")))
        assert sorted(r["_row"] for r in I._rows_of(rows, wanted).collect()) == list(range(size))


def test_copies_and_missing_ids_are_asked_once(spark):
    given = calls(spark, ["a", "a", "b", "b", "c", "c"], [2, 1, None, 5, None, None])
    out = I.cached_inference(given, spark.createDataFrame([], DS.EMPTY_CACHE), I.digest_model, "id", partitions=1)
    spent = {(p, i): s for p, i, _, _, s in answered(out.results)}
    assert {k for k, s in spent.items() if float(s) > 0} == {("a", 1), ("b", 5)}
    again = I.cached_inference(calls(spark, ["a", "c", "d"]), out.new_cache, I.digest_model, "id")
    assert [(r[0], r[3]) for r in answered(again.results)] == [("a", True), ("c", True), ("d", False)]


def test_hot_keys_are_found_from_groups(spark, monkeypatch):
    rows = spark.range(1000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("k"))
    for groups in (1, 3, 1 << 14):
        monkeypatch.setattr(O, "HOT_GROUPS", groups)
        found = O.hot_keys(rows, ["k"], 50)
        assert [r["k"] for r in found.collect()] == [7, None] and O.hot_keys(rows, ["k"], 600) is None


def test_cut_tables_are_packed(spark):
    packed = cut_lineage(spark.range(10))
    assert all(path.endswith(".zstd.parquet") for path in packed.inputFiles())


def test_documents_weighed_by_whole_tables(spark):
    words = spark.createDataFrame([(1, "a", 1, 1, "none"), (2, "b", 1, 1, "none")], "word_id bigint, form string, type int, status int, quality_flag string")
    words = words.withColumns({c: F.lit(None).cast("string") for c in ("phonetic_us", "phonetic_uk", "audio_us", "audio_uk")})
    meanings = spark.range(30).select(
        F.col("id").alias("meaning_id"), (F.col("id") % 3).alias("word_id"), F.lit(1).alias("pos"), F.lit(None).cast("int").alias("pos_sub"),
        F.concat(F.lit("m"), "id").alias("cn_paraphrase"), F.lit("e").alias("en_paraphrase"),
    )
    sentences = spark.range(90).select(
        F.col("id").alias("sentence_id"), (F.col("id") % 29).alias("meaning_id"), F.concat(F.lit("s"), "id").alias("form"), F.lit("t").alias("translation")
    )
    mnemonics = spark.createDataFrame([(1, 1, 1, "k", "x"), (2, 1, 1, "k", "y")], "mnemonic_id bigint, word_id bigint, type int, kind string, text string")
    phrases = spark.createDataFrame([(1, 2, "f", "g")], "phrase_id bigint, owner_word_id bigint, form string, meaning string")
    packages = spark.createDataFrame([(1, 1, 1, 1.0, 1)], "package_id bigint, unit_id bigint, word_id bigint, sort_order double, importance int")
    whole = {"meanings": meanings, "sentences": sentences, "mnemonics": mnemonics, "phrases": phrases, "packages": packages}
    mine = meanings.where("word_id > 0")
    below = sentences.join(mine.select("meaning_id"), "meaning_id", "left_semi")
    for floor in (1, 5, 1_000_000):
        for make, more in ((D.serving_payload, (phrases, packages)), (D.review_blob, ())):
            plain = make(words, mine, below, mnemonics, *more)
            weighed = make(words, mine, below, mnemonics, *more, floor=floor, whole=whole)
            assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, weighed.collect()))

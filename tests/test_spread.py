"""How rows are dealt out to tasks: few row groups, large buckets, small runs, large indexes."""

from pyspark.sql import functions as F

from lexmill.operators import search as Q
from lexmill.operators import stages as S
from lexmill.plans import dictionary_stages as DS
from lexmill.plans.standins import Tables
from lexmill.sources.buckets import BucketedTable


def filled(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_documents_of_one_row_group_are_dealt_out(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "10000")
    try:
        table = Tables(spark, str(tmp_path)).read("documents")
        # Many splits, but the row group lies in one of them.
        assert table.rdd.getNumPartitions() > 4 and filled(table) == 1
        dealt = Tables(spark, str(tmp_path)).documents
        assert filled(dealt) == 4 and sorted(map(tuple, dealt.collect())) == sorted(map(tuple, rows.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "20000")
    try:
        data = spark.range(0, 8000, 1, 8).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        table = BucketedTable.create(data, str(tmp_path / "t"), ["k"], 2)
        assert len(list((tmp_path / "t" / "bucket=0").glob("*.parquet"))) > 1
        assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, data.collect()))
        assert table.put(spark.createDataFrame([(5, "new")], "k bigint, v string")) and table.read().count() == 8000
        assert table.read().where("k = 5").collect()[0]["v"] == "new"
    finally:
        spark.conf.set(name, before)


def test_a_stage_moves_the_payloads_of_its_own_words_only(spark):
    seen = []

    def fn(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.select("word_id", "up_a" if "up_a" in df.columns else F.lit("p").alias("payload")).toDF("word_id", "payload")

    words = spark.range(20).withColumnRenamed("id", "word_id")
    a, b = S.Stage("a", (), fn), S.Stage("b", ("a",), fn)
    first = S.stage_chain([a], words.where("word_id < 15"), spark.createDataFrame([], DS.EMPTY_ARTIFACTS))
    seen.clear()
    run = S.run_stage(b, words, first.artifacts)
    assert "LeftSemi" in seen[0]
    told = {r["word_id"]: (r["status"], r["error"]) for r in run.ledger.collect()}
    assert told == {i: ("ok", None) if i < 15 else ("failed", "missing upstream artifact a") for i in range(20)}
    assert {(r["word_id"], r["payload"]) for r in run.fresh.collect()} == {(i, "p") for i in range(15)}


def test_a_large_index_is_written_by_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "TEXTS_PER_WRITER", 100)
    rows = spark.range(2000).select(F.col("id").alias("word_id"), F.concat(F.lit("text "), "id").alias("form"))
    index = Q.TrigramIndex(spark, str(tmp_path / "i"), 4)
    index.write(rows)
    assert max(len(list(d.glob("*.parquet"))) for d in (tmp_path / "i").iterdir() if d.is_dir()) > 8
    assert {r["word_id"] for r in Q.search_substring(rows, index, "xt 12").collect()} == {i for i in range(2000) if str(i).startswith("12")}

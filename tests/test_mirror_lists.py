"""The mirror's long lists are found without a shuffle of all children."""

from pyspark.sql import functions as F

from lexmill.operators import mirror as M


def test_children_stay_when_few_lists_are_long(spark):
    children = spark.range(2_000_000).select(F.col("id").alias("meaning_id"), F.when(F.col("id") < 1_500, 0).otherwise(F.col("id")).alias("word_id"))
    rest = M.mirror_overflow(children, "meanings", "word_id", "meaning_id")
    assert "SortMergeJoin" not in rest._jdf.queryExecution().executedPlan().toString()
    assert [(r["parent_id"], r["part_no"], r["ids"].count("id")) for r in rest.collect()] == [(0, 1, 500)]

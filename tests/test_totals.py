"""Totals that a ledger outgrows: sums of more than a million dollars."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lexmill.operators import ledger as G
from lexmill.plans import ledger_queries as Q
from lexmill.plans.standins import Tables
from lexmill.streaming import jobs as J

ATTEMPTS = "batch_id string, status string, cost_usd decimal(10,6)"
BATCHES = "id string, total_cost_usd decimal(12,6), budget_cap_usd decimal(12,6)"
MUCH = Decimal("9999.500000")


def attempts(spark, n=200):
    return spark.range(n).select(F.lit("b").alias("batch_id"), F.lit("ok").alias("status"), F.lit(MUCH).cast("decimal(10,6)").alias("cost_usd"))


def test_experiment_costs_over_a_million(spark):
    items = attempts(spark).select(F.lit("r").alias("run_id"), F.lit(True).alias("ok"), F.lit(False).alias("valid"), "cost_usd")
    assert [tuple(r) for r in G.experiment_summary(items).collect()] == [("r", 200, 0, 200 * MUCH)]


def test_batch_costs_over_a_million(spark):
    assert [tuple(r) for r in G.batch_cost(attempts(spark)).collect()] == [("b", 200 * MUCH)]


def test_added_costs_over_a_million(spark):
    batches = spark.createDataFrame([("b", Decimal(999999), None), ("c", Decimal(1), None)], BATCHES)
    once, unknown = G.add_batch_cost(batches, attempts(spark))
    twice, _ = G.add_batch_cost(once, attempts(spark))
    assert sorted((r["id"], r["total_cost_usd"]) for r in twice.collect()) == [("b", 999999 + 400 * MUCH), ("c", Decimal(1))]
    assert unknown.collect() == [] and twice.schema["total_cost_usd"].dataType == once.schema["total_cost_usd"].dataType


def test_gate_of_a_total_over_a_million(spark):
    batches = spark.createDataFrame([("b", None, Decimal(999999))], BATCHES)
    now, _ = G.add_batch_cost(batches, attempts(spark))
    assert [r["verdict"] for r in G.budget_gate(spark.createDataFrame([("b",)], "batch_id string"), now).collect()] == ["blocked"]


def test_ledger_days_over_a_million(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1), 1, "click", 9999.5, '{"k": 1}') for i in range(200)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    assert [tuple(r) for r in Q.append_ledger(Tables(spark, str(tmp_path))).collect()] == [(dt.date(2024, 1, 1), "ok", 200, 200 * MUCH)]


def test_streamed_costs_over_a_million(spark, tmp_path):
    attempts(spark).write.parquet(str(tmp_path / "in"))
    batches = spark.createDataFrame([("b", None, Decimal(5))], BATCHES)
    out = J.stream_batch_cost(spark.readStream.schema(ATTEMPTS).parquet(str(tmp_path / "in")), batches, root=str(tmp_path / "run"))
    assert [(r["spent"], r["verdict"]) for r in out.collect()] == [(200 * MUCH, "blocked")]

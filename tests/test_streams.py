"""Event-time order, silence and compaction of streams."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from lexmill.streaming import jobs as J

SCHEMA = "word_id bigint, stage_name string, id bigint, at timestamp_ntz, resolves boolean"


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def write(spark, data, schema, path):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def letters(events):
    """Third failures of (word_id, stage_name, id, at, resolves) since the last resolution, in order of time."""
    count, out = {}, []
    for word, stage, i, at, resolves in sorted(events, key=lambda e: (e[3], e[2])):
        count[word, stage] = 0 if resolves else count.get((word, stage), 0) + 1
        if count[word, stage] == 3:
            out.append((word, stage, i, 3, at))
    return sorted(out)


def test_dead_letters_in_event_time_over_shuffled_batches(spark, tmp_path):
    rnd = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    events = [(rnd.randrange(4), rnd.choice("ab"), i, start + dt.timedelta(seconds=17 * i, milliseconds=rnd.randrange(1000)), rnd.random() < 0.15) for i in range(120)]
    # Rows come up to 20 places late, so within 17 * 20 seconds.
    late = sorted(range(120), key=lambda i: i + rnd.randrange(20))
    path = str(tmp_path / "in")
    for a in range(0, 120, 30):
        write(spark, [events[i] for i in late[a : a + 30]], SCHEMA, path)
    # A row far ahead lets the watermark pass all others.
    write(spark, [(99, "z", 999, start + dt.timedelta(days=1), False)], SCHEMA, path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    with J.with_state_store(spark):
        out = J.run_available(J.stream_dead_letters_in_order(stream, "10 minutes"), "ordered", root=str(tmp_path / "run"))
    assert rows(out) == letters(events)


def test_idle_keys_are_forgotten(spark, tmp_path):
    at = lambda **k: dt.datetime(2024, 1, 1) + dt.timedelta(**k)
    path, root = str(tmp_path / "in"), str(tmp_path / "run")
    write(spark, [(k, "a", k, at(seconds=k), False) for k in range(20)] + [(1, "a", 50, at(minutes=1), False)], SCHEMA, path)
    write(spark, [(500, "a", 60, at(hours=3), False)], SCHEMA, path)
    write(spark, [(1, "a", 70, at(hours=3, minutes=1), False), (500, "a", 61, at(hours=6), False)], SCHEMA, path)
    write(spark, [(500, "a", 62, at(hours=6, minutes=1), False), (501, "a", 80, at(hours=6, minutes=30), False)], SCHEMA, path)
    stream = J.stream_dead_letters_in_order(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path), "1 minute", "1 hour")
    with J.with_state_store(spark):
        job = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
        job.awaitTermination()
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in job.recentProgress if p["stateOperators"]]
    # Word 1 fails a third time after its idle hour, so its count began anew; 500 never rests for an hour but once.
    assert rows(spark.read.parquet(f"{root}/out")) == []
    assert max(totals) >= 20 and totals[-1] < 10


def test_a_stream_that_stops_gets_its_alert(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    path = str(tmp_path / "in")
    write(spark, [(1, at(0)), (1, at(9)), (2, at(3))], "word_id bigint, started_at timestamp_ntz", path)
    stream = spark.readStream.schema("word_id bigint, started_at timestamp_ntz").parquet(path)
    with J.with_state_store(spark):
        out = J.run_until(J.stream_silence_alert(stream, "word_id", gap=2), str(tmp_path / "run"), lambda df: df.count() >= 2, 90)
    assert rows(out) == [("1", at(0), at(9), 2), ("2", at(3), at(3), 1)]


def test_compaction_of_epochs_and_restart(spark, tmp_path):
    src, root, cost = str(tmp_path / "in"), str(tmp_path / "ingest"), str(tmp_path / "cost")
    batches = spark.createDataFrame([("b", None)], "id string, budget_cap_usd decimal(12,6)")

    def run():
        lines = spark.readStream.schema("raw_form string, line_no bigint").option("maxFilesPerTrigger", 1).parquet(src)
        spent = lines.select(F.lit("ok").alias("status"), F.lit("b").alias("batch_id"), F.col("line_no").cast("decimal(10,6)").alias("cost_usd"))
        return (
            rows(J.stream_ingest(lines, "line_no", root=root), "normalized_form", "raw_form"),
            rows(J.stream_batch_cost(spent, batches, root=cost), "batch_id", "spent"),
        )

    for i, lines in enumerate([[("Apple", 1), ("fig", 2)], [("APPLE", 3), ("Pear", 4)], [("PEAR", 5), ("plum", 6)]]):
        write(spark, lines, "raw_form string, line_no bigint", src)
        want = run()
        if i == 0:
            assert J.compact_epochs(spark, root, J.INGESTED, J.first_epoch) == -1  # the newest epoch stays
    assert want == ([("apple", "Apple"), ("fig", "fig"), ("pear", "Pear"), ("plum", "plum")], [("b", Decimal(21))])
    assert J.compact_epochs(spark, root, J.INGESTED, J.first_epoch) == 1 and J.compact_epochs(spark, cost, J.SPENT, J.last_epoch) == 1
    opened = {r["f"] for r in J.read_epochs(spark, root, J.INGESTED).select(F.input_file_name().alias("f")).collect()}
    assert not any("epoch=000000000" in f or "epoch=000000001" in f for f in opened) and any("/compacted/" in f for f in opened)
    assert run() == want
    write(spark, [("Quince", 7), ("fig", 8)], "raw_form string, line_no bigint", src)
    want = (sorted([*want[0], ("quince", "Quince")]), [("b", Decimal(36))])
    assert run() == want
    assert J.compact_epochs(spark, root, J.INGESTED, J.first_epoch) == 2 and run() == want

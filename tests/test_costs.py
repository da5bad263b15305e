"""What steps may not do over and over: work that grows faster than the rows need."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.functions import nested as N
from lexmill.operators import drift as D
from lexmill.streaming import jobs as J


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_buckets_of_senses_are_read_once(spark):
    doc = {"collins": {"collins_entries": [{"entries": {"entry": [{"tran_entry": [{"tran": "<b>go</b>", "exam_sents": {"sent": [
        {"eng_sent": "<B>We</b> go.", "chn_sent": "走"}, {"eng_sent": " ", "chn_sent": "x"}, {"eng_sent": 5, "chn_sent": "x"}]}}]}]}}]}}
    docs = spark.createDataFrame([(N.json.dumps(doc),)], "raw string").select(F.try_parse_json("raw").alias("doc"))
    visits = docs.select(N.visit_order(F.col("doc")).alias("v"))
    assert plan(visits).count("exam_sents") == 1
    assert [(c["sense"], c["en"], c["cn"]) for c in visits.first()["v"]] == [("go", "We go.", "走")]


def test_only_considered_sentences_are_folded(spark):
    sents = [{"sentence": s, "sentence-translation": "x"} for s in ("Straße", "STRASSE", *[f"s{i}" for i in range(12)])]
    docs = spark.createDataFrame([(N.json.dumps({"blng_sents_part": {"sentence-pair": sents}}),)], "raw string")
    out = N.with_reference_examples(docs.select(F.try_parse_json("raw").alias("doc")), "doc")
    assert "_keyed" not in out._jdf.queryExecution().analyzed().toString()
    picked = out.first()["reference_examples"][0]["examples"]
    assert [e["en"] for e in picked] == ["Straße", *[f"s{i}" for i in range(9)]]


def test_ingest_aggregates_numbers_by_spelling(spark, monkeypatch, tmp_path):
    seen = []

    def stop(rows, *_):
        seen.append(rows._jdf.queryExecution().analyzed().toString())
        raise InterruptedError

    monkeypatch.setattr(J, "run_batches", stop)
    spark.createDataFrame([("a", 1)], "raw_form string, line_no bigint").write.parquet(str(tmp_path / "in"))
    with pytest.raises(InterruptedError):
        J.stream_ingest(spark.readStream.schema("raw_form string, line_no bigint").parquet(str(tmp_path / "in")), "line_no", root=str(tmp_path / "run"))
    assert "min(line_no" in seen[0] and "min(struct" not in seen[0]


def test_spellings_of_one_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("FIG", 3), ("Fig", 2), ("fig ", 5), (" ", 1), (None, 1), ("Nut", 1), ("NUT", 4), ("NUT", None)], "raw_form string, line_no bigint").write.parquet(path)
    out = J.stream_ingest(spark.readStream.schema("raw_form string, line_no bigint").parquet(path), "line_no")
    assert sorted(tuple(r) for r in out.select("normalized_form", "type", "raw_form", "first_seen").collect()) == [("fig", 1, "Fig", 2), ("nut", 1, "NUT", None)]


def test_keys_without_letters_make_no_frame():
    class One:
        exists, get = False, (0,)

        def update(self, value):
            self.value = value

    at = [pd.Timestamp(2024, 1, 1, 0, 0, s) for s in (5, 3, 4, 1)]
    rows, state = pd.DataFrame({"at": at, "id": [1, 2, 3, -1], "resolves": [False, False, False, True]}), One()
    assert list(J._count_failures((1, "s"), iter([rows[:2]]), state)) == [] and state.value == (2,)
    assert [tuple(r) for f in J._count_failures((1, "s"), iter([rows[:1], rows[1:]]), state) for r in f.itertuples(index=False)] == [(1, "s", 1, 3, at[0])]


class State:
    """A state that counts how often it is called."""

    calls = 0

    def __init__(self):
        self.rows, self.value, self.timers = [], None, set()

    def __getattr__(self, name):
        def call(*args):
            State.calls += 1
            return getattr(State, f"do_{name}")(self, *args)

        return call

    def do_exists(self):
        return bool(self.rows) or self.value is not None

    def do_appendList(self, rows):
        self.rows += rows

    def do_listTimers(self):
        return iter(list(self.timers))

    def do_registerTimer(self, at):
        self.timers.add(at)

    def do_deleteTimer(self, at):
        self.timers.discard(at)

    def do_getCurrentWatermarkInMs(self):
        return 0


def test_a_new_key_takes_three_calls_of_its_state():
    order = J.FailureOrder(1000)
    order.handle, order.pending, order.known = State(), State(), State()
    rows = [pd.DataFrame({"at": [pd.Timestamp(2024, 1, 1, 0, 0, s)], "id": [s], "resolves": [False]}) for s in (9, 4)]
    State.calls = 0
    out = list(order.handleInputRows((1, "s"), iter(rows), State()))
    assert State.calls == 4 and out == []  # the watermark is the fourth
    assert [r[1] for r in order.pending.rows] == [9, 4] and order.handle.timers == {int(dt.datetime(2024, 1, 1, 0, 0, 4, tzinfo=dt.UTC).timestamp() * 1000)}


def test_drift_deals_each_row_out_once(spark):
    one = spark.createDataFrame([(None, "a"), ("k", "a"), ("k", "a"), ("m", None), ("same", "s")], "id string, v string")
    other = spark.createDataFrame([(None, "b"), ("k", "a"), ("m", None), ("n", "x"), ("same", "s")], "id string, v string")
    out = D.drift_rows(one, other, ["id"])
    physical = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in physical and "BroadcastHashJoin" in physical and "FullOuter" not in physical
    assert sorted((str(r["id"]), r["drift"]) for r in out.collect()) == [("None", "changed"), ("k", "changed"), ("n", "extra")]

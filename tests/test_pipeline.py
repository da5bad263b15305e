import datetime as dt
import json
import os
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.functions import nested as N
from lexmill.operators import edits as E
from lexmill.operators import inference as I
from lexmill.operators import review as R
from lexmill.operators import stages as S
from lexmill.plans import dictionary_stages as DS
from lexmill.streaming import jobs as J


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


# --- inference --------------------------------------------------------------


def calls(spark, prompts, params="{}"):
    data = [(i, "k", "gpt-5", params, p, "{}") for i, p in enumerate(prompts)]
    return spark.createDataFrame(data, "id bigint, kind string, model string, params_json string, prompt string, input_json string")


def test_second_run_makes_no_call(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    where = str(log)

    def fn(batch):
        import uuid

        for p in batch["prompt"]:
            open(f"{where}/{p}-{uuid.uuid4()}", "w").close()
        return pd.DataFrame({"text": "a " + batch["prompt"], "tokens_input": 1000, "tokens_output": 0})

    empty = spark.createDataFrame([], DS.EMPTY_CACHE)
    first = I.cached_inference(calls(spark, ["p", "q", "p"]), empty, fn, "id", partitions=2, floor=1)
    assert rows(first.results, "id", "text", "cost_usd", "spent_usd", "hit") == [
        (0, "a p", Decimal("0.005"), Decimal("0.005"), False), (1, "a q", Decimal("0.005"), Decimal("0.005"), False), (2, "a p", Decimal("0.005"), Decimal(0), False),
    ]
    assert len(list(log.iterdir())) == 2
    again = I.cached_inference(calls(spark, ["q", "p"]), first.new_cache, fn, "id")
    assert rows(again.results, "text", "cost_usd", "spent_usd", "hit") == [("a p", Decimal("0.005"), Decimal(0), True), ("a q", Decimal("0.005"), Decimal(0), True)]
    assert len(list(log.iterdir())) == 2 and again.new_cache.count() == 0
    forced = I.cached_inference(calls(spark, ["q"]), first.new_cache, fn, "id", bypass=True)
    assert forced.results.collect()[0]["spent_usd"] == Decimal("0.005")
    assert len(list(log.iterdir())) == 3


def test_one_bad_call_does_not_lose_or_repeat_the_others(spark, tmp_path):
    where = str(tmp_path)

    def fn(batch):
        import uuid

        for p in batch["prompt"]:
            open(f"{where}/{p}-{uuid.uuid4()}", "w").close()
        if "bad" in set(batch["prompt"]):
            raise RuntimeError("refused")
        return pd.DataFrame({"text": batch["prompt"], "tokens_input": 1, "tokens_output": 1})

    out = I.cached_inference(
        calls(spark, ["ok", "bad", "fine"]), spark.createDataFrame([], DS.EMPTY_CACHE), I.per_call(fn), "id", partitions=1
    )
    assert rows(out.results, "prompt", "text", "error", "tokens_input") == [("bad", None, "refused", 0), ("fine", "fine", None, 1), ("ok", "ok", None, 1)]
    assert rows(out.new_cache, "text") == [("fine",), ("ok",)]
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["bad", "fine", "ok"]
    lost = I.cached_inference(calls(spark, ["ok", "bad"]), spark.createDataFrame([], DS.EMPTY_CACHE), fn, "id", partitions=1)
    assert rows(lost.results, "error") == [("refused",), ("refused",)] and lost.new_cache.count() == 0


def test_store_keeps_answers_between_runs(spark, tmp_path):
    store = I.AnswerStore(spark, str(tmp_path / "answers"))
    assert [r["hit"] for r in I.call(calls(spark, ["p", "q"]), store, I.digest_model, "id").collect()] == [False, False]
    again = I.call(calls(spark, ["q", "r", "q"]), I.AnswerStore(spark, str(tmp_path / "answers")), I.digest_model, "id")
    assert rows(again, "prompt", "hit") == [("q", True), ("q", True), ("r", False)]
    store.add(store.read())
    assert store.read().count() == 3


def test_a_lookup_does_not_shuffle_the_store(spark, tmp_path):
    store = I.AnswerStore(spark, str(tmp_path / "it's"), buckets=8)
    answers = spark.range(5000).select(F.lit("call:m").alias("kind"), F.sha2(F.col("id").cast("string"), 256).alias("cache_key"), F.col("id").cast("string").alias("text"), F.lit(1).cast("decimal(10,6)").alias("cost_usd"))
    store.add(answers)
    store.add(answers.limit(1))
    asked = answers.where("text % 50 = 7").select("kind", "cache_key")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = store.lookup(asked)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(int(r["text"]) for r in found.collect()) == list(range(7, 5000, 50))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Aggregates stand above the join, and the only exchange is that of the keys that are asked for.
    join = plan.index("SortMergeJoin")
    below = plan[join:]
    assert below.count("Exchange") == 1 and "Aggregate" not in below and "Bucketed: true" in below
    assert "Exchange" not in below[below.index("Scan parquet"):].split("Exchange")[0] and plan[:join].count("Exchange") == 0
    assert len([p for p in (tmp_path / "it's").iterdir() if p.suffix == ".parquet"]) <= 9
    with pytest.raises(ValueError, match="power of two"):
        I.AnswerStore(spark, str(tmp_path / "x"), buckets=6)


def test_reserved_parameters_are_refused(spark):
    out = I.cached_inference(calls(spark, ["p"], '{"prompt": 1}'), spark.createDataFrame([], DS.EMPTY_CACHE), I.digest_model, "id")
    row = out.results.collect()[0]
    assert row["text"] is None and "reserved" in row["error"] and out.new_cache.count() == 0


def test_sample_is_the_same_for_the_same_seed(spark):
    words = spark.range(500).withColumnRenamed("id", "w")
    a, b = (rows(I.hash_sample(words.repartition(n), "w", 5, 20)) for n in (1, 9))
    assert a == b and a != rows(I.hash_sample(words, "w", 6, 20))
    with pytest.raises(ValueError):
        I.hash_sample(words, "w", 5, 201)


def test_experiment_tells_ok_from_valid(spark):
    answers = {"good": '{"meanings": []}', "odd": '{"other": 1}', "bad": "prose"}

    def fn(batch):
        return pd.DataFrame({"text": [answers[p.split()[0]] for p in batch["prompt"]], "tokens_input": 1, "tokens_output": 1})

    words = spark.createDataFrame([(i, w, None) for i, w in enumerate(answers)], "word_id bigint, form string, dict_summary string")
    out = I.run_experiment(words, spark.createDataFrame([], DS.EMPTY_CACHE), "{word} {dict_summary}", "m", fn, "paraphrase", 1, 10)
    assert rows(out, "form", "ok", "valid", F.col("error").isNull()) == [("bad", False, False, False), ("good", True, True, True), ("odd", True, False, True)]
    assert all(r["latency_ms"] >= 0 for r in out.collect())
    with pytest.raises(ValueError):
        I.validator("export")


@pytest.mark.parametrize(
    ("answer", "order"),
    [('{"order": [3, 1, 3, 9, "0"]}', [3, 1, 0, 2]), ('{"order": "x"}', [0, 1, 2, 3]), (None, [0, 1, 2, 3]), ('{"order": [1]}', [1, 0, 2, 3])],
)
def test_rerank(spark, answer, order):
    df = spark.createDataFrame([([0, 1, 2, 3], answer)], "m array<int>, a string").select("m", F.try_parse_json("a").alias("a"))
    assert df.select(I.rerank_meanings(F.col("m"), F.col("a")).alias("x")).collect()[0]["x"] == order


# --- stages -----------------------------------------------------------------


def word_stage(name, upstream, fail=()):
    def fn(df):
        bad = F.col("word_id").isin(list(fail) or [-1])
        return df.select("word_id", F.when(~bad, F.lit("{}")).alias("payload"), F.when(bad, "boom").alias("error"), F.lit(1).cast("decimal(10,6)").alias("cost_usd"))

    return S.Stage(name, upstream, fn)


def test_failed_words_leave_and_reruns_skip(spark):
    words = spark.createDataFrame([(1,), (2,), (3,)], "word_id bigint")
    empty = spark.createDataFrame([], DS.EMPTY_ARTIFACTS)
    stages = [word_stage("a", (), fail=[2]), word_stage("b", ("a",))]
    run = S.stage_chain(stages, words, empty)
    assert run.report == [("a", 2, 1, 0), ("b", 2, 0, 0)]
    assert rows(run.artifacts, "stage_name", "word_id") == [("a", 1), ("a", 3), ("b", 1), ("b", 3)]
    again = S.stage_chain([word_stage("a", ()), word_stage("b", ("a",))], words, run.artifacts)
    assert again.report == [("a", 1, 0, 2), ("b", 1, 0, 2)]
    done = S.stage_chain([word_stage("a", ()), word_stage("b", ("a",))], words, again.artifacts)
    assert done.report == [("a", 0, 0, 3), ("b", 0, 0, 3)] and done.ledger.count() == 0
    assert S.stage_chain([word_stage("a", ())], words, done.artifacts, force=True).report == [("a", 3, 0, 0)]


def test_budget_stops_the_chain(spark):
    words = spark.createDataFrame([(1,), (2,)], "word_id bigint")
    batches = spark.createDataFrame([("b", None, Decimal(2))], "id string, total_cost_usd decimal(12,6), budget_cap_usd decimal(12,6)")
    empty = spark.createDataFrame([], DS.EMPTY_ARTIFACTS)
    run = S.stage_chain([word_stage("a", ()), word_stage("b", ("a",))], words, empty, "b", batches)
    assert run.stopped_at == "b" and [r[0] for r in run.report] == ["a"]
    with pytest.raises(LookupError):
        S.stage_chain([word_stage("a", ())], words, empty, "typo", batches)


def test_missing_upstream_fails_the_word(spark):
    words = spark.createDataFrame([(1,)], "word_id bigint")
    run = S.run_stage(word_stage("b", ("a",)), words, spark.createDataFrame([], DS.EMPTY_ARTIFACTS))
    assert rows(run.ledger, "status", "error") == [("failed", "missing upstream artifact a")]


GOOD = {
    "paraphrase": {"meanings": [{"pos": "n", "cn": "一"}]}, "derivatives": {}, "mnemonic": {"mnemonic": "m"},
    "examples": {"per_meaning": [{"meaning_index": 0, "examples": [{"en": "e", "cn": "c"}]}]},
}


@pytest.mark.parametrize(
    ("stage", "payload", "messages"),
    [
        (None, None, []),
        ("paraphrase", {"meanings": []}, ["meanings_non_empty: paraphrase has 0 meanings"]),
        ("paraphrase", {"meanings": [{"pos": "n", "cn": ""}, {"cn": "x"}]}, ["each_meaning_has_cn: meaning[0] missing cn", "each_meaning_has_pos: meaning[1] missing pos"]),
        ("examples", {"per_meaning": [{"examples": []}]}, ["examples_coverage: no meaning has any example"]),
        ("mnemonic", {"mnemonic": None}, ["mnemonic_present: empty mnemonic"]),
    ],
)
def test_quality_gate(spark, stage, payload, messages):
    given = GOOD | ({stage: payload} if stage else {})
    df = spark.createDataFrame([tuple(json.dumps(given[s]) for s in S.GATED)], ", ".join(f"up_{s} string" for s in S.GATED))
    row = S.quality_gate(df).collect()[0]
    assert row["failed_rules"] == messages and row["passed"] == (not messages)


def test_dictionary_run_builds_rows(spark):
    entry = {"ec": {"word": [{"usphone": "g", "trs": [{"tr": [{"l": {"i": [f"n. 义{i}"], "sentence": [{"en": f"e{i}", "zh": "z"}]}} for i in range(4)]}]}]}}
    raw = spark.createDataFrame([(1, json.dumps(entry)), (2, "{}")], "word_id bigint, raw string")
    glossary = spark.createDataFrame([(2, [])], f"word_id bigint, meanings {DS.MEANINGS}")
    words = spark.createDataFrame([(1, "go", 1), (2, "no", 1), (3, "gone", 1)], "word_id bigint, form string, type smallint")
    stages = DS.dictionary_stages(raw, glossary, spark.createDataFrame([], DS.EMPTY_CACHE), DS.stub_model)
    run = S.stage_chain(stages, words, spark.createDataFrame([], DS.EMPTY_ARTIFACTS))
    assert [r[1:3] for r in run.report] == [(2, 1)] + [(2, 0)] * 7
    built = S.build_domain_rows(words, run.artifacts)
    assert rows(built["words"], "word_id", "phonetic_us") == [(1, "g"), (2, None)]
    # The reranker swaps the first two of four meanings.
    assert rows(built["meanings"].where("word_id = 1"), "meaning_index", "cn_paraphrase")[:2] == [(0, "义1"), (1, "义0")]
    assert built["meanings"].where("word_id = 2").count() == 1
    assert built["sentences"].where("translation IS NULL").count() == 0
    assert rows(built["refused"]) == [(3, "missing upstream artifact fetch_dict")]


def test_duplicate_indexes(spark):
    payloads = {
        "fetch_dict": {}, "phonetic": {}, "mnemonic": {"mnemonic": "m"}, "quality_gate": {"passed": True},
        "paraphrase": {"meanings": [{"pos": "n", "cn": "一"}]},
        "derivatives": {"per_meaning": [{"meaning_index": 0, "synonyms": ["first"]}, {"meaning_index": 0, "synonyms": ["second"]}]},
        "examples": {"per_meaning": [{"meaning_index": 0, "examples": [{"en": "old", "cn": "c"}]}, {"meaning_index": 0, "examples": [{"en": "new", "cn": "c"}]}, {"meaning_index": 7, "examples": [{"en": "x", "cn": "c"}]}]},
    }
    artifacts = spark.createDataFrame([(1, s, "f", json.dumps(p), "src", None, None) for s, p in payloads.items()], DS.EMPTY_ARTIFACTS)
    words = spark.createDataFrame([(1, "w", 1)], "word_id bigint, form string, type smallint")
    built = S.build_domain_rows(words, artifacts)
    assert built["meanings"].collect()[0]["synonyms"] == ["first"]
    assert rows(built["sentences"], "form") == [("new",)]


# --- review and edits -------------------------------------------------------


def entities(spark):
    meanings = spark.createDataFrame([(10, 1, "一", "one"), (20, 1, "二", "two")], "meaning_id bigint, word_id bigint, cn_paraphrase string, en_paraphrase string")
    sentences = spark.createDataFrame([(1, 10, "a", "A"), (2, 10, "b", "B"), (3, 20, "c", "C")], "sentence_id bigint, meaning_id bigint, form string, translation string")
    mnemonics = spark.createDataFrame([(1, 1, "hook")], "mnemonic_id bigint, word_id bigint, text string")
    return meanings, sentences, mnemonics


def patch(spark, *patches):
    data = [(1, i, *p) for i, p in enumerate(patches)]
    return spark.createDataFrame(data, "word_id bigint, seq int, op string, path string, old_value string, new_value string")


@pytest.mark.parametrize("fold_size", [1, 1000])
def test_patches_skip_drift(spark, fold_size, monkeypatch):
    monkeypatch.setattr(R.C.fold_changes, "__defaults__", (fold_size, 1_000_000))
    out = R.apply_patches_skip(*entities(spark), patch(
        spark,
        ("update", "meanings[0].cn_paraphrase", " 一 ", "壹"),
        ("update", "meanings[0].cn_paraphrase", "一", "x"),
        ("update", "meanings[0].cn_paraphrase", "壹", "弌"),
        ("update", "meanings[0].examples[1].cn", None, "BB"),
        (None, "mnemonic.text", "hook", "new"),
        ("delete", "meanings[1]", None, None),
        ("update", "meanings[1].en_paraphrase", "two", "x"),
        ("update", "meanings[1].examples[0].en", "c", "x"),
        ("delete", "meanings[0].examples[0]", None, None),
        ("update", "meanings[9].cn_paraphrase", "q", "x"),
        ("update", "words.form", None, "x"),
    ))
    got = [r["status"] for r in out["outcomes"].orderBy("seq").collect()]
    assert got == ["applied", "drift", "applied", "applied", "applied", "applied", "drift", "none", "applied", "none", "none"]
    assert rows(out["meanings"], "meaning_id", "cn_paraphrase") == [(10, "弌")]
    assert rows(out["sentences"], "sentence_id", "translation") == [(2, "BB")]
    assert rows(out["mnemonics"], "text") == [("new",)]


def test_review_of_a_large_word_edits_the_meaning_it_was_shown(spark):
    """A word of 2,000 meanings: the patch goes to the position of the whole word."""
    def reviewer(batch):
        fixed = json.dumps({"patches": [{"op": "update", "path": "meanings[1500].cn_paraphrase", "old_value": "c1500", "new_value": "mended"}]})
        issue = json.dumps({"issues": [{"path": "meanings[1500]", "issue": "dull"}]})
        texts = [fixed if json.loads(given)["checker"] == "fixer" else issue for given in batch["input_json"]]
        return pd.DataFrame({"text": texts, "tokens_input": 1, "tokens_output": 1})

    words = spark.createDataFrame([(1, "w", 1, 1, "none")], "word_id bigint, form string, type smallint, status smallint, quality_flag string")
    words = words.withColumns({c: F.lit(None).cast("string") for c in ("phonetic_us", "phonetic_uk", "audio_us", "audio_uk")})
    meanings = spark.range(2000).select(
        (F.col("id") + 10).alias("meaning_id"), F.lit(1).cast("bigint").alias("word_id"), F.concat(F.lit("c"), "id").alias("cn_paraphrase"), F.lit("e").alias("en_paraphrase"),
        F.lit(1).cast("smallint").alias("pos"), F.lit(None).cast("smallint").alias("pos_sub"),
    )
    sentences = spark.createDataFrame([], "sentence_id bigint, meaning_id bigint, form string, translation string")
    mnemonics = spark.createDataFrame([], "mnemonic_id bigint, word_id bigint, type smallint, kind string, text string")
    phrases = spark.createDataFrame([], "phrase_id bigint, owner_word_id bigint, form string, meaning string")
    packages = spark.createDataFrame([], "package_id bigint, unit_id bigint, word_id bigint, sort_order double, importance int")
    tables = {"words": words, "meanings": meanings, "sentences": sentences, "mnemonics": mnemonics, "phrases": phrases}
    out = R.review_words(words.select("word_id"), tables, packages, spark.createDataFrame([], DS.EMPTY_CACHE), reviewer, "m")
    assert rows(out["meanings"].where("cn_paraphrase = 'mended'"), "meaning_id") == [(1510,)] and out["meanings"].count() == 2000
    assert out["upsert"].count() == 1 and rows(out["records"], "issue_count", "applied") == [(5, 1)]


CHANGE = "word_id bigint, seq int, field_path string, target_id bigint, op string, old_value string, new_value string, editor_id bigint"


def test_strict_changes_are_all_or_nothing_per_word(spark):
    words = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1)), (2, "b", dt.datetime(2024, 1, 1))], "word_id bigint, form string, updated_at timestamp")
    meanings, *_ = entities(spark)
    changes = spark.createDataFrame([
        (1, 0, "words.form", None, "update", "a", "A", 7), (1, 1, "meanings.cn_paraphrase", 20, "update", "gone", "x", 7),
        (2, 0, "words.form", None, "update", "b", "B", 7), (2, 1, "words.form", None, "update", "B", "BB", 7), (2, 2, "meanings.cn_paraphrase", 10, "update", None, "壹", 7),
        (3, 0, "words.nothing", None, "update", None, "x", 7), (4, 0, "meanings.cn_paraphrase", 99, "update", None, "x", 7),
    ], CHANGE)
    out = E.apply_changes_strict({"words": words, "meanings": meanings}, changes, F.lit("2024-05-05").cast("timestamp"))
    assert rows(out["words"], "word_id", "form", F.year("updated_at") * 100 + F.month("updated_at")) == [(1, "a", 202401), (2, "BB", 202405)]
    assert rows(out["meanings"], "cn_paraphrase") == [("二",), ("壹",)]
    assert rows(out["refused"]) == [(1, 1, "drift"), (3, 0, "unknown field_path"), (4, 0, "row not found")]
    assert rows(out["audit"], "word_id", "field_path", "target_id") == [(2, "meanings.cn_paraphrase", 10), (2, "words.form", None), (2, "words.form", None)]


def test_field_diff_sees_nulls(spark):
    meanings, *_ = entities(spark)
    after = meanings.withColumn("en_paraphrase", F.when(F.col("meaning_id") == 10, None).otherwise(F.col("en_paraphrase")))
    assert rows(E.field_diff(meanings, after, "meanings")) == [("meanings.en_paraphrase", 10, "one", None)]


def test_checkers_take_unparseable_for_no_issue(spark):
    def fn(batch):
        return pd.DataFrame({"text": ["{bad" if "mnemonic" in p else '{"issues": [{"path": "p", "issue": "i"}, 3]}' for p in batch["prompt"]], "tokens_input": 1, "tokens_output": 1})

    blobs = spark.createDataFrame([(1, "{}")], "word_id bigint, blob string")
    out = {r["checker"]: r["issues"] for r in R.run_checkers(blobs, spark.createDataFrame([], DS.EMPTY_CACHE), fn, "m").collect()}
    assert out.pop("mnemonic") == [] and all(json.loads(i[0]) == {"from": c, "issue": "i", "path": "p"} for c, i in out.items()) and len(out) == 4


def test_registered_stages_run_in_their_order(spark, monkeypatch):
    monkeypatch.setattr(S, "_STAGES", {})
    for name in ("export", "extra", "fetch_dict"):
        S.register_stage(word_stage(name, ()))
    assert [s.name for s in S.registered_stages()] == ["fetch_dict", "export", "extra"]


def test_registered_rule_joins_the_gate(spark, monkeypatch):
    monkeypatch.setattr(S, "_RULES", dict(S._RULES))
    S.register_rule("short", lambda up: F.when(F.length(F.to_json(up["mnemonic"])) < 99, F.array(F.lit("too short"))).otherwise(F.array().cast("array<string>")))
    df = spark.createDataFrame([tuple(json.dumps(GOOD[s]) for s in S.GATED)], ", ".join(f"up_{s} string" for s in S.GATED))
    assert S.quality_gate(df).collect()[0]["failed_rules"] == ["short: too short"]


# --- streams ----------------------------------------------------------------


def test_stalls(spark):
    times = [dt.datetime(2024, 1, 1, 0, 0, s) for s in (0, 50)] + [dt.datetime(2024, 1, 1, 0, m) for m in (3, 6, 10)]
    out = J.stalls(spark.createDataFrame([(x,) for x in times], "started_at timestamp_ntz").repartition(3))
    assert rows(out) == [(dt.datetime(2024, 1, 1, 0, 6), dt.datetime(2024, 1, 1, 0, 10))]


def test_stream_ingest_keeps_the_first_spelling_over_batches(spark, tmp_path):
    for n, lines in enumerate([["Apple 1", "pear 2"], ["APPLE 3", "Fig 4", " 5"]]):
        path = tmp_path / f"{n}.csv"
        path.write_text("\n".join(f"{line.rsplit(' ', 1)[0]},{line.rsplit(' ', 1)[1]}" for line in lines) + "\n")
        import os

        os.utime(path, (1000 + n, 1000 + n))
    stream = spark.readStream.schema("raw_form string, line_no bigint").option("maxFilesPerTrigger", 1).csv(str(tmp_path))
    assert rows(J.stream_ingest(stream, "line_no"), "normalized_form", "raw_form") == [("apple", "Apple"), ("fig", "Fig"), ("pear", "pear")]


def test_stream_dead_letters_over_batches(spark, tmp_path):
    schema = "word_id bigint, stage_name string, id bigint, at timestamp_ntz, resolves boolean"
    events = [(1, "s", i, dt.datetime(2024, 1, 1, 0, i), i == 5) for i in range(12)]
    for n in range(0, 12, 4):
        spark.createDataFrame(events[n:n + 4], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "e"))
    out = J.run_available(J.stream_dead_letters(stream), "t")
    # The third failure, then, after the resolution at minute 5, the third one again.
    assert rows(out, "id", "attempt") == [(2, 3), (8, 3)]


def test_repair_is_python_only_for_failures():
    assert N.repair_json("x [1, 2] y") == ("[1, 2]", "extracted")
    assert N.repair_json("none") is None


def test_streams_go_on_after_a_stop(spark, tmp_path):
    """Stopped after one of three files and started again, a stream equals the batch."""
    src, roots = tmp_path / "in", {k: str(tmp_path / k) for k in ("ingest", "cost")}
    src.mkdir()
    spelled = [["Apple,1", "fig,2"], ["APPLE,3", "Pear,4"], ["PEAR,5", "Fig,6", "plum,7"]]
    batches = spark.createDataFrame([("b", None)], "id string, budget_cap_usd decimal(12,6)")

    def run():
        lines = spark.readStream.schema("raw_form string, line_no bigint").option("maxFilesPerTrigger", 1).csv(str(src))
        cost = lines.select(F.lit("ok").alias("status"), F.lit("b").alias("batch_id"), F.col("line_no").cast("decimal(10,6)").alias("cost_usd"))
        return (
            rows(J.stream_ingest(lines, "line_no", root=roots["ingest"]), "normalized_form", "raw_form"),
            rows(J.stream_batch_cost(cost, batches, root=roots["cost"]), "batch_id", "spent"),
        )

    (src / "0.csv").write_text("\n".join(spelled[0]))
    assert run() == ([("apple", "Apple"), ("fig", "fig")], [("b", Decimal(3))])
    for i in (1, 2):
        (src / f"{i}.csv").write_text("\n".join(spelled[i]))
        os.utime(src / f"{i}.csv", (4_000_000_000 + i,) * 2)  # files are taken in the order of their times
    want = [("apple", "Apple"), ("fig", "fig"), ("pear", "Pear"), ("plum", "plum")]
    assert run() == (want, [("b", Decimal(28))])
    assert run() == (want, [("b", Decimal(28))])  # nothing new arrived


# --- errors stay visible ----------------------------------------------------


def test_failed_checks_do_not_make_clean_words(spark):
    def down(batch):
        raise RuntimeError("no connection")

    blobs = spark.createDataFrame([(1, "f", "{}")], "word_id bigint, form string, blob string")
    cache = spark.createDataFrame([], DS.EMPTY_CACHE)
    checked = R.run_checkers(blobs, cache, down, "gpt-5")
    assert {r["error"] for r in checked.collect()} == {"no connection"}
    gathered = R.gather_issues(checked)
    proposed = R.propose_patches(gathered.join(blobs, "word_id"), cache, down, "gpt-5")
    outcomes = spark.createDataFrame([], "word_id bigint, status string")
    records = R.review_records(blobs, gathered, proposed, outcomes)
    assert "no connection" in records.collect()[0]["error"] and R.reviewed(records).count() == 0
    asked = gathered.withColumn("issues", F.array(F.lit("{}"))).join(blobs, "word_id")
    assert R.propose_patches(asked, cache, down, "gpt-5").collect()[0]["fix_error"] == "no connection"


def test_a_rerun_records_no_second_dead_letter(spark):
    words = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "word_id bigint, form string, type int")
    artifacts = spark.createDataFrame([], DS.EMPTY_ARTIFACTS)
    letters = spark.createDataFrame([], "id bigint, word_id bigint, stage_name string, error string, attempt int, created_at timestamp, resolved_at timestamp")
    history = None
    for attempt in range(1, 6):
        now = F.lit(f"2024-01-0{attempt}").cast("timestamp")
        run = S.stage_chain([word_stage("a", (), {2})], words, artifacts, now=now, history=history, dead_letters=letters, force=True)
        ledger = run.ledger.withColumn("id", F.lit(attempt).cast("bigint"))
        history = ledger if history is None else history.unionByName(ledger)
        letters = spark.createDataFrame(run.dead_letters.collect(), letters.schema)
        assert letters.count() == (1 if attempt >= 3 else 0)
    resolved = letters.withColumn("resolved_at", F.lit("2024-01-06").cast("timestamp"))
    quiet = S.stage_chain([word_stage("a", ())], words, artifacts, now=F.lit("2024-01-07").cast("timestamp"), history=history, dead_letters=resolved)
    assert quiet.dead_letters.count() == 1

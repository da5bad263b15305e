import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lexmill.operators import documents as D
from lexmill.operators import ledger as G
from lexmill.operators import mirror as M
from lexmill.operators import nesting, numbering
from lexmill.operators import search as S
from lexmill.operators import tables as O
from lexmill.sources import writers as W


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


WORDS = "id bigint, raw_form string, normalized_form string, type smallint"


def test_insert_ignore_keeps_the_first_spelling_and_is_idempotent(spark):
    lines = spark.createDataFrame(
        [(1, "Apple"), (2, " "), (3, "APPLE"), (4, "give up"), (5, "pear"), (6, "Pear ")], "line_no bigint, raw_form string"
    ).repartition(4)
    current = spark.createDataFrame([(7, "x", "pear", 1)], WORDS)
    new = O.insert_ignore(current, lines, ["line_no"])
    assert rows(new) == [(8, "Apple", "apple", 1), (9, "give up", "give up", 2)]
    assert rows(O.insert_outcome(current, lines)) == [(2, 3, 1)]
    assert O.insert_ignore(current.unionByName(new), lines, ["line_no"]).count() == 0


def test_upsert_is_last_write_wins_and_idempotent(spark):
    current = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k bigint, v string, n int")
    changes = spark.createDataFrame([(1, "x", 5), (1, None, 6), (3, "z", 1)], "k bigint, v string, seq int")
    out = O.upsert_by_key(current, changes, ["k"], ["seq"])
    assert rows(out) == [(1, None, 1), (2, "b", 2), (3, "z", None)]
    assert rows(O.upsert_by_key(out, changes, ["k"], ["seq"])) == rows(out)


def test_guarded_upsert(spark):
    schema = "word_id bigint, form string, type smallint, source string, status smallint"
    current = spark.createDataFrame([(1, "a", 1, "pipeline:x", 2), (2, "b", 1, "human:web", 0), (4, "d", 1, "pipeline:x", 1)], schema)
    incoming = spark.createDataFrame([(f, 1, "pipeline:y") for f in "abc"], "form string, type smallint, source string")
    out = O.guarded_upsert(current, incoming)
    assert rows(out, "form", "source", "status", "action") == [
        ("a", "pipeline:y", 2, "update"), ("b", "human:web", 0, "refused"), ("c", "pipeline:y", 1, "insert"), ("d", "pipeline:x", 1, "kept"),
    ]
    assert rows(O.assign_ids(out, "word_id", ["form"], 4), "word_id", "form")[-1][0] == 5


def test_cascade_spares_other_origins(spark):
    tables = {
        "meanings": spark.createDataFrame([(1, 1, "pipeline:x"), (2, 1, "human:web"), (3, 2, "pipeline:x")], "meaning_id bigint, word_id bigint, source string"),
        "sentences": spark.createDataFrame([(1, 1, "human:web"), (2, 2, "pipeline:x"), (3, 3, "pipeline:x")], "sentence_id bigint, meaning_id bigint, source string"),
        "mnemonics": spark.createDataFrame([(1, 1, "pipeline:x"), (2, 1, None)], "mnemonic_id bigint, word_id bigint, source string"),
        "phrases": spark.createDataFrame([(1, 1, "pipeline:x")], "phrase_id bigint, owner_word_id bigint, source string"),
    }
    out = O.cascade_delete(spark.createDataFrame([(1,)], "word_id bigint"), tables)
    assert rows(out["meanings"], "meaning_id") == [(2,), (3,)]
    assert rows(out["sentences"], "sentence_id") == [(2,), (3,)]
    assert out["phrases"].count() == 0


def test_remap_twice_changes_nothing(spark):
    once = O.remap_ids({"t": (spark.createDataFrame([(5,), (150,)], "id bigint"), "id")}, 100, 100)["t"]
    assert rows(once) == [(5,), (50,)]
    assert rows(O.remap_ids({"t": (once, "id")}, 100, 100)["t"]) == rows(once)


def test_prune_and_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 5, 9)], "created_at timestamp")
    kept, deleted = O.prune_older_than(df, 5, F.lit("2024-01-10").cast("timestamp"))
    assert kept.count() == 2 and deleted.collect()[0]["deleted"] == 1
    assert O.parse_days("0d") == 0
    for bad in ("5", "d", "-1d", "2h"):
        with pytest.raises(ValueError):
            O.parse_days(bad)


def test_versions(spark):
    versions = spark.createDataFrame([(1, "p", 1, "a", "m"), (2, "p", 2, "b", "m")], "id bigint, parent_id string, version bigint, content string, model string")
    heads = spark.createDataFrame([("p", 2), ("q", None)], "parent_id string, current_version_id bigint")
    edit = spark.createDataFrame([("p", "c", None)], "parent_id string, content string, model string")
    heads2, versions2 = O.save_version(heads, versions, edit)
    assert rows(O.current_versions(heads2, versions2), "version", "content", "model") == [(3, "c", "m")]
    back, absent = O.rollback_version(heads2, versions2, spark.createDataFrame([("p", 1), ("q", 9)], "parent_id string, version bigint"))
    assert rows(back) == [("p", 1), ("q", None)] and rows(absent) == [("q", 9)]
    assert rows(O.version_history(versions2), "version", "rank") == [(1, 3), (2, 2), (3, 1)]
    assert rows(O.next_version(heads, versions)) == [("p", 3), ("q", 1)]


# --- hot parents ------------------------------------------------------------


@pytest.mark.parametrize("floor", [10, 10**6])
def test_positions_do_not_depend_on_hot_parents(spark, floor):
    df = spark.range(1000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"), F.xxhash64("id").alias("o")).repartition(7)
    got = {(r["k"], r["o"]): r["p"] for r in numbering.position_in_parent(df, ["k"], ["o"], "p", floor).collect()}
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r["k"], []).append(r["o"])
    assert got == {(k, o): i for k, os in by_key.items() for i, o in enumerate(sorted(os))}


def test_number_rows_over_many_partitions(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("o")).repartition(13)
    got = [r["n"] for r in numbering.number_rows(df, ["o"], "n", 11).orderBy("o").collect()]
    assert got == list(range(11, 5011))


@pytest.mark.parametrize("floor", [10, 10**6])
def test_nested_parts_hold_everything_in_order(spark, floor):
    df = spark.range(300).select(F.when(F.col("id") < 200, 1).otherwise(F.col("id")).alias("k"), "id").repartition(5)
    parts = nesting.nest_children(df, ["k"], ["id"], F.col("id"), "ids", part_size=30, floor=floor).collect()
    assert max(len(p["ids"]) for p in parts) == 30
    big = [i for p in sorted((p for p in parts if p["k"] == 1), key=lambda p: p["part_no"]) for i in p["ids"]]
    assert big == list(range(200))
    assert sum(len(p["ids"]) for p in parts) == 300


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_to_parent_with_hot_keys(spark, how):
    child = spark.range(200).select((F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 50)).alias("k"), "id")
    parent = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = rows(child.join(parent, "k", how))
    assert rows(numbering.join_to_parent(child, parent, ["k"], how, floor=20)) == plain


# --- ledger -----------------------------------------------------------------

LEDGER = "id bigint, batch_id string, word_id bigint, stage_name string, status string, cost_usd decimal(10,6), error string, started_at timestamp"
RESOLVED = "word_id bigint, stage_name string, resolved_at timestamp"


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def failures(spark, word, *minutes):
    return [(word * 100 + m, "b", word, "s", "failed", None, "e", at(m)) for m in minutes]


def test_third_failure_fires_once(spark):
    ledger = spark.createDataFrame(failures(spark, 1, 1) + failures(spark, 3, 1, 2, 3) + failures(spark, 5, 1, 2, 3, 4, 5), LEDGER)
    none = spark.createDataFrame([], RESOLVED)
    assert rows(G.third_failure(ledger, none), "word_id", "id") == [(3, 303), (5, 503)]
    replayed = spark.createDataFrame([(3, "s", at(3)), (5, "s", at(2))], RESOLVED)
    assert rows(G.third_failure(ledger, replayed), "word_id", "id") == [(5, 505)]
    assert rows(G.failures_since_resolution(ledger, replayed), "word_id", "failures") == [(1, 1), (3, 0), (5, 3)]


def test_budget(spark):
    batches = spark.createDataFrame(
        [("under", None, Decimal(5)), ("nocap", Decimal(9), None), ("at", Decimal(3), Decimal(5))], "id string, total_cost_usd decimal(12,6), budget_cap_usd decimal(12,6)"
    )
    spent = spark.createDataFrame([(1, b, 1, "s", st, Decimal(2), None, at(1)) for b, st in (("at", "ok"), ("under", "ok"), ("nocap", "failed"), ("typo", "ok"))], LEDGER)
    now, unknown = G.add_batch_cost(batches, spent)
    assert rows(now, "id", F.col("total_cost_usd").cast("int")) == [("at", 5), ("nocap", 9), ("under", 2)]
    assert rows(unknown) == [("typo",)]
    asked = spark.createDataFrame([("under",), ("nocap",), ("at",), ("typo",), (None,)], "batch_id string")
    verdicts = {r["batch_id"]: r["verdict"] for r in G.budget_gate(asked, now).collect()}
    assert verdicts == {"under": "pass", "nocap": "pass", "at": "blocked", "typo": "unknown", None: "pass"}


def test_replay(spark):
    dead = spark.createDataFrame([(1, 1, "s", None), (2, 1, "t", at(1)), (3, 2, "s", None)], "id bigint, word_id bigint, stage_name string, resolved_at timestamp")
    words = spark.createDataFrame([(1, "failed"), (2, "failed")], "id bigint, status string")
    out = G.replay(dead, words, spark.createDataFrame([(1,), (9,)], "word_id bigint"))
    assert rows(out["resolved"]) == [(1, 1)] and rows(out["unknown"]) == [(9,)]
    assert rows(out["words"]) == [(1, "new"), (2, "failed")]
    assert rows(G.open_items(out["dead_letters"]), "id") == [(3,)]


def test_stage_plan(spark):
    words = spark.createDataFrame([(i, "b", f"w{i:02d}") for i in range(14)], "id bigint, batch_id string, normalized_form string")
    artifacts = spark.createDataFrame([(0, "s", "f"), (1, "s", "g"), (2, "other", "f")], "word_id bigint, stage_name string, fingerprint string")
    expected = spark.createDataFrame([(i, "s", "f") for i in range(14)], "word_id bigint, stage_name string, fingerprint string")
    row = G.stage_plan(words, artifacts, expected, {"s": 0.5}).collect()[0]
    assert (row["candidates"], row["has_artifact"], row["stale"], row["needs_rerun"], float(row["estimated_cost_usd"])) == (14, 2, 1, 12, 6.0)
    assert row["sample_forms"] == [f"w{i:02d}" for i in range(2, 12)]


# --- documents, search, mirror ----------------------------------------------


def entity_tables(spark):
    words = spark.createDataFrame(
        [(1, 1, "go", "u", None, None, None, 1, None, "pipeline:x"), (2, 1, "no", None, None, None, None, 0, "none", "pipeline:x"), (3, 1, "hi", None, None, None, None, 2, "none", "pipeline:x")],
        "word_id bigint, type smallint, form string, phonetic_us string, phonetic_uk string, audio_us string, audio_uk string, status smallint, quality_flag string, source string",
    )
    meanings = spark.createDataFrame([(5, 1, 1, None, "一；二", "en"), (4, 1, 99, None, None, None)], "meaning_id bigint, word_id bigint, pos smallint, pos_sub smallint, cn_paraphrase string, en_paraphrase string")
    sentences = spark.createDataFrame([(i, 5, f"s{i}", "t") for i in (3, 1, 2)], "sentence_id bigint, meaning_id bigint, form string, translation string")
    mnemonics = spark.createDataFrame([(2, 1, 1, "k", "late"), (1, 1, 1, "k", "early")], "mnemonic_id bigint, word_id bigint, type smallint, kind string, text string")
    phrases = spark.createDataFrame([(1, 1, "p", "m")], "phrase_id bigint, owner_word_id bigint, form string, meaning string")
    packages = spark.createDataFrame([(1, 2, 1, 2.0, 1), (1, 1, 1, 1.0, 1)], "package_id bigint, unit_id bigint, word_id bigint, sort_order double, importance int")
    return words, meanings, sentences, mnemonics, phrases, packages


def test_serving_payload(spark):
    import json

    tables = entity_tables(spark)
    out = D.serving_payload(*tables).collect()
    assert [r["word_id"] for r in out] == [1]
    doc = json.loads(out[0]["payload"])
    assert [m["meaning_id"] for m in doc["meanings"]] == [4, 5]
    assert [s["sentence_id"] for s in doc["meanings"][1]["sentences"]] == [1, 2, 3]
    assert doc["mnemonic"]["content"]["text"] == "early" and doc["quality_flag"] == "none"
    assert [p["unit_id"] for p in doc["packages"]] == [1, 2]


@pytest.mark.parametrize("floor", [1_000_000, 1])
def test_a_word_is_one_document_whatever_its_size(spark, floor):
    import json

    words, _, _, mnemonics, phrases, packages = entity_tables(spark)
    meanings = spark.range(5000).select(
        F.col("id").alias("meaning_id"), F.when(F.col("id") % 100 == 7, 3).otherwise(1).cast("bigint").alias("word_id"), F.lit(1).cast("smallint").alias("pos"),
        F.lit(None).cast("smallint").alias("pos_sub"), F.concat(F.lit("a；b "), "id").alias("cn_paraphrase"), F.lit('q"uote').alias("en_paraphrase"),
    )
    sentences = spark.range(3000).select(
        F.col("id").alias("sentence_id"), F.when(F.col("id") < 2500, 5).otherwise(F.col("id") - 2500).cast("bigint").alias("meaning_id"), F.lit("s").alias("form"), F.lit("t").alias("translation")
    )
    mine = [i for i in range(5000) if i % 100 != 7]
    below = {5: [*range(2500), 2505]} | {i: [2500 + i] for i in range(500) if i != 5}
    out = D.serving_payload(words, meanings, sentences, mnemonics, phrases, packages, fragments_at_once=300, floor=floor).collect()
    doc = json.loads(out[0]["payload"])
    assert len(out) == 1 and [m["meaning_id"] for m in doc["meanings"]] == mine
    assert all([x["sentence_id"] for x in m["sentences"]] == below.get(m["meaning_id"], []) for m in doc["meanings"])
    assert list(doc) == ["form", "type", "status", "quality_flag", "phonetic", "meanings", "mnemonic", "phrases", "packages"]
    assert doc["mnemonic"]["content"]["text"] == "early" and len(doc["packages"]) == 2 and len(doc["phrases"]) == 1
    packed = {r["word_id"]: json.loads(r["word_json"]) for r in D.package_entry(words, meanings, sentences, mnemonics, floor=floor).collect()}
    assert [m["id"] for m in packed[1]["meanings"]] == mine and packed[1]["meanings"][0]["phonetic_us"] == {"form": "u", "audio": ""}
    assert packed[2]["meanings"] == [] and len(packed[3]["meanings"]) == 50 and [m["content"] for m in packed[1]["mnemonics"]] == ["early", "late"]
    blobs = {r["word_id"]: (r["blob"], r["truncated"]) for r in D.review_blob(words, meanings, sentences, mnemonics, floor=floor).collect()}
    assert len(blobs) == 3 and blobs[1][1] and '"meaning_id":2,' in blobs[1][0] and json.loads(blobs[2][0])["meanings"] == []


def test_hot_null_keys_are_split(spark):
    from lexmill.operators import numbering

    rows = spark.createDataFrame([(None, i) for i in range(50)] + [(1, i) for i in range(60)] + [(2, 0)], "k int, v int").repartition(4)
    cold, hot, _ = numbering.split_hot(rows, ["k"], floor=10)
    assert cold.count() == 1 and hot.count() == 110
    placed = numbering.position_in_parent(rows, ["k"], ["v"], floor=10).collect()
    assert len(placed) == 111 and all(r["position"] == r["v"] for r in placed)


def test_package_entry(spark):
    import json

    words, meanings, sentences, mnemonics, *_ = entity_tables(spark)
    docs = {r["word_id"]: json.loads(r["word_json"]) for r in D.package_entry(words, meanings, sentences, mnemonics).collect()}
    assert docs[2] == {"id": 2, "type": 1, "form": "no", "phonetic_us": {"form": "", "audio": ""}, "phonetic_uk": {"form": "", "audio": ""}, "meanings": [], "mnemonics": []}
    last = docs[1]["meanings"][1]
    assert (last["pos_en"], last["pos_meanings"], last["phonetic_us"]["form"]) == ("n.", ["一", "二"], "u")
    assert docs[1]["meanings"][0]["pos_cn"] == "" and docs[1]["mnemonics"][0]["creator"] == {}


def test_pages_concatenate(spark):
    df = spark.range(23).select("id", (F.col("id") % 5).cast("int").alias("u"))
    seen, after = [], None
    while True:
        page = S.keyset_page(df, "u", "id", 4, after).collect()
        seen += page[:4]
        if len(page) <= 4:
            break
        after = (page[3]["u"], page[3]["id"])
    assert [(r["u"], r["id"]) for r in seen] == sorted(((i % 5, i) for i in range(23)), reverse=True)
    with pytest.raises(ValueError):
        S.keyset_page(df, "u", "id", 500)


def test_checksums_ignore_order_and_see_duplicates(spark):
    a = spark.createDataFrame([(i, f"f{i}") for i in range(50)], "phrase_id bigint, form string")
    twice = a.unionByName(a.where("phrase_id < 2")).unionByName(a.where("phrase_id < 2"))
    out = M.table_checksums({"phrase": (a, a.orderBy(F.rand()))}).collect()[0]
    assert not out["drift"]
    out = M.table_checksums({"phrase": (twice, a.unionByName(a.where("phrase_id < 2")).unionByName(a.where("phrase_id between 2 and 3")))}).collect()[0]
    assert out["drift"] and out["source_count"] == out["target_count"]


def test_mirror_publishes_all_or_nothing(spark, tmp_path):
    snaps = W.Snapshots(spark, str(tmp_path / "m"))
    words, meanings, sentences, mnemonics, phrases, _ = entity_tables(spark)
    source = F.lit("x").alias("source")
    sources = {"word": words, "meaning": meanings, "sentence": sentences, "mnemonic": mnemonics, "phrase": phrases}
    tables = M.mirror_tables(
        words, meanings.select("*", source), sentences.select("*", source), mnemonics.select("*", source), phrases, F.struct("kind", "text")
    )
    assert all(r["published"] for r in W.mirror_refresh(snaps, tables, sources).collect())
    first = snaps.current()
    assert not any(r["published"] for r in W.mirror_refresh(snaps, tables, sources, dry_run=True).collect())
    assert snaps.current() == first and all(p.startswith(str(tmp_path)) for p in first.values())
    lost = W.mirror_refresh(snaps, tables | {"sentence": tables["sentence"].limit(0)}, sources).collect()
    assert [r["table_name"] for r in lost if not r["same"]] == ["sentence"] and not any(r["published"] for r in lost)
    assert snaps.current() == first
    word = snaps.read("word").where("word_id = 1").collect()[0]
    assert (word["meanings"], word["phonetic_uk"], word["plural"]) == ('[{"id":4},{"id":5}]', "", None)
    assert snaps.read("word").where("word_id = 2").collect()[0]["meanings"] is None


def test_mirror_overflow_keeps_long_lists(spark, monkeypatch):
    import json

    monkeypatch.setattr(M, "PART_SIZE", 1000)
    children = spark.range(2500).select(F.lit(1).alias("word_id"), F.col("id").alias("meaning_id"))
    rest = M.mirror_overflow(children, "meanings", "word_id", "meaning_id").orderBy("part_no").collect()
    assert [len(json.loads(r["ids"])) for r in rest] == [1000, 500]


# --- cases that once went wrong ---------------------------------------------


def test_indented_glossary_and_broken_lines(spark, tmp_path):
    from lexmill.sources import readers as Rd

    (tmp_path / "one.json").write_text('{\n  "cat": [{"pos": "n", "cn": "(x) 猫", "en": "<b>cat</b>"}],\n  "dog": []\n}')
    (tmp_path / "lines.json").write_text('{"owl": [{"pos": "n", "cn": "o", "en": null}]}\n{"bad\n')
    got = {r["word"]: r["meanings"][0]["cn"] for r in Rd.read_glossary(spark, str(tmp_path)).collect()}
    assert got == {"cat": "猫", "owl": "o"}
    assert [(r["at"], r["value"]) for r in Rd.glossary_errors(spark, str(tmp_path)).collect()] == [(1, '{"bad')]


def test_upsert_takes_one_row_per_key(spark):
    words = spark.createDataFrame([(1, "a", 1, "pipeline:x", 2)], "word_id bigint, form string, type int, source string, status smallint")
    new = spark.createDataFrame([("a", 1, "pipeline:b"), ("a", 1, "pipeline:a"), ("n", 1, "pipeline:c"), ("n", 1, "pipeline:d")], "form string, type int, source string")
    out = {r["form"]: (r["source"], r["action"]) for r in O.guarded_upsert(words, new).collect()}
    assert out == {"a": ("pipeline:b", "update"), "n": ("pipeline:d", "insert")}
    assert O.guarded_upsert(words, new).count() == 2


def test_rows_without_time_or_source_stay(spark):
    rows = spark.createDataFrame([(1, "2020-01-01"), (2, None)], "id int, at string").withColumn("created_at", F.col("at").cast("timestamp"))
    kept, gone = O.prune_older_than(rows, 30, F.lit("2024-01-01").cast("timestamp"))
    assert [r["id"] for r in kept.collect()] == [2] and gone.collect()[0]["deleted"] == 1
    child = "word_id bigint, source string"
    tables = {
        "meanings": spark.createDataFrame([(7, 1, None), (8, 1, "pipeline:x")], "meaning_id bigint, " + child),
        "sentences": spark.createDataFrame([(7,), (8,)], "meaning_id bigint"),
        "mnemonics": spark.createDataFrame([(1, None), (1, "pipeline:x")], child),
        "phrases": spark.createDataFrame([(1, None)], "owner_word_id bigint, source string"),
    }
    left = O.cascade_delete(spark.createDataFrame([(1,)], "word_id bigint"), tables)
    assert {k: v.count() for k, v in left.items()} == {"meanings": 1, "sentences": 1, "mnemonics": 1, "phrases": 1}


def test_edits_refuse_bad_values_of_their_word_only(spark):
    from lexmill.operators import edits as E

    words = spark.createDataFrame([(1, "a", 1, "none"), (2, "b", 1, "none"), (3, "c", 1, "none")], "word_id bigint, form string, status smallint, quality_flag string")
    change = "word_id bigint, seq int, field_path string, target_id bigint, op string, old_value string, new_value string, editor_id int"
    asked = [(1, 0, "words.status", None, "update", None, "abc", 1), (2, 0, "words.status", None, "update", None, "9", 1), (3, 0, "words.status", None, "update", None, "2", 1)]
    asked += [(3, 1, "words.quality_flag", None, "update", None, "fixed", 1), (2, 1, "words.form", None, "update", None, "z", 1)]
    out = E.apply_changes_strict({"words": words}, spark.createDataFrame(asked, change))
    assert {r["word_id"]: (r["form"], r["status"], r["quality_flag"]) for r in out["words"].collect()} == {1: ("a", 1, "none"), 2: ("b", 1, "none"), 3: ("c", 2, "fixed")}
    assert {(r["word_id"], r["reason"]) for r in out["refused"].collect()} == {(1, "value not allowed"), (2, "value not allowed")}


def test_entries_with_a_wrong_index_are_refused_and_highlights_kept(spark):
    from lexmill.operators import edits as E

    meaning = "array<struct<pos:int,cn_paraphrase:string,en_paraphrase:string>>"
    sentence = "array<struct<meaning_index:int,form:string,translation:string,highlight:array<string>>>"
    entry = f"entry_id bigint, form string, type int, phonetic_us string, phonetic_uk string, editor_id int, meanings {meaning}, sentences {sentence}, mnemonics array<struct<type:int,text:string>>, phrases array<struct<form:string,meaning:string>>"
    one = [(1, "c", "e")]
    asked = [(1, "good", 1, None, None, 5, one, [(0, "s", "t", ["h"])], [], []), (2, "bad", 1, None, None, 5, one, [(1, "s", "t", [])], [], [])]
    tables = {n: spark.createDataFrame([], f"{k} bigint, form string, type int") for n, (k, _) in E.EDITABLE.items()}
    out = E.create_entries(tables, spark.createDataFrame(asked, entry))
    assert [r["form"] for r in out["words"].collect()] == ["good"]
    assert [(r["form"], r["highlight"]) for r in out["sentences"].collect()] == [("s", ["h"])]
    assert [(r["entry_id"], r["reason"]) for r in out["refused"].collect()] == [(2, "meaning_index out of range")]


def test_answers_that_are_no_json_have_an_error(spark):
    from lexmill.functions import nested as Ns

    texts = ['{"a": NaN}', "x [1, 2] y", "[" * 3000 + "1", '{"a": 1}']
    out = Ns.parse_model_json(spark.createDataFrame([(t,) for t in texts], "t string"), "t").collect()
    assert [(r["method"], r["error"] is None) for r in out] == [(None, False), ("extracted", True), (None, False), ("plain", True)]


def test_package_has_one_line_per_word(spark, tmp_path):
    entries = spark.createDataFrame([(2, "c"), (1, "a")], "word_id bigint, word_json string")
    W.export_packaged_json(entries, str(tmp_path / "p"))
    back = spark.read.schema("word_id bigint, word_json string").json(str(tmp_path / "p"))
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "c")]


def test_export_twice_updates_what_it_inserted(spark):
    from lexmill.operators import export as X

    child = "source string"
    tables = {
        "words": spark.createDataFrame([(5, "h", 1, "human:web", 1, "none")], "word_id bigint, form string, type smallint, source string, status smallint, quality_flag string"),
        "meanings": spark.createDataFrame([], f"meaning_id bigint, word_id bigint, cn_paraphrase string, {child}"),
        "sentences": spark.createDataFrame([], f"sentence_id bigint, meaning_id bigint, form string, translation string, {child}"),
        "mnemonics": spark.createDataFrame([], f"mnemonic_id bigint, word_id bigint, text string, {child}"),
        "phrases": spark.createDataFrame([], f"phrase_id bigint, owner_word_id bigint, form string, {child}"),
    }

    def made(cn):
        names = spark.createDataFrame([(1, "n", 1, "pipeline:a"), (2, "n", 1, "pipeline:b"), (3, "h", 1, "pipeline:a")], "word_id bigint, form string, type smallint, source string")
        meanings = spark.createDataFrame([(w, i, f"{cn}{w}{i}", "pipeline:a") for w in (1, 2, 3) for i in (0, 1)], f"word_id bigint, meaning_index int, cn_paraphrase string, {child}")
        sentences = spark.createDataFrame([(2, 1, 0, "s", "t", "pipeline:a")], f"word_id bigint, meaning_index int, example_index int, form string, translation string, {child}")
        mnemonics = spark.createDataFrame([(2, "m", "pipeline:a")], f"word_id bigint, text string, {child}")
        return {"words": names, "meanings": meanings, "sentences": sentences, "mnemonics": mnemonics, "refused": spark.createDataFrame([], "word_id bigint, reason string")}

    first = X.export_words(made("x"), tables)
    assert sorted(map(tuple, first["payloads"].collect())) == [(1, 6, "A"), (2, 6, "B"), (3, 5, "C")]
    again = X.export_words(made("y"), {k: first[k] for k in tables})
    assert sorted(map(tuple, again["payloads"].collect())) == [(1, 6, "B"), (2, 6, "B"), (3, 5, "C")]
    assert {r["word_id"]: r["source"] for r in again["words"].collect()} == {5: "human:web", 6: "pipeline:b"}
    assert sorted((r["word_id"], r["cn_paraphrase"]) for r in again["meanings"].collect()) == [(6, "y20"), (6, "y21")]
    assert again["sentences"].count() == again["mnemonics"].count() == 1
    assert [r["word_id"] for r in again["affected"].collect()] == [6]


def test_substring_search_equals_ilike_and_opens_its_grams_only(spark, tmp_path):
    from lexmill.operators import search as Q

    forms = ["Banana", "bandana", "an_ana", "naÏve Straße", "ab", "", None, "aaaa", "anaban", "100% sure", "İstanbul", "x" * 5000 + "needle", "nan-ana"]
    words = spark.createDataFrame(list(enumerate([*forms, "Banana"])), "word_id int, form string")
    index = Q.TrigramIndex(spark, str(tmp_path / "t"), 16)
    index.write(words)
    for q in ("ana", "BANANA", "an%ana", "ban_n", "naïve s", "aaa", "a", "%", "aaaaa", "0% s", "stanbul", "NEEDLE", "zzz", "an", "%ana%ban%", "ana%nan", "n_n%ana", "\\%"):
        want = words.where(F.col("form").ilike(f"%{q}%"))
        assert rows(Q.search_substring(words, index, q)) == rows(want), q
    opened = {r["f"] for r in index.postings(["ana"]).select(F.input_file_name().alias("f")).collect()}
    assert len({f.rsplit("/", 2)[1] for f in opened}) == 1 and index.candidates("an") is None
    assert rows(index.candidates("bana")) == [(0,), (13,)]

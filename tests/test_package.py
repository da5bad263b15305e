"""The package: sorted without a second shuffle of its documents, whatever its keys."""

import gzip
import json

from pyspark.sql import functions as F

from lexmill.operators import documents as D
from lexmill.sources import writers as W


def vocabulary(spark):
    words = spark.createDataFrame(
        [(3, 1, "c", "k\x01\x02", None), (1, 1, "a", "x", None), (2, 1, "b", "y", None), (2, 2, "b2", "z", None), (None, 1, "n", None, None)],
        "word_id bigint, type smallint, form string, phonetic_us string, phonetic_uk string",
    ).withColumns({"audio_us": F.lit(None).cast("string"), "audio_uk": F.lit(None).cast("string")})
    meanings = spark.createDataFrame(
        [(10, 1, 1, "m\x02,\x01"), (11, 2, 1, "m11"), (12, 2, 1, None), (13, None, 1, "lost"), (14, 9, 1, "gone"), (15, 3, None, "m15")],
        "meaning_id bigint, word_id bigint, pos smallint, cn_paraphrase string",
    )
    sentences = spark.createDataFrame([(100, 10, "s,\x02", "t"), (101, 11, "s", None), (102, 10, "u", "v")], "sentence_id bigint, meaning_id bigint, form string, translation string")
    mnemonics = spark.createDataFrame([(7, 1, 1, "hook"), (8, None, 1, "lost"), (6, 1, 1, None)], "mnemonic_id bigint, word_id bigint, type smallint, text string")
    return words, meanings, sentences, mnemonics


def test_package_with_repeated_and_missing_ids(spark):
    for floor in (1_000_000, 1):
        docs = [(r["word_id"], json.loads(r["word_json"])) for r in D.package_entry(*vocabulary(spark), floor=floor, ranged=True).collect()]
        by_form = {d["form"]: (i, d) for i, d in docs}
        assert len(docs) == 5 and sorted(by_form) == ["a", "b", "b2", "c", "n"]
        assert by_form["n"][0] is None and by_form["n"][1]["meanings"] == [] and by_form["n"][1]["mnemonics"] == []
        a = by_form["a"][1]
        assert [m["id"] for m in a["mnemonics"]] == [6, 7] and [s["id"] for s in a["meanings"][0]["sentences"]] == [100, 102]
        assert a["meanings"][0]["phonetic_us"] == {"form": "x", "audio": ""} and a["meanings"][0]["sentences"][0]["form"] == "s,\x02"
        # Words that share an id list each meaning once for the sounds of each of them.
        for form in ("b", "b2"):
            assert sorted((m["id"], m["phonetic_us"]["form"]) for m in by_form[form][1]["meanings"]) == [(11, "y"), (11, "z"), (12, "y"), (12, "z")]
        assert by_form["c"][1]["meanings"][0]["phonetic_us"]["form"] == "k\x01\x02" and by_form["c"][1]["phonetic_us"]["form"] == "k\x01\x02"


def test_package_is_sorted_without_shuffling_documents(spark, tmp_path):
    entries = D.package_entry(*vocabulary(spark), ranged=True)
    plan = entries.orderBy("word_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "SortMergeJoin" not in plan.split("Exchange rangepartitioning")[0]
    W.export_packaged_json(entries, str(tmp_path / "p"))
    files = sorted((tmp_path / "p").glob("part-*.json.gz"))
    lines = [json.loads(line) for f in files for line in gzip.open(f, "rt", encoding="utf-8")]
    assert [r.get("word_id") for r in lines] == [None, 1, 2, 2, 3]

import pytest
from pyspark.sql import functions as F

from lexmill.functions import hashing as H
from lexmill.functions import lookups as L
from lexmill.functions import nested as N
from lexmill.functions import text as T
from lexmill.sources import readers as R


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_")).select(expr.alias("x"))
    return row.collect()[0]["x"]


@pytest.mark.parametrize(
    ("raw", "form", "kind"),
    [
        ("   ", None, None), ("　\t", None, None), ("mother-in-law", "mother-in-law", 1), (" Give  Up ", "give  up", 2),
        ("Straße", "strasse", 1), ("ΣΑΣ", "σασ", 1), ("İx", "i̇x", 1), ("ﬁn", "fin", 1), ("a b", "a b", 2),
    ],
)
def test_normalized_form(spark, raw, form, kind):
    row = T.with_normalized(spark.createDataFrame([(raw,)], "raw string"), "raw").collect()[0]
    assert (row["normalized_form"], row["type"]) == (form, kind)
    expected = raw.strip().casefold() or None
    assert form == expected


def test_casefold_equals_python_for_every_character(spark):
    chars = [(chr(i), chr(i).casefold()) for i in range(1, 0x1FFFF) if not 0xD800 <= i <= 0xDFFF and chr(i).casefold() != chr(i)]
    df = spark.createDataFrame(chars, "c string, want string")
    wrong = df.where(T.casefold(F.col("c")) != F.col("want")).collect()
    # Characters newer than the JVM's Unicode tables may stay as they are.
    assert all(ord(r["c"]) > 0xA7C0 for r in wrong)


@pytest.mark.parametrize(("text", "parts"), [(" 山 ； ;水; ", ["山", "水"]), ("；；火 ；", ["火"]), ("red, green", ["red, green"]), ("", [])])
def test_split_gloss(spark, text, parts):
    assert one(spark, T.split_gloss(F.col("t")), t=text) == parts


def test_parse_gloss_line(spark):
    def parse(line):
        return [tuple(r) for r in one(spark, T.parse_gloss_line(F.col("t")), t=line)]

    assert parse("vt. 跑，奔跑；参加 ；") == [("v", "跑，奔跑"), ("v", "参加")]
    assert parse("v. 看见（see 的过去式）；明白") == [("v", "[see 过去式] 看见"), ("v", "[see 过去式] 明白")]
    assert parse("【名】 无") == []


def test_urls_tags_and_cuts(spark):
    assert one(spark, T.compose_url("u?", F.col("t")), t="") is None
    assert one(spark, T.compose_url("u?", F.col("t")), t="a") == "u?a"
    assert one(spark, T.short_model_tag(F.col("t")), t="us.vendor.some-model-v1") == "some-model"
    assert one(spark, T.source_origin(F.col("t")), t="human:web") == "human"
    assert one(spark, T.strip_markup(F.col("t")), t=" <B>x</b> ") == "x"
    assert one(spark, T.strip_markup(F.col("t")), t="<b></b>") is None
    assert one(spark, T.error_summary(F.col("t")), t="x" * 90 + "\ny") == "x" * 80


def test_split_lines_breaks_like_the_host_language(spark):
    text = "a\r\nb c\x0bd\n\ne\n"
    assert one(spark, T.split_lines(F.col("t")), t=text) == text.splitlines()


def test_canonical_json_and_keys(spark):
    assert one(spark, H.canonical_json(F.col("t")), t='{"b": [1, {"z": null, "a": "ü"}], "a": 1}') == '{"a":1,"b":[1,{"a":"ü","z":null}]}'

    def key(params, prompt="p"):
        return one(spark, H.cache_key(F.lit("k"), F.lit("m"), F.lit(params), F.lit(prompt), F.lit("{}")))

    assert key('{"a":1,"b":2}') == key('{"b": 2, "a": 1}')
    assert len({key('{"t":0}'), key('{"t":1}'), key('{"t":0}', "q")}) == 3


def test_stage_fingerprint(spark):
    none = F.lit(None).cast("string")

    def fp(upstream, config='{"a":1,"b":2}', parser="1"):
        return one(spark, H.stage_fingerprint(F.array(*map(F.lit, upstream)), F.lit(config), none, none, F.lit(parser)))

    assert fp(["x", "y"]) == fp(["y", "x"], '{"b":2,"a":1}')
    assert fp(["x", "y"]) != fp(["x", "y"], parser="2")


def test_prices(spark):
    calls = spark.createDataFrame(
        [("gemini-2.5-flash-lite", 1_000_000, 0), ("x.gpt-5-mini", 0, 1_000_000), ("nobody", 1_000_000, 1_000_000), ("gpt-4o", None, 3)],
        "model string, tokens_input long, tokens_output long",
    )
    got = {r["model"]: (float(r["cost_usd"]), r["price_known"]) for r in L.with_cost(calls).collect()}
    assert got == {"gemini-2.5-flash-lite": (0.05, True), "x.gpt-5-mini": (2.0, True), "nobody": (18.0, False), "gpt-4o": (0.00003, True)}


def test_pos(spark):
    assert one(spark, L.pos_code(F.col("t")), t="adv") == 4
    assert one(spark, L.pos_code(F.col("t")), t="xx") is None
    assert tuple(one(spark, L.pos_display(F.col("t")), t=201)) == ("phrase", "短语动词")
    assert tuple(one(spark, L.pos_display(F.col("t")), t=99)) == ("", "")


def test_readers(spark, tmp_path):
    (tmp_path / "w.txt").write_text("Apple\n\napple\x0cPear\n")
    rows = R.read_word_lines(spark, str(tmp_path / "w.txt")).orderBy(*R.LINE_ORDER).collect()
    assert [r["raw_form"] for r in rows] == ["Apple", "", "apple", "Pear"]
    (tmp_path / "g.json").write_text(
        '{"go": [{"pos": "v", "cn": "(口语) 去", "en": "<b>move</b>"}, {"cn": ""}], "no": [{"pos": "n", "cn": null}]}\n'
    )
    got = R.read_glossary(spark, str(tmp_path / "g.json")).collect()
    assert [(r["word"], [tuple(m) for m in r["meanings"]]) for r in got] == [("go", [("v", "去", "move")])]
    (tmp_path / "r.jsonl").write_text('{"word_id": 3}\n{"word_id": "4"}\nbroken\n{"word_id": 3}\n{"word_id": 5.5}\n[]\n')
    assert [r["word_id"] for r in R.read_result_log(spark, str(tmp_path / "r.jsonl")).collect()] == [3]


# --- nested documents -------------------------------------------------------


def doc(spark, raw):
    return spark.createDataFrame([(raw,)], "raw string").select(F.try_parse_json("raw").alias("doc"))


def examples(spark, raw):
    row = N.with_reference_examples(doc(spark, raw), "doc").collect()[0]["reference_examples"]
    return [(b["sense"], [(e["en"], e["cn"]) for e in b["examples"]]) for b in row]


def test_reference_examples(spark):
    import json

    raw = {
        "ec": {"word": [{"trs": [{"tr": [
            {"l": {"i": ["sense one"], "sentence": [{"en": "<b>Hi</b> there", "zh": "一"}, {"en": "x", "zh": None}]}},
            {"l": {"i": [], "sentence": [{"en": "loose", "zh": "散"}]}},
        ]}]}]},
        "collins": {"collins_entries": [{"entries": {"entry": [{"tran_entry": [
            {"tran": "sense <b>two</b>", "exam_sents": {"sent": [{"eng_sent": "hi THERE", "chn_sent": "二"}, {"eng_sent": "new", "chn_sent": "三"}]}},
        ]}]}}]},
        "blng_sents_part": {"sentence-pair": [{"sentence": "corpus", "sentence-translation": "料"}, {"sentence": "LOOSE", "sentence-translation": "重"}]},
    }
    assert examples(spark, json.dumps(raw)) == [
        ("sense one", [("Hi there", "一")]), ("sense two", [("new", "三")]), (None, [("loose", "散"), ("corpus", "料")]),
    ]


def test_reference_examples_share_the_budget(spark):
    import json

    def bucket(b, n):
        return {"l": {"i": [f"s{b}"], "sentence": [{"en": f"e{b}-{i}", "zh": "c"} for i in range(n)]}}

    six = {"ec": {"word": [{"trs": [{"tr": [bucket(b, 5) for b in range(6)]}]}]}}
    assert [len(e) for _, e in examples(spark, json.dumps(six))] == [2, 2, 2, 2, 1, 1]
    corpus = {"sentence-pair": [{"sentence": f"k{i}", "sentence-translation": "c"} for i in range(20)]}
    one_and_corpus = {"ec": {"word": [{"trs": [{"tr": [bucket(0, 1)]}]}]}, "blng_sents_part": corpus}
    assert [len(e) for _, e in examples(spark, json.dumps(one_and_corpus))] == [1, 9]


@pytest.mark.parametrize("raw", [None, '"text"', "{}", '{"ec": 3, "collins": [], "blng_sents_part": "x"}', '{"ec": {"word": "w"}}'])
def test_odd_documents_give_nothing(spark, raw):
    assert examples(spark, raw) == []
    row = doc(spark, raw).select(N.gloss_meanings(F.col("doc")).alias("g"), N.extract_phonetics(F.col("doc")).alias("p")).collect()[0]
    assert row["g"] is None and all(v is None for v in row["p"])


def test_phonetics_fall_back(spark):
    raw = '{"simple": {"word": [{}]}, "ec": {"word": [{"usphone": "u", "ukphone": "", "usspeech": "a&type=2"}]}}'
    got = doc(spark, raw).select(N.extract_phonetics(F.col("doc"), "b?").alias("p")).collect()[0]["p"]
    assert tuple(got) == ("u", None, "b?a&type=2", None)


def test_dictionary_summary_takes_any_wrapping(spark):
    for word in ('[{"trs": [{"tr": [{"l": {"i": [" n. 一 "]}}]}]}]', '{"trs": [{"tr": [{"l": {"i": ["n. 一"]}}]}]}'):
        got = doc(spark, '{"ec": {"word": %s}, "ee": {"word": "x"}}' % word).select(N.dictionary_summary(F.col("doc")).alias("s"))
        assert got.collect()[0]["s"] == "[ec] n. 一"


@pytest.mark.parametrize(
    ("text", "method", "value"),
    [
        ('{"a": 1}', "plain", '{"a":1}'),
        ('```json\n{"a": 1}\n```', "fenced", '{"a":1}'),
        ('```\n[1]\n```', "fenced", "[1]"),
        ('Here you are: {"a": {"b": 2}} enjoy', "extracted", '{"a":{"b":2}}'),
        ('See [note] first {"a": 1}', "extracted", '{"a":1}'),
        ('{"note": "店员答："今天休息。""}', "repaired", '{"note":"店员答：\\"今天休息。\\""}'),
        ("nothing here", None, None),
        ("{broken", None, None),
    ],
)
def test_parse_model_json(spark, text, method, value):
    row = N.parse_model_json(spark.createDataFrame([(text,)], "t string"), "t").select("method", F.to_json("parsed").alias("j"), "error").collect()[0]
    assert (row["method"], row["j"]) == (method, value)
    assert (row["error"] is None) == (value is not None)


def test_shape_examples(spark):
    def shape(text):
        return one(spark, N.shape_examples(F.try_parse_json(F.col("t"))), t=text)

    assert shape('{"per_meaning": [], "x": 1}') == '{"per_meaning":[],"x":1}'
    assert shape('{"examples": [{"en": "a"}], "meaning_index": 2}') == '{"per_meaning":[{"examples":[{"en":"a"}],"meaning_index":2}]}'
    assert shape("[1]") == '{"per_meaning":[]}'

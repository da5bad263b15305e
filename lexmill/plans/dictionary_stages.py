"""The eight stages of a dictionary run, from raw documents to publishable rows."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import nested as N
from lexmill.functions import text as T
from lexmill.functions.hashing import KEEP_NULLS, to_json
from lexmill.operators import inference as I
from lexmill.operators import stages as S
from lexmill.session import cut_lineage

# Prompt templates are content; these are short stand-ins with the same placeholders.
TEMPLATES = {
    "paraphrase": "List the meanings of {word} as JSON. Dictionary:\n{dict_summary}",
    "paraphrase_rerank": "Order these meanings of {word} by use: {meanings_json}",
    "derivatives": "Give inflections and synonyms of {word} for {meanings_json}",
    "examples": "Write example sentences for {word}: {meanings_json} in the style of {reference_examples_json}",
    "mnemonic": "Give a memory hook for {word}: {meanings_json}",
}
MODEL = "deepseek-chat"
MEANINGS = "array<struct<pos:string,cn:string,en:string>>"


def stub_model(calls: pd.DataFrame) -> pd.DataFrame:
    """Answers every stage's prompt with valid JSON that depends on the prompt only."""
    texts = []
    for prompt, given in zip(calls["prompt"], calls["input_json"], strict=True):
        mark = hashlib.md5(prompt.encode()).hexdigest()[:8]
        stage = json.loads(given)["stage"]
        answers = {
            "paraphrase": {"meanings": [{"pos": "n", "cn": f"义{mark}", "en": mark}], "structure": {"root": mark}},
            "paraphrase_rerank": {"order": [1, 0]},
            "derivatives": {"word_forms": {"plural": f"{mark}s"}, "per_meaning": [{"meaning_index": 0, "synonyms": [mark], "antonyms": []}]},
            "examples": {"per_meaning": [{"meaning_index": 0, "examples": [{"en": f"See {mark}.", "cn": f"看{mark}。"}, {"en": mark, "cn": None}]}]},
            "mnemonic": {"mnemonic": f"记{mark}", "kind": "phonetic", "sound_alike": mark},
        }
        texts.append("```json\n" + json.dumps(answers[stage], ensure_ascii=False) + "\n```")
    return pd.DataFrame({"text": texts, "tokens_input": calls["prompt"].str.len(), "tokens_output": 100})


I.register_model("stub", stub_model)


def ask(
    df: DataFrame, stage: str, values: dict[str, Column], cache: DataFrame | I.AnswerStore, fn: I.ModelFn, parallel: int | None = None
) -> DataFrame:
    """(word_id, parsed, cost_usd, tokens_input, tokens_output, error): one model call per row."""
    calls = df.select(
        "word_id", F.lit(f"call:{MODEL}").alias("kind"), F.lit(MODEL).alias("model"),
        F.lit('{"max_tokens":8192,"temperature":0}').alias("params_json"),
        T.render_prompt(F.lit(TEMPLATES[stage]), values).alias("prompt"), F.lit(f'{{"stage":"{stage}"}}').alias("input_json"),
    )
    answered = I.call(calls, cache, fn, "word_id", parallel)
    parsed = N.parse_model_json(answered.withColumnRenamed("error", "_call_error"), "text")
    return parsed.select("word_id", "parsed", "cost_usd", *I.TOKENS, F.coalesce("_call_error", "error").alias("error"))


def _source(stage: str, model: str = MODEL) -> Column:
    return T.source_tag(F.lit("openai"), F.lit(model), F.lit(stage), F.lit("1"))


def _local(stage: str) -> Column:
    return F.lit(f"pipeline:local:{stage}_v1")


def dictionary_stages(
    raw: DataFrame, glossary: DataFrame, cache: DataFrame | I.AnswerStore, fn: I.ModelFn, parallel: int | None = None, export: S.StageFn | None = None
) -> list[S.Stage]:
    """Stages over `raw` (word_id, raw) documents and `glossary` (word_id, meanings).

    New answers go to `cache` if that is a store; `parallel` is the number of model calls at a
    time. `export` is the last stage's function; without one its payload only says that the
    gate was passed.
    """
    publish = export

    def fetch_dict(df: DataFrame) -> DataFrame:
        found = df.join(raw, "word_id", "left")
        payload = F.when(F.col("raw").isNotNull(), F.concat(F.lit('{"raw_json":'), "raw", F.lit("}")))
        error = F.when(F.col("raw").isNull(), "dictionary has no entry")
        return found.select("word_id", payload.alias("payload"), error.alias("error"), _local("fetch_dict").alias("source"))

    def document(df: DataFrame) -> DataFrame:
        return df.withColumn("doc", N.at(F.try_parse_json("up_fetch_dict"), "$.raw_json"))

    def paraphrase(df: DataFrame) -> DataFrame:
        words = document(df).select(
            "word_id", "form", N.gloss_meanings(F.col("doc")).alias("_glosses"), N.dictionary_summary(F.col("doc")).alias("_summary")
        )
        known = words.join(glossary.select("word_id", F.col("meanings").cast(MEANINGS).alias("_listed")), "word_id", "left")
        listed = F.when(F.size("_listed") > 0, F.col("_listed"))
        known = cut_lineage(
            known.withColumn("meanings", F.coalesce(listed, "_glosses")).withColumn(
                "origin", F.when(listed.isNotNull(), "glossary").when(F.col("_glosses").isNotNull(), "gloss")
            )
        )
        # Only words without a cheaper answer reach the model, and only long lists the reranker.
        summary = F.coalesce(T.blank_to_null(F.col("_summary")), F.lit("(no dictionary data)"))
        told = ask(known.where("meanings IS NULL"), "paraphrase", {"word": F.col("form"), "dict_summary": summary}, cache, fn, parallel)
        generated = told.select(
            "word_id", F.to_json("parsed", KEEP_NULLS).alias("payload"), "error", _source("paraphrase").alias("source"),
            F.lit(MODEL).alias("model"), "cost_usd", *I.TOKENS,
        )
        short = known.where("meanings IS NOT NULL")
        shown = T.truncate_text(to_json(F.col("meanings")), "rerank_json")
        order = ask(short.where(I.needs_rerank(F.col("meanings"))), "paraphrase_rerank", {"word": F.col("form"), "meanings_json": shown}, cache, fn, parallel)
        # A failed rerank keeps the order and costs the word nothing.
        ranked = short.join(order.select("word_id", "parsed", "cost_usd", *I.TOKENS), "word_id", "left").withColumn(
            "meanings", I.rerank_meanings(F.col("meanings"), F.col("parsed"))
        )
        tag = F.concat(F.lit("pipeline:"), "origin", F.lit("+"), T.short_model_tag(F.lit(MODEL)), F.lit(":paraphrase_v1"))
        cheap = ranked.select(
            "word_id", to_json(F.struct("meanings")).alias("payload"), F.lit(None).cast("string").alias("error"), tag.alias("source"),
            F.when(F.col("cost_usd") > 0, MODEL).alias("model"), F.coalesce("cost_usd", F.lit(0)).cast("decimal(10,6)").alias("cost_usd"),
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in I.TOKENS],
        )
        return generated.unionByName(cheap)

    def phonetic(df: DataFrame) -> DataFrame:
        return document(df).select(
            "word_id", to_json(N.extract_phonetics(F.col("doc"))).alias("payload"), _local("phonetic").alias("source")
        )

    def modelled(stage: str, shape=None, extra=None):
        def run(df: DataFrame) -> DataFrame:
            rows = df if extra is None else extra(df)
            values = {"word": F.col("form"), "meanings_json": T.truncate_text(N.top_meanings(F.try_parse_json("up_paraphrase")), "meanings_json")}
            if extra is not None:
                values["reference_examples_json"] = F.col("_reference")
            told = ask(rows, stage, values, cache, fn, parallel)
            payload = F.to_json("parsed", KEEP_NULLS) if shape is None else shape(F.col("parsed"))
            return told.select(
                "word_id", F.when(F.col("error").isNull(), payload).alias("payload"), "error", _source(stage).alias("source"),
                F.lit(MODEL).alias("model"), "cost_usd", *I.TOKENS,
            )

        return run

    def with_reference(df: DataFrame) -> DataFrame:
        rows = N.with_reference_examples(document(df), "doc")
        return rows.withColumn("_reference", T.truncate_text(F.to_json("reference_examples", KEEP_NULLS), "reference_examples_json"))

    def gate(df: DataFrame) -> DataFrame:
        judged = S.quality_gate(df)
        payload = to_json(F.struct("passed", "failed_rules"))
        return judged.select("word_id", F.when(F.col("error").isNull(), payload).alias("payload"), "error", _local("quality_gate").alias("source"))

    def passed_on(df: DataFrame) -> DataFrame:
        passed = F.coalesce(F.try_variant_get(F.try_parse_json("up_quality_gate"), "$.passed", "boolean"), F.lit(False))
        payload = to_json(F.struct(F.lit(True).alias("exported")))
        error = F.when(~passed, "quality gate did not pass")
        return df.select("word_id", F.when(passed, payload).alias("payload"), error.alias("error"), _local("export").alias("source"))

    digest = {s: hashlib.sha256(t.encode()).hexdigest() for s, t in TEMPLATES.items()}

    def stage(name: str, upstream: tuple[str, ...], run: S.StageFn, soft: tuple[str, ...] = ()) -> S.Stage:
        prompt = digest.get(name)
        return S.Stage(name, upstream, run, prompt_version="v1" if prompt else None, prompt_hash=prompt, soft=soft)

    return [
        stage("fetch_dict", (), fetch_dict),
        stage("paraphrase", ("fetch_dict",), paraphrase),
        stage("phonetic", ("fetch_dict",), phonetic),
        stage("derivatives", ("paraphrase",), modelled("derivatives")),
        stage("examples", ("paraphrase", "fetch_dict"), modelled("examples", N.shape_examples, with_reference)),
        stage("mnemonic", ("paraphrase",), modelled("mnemonic")),
        stage("quality_gate", S.GATED, gate),
        stage("export", S.EXPORT_UPSTREAM, publish or passed_on),
    ]


EMPTY_CACHE = "kind string, cache_key string, text string, cost_usd decimal(10,6)"
EMPTY_ARTIFACTS = (
    "word_id bigint, stage_name string, fingerprint string, payload string, source string, model string, prompt_version string"
)

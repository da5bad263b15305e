"""Model calls: looked up first, each distinct call made once, every answer kept.

A model is a function from a batch of prompts to a DataFrame with text, tokens_input and
tokens_output. It runs inside mapInPandas; everything around it is joins.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import lookups
from lexmill.functions import nested as N
from lexmill.functions.hashing import cache_key
from lexmill.operators.numbering import HOT_FLOOR, join_to_parent
from lexmill.session import by_rows, cut_lineage

ModelFn = Callable[[pd.DataFrame], pd.DataFrame]

CALL = ["kind", "model", "params_json", "prompt", "input_json"]
# Request parameters that the call itself sets.
RESERVED = ("model", "prompt")
# A list of up to this many rows, told by one number each, is sent to all tasks.
LISTED = 500_000

_MODELS: dict[str, ModelFn] = {}
_VALIDATORS: dict[str, Callable[[Column], Column]] = {}


def register_model(name: str, fn: ModelFn) -> None:
    """`fn` gets a batch of calls (kind, model, params_json, prompt, input_json) as pandas and
    returns text, tokens_input and tokens_output, row for row, and may return an `error` for rows
    that failed. One that raises loses its batch; wrap a function of single calls in `per_call`."""
    _MODELS[name] = fn


def model_fn(name: str) -> ModelFn:
    return _MODELS[name]


def register_validator(stage: str, check: Callable[[Column], Column]) -> None:
    """`check` turns a parsed answer (variant) into a boolean column."""
    _VALIDATORS[stage] = check


def validator(stage: str) -> Callable[[Column], Column]:
    if stage not in _VALIDATORS:
        raise ValueError(f"no experiments on stage {stage!r}; known: {sorted(_VALIDATORS)}")
    return _VALIDATORS[stage]


def digest_model(calls: pd.DataFrame) -> pd.DataFrame:
    """The stub for tests: answers with the md5 of the prompt."""
    text = [hashlib.md5(p.encode()).hexdigest() for p in calls["prompt"]]
    return pd.DataFrame({"text": text, "tokens_input": calls["prompt"].str.len(), "tokens_output": 32})


register_model("digest", digest_model)
register_validator("paraphrase", lambda answer: N.has_kind(N.at(answer, "$.meanings"), "ARRAY"))


@dataclass
class Inference:
    """`results` has every call with its answer; `new_cache` the rows to add to the cache."""

    results: DataFrame
    new_cache: DataFrame


ANSWER = "text string, tokens_input bigint, tokens_output bigint, error string, latency_ms bigint"
TOKENS = ("tokens_input", "tokens_output")


def per_call(one: ModelFn) -> ModelFn:
    """A model function that asks for one prompt at a time: a call that fails is its row's error alone.

    Each prompt is asked exactly once, whatever becomes of the others.
    """
    def run(calls: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for i in range(len(calls)):
            began = time.perf_counter()
            try:
                row = one(calls.iloc[[i]]).iloc[0].to_dict() | {"error": None}
            except Exception as error:  # noqa: BLE001  the answers of others are paid for
                row = {"text": None, "tokens_input": 0, "tokens_output": 0, "error": str(error)[:500]}
            rows.append(row | {"latency_ms": round(1000 * (time.perf_counter() - began))})
        return pd.DataFrame(rows)

    return run


def _call_model(fn: ModelFn) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for calls in batches:
            kept = calls[["kind", "cache_key", "model", "first_call"]].reset_index(drop=True)
            began = time.perf_counter()
            try:
                answers = fn(calls).reset_index(drop=True)
                if "error" not in answers.columns:
                    answers["error"] = None
            except Exception as error:  # noqa: BLE001  nothing of the batch is known, so nothing is asked again
                answers = kept[[]].assign(text=None, tokens_input=0, tokens_output=0, error=str(error)[:500])
            if "latency_ms" not in answers.columns:
                # Calls that are asked together are answered together.
                answers["latency_ms"] = round(1000 * (time.perf_counter() - began))
            yield pd.concat([kept, answers[["text", "tokens_input", "tokens_output", "error", "latency_ms"]]], axis=1)

    return run


CACHE = "kind string, cache_key string, text string, cost_usd decimal(10,6)"
ANSWERS_PER_WRITER = 100_000


class AnswerStore:
    """Paid answers as a table that only grows, in a folder of the caller's, dealt into buckets by key.

    The table is one of Spark's own bucketed tables, registered in the session under a name made
    of its path, and registered again by the next session. A lookup joins on the key alone, which
    names its kind, so Spark shuffles the calls to the store's buckets and leaves the store where
    it is. `buckets` is a power of two and must be the same each time. An answer that was
    stored twice is read once.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        if buckets < 1 or buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.name = f"answers_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"
        place = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({CACHE}) USING parquet CLUSTERED BY (cache_key) INTO {buckets} BUCKETS LOCATION '{place}'")

    def _table(self) -> DataFrame:
        # Another session may have added files.
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _once(self, rows: DataFrame) -> DataFrame:
        first = F.min_by(F.struct("text", "cost_usd"), F.struct("text", "cost_usd")).alias("_a")
        return rows.groupBy("kind", "cache_key").agg(first).select("kind", "cache_key", "_a.*")

    def read(self) -> DataFrame:
        return self._once(self._table())

    def lookup(self, asked: DataFrame) -> DataFrame:
        """The answers to the keys in `asked` (cache_key); only these are aggregated, the store is not shuffled."""
        table = self._table()
        # A first run finds nothing, so its keys need not be shuffled.
        return self._once(table if table.isEmpty() else table.join(by_rows(asked.select("cache_key")), "cache_key", "left_semi"))

    def add(self, answers: DataFrame) -> None:
        """Append answers with as many writers as their number asks for; each bucket has one writer."""
        rows = answers.select("kind", "cache_key", "text", F.col("cost_usd").cast("decimal(10,6)").alias("cost_usd"))
        count = rows.count()
        if count:
            # A power of two divides the number of buckets, so a bucket's rows meet in one task.
            writers = 1 << min(-(-count // ANSWERS_PER_WRITER) - 1, self.buckets - 1).bit_length()
            rows.repartition(writers, "cache_key").write.insertInto(self.name)


def call(calls: DataFrame, cache: DataFrame | AnswerStore, fn: ModelFn, call_id: str, parallel: int | None = None, bypass: bool = False) -> DataFrame:
    """The results of `cached_inference`; a store gets the new answers before anybody reads them."""
    if not isinstance(cache, AnswerStore):
        return cached_inference(calls, cache, fn, call_id, parallel, bypass).results
    out = cached_inference(calls, cache, fn, call_id, parallel, bypass)
    cache.add(out.new_cache)
    return out.results


def _rows_of(calls: DataFrame, wanted: DataFrame) -> DataFrame:
    """The calls whose `_row` is in `wanted`, told by those wanted or by those not wanted, whichever are fewer.

    Prompts are by far the most bytes of a call. They stay where they are as long as the smaller of the
    two lists has up to LISTED rows and is broadcast, which holds for a first run and for one that was answered before.
    """
    count, size = calls.count(), wanted.count()
    if count == size:
        return calls
    if 2 * size <= count:
        return calls.join(F.broadcast(wanted) if size <= LISTED else by_rows(wanted), "_row", "left_semi")
    others = cut_lineage(calls.select("_row").join(by_rows(wanted), "_row", "left_anti"))
    return calls.join(F.broadcast(others) if count - size <= LISTED else by_rows(others), "_row", "left_anti")


def cached_inference(
    calls: DataFrame, cache: DataFrame | AnswerStore, fn: ModelFn, call_id: str, partitions: int | None = None,
    bypass: bool = False, floor: int = HOT_FLOOR,
) -> Inference:
    """Answer `calls` (call_id and the CALL columns) from `cache` or by the model.

    `cache` is (kind, cache_key, text, cost_usd) or a store; of either only the keys that are asked
    for are looked at, and a store is not shuffled for that. Each distinct miss is called once, in `partitions` parallel streams; the answers
    are written before anyone reads them, so executors lost after that repeat no call. A hit
    reports the stored cost in cost_usd, 0 in spent_usd, no tokens and no latency; failed calls and
    reserved parameters end up in `error` and are not cached.
    """
    reserved = [F.try_variant_get(F.try_parse_json("params_json"), f"$.{name}", "variant").isNotNull() for name in RESERVED]
    keyed = calls.withColumn("cache_key", cache_key(*[F.col(c) for c in CALL])).withColumn(
        "_refused", reserved[0] | reserved[1]
    )
    # Prompts are rendered and hashed once; what follows reads only the columns it needs.
    keyed = cut_lineage(keyed.withColumn("_row", F.monotonically_increasing_id()))
    good = keyed.where(~F.coalesce("_refused", F.lit(False)))
    # The reduction to distinct calls comes before the lookup, so copies never meet in one task. The
    # row of a call's lowest id stands for its copies.
    lowest = F.min(F.struct(F.col(call_id).isNull().alias("n"), F.col(call_id).alias("c"), F.col("_row").alias("r")))
    # Keys travel as bytes, half as long as their text.
    packed = good.groupBy("kind", F.unhex("cache_key").alias("_k")).agg(lowest.alias("_l"))
    distinct = cut_lineage(packed.select("kind", F.lower(F.hex("_k")).alias("cache_key"), F.col("_l.r").alias("_row")))
    asked = distinct.select("kind", "cache_key")
    if isinstance(cache, AnswerStore):
        # Read twice below, by the misses and by the results.
        cache = cut_lineage(cache.lookup(asked.limit(0) if bypass else asked))
    else:
        cache = cache.limit(0) if bypass else cache.join(by_rows(asked), ["kind", "cache_key"], "left_semi")

    def unanswered(rows: DataFrame) -> DataFrame:
        return rows if bypass else rows.join(by_rows(cache.select("kind", "cache_key")), ["kind", "cache_key"], "left_anti")

    if partitions is None:
        # Which calls are asked, and fail, together is told by their keys, not by where their rows lie.
        misses = unanswered(good.groupBy("kind", "cache_key").agg(
            F.min(call_id).alias("first_call"), *[F.first(c).alias(c) for c in ("model", "params_json", "prompt", "input_json")]
        ))
    else:
        misses = _rows_of(good, cut_lineage(unanswered(distinct).select("_row"))).select(*CALL, "cache_key", F.col(call_id).alias("first_call"))
        # Streams are put together from the tasks there are; prompts are dealt out only when those are too few.
        misses = misses.coalesce(partitions) if keyed.rdd.getNumPartitions() >= partitions else misses.repartition(partitions)
    id_type = calls.schema[call_id].dataType.simpleString()
    schema = f"kind string, cache_key string, model string, first_call {id_type}, {ANSWER}"
    answered = cut_lineage(lookups.with_cost(misses.mapInPandas(_call_model(fn), schema)))
    fresh = answered.select("kind", "cache_key", "text", "cost_usd", "first_call", "error", "tokens_input", "tokens_output", "latency_ms")
    stored = cache.select(
        "kind", "cache_key", "text", F.col("cost_usd").cast("decimal(10,6)"), F.lit(None).cast(id_type).alias("first_call"),
        F.lit(None).cast("string").alias("error"), *[F.lit(None).cast("bigint").alias(c) for c in (*TOKENS, "latency_ms")],
    )
    answers = fresh.unionByName(stored).withColumn("_k", F.unhex("cache_key")).drop("cache_key")
    joined = join_to_parent(keyed.withColumn("_k", F.unhex("cache_key")), answers, ["kind", "_k"], "left", floor)
    refusal = F.when(F.col("_refused"), "request parameters must not contain reserved keys")
    made = F.col("first_call") == F.col(call_id)
    results = joined.withColumn("hit", F.col("first_call").isNull() & F.col("text").isNotNull()).withColumn(
        "spent_usd", F.when(made, F.col("cost_usd")).otherwise(0).cast("decimal(10,6)")
    ).withColumns({c: F.when(made, F.col(c)).otherwise(0).cast("bigint") for c in TOKENS})
    results = results.withColumn("latency_ms", F.when(made, F.col("latency_ms")))
    results = results.withColumn("error", F.coalesce("error", refusal)).drop("_refused", "first_call", "_row", "_k")
    results = results.select("kind", "cache_key", *[c for c in results.columns if c not in ("kind", "cache_key")])
    new_cache = fresh.where("error IS NULL").select("kind", "cache_key", "text", "cost_usd")
    return Inference(results, new_cache)


def hash_sample(rows: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """The n rows with the smallest sha256 of "seed:key": the same rows for the same seed."""
    if not 1 <= n <= 200:
        raise ValueError("sample size must be 1..200")
    return rows.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)).limit(n)


def run_experiment(
    words: DataFrame, cache: DataFrame | AnswerStore, template: str, model: str, fn: ModelFn, stage: str,
    seed: int, n: int, params_json: str = '{"max_tokens":8192,"temperature":0}', parallel: int | None = None,
) -> DataFrame:
    """One row per sampled word: ok, valid, cost_usd, latency_ms, text, error.

    `latency_ms` is how long the model took for the word's call, NULL for an answer that was
    kept. `words` is (word_id, form, dict_summary); ok means the answer parses, valid that it
    has the shape the stage needs.
    """
    from lexmill.functions import text as T

    check = validator(stage)
    picked = hash_sample(words, "word_id", seed, n)
    summary = F.coalesce(T.blank_to_null(F.col("dict_summary")), F.lit("(no dictionary data)"))
    prompt = T.render_prompt(F.lit(template), {"word": F.col("form"), "dict_summary": summary})
    calls = picked.select(
        "word_id", "form", F.lit(f"call:{model}").alias("kind"), F.lit(model).alias("model"), F.lit(params_json).alias("params_json"),
        prompt.alias("prompt"), F.lit(f'{{"script":"experiment","stage":"{stage}"}}').alias("input_json"),
    )
    answered = call(calls, cache, fn, "word_id", parallel).withColumnRenamed("error", "_call_error")
    parsed = N.parse_model_json(answered, "text")
    ok = F.col("_call_error").isNull() & F.col("parsed").isNotNull()
    return parsed.select(
        "word_id", "form", ok.alias("ok"), F.coalesce(ok & check(F.col("parsed")), F.lit(False)).alias("valid"),
        "cost_usd", "latency_ms", "text", T.truncate_text(F.coalesce("_call_error", "error"), "error").alias("error"),
    )


def compare_runs(items: DataFrame, run_ids: list) -> DataFrame:
    """One row per word with the validity of each listed run side by side."""
    return items.groupBy("word_id").pivot("run_id", run_ids).agg(F.first("valid"))


# --- meanings ---------------------------------------------------------------


def choose_meanings(words: DataFrame, glossary: DataFrame, glosses: DataFrame, generated: DataFrame) -> DataFrame:
    """(…, meanings, origin): from the glossary, else the dictionary gloss, else the model."""
    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select("word_id", F.col("meanings").alias(f"_{name}"))

    out = words
    names = ["glossary", "gloss", "model"]
    for df, name in zip((glossary, glosses, generated), names, strict=True):
        out = out.join(tagged(df, name), "word_id", "left")
    origin = F.coalesce(*[F.when(F.size(f"_{n}") > 0, n) for n in names])
    picked = F.coalesce(*[F.when(F.size(f"_{n}") > 0, F.col(f"_{n}")) for n in names])
    return out.withColumn("origin", origin).withColumn("meanings", picked).drop(*[f"_{n}" for n in names])


def needs_rerank(meanings: Column) -> Column:
    """Three meanings or fewer keep their order and cost no call."""
    return F.size(meanings) > 3


def rerank_meanings(meanings: Column, answer: Column) -> Column:
    """Meanings in the order of the answer's `order`: valid distinct indexes first, then the rest.

    Any other answer leaves the order as it is.
    """
    count = F.size(meanings)
    listed = F.transform(
        N.items(answer, "$.order"), lambda i: F.when(N.has_kind(i, "BIGINT"), F.try_variant_get(i, "$", "int"))
    )
    valid = F.array_distinct(F.filter(listed, lambda i: (i >= 0) & (i < count)))
    order = F.array_union(valid, F.sequence(F.lit(0), count - 1))
    return F.when(needs_rerank(meanings), F.transform(order, lambda i: F.get(meanings, i))).otherwise(meanings)

"""The work ledger: costs against budgets, failures, dead letters, summaries.

A ledger row is one attempt of one word at one stage. All per-key results are partially
aggregated, so a word or batch that owns a third of the ledger costs no more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.numbering import HOT_FLOOR, join_to_parent, number_rows

MONEY = "decimal(12,6)"
# Sums take every digit that Spark's decimals have: a total grows with its ledger.
TOTAL = "decimal(38,6)"
DEAD_AFTER = 3
EPOCH = "1970-01-01"
KEY = ["word_id", "stage_name"]


# --- money ------------------------------------------------------------------


def batch_cost(ledger: DataFrame) -> DataFrame:
    """(batch_id, spent): cost of the ok attempts per batch."""
    ok = ledger.where((F.col("status") == "ok") & F.col("batch_id").isNotNull())
    return ok.groupBy("batch_id").agg(F.coalesce(F.sum("cost_usd"), F.lit(0)).cast(TOTAL).alias("spent"))


def add_batch_cost(batches: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(batches with the cost of new attempts added, batch ids that do not exist).

    A NULL total counts as 0. Callers refuse the run when the second table is not empty.
    """
    spent = batch_cost(ledger)
    known = spent.withColumnRenamed("batch_id", "id")
    total = F.coalesce("total_cost_usd", F.lit(0)) + F.coalesce("spent", F.lit(0))
    updated = batches.join(known, "id", "left").withColumn(
        "total_cost_usd", F.when(F.col("spent").isNull(), F.col("total_cost_usd")).otherwise(total).cast(TOTAL)
    ).drop("spent")
    used = ledger.select(F.col("batch_id").alias("id")).where("id IS NOT NULL").distinct()
    return updated, used.join(batches.select("id"), "id", "left_anti")


def budget_gate(requests: DataFrame, batches: DataFrame) -> DataFrame:
    """(…, verdict) for requested batch ids: pass, blocked or unknown.

    Blocked means total >= cap. No cap or no batch never blocks.
    """
    caps = batches.select(
        F.col("id").alias("batch_id"), F.coalesce("total_cost_usd", F.lit(0)).alias("_total"), "budget_cap_usd", F.lit(True).alias("_there")
    )
    verdict = (
        F.when(F.col("batch_id").isNull(), "pass")
        .when(F.col("_there").isNull(), "unknown")
        .when(F.col("_total") >= F.col("budget_cap_usd"), "blocked")
        .otherwise("pass")
    )
    return requests.join(caps, "batch_id", "left").withColumn("verdict", verdict).drop("_total", "budget_cap_usd", "_there")


# --- failures and dead letters ----------------------------------------------


def _last_resolution(resolutions: DataFrame) -> DataFrame:
    done = resolutions.where(F.col("resolved_at").isNotNull())
    return done.groupBy(*KEY).agg(F.max("resolved_at").alias("_resolved"))


def failures_after_resolution(
    ledger: DataFrame, resolutions: DataFrame, batch_id: str | None = None, floor: int = HOT_FLOOR
) -> DataFrame:
    """Failed attempts that started after the last resolution of their word and stage.

    Attempts are limited to a batch if one is given, resolutions never are. There is one
    resolution row per key, so a key with very many failures meets it by broadcast.
    """
    failed = ledger.where(F.col("status") == "failed")
    if batch_id is not None:
        failed = failed.where(F.col("batch_id") == batch_id)
    kind = ledger.schema["started_at"].dataType
    since = F.coalesce("_resolved", F.lit(EPOCH).cast(kind))
    joined = join_to_parent(failed, _last_resolution(resolutions), KEY, "left", floor)
    return joined.where(F.col("started_at") > since).drop("_resolved")


def failures_since_resolution(
    ledger: DataFrame, resolutions: DataFrame, batch_id: str | None = None, floor: int = HOT_FLOOR
) -> DataFrame:
    """(word_id, stage_name, failures); keys that failed before but not since have 0."""
    failed = ledger.where(F.col("status") == "failed")
    if batch_id is not None:
        failed = failed.where(F.col("batch_id") == batch_id)
    kind = ledger.schema["started_at"].dataType
    since = F.coalesce("_resolved", F.lit(EPOCH).cast(kind))
    joined = join_to_parent(failed, _last_resolution(resolutions), KEY, "left", floor)
    return joined.groupBy(*KEY).agg(F.count_if(F.col("started_at") > since).alias("failures"))


def third_failure(
    ledger: DataFrame, resolutions: DataFrame, threshold: int = DEAD_AFTER, floor: int = HOT_FLOOR
) -> DataFrame:
    """Dead letters due: the attempt with which the failures since the last resolution reach the threshold.

    Later failures add none. The rank filter lets Spark keep only the first few rows of a key
    in each task before the shuffle.
    """
    since = failures_after_resolution(ledger, resolutions, floor=floor)
    order = Window.partitionBy(*KEY).orderBy("started_at", "id")
    ranked = since.withColumn("attempt", F.row_number().over(order)).where(F.col("attempt") <= threshold)
    return ranked.where(F.col("attempt") == threshold)


def dead_letter_record(dead_letters: DataFrame, due: DataFrame) -> DataFrame:
    """Rows to append to `dead_letters`: (id, word_id, stage_name, error, attempt, created_at, resolved_at).

    A word and stage with an open letter gets no other one, so a rerun over the same ledger
    records nothing.
    """
    still_open = dead_letters.where(F.col("resolved_at").isNull()).select(*KEY)
    due = due.join(still_open, KEY, "left_anti")
    last = dead_letters.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).collect()[0]["m"]
    numbered = number_rows(due, ["started_at", *KEY], "_dead_id", last + 1)
    return numbered.select(
        F.col("_dead_id").alias("id"), *KEY, "error", "attempt", F.col("started_at").alias("created_at"),
        F.lit(None).cast(dead_letters.schema["resolved_at"].dataType).alias("resolved_at"),
    )


def replay(dead_letters: DataFrame, words: DataFrame, wanted: DataFrame, now: Column | None = None) -> dict[str, DataFrame]:
    """Resolve all open dead letters of the wanted words and set those words back to new.

    Returns the next `dead_letters` and `words`, the number `resolved` per word, and the
    `unknown` words, which callers refuse.
    """
    now = F.current_timestamp() if now is None else now
    ids = wanted.select("word_id").distinct()
    known = ids.join(words.select(F.col("id").alias("word_id")), "word_id", "left_semi")
    hit = known.withColumn("_hit", F.lit(True))
    flagged = dead_letters.join(hit, "word_id", "left")
    closes = F.col("_hit") & F.col("resolved_at").isNull()
    kind = dead_letters.schema["resolved_at"].dataType
    renamed = hit.withColumnRenamed("word_id", "id")
    return {
        "dead_letters": flagged.withColumn(
            "resolved_at", F.when(closes, now.cast(kind)).otherwise(F.col("resolved_at"))
        ).select(*dead_letters.columns),
        "words": words.join(renamed, "id", "left").withColumn(
            "status", F.when(F.col("_hit"), "new").otherwise(F.col("status"))
        ).select(*words.columns),
        "resolved": known.join(
            flagged.where(closes).groupBy("word_id").agg(F.count(F.lit(1)).alias("_n")), "word_id", "left"
        ).select("word_id", F.coalesce("_n", F.lit(0)).alias("resolved")),
        "unknown": ids.join(words.select(F.col("id").alias("word_id")), "word_id", "left_anti"),
    }


def open_items(dead_letters: DataFrame, limit: int = 100) -> DataFrame:
    """Unresolved dead letters, newest id first."""
    return dead_letters.where(F.col("resolved_at").isNull()).orderBy(F.col("id").desc()).limit(limit)


# --- words and their artifacts ----------------------------------------------


def _stage(artifacts: DataFrame, stage: str) -> DataFrame:
    return artifacts.where(F.col("stage_name") == stage)


def words_with_artifact(words: DataFrame, artifacts: DataFrame, stage: str, batch_id: str | None = None) -> DataFrame:
    if batch_id is not None:
        words = words.where(F.col("batch_id") == batch_id)
    mine = _stage(artifacts, stage).select(F.col("word_id").alias("id"), "fingerprint", "payload")
    return words.join(mine, "id")


def words_missing_artifact(words: DataFrame, artifacts: DataFrame, stage: str, batch_id: str | None = None) -> DataFrame:
    if batch_id is not None:
        words = words.where(F.col("batch_id") == batch_id)
    return words.join(_stage(artifacts, stage).select(F.col("word_id").alias("id")), "id", "left_anti")


def sample_forms(words: DataFrame, n: int = 10) -> DataFrame:
    return words.select("normalized_form").orderBy("normalized_form").limit(n)


def stage_plan(words: DataFrame, artifacts: DataFrame, expected: DataFrame, unit_cost: dict[str, float], samples: int = 10) -> DataFrame:
    """Per (batch, stage): candidates, has_artifact, stale, needs_rerun, estimated cost, sample forms.

    `expected` is (word_id, stage_name, fingerprint); stale counts artifacts with another one.
    Counts come from one aggregation; samples keep the first forms of each group by rank, so
    no group is collected whole.
    """
    stages = list(unit_cost)
    per_word = words.select("id", "batch_id", "normalized_form", F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage_name"))
    have = artifacts.select(F.col("word_id").alias("id"), "stage_name", F.col("fingerprint").alias("_have"), F.lit(True).alias("_there"))
    want = expected.select(F.col("word_id").alias("id"), "stage_name", F.col("fingerprint").alias("_want"))
    state = per_word.join(have, ["id", "stage_name"], "left").join(want, ["id", "stage_name"], "left")
    there = F.col("_there").isNotNull()
    counts = state.groupBy("batch_id", "stage_name").agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(there).alias("has_artifact"),
        F.count_if(there & ~F.col("_have").eqNullSafe(F.col("_want"))).alias("stale"),
        F.count_if(~there).alias("needs_rerun"),
    )
    order = Window.partitionBy("batch_id", "stage_name").orderBy("normalized_form", "id")
    first = state.where(~there).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= samples)
    shown = first.groupBy("batch_id", "stage_name").agg(
        F.array_sort(F.collect_list("normalized_form")).alias("sample_forms")
    )
    cost = F.create_map(*[F.lit(x) for s, c in unit_cost.items() for x in (s, c)])
    counts = counts.withColumn("estimated_cost_usd", (F.col("needs_rerun") * cost[F.col("stage_name")]).cast(MONEY))
    shown = shown.withColumnsRenamed({"batch_id": "_b", "stage_name": "_s"})
    same_group = F.col("batch_id").eqNullSafe(F.col("_b")) & (F.col("stage_name") == F.col("_s"))
    return counts.join(shown, same_group, "left").drop("_b", "_s").withColumn(
        "sample_forms", F.coalesce("sample_forms", F.array().cast("array<string>"))
    )


def words_to_review(pipeline_words: DataFrame, words: DataFrame, done: DataFrame, batch_id: str | None = None, limit: int | None = None) -> DataFrame:
    """(word_id, form) of finished words, without those that earlier logs cover, then limited."""
    finished = pipeline_words.where(F.col("status") == "done")
    if batch_id is not None:
        finished = finished.where(F.col("batch_id") == batch_id)
    targets = finished.select(F.col("id").alias("_order"), F.col("app_word_id").alias("word_id")).join(
        words.select("word_id", "form"), "word_id"
    )
    left = resume_filter(targets, done)
    if limit is not None:
        left = left.orderBy("_order").limit(limit)
    return left.select("word_id", "form")


def resume_filter(targets: DataFrame, done: DataFrame) -> DataFrame:
    """Targets whose word_id is not done yet."""
    return targets.join(done.select("word_id"), "word_id", "left_anti")


def merge_done_sets(*logs: DataFrame) -> DataFrame:
    """Distinct word_id over several logs; each log is reduced before the union."""
    out = logs[0].select("word_id").distinct()
    for log in logs[1:]:
        out = out.unionByName(log.select("word_id").distinct())
    return out.distinct()


def done_bitmaps(done: DataFrame, key: str = "word_id") -> DataFrame:
    """(bucket, bits): the ids of `done` as bitmaps of 32,768 ids each; repeats and NULL ids leave no trace.

    Partial bitmaps are made before the shuffle, so a log of any length is sent as its ids' bits.
    """
    ids = done.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"))
    place = ids.select(F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("at"))
    return place.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def merge_bitmaps(*sets: DataFrame) -> DataFrame:
    """The ids of all sets: bitmaps of a bucket are joined bit by bit, and no id is listed."""
    out = sets[0]
    for one in sets[1:]:
        out = out.unionByName(one)
    return out.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_done(bitmaps: DataFrame) -> DataFrame:
    """One row: how many ids the bitmaps hold."""
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("done"))


def resume_by_bitmap(targets: DataFrame, bitmaps: DataFrame, key: str = "word_id") -> DataFrame:
    """Targets whose id is in no bitmap; each row looks at one bit of its bucket. Rows without an id stay.

    A bucket has 4 KB, so buckets of up to 32,768 times their number of ids are joined, not ids.
    """
    id_ = F.col(key).cast("bigint")
    placed = targets.withColumn("_bucket", F.bitmap_bucket_number(id_)).withColumn("_at", F.bitmap_bit_position(id_))
    joined = placed.join(bitmaps.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")), "_bucket", "left")
    byte = F.expr("CAST(conv(hex(substring(_bits, CAST(_at DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    there = F.shiftright(byte, 0).bitwiseAND(F.expr("shiftleft(1, CAST(_at % 8 AS INT))")) != 0
    return joined.where(~F.coalesce(there, F.lit(False))).select(*targets.columns)


# --- summaries --------------------------------------------------------------


def run_summary(ledger: DataFrame, hits: DataFrame, words: int | Column, stages: int) -> DataFrame:
    """One row: ok, failed, skipped (fingerprint hits), pruned (what never ran)."""
    attempts = ledger.agg(
        F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "failed").alias("failed")
    )
    skipped = hits.agg(F.count(F.lit(1)).alias("skipped"))
    total = (words if isinstance(words, Column) else F.lit(words)) * stages
    one = attempts.select("ok", "failed", F.lit(0).cast("bigint").alias("skipped")).unionByName(
        skipped.select(F.lit(0).cast("bigint").alias("ok"), F.lit(0).cast("bigint").alias("failed"), "skipped")
    )
    return one.agg(F.sum("ok").alias("ok"), F.sum("failed").alias("failed"), F.sum("skipped").alias("skipped")).withColumn(
        "pruned", total - F.col("ok") - F.col("failed") - F.col("skipped")
    )


def experiment_summary(items: DataFrame) -> DataFrame:
    """Per run: how many answers came, how many were valid, what they cost."""
    return items.groupBy("run_id").agg(
        F.count_if("ok").alias("ok_count"), F.count_if("valid").alias("valid_count"),
        F.sum("cost_usd").cast(TOTAL).alias("total_cost_usd"),
    )

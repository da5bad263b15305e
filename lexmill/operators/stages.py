"""Incremental stages: what must run, running it, checking quality, publishing.

A stage is a DataFrame-to-DataFrame function. Its input has one row per word with the
upstream payloads as `up_<stage>`; its output is (word_id, payload, error, ...).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexmill.functions import lookups
from lexmill.functions import nested as N
from lexmill.functions import text as T
from lexmill.functions.hashing import stage_fingerprint, to_json
from lexmill.operators import ledger as G
from lexmill.session import by_rows, cut_lineage
from lexmill.sources.buckets import BucketedTable

StageFn = Callable[[DataFrame], DataFrame]

# The stages in the order in which they run.
STAGE_ORDER = ("fetch_dict", "paraphrase", "phonetic", "derivatives", "examples", "mnemonic", "quality_gate", "export")


@dataclass(frozen=True)
class Stage:
    name: str
    upstream: tuple[str, ...]
    fn: StageFn
    config_json: str = '{"parser_version":"1"}'
    prompt_version: str | None = None
    prompt_hash: str | None = None
    parser_version: str = "1"
    soft: tuple[str, ...] = field(default=())


_STAGES: dict[str, Stage] = {}


def register_stage(stage: Stage) -> None:
    _STAGES[stage.name] = stage


def registered_stages() -> list[Stage]:
    """Registered stages in running order; stages of other names come after the known ones."""
    rank = {name: i for i, name in enumerate(STAGE_ORDER)}
    return sorted(_STAGES.values(), key=lambda s: rank.get(s.name, len(rank)))


OUTPUT = {
    "payload": "string", "error": "string", "source": "string", "model": "string", "prompt_version": "string",
    "cost_usd": "decimal(10,6)", "tokens_input": "bigint", "tokens_output": "bigint",
}
ARTIFACT = ["word_id", "stage_name", "fingerprint", "payload", "source", "model", "prompt_version"]


def _optional(df: DataFrame, name: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast(OUTPUT[name]).alias(name)


# --- deciding ---------------------------------------------------------------


def upstream_wide(artifacts: DataFrame, stages: Sequence[str], values: dict[str, str]) -> DataFrame:
    """One row per word with `<prefix><stage>` columns for each value column and its prefix.

    A word has at most one artifact per stage, so the list collected for it has at most
    len(stages) entries.
    """
    mine = artifacts.where(F.col("stage_name").isin(*stages))
    entry = F.struct("stage_name", F.struct(*values).alias("value"))
    wide = mine.groupBy("word_id").agg(F.map_from_entries(F.collect_list(entry)).alias("_by_stage"))
    return wide.select(
        "word_id", F.map_keys("_by_stage").alias("_present"),
        *[F.col("_by_stage")[s][value].alias(f"{prefix}{s}") for s in stages for value, prefix in values.items()],
    )


def first_absent(stages: Sequence[str], message: str) -> Column:
    """The message with the first stage that `upstream_wide` did not find; NULL when all are there."""
    present = F.coalesce("_present", F.array().cast("array<string>"))
    absent = F.array_except(F.array(*[F.lit(s) for s in stages]).cast("array<string>"), present)
    return F.concat(F.lit(message), F.get(absent, F.lit(0)))


def expected_fingerprints(words: DataFrame, artifacts: DataFrame, stage: Stage) -> DataFrame:
    """(word_id, expected) for every word, from the fingerprints of the upstream artifacts."""
    none = F.lit(None).cast("string")
    if stage.upstream:
        wide = upstream_wide(artifacts, stage.upstream, {"fingerprint": "_fp_"})
        rows = words.select("word_id").join(by_rows(wide), "word_id", "left")
        upstream = F.array_compact(F.array(*[F.col(f"_fp_{s}") for s in stage.upstream]))
    else:
        rows = words.select("word_id")
        upstream = F.array().cast("array<string>")
    key = stage_fingerprint(
        upstream, F.lit(stage.config_json), F.lit(stage.prompt_version) if stage.prompt_version else none,
        F.lit(stage.prompt_hash) if stage.prompt_hash else none, F.lit(stage.parser_version),
    )
    return rows.select("word_id", key.alias("expected"))


def stale_closure(stages: Sequence[Stage], words: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(word_id, stage_name, reason): what a run of `stages` would do again, told before it runs.

    A stage's expected fingerprint follows from those that its upstream stages are expected to
    have, so a change runs down the graph: `missing` has no artifact, `changed` differs by its
    own settings or a new upstream artifact, `upstream` only because a stage above will be run
    again. Artifacts are put side by side once per word; all stages are then judged in that row,
    without a join for each. Stages are taken after the ones they need; a cycle is an error.
    Words that would fail above are still listed.
    """
    by_name, placed = {s.name: s for s in stages}, []
    while len(placed) < len(by_name):
        ready = [s for s in stages if s.name not in placed and all(u in placed or u not in by_name for u in s.upstream)]
        if not ready:
            raise ValueError("the stages need each other in a circle")
        placed += [s.name for s in ready]
    named = sorted({u for s in stages for u in (s.name, *s.upstream)})
    wide = upstream_wide(artifacts, named, {"fingerprint": "_fp_"})
    rows = words.select("word_id").join(wide, "word_id", "left")
    text = lambda value: F.lit(value).cast("string")

    def key(stage: Stage, upstream: list[Column]) -> Column:
        listed = F.array_compact(F.array(*upstream)) if upstream else F.array().cast("array<string>")
        return stage_fingerprint(listed, F.lit(stage.config_json), text(stage.prompt_version or None), text(stage.prompt_hash or None), F.lit(stage.parser_version))

    found = []
    for name in placed:
        stage = by_name[name]
        expected = {u: F.col(f"_ex_{u}") if u in by_name else F.col(f"_fp_{u}") for u in stage.upstream}
        rows = rows.withColumn(f"_ex_{name}", key(stage, list(expected.values())))
        stored = F.col(f"_fp_{name}")
        as_it_is = key(stage, [F.col(f"_fp_{u}") for u in stage.upstream])
        reason = (
            F.when(stored.isNull(), "missing").when(~as_it_is.eqNullSafe(stored), "changed")
            .when(F.col(f"_ex_{name}") != stored, "upstream")
        )
        found.append(F.when(reason.isNotNull(), F.struct(F.lit(name).alias("stage_name"), reason.alias("reason"))))
    listed = rows.select("word_id", F.explode_outer(F.array_compact(F.array(*found))).alias("s")).where("s IS NOT NULL")
    return listed.select("word_id", "s.*")


def stage_worklist(
    expected: DataFrame, artifacts: DataFrame, stage: str, failed: DataFrame | None = None, force: bool = False
) -> DataFrame:
    """(word_id, expected, hit): hit words keep their artifact, the others must run.

    A word must run when its stored fingerprint is missing or differs, or always with force.
    Words in `failed` dropped out in an earlier stage.
    """
    stored = artifacts.where(F.col("stage_name") == stage).select("word_id", F.col("fingerprint").alias("_stored"))
    rows = expected if failed is None else expected.join(failed.select("word_id").distinct(), "word_id", "left_anti")
    same = F.lit(False) if force else F.col("expected").eqNullSafe(F.col("_stored"))
    return rows.join(by_rows(stored), "word_id", "left").select("word_id", "expected", same.alias("hit"))


# --- running ----------------------------------------------------------------


# Up to this many words of a stage are sent to all tasks, which then look up their artifacts only.
FEW = 100_000


@dataclass
class StageRun:
    """`artifacts` are the stage's own rows only, of which this run wrote `fresh`; those of other stages are not touched."""

    artifacts: DataFrame
    fresh: DataFrame
    ledger: DataFrame
    hits: DataFrame
    survivors: DataFrame


def run_stage(
    stage: Stage, words: DataFrame, artifacts: DataFrame, batch_id: Column | None = None,
    force: bool = False, now: Column | None = None,
) -> StageRun:
    """Run one stage for `words` (word_id, form, type, ...).

    Rows that come back with a payload replace the word's artifact and get an ok row in the
    ledger; rows with an error get a failed row only and leave the run. The worklist and the
    function's output are written once, because several results are derived from each.
    """
    now = F.current_timestamp() if now is None else now
    batch = F.lit(None).cast("string") if batch_id is None else batch_id
    listed = cut_lineage(stage_worklist(expected_fingerprints(words, artifacts, stage), artifacts, stage.name, force=force))
    todo = listed.where(~F.col("hit")).drop("hit")
    work = words.join(by_rows(todo), "word_id")
    needed = (*stage.upstream, *stage.soft)
    empty = {c: F.lit(None).cast(t).alias(c) for c, t in OUTPUT.items()}
    if needed:
        # A run with little to do moves the payloads of those words only.
        ids = todo.select("word_id").distinct()
        mine = artifacts if todo.count() > FEW else artifacts.join(F.broadcast(ids), "word_id", "left_semi")
        missing = first_absent(stage.upstream, "missing upstream artifact ")
        # What is lost is told from the fingerprints, so payloads are put together once, for the function.
        there = work.join(by_rows(upstream_wide(mine, needed, {"fingerprint": "_fp_"})), "word_id", "left")
        lost = there.select("word_id", missing.alias("_missing")).where("_missing IS NOT NULL").select(
            "word_id", *[F.col("_missing").alias(c) if c == "error" else none for c, none in empty.items()]
        )
        work = work.join(by_rows(upstream_wide(mine, needed, {"payload": "up_", "source": "src_"})), "word_id", "left").where(missing.isNull())
    else:
        lost = words.limit(0).select("word_id", *empty.values())
    produced = stage.fn(work)
    out = produced.select("word_id", *[_optional(produced, c) for c in OUTPUT])
    done = cut_lineage(out.unionByName(lost).join(by_rows(listed.select("word_id", "expected")), "word_id"))
    ok = done.where("error IS NULL")
    fresh = ok.select("word_id", F.lit(stage.name).alias("stage_name"), F.col("expected").alias("fingerprint"), *ARTIFACT[3:])
    kept = artifacts.where(F.col("stage_name") == stage.name).join(by_rows(ok.select("word_id")), "word_id", "left_anti")
    attempts = done.select(
        batch.alias("batch_id"), "word_id", F.lit(stage.name).alias("stage_name"),
        F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"), "model", "tokens_input", "tokens_output",
        F.when(F.col("error").isNull(), F.coalesce("cost_usd", F.lit(0))).cast("decimal(10,6)").alias("cost_usd"),
        T.truncate_text(F.col("error"), "error").alias("error"), now.alias("started_at"),
    )
    failed = done.where("error IS NOT NULL").select("word_id")
    return StageRun(
        artifacts=kept.select(*ARTIFACT).unionByName(fresh),
        fresh=fresh,
        ledger=attempts,
        hits=listed.where("hit").select("word_id"),
        survivors=words.join(by_rows(failed), "word_id", "left_anti"),
    )


@dataclass
class ChainRun:
    artifacts: DataFrame
    ledger: DataFrame | None
    report: list[tuple[str, int, int, int]]
    stopped_at: str | None = None
    dead_letters: DataFrame | None = None


class ArtifactStore:
    """Artifacts under a folder of the caller's: one bucketed table per stage, keyed by word.

    A run of a stage rewrites the buckets of the words that it worked on, in that stage's table
    and no other.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, buckets: int):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.schema = StructType([schema[c] for c in ARTIFACT])
        self.tables: dict[str, BucketedTable] = {}

    def of(self, stage: str) -> BucketedTable:
        if stage not in self.tables:
            self.tables[stage] = BucketedTable.open(self.spark, f"{self.root}/{stage}", self.schema, ["word_id"], self.buckets)
        return self.tables[stage]

    def read(self, stages: Iterable[str]) -> DataFrame:
        out = self.spark.createDataFrame([], self.schema)
        for stage in sorted(set(stages)):
            out = out.unionByName(self.of(stage).read())
        return out


def stage_chain(
    stages: Sequence[Stage], words: DataFrame, artifacts: DataFrame | ArtifactStore, batch_id: str | None = None,
    batches: DataFrame | None = None, force: bool = False, now: Column | None = None,
    history: DataFrame | None = None, dead_letters: DataFrame | None = None,
) -> ChainRun:
    """Run stages in order on the words that survive, checking the budget before each.

    After a stage the artifacts that it made are written, and no others: into the store, where
    a later run finds them, or beside the given table. A stage without work writes none. Only
    counts come to the driver: one row per stage.
    With `dead_letters`, the result holds them and a new one for each word and stage whose
    failures in `history` (an earlier ledger) and this run reach the threshold.
    """
    store = artifacts if isinstance(artifacts, ArtifactStore) else None
    named = {name for s in stages for name in (s.name, *s.upstream, *s.soft)}
    artifacts = artifacts.select(*ARTIFACT) if store is None else store.read(named)

    def ended(stopped_at: str | None = None) -> ChainRun:
        letters = None
        if dead_letters is not None and spent is not None:
            letters = dead_letters.unionByName(_letters_due(history, spent, dead_letters))
        return ChainRun(artifacts, spent, report, stopped_at, letters)

    spent: DataFrame | None = None
    report = []
    batch = F.lit(batch_id).cast("string")
    for stage in stages:
        if batches is not None and batch_id is not None:
            current = batches if spent is None else G.add_batch_cost(batches, spent)[0]
            asked = words.sparkSession.range(1).select(batch.alias("batch_id"))
            verdict = G.budget_gate(asked, current).collect()[0]["verdict"]
            if verdict == "unknown":
                raise LookupError(f"unknown batch {batch_id!r}")
            if verdict == "blocked":
                return ended(stage.name)
        mine = artifacts if store is None else store.read((stage.name, *stage.upstream, *stage.soft))
        run = run_stage(stage, words, mine, batch, force, now)
        spent = run.ledger if spent is None else spent.unionByName(run.ledger)
        counts = run.ledger.agg(F.count_if(F.col("status") == "ok"), F.count_if(F.col("status") == "failed")).collect()[0]
        if counts[0] and store is not None:
            store.of(stage.name).put(run.fresh)
            artifacts = store.read(named)
        elif counts[0]:
            fresh = cut_lineage(run.fresh)
            mine = F.col("stage_name") == stage.name
            kept = artifacts.where(mine).join(by_rows(fresh.select("word_id")), "word_id", "left_anti").select(*ARTIFACT)
            artifacts = artifacts.where(~mine).unionByName(kept).unionByName(fresh)
        report.append((stage.name, counts[0], counts[1], run.hits.count()))
        if counts[1]:
            words = cut_lineage(run.survivors)
    return ended()


def _letters_due(history: DataFrame | None, run: DataFrame, dead_letters: DataFrame) -> DataFrame:
    """Dead letters that a run adds; a resolved letter starts the count of its word and stage anew."""
    columns = ["word_id", "stage_name", "status", "error", "started_at", "id"]
    attempts = run.withColumn("id", F.monotonically_increasing_id()).select(*columns)
    if history is not None:
        kind = history.schema["started_at"].dataType
        attempts = history.select(*columns).unionByName(attempts.withColumn("started_at", F.col("started_at").cast(kind)))
    attempts = cut_lineage(attempts.where("status = 'failed'"))
    due = G.third_failure(attempts, dead_letters.select("word_id", "stage_name", "resolved_at"))
    return G.dead_letter_record(dead_letters, due).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in dead_letters.schema])


# --- quality ----------------------------------------------------------------

Rule = Callable[[dict[str, Column]], Column]
_RULES: dict[str, Rule] = {}


def register_rule(name: str, rule: Rule) -> None:
    """`rule` gets the payload variants by stage and returns an array of failure details."""
    _RULES[name] = rule


def _when_array(condition: Column, detail: str) -> Column:
    return F.when(condition, F.array(F.lit(detail))).otherwise(F.array().cast("array<string>"))


def _missing_text(field_name: str) -> Rule:
    def rule(up: dict[str, Column]) -> Column:
        meanings = N.items(up["paraphrase"], "$.meanings")
        lacks = F.transform(
            meanings,
            lambda m, i: F.when(
                F.coalesce(N.text_at(m, f"$.{field_name}"), F.lit("")) == "",
                F.concat(F.lit("meaning["), i, F.lit(f"] missing {field_name}")),
            ),
        )
        return F.array_compact(lacks)

    return rule


def _covered(up: dict[str, Column]) -> Column:
    return F.filter(N.items(up["examples"], "$.per_meaning"), lambda p: F.size(N.items(p, "$.examples")) > 0)


# The rules and their messages.
register_rule(
    "meanings_non_empty",
    lambda up: _when_array(F.size(N.items(up["paraphrase"], "$.meanings")) == 0, "paraphrase has 0 meanings"),
)
register_rule("each_meaning_has_cn", _missing_text("cn"))
register_rule("each_meaning_has_pos", _missing_text("pos"))
register_rule(
    "examples_coverage",
    lambda up: _when_array(
        (F.size(N.items(up["paraphrase"], "$.meanings")) > 0) & (F.size(_covered(up)) == 0), "no meaning has any example"
    ),
)
register_rule(
    "mnemonic_present",
    lambda up: _when_array(F.coalesce(N.text_at(up["mnemonic"], "$.mnemonic"), F.lit("")) == "", "empty mnemonic"),
)

GATED = ("paraphrase", "derivatives", "examples", "mnemonic")


def quality_gate(df: DataFrame, prefix: str = "up_") -> DataFrame:
    """Add passed and failed_rules from the payload columns of the gated stages (JSON text).

    A missing upstream payload is an error of its own, named in `error`.
    """
    parsed = df.withColumns({f"_v_{s}": F.try_parse_json(f"{prefix}{s}") for s in GATED})
    variants = {s: F.col(f"_v_{s}") for s in GATED}
    named = F.concat(*[_named(name, rule(variants)) for name, rule in _RULES.items()])
    absent = F.coalesce(*[F.when(F.col(f"{prefix}{s}").isNull(), f"{s} artifact missing") for s in GATED])
    return (
        parsed.withColumn("failed_rules", named)
        .withColumn("error", absent)
        .withColumn("passed", F.col("error").isNull() & (F.size("failed_rules") == 0))
        .drop(*[f"_v_{s}" for s in GATED])
    )


def _named(name: str, details: Column) -> Column:
    return F.transform(details, lambda d: F.concat(F.lit(f"{name}: "), d))


# --- publishing -------------------------------------------------------------


def classify_export(incoming: DataFrame, words: DataFrame) -> DataFrame:
    """(…, existing_id, case): A is new, B belongs to the pipeline, C to somebody else."""
    there = words.select("form", "type", F.col("word_id").alias("existing_id"), F.col("source").alias("_owner"))
    case = (
        F.when(F.col("existing_id").isNull(), "A")
        .when(T.source_origin(F.col("_owner")) == "pipeline", "B")
        .otherwise("C")
    )
    return incoming.join(by_rows(there), ["form", "type"], "left").withColumn("case", case).drop("_owner")


def link_words(pipeline_words: DataFrame, exported: DataFrame) -> DataFrame:
    """Pipeline words with app_word_id and status done where an export (id, app_word_id) went through."""
    linked = exported.select("id", F.col("app_word_id").alias("_to"))
    return pipeline_words.join(linked, "id", "left").withColumn(
        "status", F.when(F.col("_to").isNotNull(), "done").otherwise(F.col("status"))
    ).withColumn("app_word_id", F.coalesce("_to", "app_word_id")).drop("_to")


# Inflected forms that a word row carries.
INFLECTIONS = (
    "plural", "past_tense", "past_participle", "third_person", "present_participle", "comparative", "superlative",
)


def domain_words(df: DataFrame) -> DataFrame:
    """Word rows from the payload variants v_<stage> and sources src_<stage> of each word."""
    def text(stage: str, name: str) -> Column:
        return N.text_at(F.col(f"v_{stage}"), f"$.{name}")

    structure = N.at(F.col("v_paraphrase"), "$.structure")
    filled = N.has_kind(structure, "OBJECT") & (F.to_json(structure) != "{}")
    derived = F.col("v_derivatives")
    return df.select(
        "word_id", "form", "type",
        *[text("phonetic", c).alias(c) for c in ("phonetic_us", "phonetic_uk", "audio_us", "audio_uk")],
        F.when(filled, F.to_json(structure)).alias("structure"),
        *[text("derivatives", f"word_forms.{c}").alias(c) for c in INFLECTIONS],
        F.when(N.has_kind(derived, "OBJECT") & (F.to_json(derived) != "{}"), F.to_json(derived)).alias("derivatives"),
        F.col("src_paraphrase").alias("source"),
    )


def _string_list(entry: Column, name: str) -> Column:
    values = F.transform(N.items(entry, f"$.{name}"), lambda v: N.text_at(v))
    return F.when(F.size(values) > 0, values)


def domain_meanings(df: DataFrame) -> DataFrame:
    """Meaning rows in order; derivatives come from the first entry with the meaning's index."""
    listed = df.withColumn("_per", N.items(F.col("v_derivatives"), "$.per_meaning"))
    rows = listed.select(
        "word_id", "src_paraphrase", "_per", F.posexplode_outer(N.items(F.col("v_paraphrase"), "$.meanings")).alias("meaning_index", "m")
    ).where("meaning_index IS NOT NULL")
    mine = F.filter("_per", lambda d: F.try_variant_get(d, "$.meaning_index", "int") == F.col("meaning_index"))
    found = rows.withColumn("_d", F.get(mine, F.lit(0)))
    return found.select(
        "word_id", "meaning_index", lookups.pos_code(N.text_at(F.col("m"), "$.pos")).alias("pos"),
        N.text_at(F.col("m"), "$.cn").alias("cn_paraphrase"), N.text_at(F.col("m"), "$.en").alias("en_paraphrase"),
        *[_string_list(F.col("_d"), c).alias(c) for c in ("equivalents", "synonyms", "antonyms")],
        F.col("src_paraphrase").alias("source"),
    )


def domain_sentences(df: DataFrame) -> DataFrame:
    """Sentence rows by (word_id, meaning_index, example_index); the last entry of an index counts.

    Sentences without text or translation are dropped, and so are those of a meaning that the
    word does not have.
    """
    entries = N.items(F.col("v_examples"), "$.per_meaning")
    indexed = F.transform(
        entries,
        lambda p: F.struct(
            F.when(N.has_kind(N.at(p, "$.meaning_index"), "BIGINT"), F.try_variant_get(p, "$.meaning_index", "int")).alias("i"),
            F.when(N.has_kind(N.at(p, "$.examples"), "ARRAY"), N.items(p, "$.examples")).alias("ex"),
        ),
    )
    usable = F.filter(indexed, lambda p: p["i"].isNotNull() & p["ex"].isNotNull())
    count = F.size(N.items(F.col("v_paraphrase"), "$.meanings"))
    prepared = df.withColumn("_entries", usable).withColumn("_count", count)
    rows = prepared.select(
        "word_id", "src_examples", "_entries", "_count", F.posexplode_outer("_entries").alias("_at", "_e")
    ).where("_at IS NOT NULL")
    later = F.exists(
        F.slice(F.col("_entries"), F.col("_at") + 2, F.size("_entries")), lambda p: p["i"] == F.col("_e.i")
    )
    last = rows.where(~later & (F.col("_e.i") < F.col("_count")) & (F.col("_e.i") >= 0))
    texts = last.select(
        "word_id", F.col("_e.i").alias("meaning_index"), F.col("src_examples").alias("source"),
        F.posexplode_outer("_e.ex").alias("example_index", "x"),
    ).where("x IS NOT NULL")
    return texts.select(
        "word_id", "meaning_index", "example_index", N.text_at(F.col("x"), "$.en").alias("form"),
        N.text_at(F.col("x"), "$.cn").alias("translation"), "source",
    ).where((F.col("form") != "") & (F.col("translation") != ""))


def domain_mnemonics(df: DataFrame) -> DataFrame:
    told = N.text_at(F.col("v_mnemonic"), "$.mnemonic")
    kind = F.coalesce(N.text_at(F.col("v_mnemonic"), "$.kind"), F.lit("phonetic"))
    return df.where(told != "").select(
        "word_id", F.lit(1).cast("smallint").alias("type"), kind.alias("kind"), told.alias("text"), F.col("src_mnemonic").alias("source")
    )


EXPORT_UPSTREAM = STAGE_ORDER[:-1]


def build_domain_rows(words: DataFrame, artifacts: DataFrame) -> dict[str, DataFrame]:
    """Word, meaning, sentence and mnemonic rows from the seven artifacts of each word.

    `refused` lists words with a missing artifact or a failed quality gate, and why.
    """
    return domain_rows_of(words.join(upstream_wide(artifacts, EXPORT_UPSTREAM, {"payload": "up_", "source": "src_"}), "word_id", "left"))


def domain_rows_of(wide: DataFrame) -> dict[str, DataFrame]:
    """The same from words that carry their payloads as up_<stage> and sources as src_<stage>."""
    parsed = wide.withColumns({f"v_{s}": F.try_parse_json(f"up_{s}") for s in EXPORT_UPSTREAM})
    passed = F.coalesce(F.try_variant_get("v_quality_gate", "$.passed", "boolean"), F.lit(False))
    absent = first_absent(EXPORT_UPSTREAM, "missing upstream artifact ")
    judged = parsed.withColumn("reason", F.coalesce(absent, F.when(~passed, "quality gate did not pass")))
    good = judged.where("reason IS NULL")
    return {
        "words": domain_words(good),
        "meanings": domain_meanings(good),
        "sentences": domain_sentences(good),
        "mnemonics": domain_mnemonics(good),
        "refused": judged.where("reason IS NOT NULL").select("word_id", "reason"),
    }


def as_payload(*fields: Column) -> Column:
    return to_json(F.struct(*fields))

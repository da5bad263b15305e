"""The last stage: finished words become rows of the vocabulary and documents of serving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.hashing import to_json
from lexmill.operators import stages as S
from lexmill.operators import tables as O
from lexmill.operators.documents import serving_payload
from lexmill.operators.numbering import HOT_FLOOR, join_to_parent, number_rows
from lexmill.session import by_rows, cut_lineage
from lexmill.sources.buckets import BucketedTable

CHILDREN = ("meanings", "sentences", "mnemonics", "phrases")


def _last_id(table: DataFrame, key: str) -> int:
    """One number comes to the driver; keys that are no numbers do not count."""
    return table.agg(F.coalesce(F.max(F.col(key).try_cast("bigint")), F.lit(0)).alias("m")).collect()[0]["m"]


def _append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """`table` with `rows`, in the table's columns and types; what the rows lack is NULL."""
    fields = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
    return table.unionByName(rows.select(*fields))


def _with_offenders(words: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(word_id, offender) of the given existing words that have a child of another origin."""
    ids = words.select("word_id")
    mine = tables["meanings"].join(by_rows(ids), "word_id", "left_semi")
    deep = tables["sentences"].join(by_rows(mine.select("meaning_id", "word_id")), "meaning_id")
    hooks = tables["mnemonics"].join(by_rows(ids), "word_id", "left_semi")
    owned = tables["phrases"].join(by_rows(ids.withColumnRenamed("word_id", "owner_word_id")), "owner_word_id", "left_semi")
    return O.prefix_guard(words, O.union_child_sources(mine, deep, hooks, owned)).select("word_id", "offender")


def export_words(rows: dict[str, DataFrame], tables: dict[str, DataFrame], floor: int = HOT_FLOOR) -> dict[str, DataFrame]:
    """Write the domain rows of finished pipeline words into the vocabulary tables.

    `rows` is what `build_domain_rows` returns, keyed by the pipeline's word ids. A word whose
    (form, type) is new is inserted (case A); one that belongs to the pipeline is updated and
    its pipeline children are replaced (B); one that belongs to somebody else stays as it is
    and is only linked (C). An existing word with a child of another origin than its own is
    refused and keeps every row. Of several pipeline words with one (form, type) the last
    writes; the others are linked to it.

    Returns the next tables, `payloads` (word_id, app_word_id, case), `refused` (word_id,
    reason) and `affected`, the ids of the words that were written.
    """
    words = tables["words"]
    incoming = rows["words"].withColumnRenamed("word_id", "pipeline_id")
    classified = cut_lineage(S.classify_export(incoming, words))
    existing = words.join(by_rows(classified.select(F.col("existing_id").alias("word_id")).distinct()), "word_id", "left_semi").select("word_id", "source")
    offenders = cut_lineage(_with_offenders(existing, tables))
    blocked = offenders.withColumnRenamed("word_id", "existing_id")
    going = classified.join(by_rows(blocked.select("existing_id")), "existing_id", "left_anti")
    refused = classified.join(by_rows(blocked), "existing_id").select(
        F.col("pipeline_id").alias("word_id"), F.concat(F.lit("child of another origin: "), "offender").alias("reason")
    )
    ends = going.groupBy("form", "type").agg(F.min("pipeline_id").alias("_first"), F.max("pipeline_id").alias("_last"))
    going = cut_lineage(going.join(by_rows(ends), ["form", "type"]))
    writers = going.where((F.col("pipeline_id") == F.col("_last")) & F.col("case").isin("A", "B"))

    fresh = number_rows(writers.where("case = 'A'").select("form", "type", "_first"), ["_first"], "app_word_id", _last_id(words, "word_id") + 1)
    made = cut_lineage(fresh.select("form", "type", "app_word_id"))
    linked = going.join(by_rows(made), ["form", "type"], "left").withColumn("app_word_id", F.coalesce("app_word_id", "existing_id"))
    # Within one run the first word of a new spelling inserts it, the next ones find it.
    case = F.when((F.col("case") == "A") & (F.col("pipeline_id") != F.col("_first")), "B").otherwise(F.col("case"))
    linked = cut_lineage(linked.withColumn("case", case))
    payloads = linked.select(F.col("pipeline_id").alias("word_id"), "app_word_id", "case")

    written = linked.join(by_rows(writers.select("pipeline_id")), "pipeline_id", "left_semi")
    data = [c for c in incoming.columns if c not in ("pipeline_id", "form", "type") and c in words.columns]
    change = written.where(F.col("existing_id").isNotNull()).select(
        F.col("app_word_id").alias("word_id"), F.lit(True).alias("_hit"), *[F.col(c).cast(words.schema[c].dataType).alias(f"_n_{c}") for c in data]
    )
    updated = words.join(by_rows(change), "word_id", "left").select(
        *[F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in data else F.col(c) for c in words.columns]
    )
    inserted = written.where(F.col("existing_id").isNull()).withColumn("word_id", F.col("app_word_id")).withColumn(
        "status", F.lit(1)
    ).withColumn("quality_flag", F.lit("none"))
    out = {"words": _append(updated, inserted.select(*[c for c in inserted.columns if c in words.columns]))}

    names = written.select(F.col("pipeline_id").alias("word_id"), F.col("app_word_id").alias("_app"))

    def moved(kind: str) -> DataFrame:
        mine = join_to_parent(rows[kind], names, ["word_id"], "inner", floor)
        return mine.withColumn("word_id", F.col("_app")).drop("_app")

    out |= O.cascade_delete(change.select("word_id"), {kind: tables[kind] for kind in CHILDREN})
    meanings = number_rows(moved("meanings"), ["word_id", "meaning_index"], "meaning_id", _last_id(tables["meanings"], "meaning_id") + 1)
    meanings = cut_lineage(meanings)
    address = meanings.select("word_id", "meaning_index", "meaning_id")
    placed = join_to_parent(moved("sentences"), address, ["word_id", "meaning_index"], "inner", floor)
    sentences = number_rows(placed, ["meaning_id", "example_index"], "sentence_id", _last_id(tables["sentences"], "sentence_id") + 1)
    mnemonics = number_rows(moved("mnemonics"), ["word_id"], "mnemonic_id", _last_id(tables["mnemonics"], "mnemonic_id") + 1)
    for kind, new in (("meanings", meanings), ("sentences", sentences), ("mnemonics", mnemonics)):
        out[kind] = _append(out[kind], new)
    return out | {
        "payloads": payloads,
        "refused": rows["refused"].unionByName(refused),
        "affected": written.select(F.col("app_word_id").alias("word_id")).distinct(),
    }


def serving_refresh(changed: DataFrame, tables: dict[str, DataFrame], packages: DataFrame, **options) -> dict[str, DataFrame]:
    """The serving rows to `upsert`, the ids to `remove` and all ids of both for the changed words (a DataFrame with word_id).

    Only those words' rows are read into documents; a word that is not published, or no longer
    there, is removed.
    """
    ids = cut_lineage(changed.select("word_id").distinct())
    words = tables["words"].join(by_rows(ids), "word_id", "left_semi")
    meanings = tables["meanings"].join(by_rows(ids), "word_id", "left_semi")
    upsert = serving_payload(
        words, meanings, tables["sentences"].join(by_rows(meanings.select("meaning_id")), "meaning_id", "left_semi"),
        tables["mnemonics"].join(by_rows(ids), "word_id", "left_semi"),
        tables["phrases"].join(by_rows(ids.withColumnRenamed("word_id", "owner_word_id")), "owner_word_id", "left_semi"),
        packages.join(by_rows(ids), "word_id", "left_semi"), whole=tables | {"packages": packages}, **options,
    )
    published = words.where(F.col("status") == 1).select("word_id")
    return {"upsert": upsert, "remove": ids.join(by_rows(published), "word_id", "left_anti"), "ids": ids}


def apply_refresh(serving: DataFrame, refresh: dict[str, DataFrame]) -> DataFrame:
    """The next serving table: changed words replaced or taken out, all others as they are."""
    touched = refresh["upsert"].select("word_id").distinct().unionByName(refresh["remove"])
    return serving.join(by_rows(touched), "word_id", "left_anti").unionByName(refresh["upsert"].select(*serving.columns))


def apply_refresh_in_place(serving: BucketedTable, refresh: dict[str, DataFrame]) -> list[int]:
    """`apply_refresh` written into a serving table keyed by word_id; returns the rewritten buckets."""
    return serving.swap(refresh["ids"], refresh["upsert"])


class Exporter:
    """The export stage of a chain. After it ran, `tables` are the next vocabulary tables.

    Words that are refused fail the stage and keep all their rows. `affected` names the words
    whose serving rows are to be refreshed.
    """

    def __init__(self, tables: dict[str, DataFrame], source: str = "pipeline:local:export_v1"):
        self.tables = tables
        self.source = source
        self.affected: DataFrame | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        done = export_words(S.domain_rows_of(df), self.tables)
        self.tables = self.tables | {name: cut_lineage(done[name]) for name in ("words", *CHILDREN)}
        self.affected = done["affected"]
        payload: Column = to_json(F.struct("app_word_id", "case"))
        none = F.lit(None).cast("string")
        good = done["payloads"].select("word_id", payload.alias("payload"), none.alias("error"), F.lit(self.source).alias("source"))
        bad = done["refused"].select("word_id", none.alias("payload"), F.col("reason").alias("error"), F.lit(self.source).alias("source"))
        return good.unionByName(bad)

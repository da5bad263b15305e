"""Keyed tables: insert-or-keep, upserts, deletes that cascade, constraints, versions.

Every operator takes the current rows and returns the next ones; publishing them is the
business of sources/writers.py.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators.numbering import HOT_FLOOR, join_to_parent, number_rows, position_in_parent

PIPELINE = "pipeline"


# --- insert and upsert ------------------------------------------------------


def first_spelling(lines: DataFrame, order: Sequence[str], raw: str = "raw_form", keep: Sequence[str] = ()) -> DataFrame:
    """(normalized_form, type, raw_form, first_seen, ...): the first raw spelling of each form.

    Lines are first reduced to distinct spellings with their earliest place. With one numeric
    order column that is a hash aggregation before the shuffle; several columns compare as a
    struct and aggregate by sorting. Only spellings are then normalised. Blank lines are left out.
    """
    seen = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    spellings = lines.where(~T.is_blank(F.col(raw))).groupBy(raw, *keep).agg(F.min(seen).alias("_seen"))
    forms = T.with_normalized(spellings, raw)
    first = F.min(F.struct(F.col("_seen").alias("seen"), F.col(raw).alias("raw_form"), *keep)).alias("_first")
    grouped = forms.groupBy("normalized_form", "type").agg(first)
    return grouped.select(
        "normalized_form", "type", "_first.raw_form", F.col("_first.seen").alias("first_seen"),
        *[F.col(f"_first.{c}").alias(c) for c in keep],
    )


def insert_ignore(current: DataFrame, lines: DataFrame, order: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows to add to `current`, keyed by (normalized_form, type); what exists is not touched.

    New ids follow the largest existing one in order of first appearance.
    """
    fresh = first_spelling(lines, order, keep=keep).join(
        current.select("normalized_form", "type"), ["normalized_form", "type"], "left_anti"
    )
    # One number comes to the driver.
    last = current.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).collect()[0]["m"]
    return number_rows(fresh, ["first_seen"], "id", last + 1).select(
        "id", "raw_form", "normalized_form", "type", *keep
    )


def insert_outcome(current: DataFrame, lines: DataFrame, raw: str = "raw_form") -> DataFrame:
    """One row: inserted, deduped, skipped_empty."""
    spellings = lines.groupBy(raw).agg(F.count(F.lit(1)).alias("_n"))
    forms = T.with_normalized(spellings, raw).groupBy("normalized_form", "type").agg(F.sum("_n").alias("_n"))
    known = current.select("normalized_form", "type", F.lit(True).alias("_known"))
    marked = forms.join(known, ["normalized_form", "type"], "left")
    blank = F.col("normalized_form").isNull()
    new = ~blank & F.col("_known").isNull()
    zero = F.lit(0).cast("bigint")
    return marked.agg(
        F.count_if(new).alias("inserted"),
        F.coalesce(F.sum(F.when(~blank, F.col("_n") - F.when(new, 1).otherwise(0))), zero).alias("deduped"),
        F.coalesce(F.sum(F.when(blank, F.col("_n"))), zero).alias("skipped_empty"),
    )


def missing_batches(batches: DataFrame, wanted: DataFrame) -> DataFrame:
    """Batch rows to create for ids that are used but not there yet."""
    ids = wanted.select(F.col("batch_id").alias("id")).where("id IS NOT NULL").distinct()
    return ids.join(batches.select("id"), "id", "left_anti").select(
        "id", F.lit("running").alias("status"), F.lit(0).cast("decimal(12,6)").alias("total_cost_usd")
    )


def last_change(changes: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last change per key; a partially aggregated maximum."""
    rest = [c for c in changes.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_new")
    return changes.groupBy(*keys).agg(newest).select(*keys, "_new.*")


def upsert_by_key(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
    stamp: Column | None = None, stamp_name: str = "updated_at",
) -> DataFrame:
    """The next table: last write wins per key, every non-key column is replaced.

    Columns that the changes lack keep their value; for a new key they are NULL. `stamp`
    becomes the update time of written rows.
    """
    written = last_change(changes, keys, order)
    rest = [c for c in current.columns if c not in keys]
    theirs = [F.col(c).alias(f"_n_{c}") for c in rest if c in written.columns]
    joined = current.join(written.select(*keys, F.lit(True).alias("_hit"), *theirs), list(keys), "full_outer")
    out = []
    for c in rest:
        value = F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)) if c in written.columns else F.col(c)
        if stamp is not None and c == stamp_name:
            value = F.when(F.col("_hit"), stamp).otherwise(F.col(c))
        out.append(value.alias(c))
    return joined.select(*keys, *out)


def guarded_upsert(current: DataFrame, incoming: DataFrame, order: Sequence[Column | str] | None = None) -> DataFrame:
    """Words by (form, type): insert, update if the existing row is the pipeline's, else refuse.

    `action` is insert, update, refused or kept. Status is 1 on insert and stays as it is on
    update. New rows have no word_id yet; number them with `assign_ids`. Of several incoming
    rows of one key the last by `order` counts, by default that of the largest values.
    """
    key = ["form", "type"]
    data = [c for c in incoming.columns if c not in (*key, "status", "word_id")]
    incoming = last_change(incoming.select(*key, *data), key, order or data)
    mine = current.select(*key, "word_id", "status", *[F.col(c).alias(f"_old_{c}") for c in data])
    joined = mine.withColumn("_there", F.lit(True)).join(
        incoming.select(*key, F.lit(True).alias("_new"), *data), key, "full_outer"
    )
    own = T.source_origin(F.col("_old_source")) == PIPELINE
    action = (
        F.when(F.col("_there").isNull(), "insert")
        .when(F.col("_new").isNull(), "kept")
        .when(own, "update")
        .otherwise("refused")
    )
    joined = joined.withColumn("action", action)
    takes = F.col("action").isin("insert", "update")
    return joined.select(
        "word_id", *key, F.when(F.col("action") == "insert", 1).otherwise(F.col("status")).cast("smallint").alias("status"),
        *[F.when(takes, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in data], "action",
    )


def assign_ids(rows: DataFrame, id_name: str, order: Sequence[str], last: int) -> DataFrame:
    """Number the rows without an id after the largest id in use."""
    numbered = number_rows(rows.where(F.col(id_name).isNull()).drop(id_name), order, id_name, last + 1)
    return rows.where(F.col(id_name).isNotNull()).unionByName(numbered)


# --- deletes and rewrites ---------------------------------------------------


def prune_older_than(rows: DataFrame, days: int, now: Column | None = None, at: str = "created_at") -> tuple[DataFrame, DataFrame]:
    """(kept rows, one row with the number deleted). Partition columns on `at` prune the scan."""
    if days < 0:
        raise ValueError("days must not be negative")
    now = F.current_timestamp() if now is None else now
    # A row without a time is not known to be old.
    old = F.coalesce(F.col(at) < now - F.make_dt_interval(F.lit(days)), F.lit(False))
    return rows.where(~old), rows.agg(F.count_if(old).alias("deleted"))


def parse_days(text: str) -> int:
    """`30d` as 30; anything else is an error."""
    if not text.endswith("d") or not text[:-1].isdecimal():
        raise ValueError(f"expected <days>d, got {text!r}")
    return int(text[:-1])


def cascade_delete(words: DataFrame, tables: dict[str, DataFrame], origin: str | None = PIPELINE) -> dict[str, DataFrame]:
    """Tables without the children of the given words (a DataFrame with word_id).

    Only rows of `origin` go, except that sentences always follow their meaning. The list of
    words is joined, never collected.
    """
    ids = words.select("word_id").distinct()
    own = F.lit(True) if origin is None else F.coalesce(T.source_origin(F.col("source")) == origin, F.lit(False))
    gone = tables["meanings"].where(own).join(ids, "word_id", "left_semi").select("meaning_id")
    owners = ids.withColumnRenamed("word_id", "owner_word_id")
    out = {
        "meanings": tables["meanings"].join(gone, "meaning_id", "left_anti"),
        "sentences": tables["sentences"].join(gone, "meaning_id", "left_anti"),
    }
    for name, key, listed in (("mnemonics", "word_id", ids), ("phrases", "owner_word_id", owners)):
        rows = tables[name]
        flagged = rows.join(listed.withColumn("_hit", F.lit(True)), key, "left")
        out[name] = flagged.where(F.col("_hit").isNull() | ~own).select(*rows.columns)
    return out


def replace_children(
    meanings: DataFrame, sentences: DataFrame, new_meanings: DataFrame, new_sentences: DataFrame, floor: int = HOT_FLOOR
) -> tuple[DataFrame, DataFrame]:
    """Pipeline children of the words in `new_meanings` replaced by new rows with fresh ids.

    `new_meanings` is (word_id, meaning_index, ...), `new_sentences` (word_id, meaning_index,
    example_index, ...). A sentence finds its meaning by (word_id, meaning_index).
    """
    words = new_meanings.select("word_id").distinct()
    own = T.source_origin(F.col("source")) == PIPELINE
    gone = meanings.where(own).join(words, "word_id", "left_semi").select("meaning_id")
    kept_m = meanings.join(gone, "meaning_id", "left_anti")
    kept_s = sentences.join(gone, "meaning_id", "left_anti")
    last_m = meanings.agg(F.coalesce(F.max("meaning_id"), F.lit(0)).alias("m")).collect()[0]["m"]
    last_s = sentences.agg(F.coalesce(F.max("sentence_id"), F.lit(0)).alias("m")).collect()[0]["m"]
    added_m = number_rows(new_meanings, ["word_id", "meaning_index"], "meaning_id", last_m + 1)
    address = added_m.select("word_id", "meaning_index", "meaning_id")
    placed = join_to_parent(new_sentences, address, ["word_id", "meaning_index"], "inner", floor)
    added_s = number_rows(placed, ["meaning_id", "example_index"], "sentence_id", last_s + 1)
    return (
        kept_m.unionByName(added_m.select(*[c for c in meanings.columns if c in added_m.columns]), allowMissingColumns=True),
        kept_s.unionByName(added_s.select(*[c for c in sentences.columns if c in added_s.columns]), allowMissingColumns=True),
    )


def remap_ids(tables: dict[str, tuple[DataFrame, str]], above: int, shift: int) -> dict[str, DataFrame]:
    """Shift an id column by a constant in each table, only above a threshold; a rerun changes nothing.

    The shifted ids must land at or below the threshold for that, which holds when the
    largest id is at most above + shift.
    """
    return {
        name: df.withColumn(col, F.when(F.col(col) > above, F.col(col) - shift).otherwise(F.col(col)))
        for name, (df, col) in tables.items()
    }


def backfill_by_membership(rows: DataFrame, members: DataFrame, key: str, column: str, value) -> DataFrame:
    """Set a column where the key occurs in `members`."""
    listed = members.select(key).distinct().withColumn("_in", F.lit(True))
    kind = rows.schema[column].dataType
    return rows.join(listed, key, "left").withColumn(
        column, F.when(F.col("_in"), F.lit(value).cast(kind)).otherwise(F.col(column))
    ).drop("_in")


# --- constraints ------------------------------------------------------------


def check_constraints(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations): rows per rule that are not true; NULL passes, as in a CHECK.

    One pass over the rows for all rules.
    """
    counts = rows.agg(*[F.count_if(~F.coalesce(rule, F.lit(True))).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return counts.select(F.inline(pairs))


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(children: DataFrame, child_key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Children whose parent does not exist; NULL keys are allowed."""
    listed = parents.select(F.col(parent_key).alias(child_key))
    return children.where(F.col(child_key).isNotNull()).join(listed, child_key, "left_anti")


def union_child_sources(meanings: DataFrame, sentences: DataFrame, mnemonics: DataFrame, phrases: DataFrame) -> DataFrame:
    """(word_id, child, source) over the four child tables; sentences come with their word."""
    def tag(df: DataFrame, kind: str, word: str = "word_id") -> DataFrame:
        return df.select(F.col(word).alias("word_id"), F.lit(kind).alias("child"), "source")

    return (
        tag(meanings, "meaning").unionByName(tag(sentences, "sentence"))
        .unionByName(tag(mnemonics, "mnemonic")).unionByName(tag(phrases, "phrase", "owner_word_id"))
    )


def prefix_guard(words: DataFrame, child_sources: DataFrame) -> DataFrame:
    """(word_id, parent_origin, offender, offenders): words with a child of another origin.

    Children are reduced to their distinct (word, source) before the join.
    """
    found = child_sources.groupBy("word_id", "source").agg(F.count(F.lit(1)).alias("_n"))
    parents = words.select("word_id", T.source_origin(F.col("source")).alias("parent_origin"))
    wrong = found.join(parents, "word_id").where(T.source_origin(F.col("source")) != F.col("parent_origin"))
    return wrong.groupBy("word_id", "parent_origin").agg(
        F.min("source").alias("offender"), F.sum("_n").alias("offenders")
    )


# --- versions ---------------------------------------------------------------


def next_version(parents: DataFrame, versions: DataFrame) -> DataFrame:
    """(parent_id, next_version): one more than the largest, 1 for a parent without versions."""
    top = versions.groupBy("parent_id").agg(F.max("version").alias("_top"))
    return parents.select("parent_id").join(top, "parent_id", "left").select(
        "parent_id", (F.coalesce("_top", F.lit(0)) + 1).alias("next_version")
    )


def version_history(versions: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Versions with their rank, 1 being the newest of the parent."""
    ranked = position_in_parent(versions, ["parent_id"], [F.col("version").desc()], "rank", floor)
    return ranked.withColumn("rank", F.col("rank") + 1)


def current_versions(heads: DataFrame, versions: DataFrame) -> DataFrame:
    """Each parent's current version, found by its pointer."""
    pointed = versions.drop("parent_id").withColumnRenamed("id", "current_version_id")
    return heads.select("parent_id", "current_version_id").join(pointed, "current_version_id")


def save_version(heads: DataFrame, versions: DataFrame, edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append one version per edited parent and move its pointer; NULL inputs keep the old value.

    `edits` has parent_id and the editable columns, one row per parent. Returns (heads, versions).
    """
    editable = [c for c in edits.columns if c != "parent_id"]
    last_id = versions.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).collect()[0]["m"]
    old = current_versions(heads, versions).select("parent_id", *[F.col(c).alias(f"_old_{c}") for c in editable])
    top = next_version(heads, versions).withColumnRenamed("next_version", "version")
    merged = (
        edits.join(top, "parent_id").join(old, "parent_id", "left")
        .select("parent_id", "version", *[F.coalesce(c, f"_old_{c}").alias(c) for c in editable])
    )
    added = number_rows(merged, ["parent_id"], "id", last_id + 1)
    moved = heads.join(added.select("parent_id", F.col("id").alias("_new")), "parent_id", "left").select(
        "parent_id", F.coalesce("_new", "current_version_id").alias("current_version_id")
    )
    return moved, versions.unionByName(added, allowMissingColumns=True)


def rollback_version(heads: DataFrame, versions: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Move pointers to the wanted (parent_id, version). Returns (heads, requests without such a version)."""
    found = wanted.join(versions.select("parent_id", "version", F.col("id").alias("_to")), ["parent_id", "version"], "left")
    moved = heads.join(found.select("parent_id", "_to"), "parent_id", "left").select(
        "parent_id", F.coalesce("_to", "current_version_id").alias("current_version_id")
    )
    return moved, found.where("_to IS NULL").select("parent_id", "version")


def resolve_pinned_versions(
    recipes: DataFrame, providers: DataFrame, provider_versions: DataFrame, prompts: DataFrame, prompt_versions: DataFrame
) -> DataFrame:
    """Recipes with the exact provider and prompt versions that they pin.

    `missing` names what a recipe pins and cannot be found; it is NULL for a runnable one.
    """
    provider = provider_versions.select(
        F.col("parent_id").alias("provider_id"), F.col("version").alias("provider_version"),
        "base_url", "transport", F.lit(True).alias("_pv"),
    )
    prompt = prompt_versions.select(
        F.col("parent_id").alias("prompt_id"), F.col("version").alias("prompt_version"),
        F.col("content").alias("prompt_content"), F.lit(True).alias("_qv"),
    )
    named = recipes.join(providers.select(F.col("id").alias("provider_id"), F.col("name").alias("provider_name")), "provider_id", "left")
    named = named.join(prompts.select(F.col("id").alias("prompt_id"), F.col("name").alias("prompt_name"), "stage"), "prompt_id", "left")
    joined = named.join(provider, ["provider_id", "provider_version"], "left").join(prompt, ["prompt_id", "prompt_version"], "left")
    missing = (
        F.when(F.col("_pv").isNull() | F.col("provider_name").isNull(), "provider version")
        .when(F.col("_qv").isNull() | F.col("prompt_name").isNull(), "prompt version")
    )
    return joined.withColumn("missing", missing).drop("_pv", "_qv")


def config_snapshot(resolved: DataFrame) -> DataFrame:
    """(recipe_id, snapshot): the resolved recipe as an immutable record with a prompt digest."""
    record = F.struct(
        F.struct(F.col("recipe_id").alias("id"), F.col("recipe_name").alias("name"), F.col("recipe_version").alias("version")).alias("recipe"),
        F.struct(
            F.col("provider_id").alias("id"), F.col("provider_name").alias("name"),
            F.col("provider_version").alias("version"), "base_url", "transport",
        ).alias("provider"),
        "model",
        F.struct(
            F.col("prompt_id").alias("id"), F.col("prompt_name").alias("name"), F.col("prompt_version").alias("version"),
            F.left(F.sha2("prompt_content", 256), F.lit(16)).alias("sha256"),
        ).alias("prompt"),
    )
    return resolved.where("missing IS NULL").select("recipe_id", record.alias("snapshot"))

"""Checking entries, proposing patches, and applying them by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import nested as N
from lexmill.functions import text as T
from lexmill.functions.hashing import to_json
from lexmill.operators import cells as C
from lexmill.operators import inference as I
from lexmill.operators.documents import review_blob
from lexmill.operators.export import serving_refresh
from lexmill.operators.numbering import HOT_FLOOR, join_to_parent, position_in_parent
from lexmill.session import by_rows, cut_lineage
from lexmill.sources.buckets import BucketedTable

# The checkers, and what each looks at.
CHECKERS = ("field_quality", "morphology", "examples", "mnemonic", "pos_consistency")
CHECK_TEMPLATE = "Check {checker} of this entry and list issues as JSON:\n{blob_json}"
FIX_TEMPLATE = "Fix this entry:\n{blob_json}\nIssues:\n{issues_json}"
# Rules that need no model.
MAX_GLOSS = 25
CUT_OFF = r"(\(\s*['\"]?|['\"(]|\b(a|an|the|of|to|as|is)\s*\.?)\s*$"


# --- checkers ---------------------------------------------------------------


def rule_checkers(meanings: DataFrame, sentences: DataFrame, mnemonics: DataFrame) -> DataFrame:
    """(word_id, checker, path, issue): what can be told without a model.

    `meanings` and `sentences` carry their position (and sentences their meaning's). No
    shuffle: each row is judged alone.
    """
    def found(*rules: tuple[Column, str, str, str]) -> Column:
        listed = [
            F.when(rule, F.struct(F.lit(checker).alias("checker"), F.lit(field).alias("field"), F.lit(issue).alias("issue")))
            for rule, checker, field, issue in rules
        ]
        return F.array_compact(F.array(*listed))

    def count(col: Column, chars: str) -> Column:
        return F.length(col) - F.length(F.translate(col, chars, ""))

    cn, en = F.coalesce("cn_paraphrase", F.lit("")), F.coalesce("en_paraphrase", F.lit(""))
    on_meaning = found(
        (T.strip(cn) == "", "field_quality", "cn_paraphrase", "empty"),
        (F.length(cn) > MAX_GLOSS, "field_quality", "cn_paraphrase", "too long"),
        (count(cn, "(（") != count(cn, ")）"), "field_quality", "cn_paraphrase", "unbalanced brackets"),
        (T.strip(en) == "", "field_quality", "en_paraphrase", "empty"),
        ((en != "") & en.rlike(CUT_OFF), "field_quality", "en_paraphrase", "cut off"),
        (F.coalesce("pos", F.lit(0)) == 0, "pos_consistency", "pos", "missing"),
    )
    on_sentence = found(
        (T.strip(F.coalesce("form", F.lit(""))) == "", "examples", "en", "empty"),
        (T.strip(F.coalesce("translation", F.lit(""))) == "", "examples", "cn", "empty"),
    )
    on_mnemonic = found((T.strip(F.coalesce("text", F.lit(""))) == "", "mnemonic", "text", "empty"))

    def rows(df: DataFrame, issues: Column, path: Column) -> DataFrame:
        listed = df.select("word_id", path.alias("_path"), F.explode_outer(issues).alias("i")).where("i IS NOT NULL")
        return listed.select("word_id", "i.checker", F.concat("_path", F.lit("."), "i.field").alias("path"), "i.issue")

    meaning_path = F.concat(F.lit("meanings["), "position", F.lit("]"))
    sentence_path = F.concat(F.lit("meanings["), "meaning_position", F.lit("].examples["), "position", F.lit("]"))
    return (
        rows(meanings, on_meaning, meaning_path)
        .unionByName(rows(sentences, on_sentence, sentence_path))
        .unionByName(rows(mnemonics, on_mnemonic, F.lit("mnemonic")))
    )


def run_checkers(
    blobs: DataFrame, cache: DataFrame | I.AnswerStore, fn: I.ModelFn, model: str, parallel: int | None = None
) -> DataFrame:
    """(word_id, checker, issues, error, cost_usd, spent_usd): five calls per word.

    `blobs` is (word_id, blob). Issues are JSON objects tagged with their checker; an answer that does not parse, or has no list, counts as no issue. A call that failed has an error
    and says nothing about the word.
    """
    calls = blobs.select("word_id", "blob", F.explode(F.array(*[F.lit(c) for c in CHECKERS])).alias("checker")).select(
        F.concat_ws(":", "word_id", "checker").alias("call_id"), "word_id", "checker",
        F.lit(f"call:{model}").alias("kind"), F.lit(model).alias("model"), F.lit('{"max_tokens":4000,"temperature":0}').alias("params_json"),
        T.render_prompt(F.lit(CHECK_TEMPLATE), {"checker": F.col("checker"), "blob_json": F.col("blob")}).alias("prompt"),
        F.concat(F.lit('{"checker":"'), "checker", F.lit('","script":"review"}')).alias("input_json"),
    )
    answered = I.call(calls, cache, fn, "call_id", parallel).withColumnRenamed("error", "_call_error")
    parsed = N.parse_model_json(answered, "text")
    objects = F.filter(N.items(F.col("parsed"), "$.issues"), lambda i: N.has_kind(i, "OBJECT"))
    issues = F.transform(
        objects,
        lambda i: to_json(
            F.struct(
                F.col("checker").alias("from"), N.text_at(i, "$.issue").alias("issue"), N.text_at(i, "$.path").alias("path")
            )
        ),
    )
    return parsed.select("word_id", "checker", issues.alias("issues"), F.col("_call_error").alias("error"), "cost_usd", "spent_usd")


def gather_issues(checked: DataFrame) -> DataFrame:
    """(word_id, issues, checker_costs, check_total, check_error): one row per word, five rows in.

    Costs are rounded as they are recorded: five places each, four for the total. `check_error`
    names the checkers that failed; a word with one has not been reviewed.
    """
    cost = F.round("cost_usd", 5).cast("decimal(10,5)")
    grouped = checked.groupBy("word_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.concat_ws(": ", "checker", "error")))).alias("_e"),
        F.array_sort(F.collect_list(F.struct(F.array_position(F.array(*[F.lit(c) for c in CHECKERS]), F.col("checker")).alias("o"), "issues"))).alias("_i"),
        F.map_from_entries(
            F.array_compact(F.array(*[
                F.when(F.count_if(F.col("checker") == c) > 0, F.struct(F.lit(c).alias("checker"), F.sum(F.when(F.col("checker") == c, cost)).cast("decimal(10,5)").alias("cost")))
                for c in CHECKERS
            ]))
        ).alias("checker_costs"),
        F.round(F.sum("cost_usd"), 4).cast("decimal(10,4)").alias("check_total"),
    )
    failed = F.when(F.size("_e") > 0, F.array_join("_e", "; "))
    return grouped.select("word_id", F.flatten(F.col("_i.issues")).alias("issues"), "checker_costs", "check_total", failed.alias("check_error"))


PATCH = "array<struct<seq:int,op:string,path:string,old_value:string,new_value:string>>"


def propose_patches(
    issues: DataFrame, cache: DataFrame | I.AnswerStore, fn: I.ModelFn, model: str, parallel: int | None = None
) -> DataFrame:
    """(word_id, patches, fix_cost, fix_error) from (word_id, blob, issues); no issue, no call."""
    asked = issues.where(F.size("issues") > 0)
    listed = F.concat(F.lit("["), F.array_join("issues", ", "), F.lit("]"))
    values = {"blob_json": F.col("blob"), "issues_json": T.truncate_text(listed, "issues")}
    calls = asked.select(
        "word_id", F.lit(f"call:{model}").alias("kind"), F.lit(model).alias("model"), F.lit('{"max_tokens":12000,"temperature":0}').alias("params_json"),
        T.render_prompt(F.lit(FIX_TEMPLATE), values).alias("prompt"), F.lit('{"checker":"fixer","script":"review"}').alias("input_json"),
    )
    answered = I.call(calls, cache, fn, "word_id", parallel).withColumnRenamed("error", "_call_error")
    parsed = N.parse_model_json(answered, "text")
    has = N.at(F.col("parsed"), "$.patches").isNotNull()
    patches = F.transform(
        N.items(F.col("parsed"), "$.patches"),
        lambda p, i: F.struct(
            i.alias("seq"), F.coalesce(N.text_at(p, "$.op"), F.lit("update")).alias("op"), N.text_at(p, "$.path").alias("path"),
            F.try_variant_get(p, "$.old_value", "string").alias("old_value"), F.try_variant_get(p, "$.new_value", "string").alias("new_value"),
        ),
    )
    return parsed.select(
        "word_id", patches.cast(PATCH).alias("patches"), F.round("cost_usd", 4).cast("decimal(10,4)").alias("fix_cost"),
        F.when(~F.coalesce(has, F.lit(False)), T.truncate_text(F.coalesce("_call_error", "text", F.lit("")), "fix_error")).alias("fix_error"),
    )


def review_totals(records: DataFrame) -> DataFrame:
    """One row over review records (issues, patches, applied, drift_skipped, error, two costs)."""
    def total(col: Column) -> Column:
        return F.coalesce(F.sum(col), F.lit(0))

    patches = F.coalesce("patches", F.array().cast(PATCH))
    return records.agg(
        F.count(F.lit(1)).alias("done"),
        F.count_if(F.col("issue_count") > 0).alias("with_issues"),
        F.count_if(F.size(patches) > 0).alias("with_patches"),
        total(F.col("applied")).alias("applied"),
        total(F.col("drift_skipped")).alias("drift_skipped"),
        total(F.size(F.filter(patches, lambda p: p["op"] == "delete"))).alias("deletes"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        total(F.col("check_total")).cast("decimal(14,4)").alias("check_cost"),
        total(F.col("fix_cost")).cast("decimal(14,4)").alias("fix_cost"),
    )


# --- patches by position ----------------------------------------------------

# The paths that patches may use. Groups: meaning index, example index, field.
PATHS = {
    "update": r"^(?:meanings\[(\d+)\]\.(?:examples\[(\d+)\]\.)?(cn_paraphrase|en_paraphrase|en|cn)|mnemonic\.(text))$",
    "delete": r"^meanings\[(\d+)\](?:\.examples\[(\d+)\])?$",
}


def parse_patch_path(patches: DataFrame) -> DataFrame:
    """Add target (meaning, sentence, mnemonic or NULL), i, j and column_name."""
    update, path = PATHS["update"], F.col("path")
    op = F.coalesce("op", F.lit("update"))

    def group(pattern: str, n: int) -> Column:
        return T.blank_to_null(F.regexp_extract(path, pattern, n))

    i = F.when(op == "update", group(update, 1)).when(op == "delete", group(PATHS["delete"], 1))
    j = F.when(op == "update", group(update, 2)).when(op == "delete", group(PATHS["delete"], 2))
    field = F.when(op == "update", F.coalesce(group(update, 3), group(update, 4)))
    parsed = patches.withColumns({"op": op, "i": i.try_cast("bigint"), "j": j.try_cast("bigint"), "_f": field})
    gloss = F.col("_f").isin("cn_paraphrase", "en_paraphrase")
    target = (
        F.when((op == "delete") & F.col("i").isNotNull(), F.when(F.col("j").isNull(), "meaning").otherwise("sentence"))
        .when((F.col("_f") == "text") & F.col("i").isNull(), "mnemonic")
        .when(gloss & F.col("j").isNull(), "meaning")
        .when(F.col("_f").isin("en", "cn") & F.col("j").isNotNull(), "sentence")
    )
    column = F.when(F.col("_f") == "en", "form").when(F.col("_f") == "cn", "translation").otherwise(F.col("_f"))
    return parsed.withColumn("target", target).withColumn("column_name", column).drop("_f")


# The tables that patches change: name of the target, key, columns.
PATCHED = {
    "meanings": ("meaning", "meaning_id", ["cn_paraphrase", "en_paraphrase"]),
    "sentences": ("sentence", "sentence_id", ["form", "translation"]),
    "mnemonics": ("mnemonic", "mnemonic_id", ["text"]),
}


def resolve_patches(
    meanings: DataFrame, sentences: DataFrame, mnemonics: DataFrame, patches: DataFrame,
    sentence_order: tuple = ("sentence_id",), floor: int = HOT_FLOOR,
) -> dict[str, DataFrame]:
    """What patches (word_id, seq, op, path, old_value, new_value) change; a drifted one is skipped, the rest apply.

    Positions of meanings and examples are those before the first patch. Nothing happens for
    an address out of range or an unknown path. After a delete, a later patch of that row has
    nothing to change: drift for a meaning's field if it names an old value, else no effect.
    Returns `values` (cell, value) of the cells that get another value, the ids in
    `gone_meanings` and `gone_sentences`, and `outcomes` (word_id, seq, op, path, status
    applied/drift/none).
    """
    parsed = cut_lineage(parse_patch_path(patches).withColumn("change_id", F.concat_ws(":", "word_id", "seq")))
    # Only rows of words with a patch are numbered, and sentences only of meanings in one.
    patched = parsed.select("word_id").distinct()
    mine = meanings.select("word_id", "meaning_id", "cn_paraphrase", "en_paraphrase").join(by_rows(patched), "word_id", "left_semi")
    m_at = position_in_parent(mine, ["word_id"], ["meaning_id"], "i", floor, meanings)
    below = sentences.join(by_rows(mine.select("meaning_id")), "meaning_id", "left_semi")
    s_at = position_in_parent(below, ["meaning_id"], list(sentence_order), "j", floor, sentences).select(
        "meaning_id", "j", "sentence_id", "form", "translation"
    )
    told = mnemonics.join(by_rows(parsed.where("target = 'mnemonic'").select("word_id").distinct()), "word_id", "left_semi")
    first = told.groupBy("word_id").agg(F.min_by(F.struct("mnemonic_id", "text"), "mnemonic_id").alias("_m"))
    on_m = join_to_parent(parsed.where("target IN ('meaning', 'sentence')"), m_at, ["word_id", "i"], "left", floor)
    plain = on_m.where("target = 'meaning'").select(
        *parsed.columns, "meaning_id", F.col("meaning_id").cast("string").alias("row_id"),
        F.when(F.col("column_name") == "cn_paraphrase", F.col("cn_paraphrase")).when(F.col("column_name") == "en_paraphrase", F.col("en_paraphrase")).alias("value"),
    )
    deep = join_to_parent(
        on_m.where("target = 'sentence'").select(*parsed.columns, "meaning_id"), s_at, ["meaning_id", "j"], "left", floor
    ).select(
        *parsed.columns, "meaning_id", F.col("sentence_id").cast("string").alias("row_id"),
        F.when(F.col("column_name") == "form", F.col("form")).when(F.col("column_name") == "translation", F.col("translation")).alias("value"),
    )
    hooks = join_to_parent(parsed.where("target = 'mnemonic'"), first, ["word_id"], "left", floor).select(
        *parsed.columns, F.lit(None).cast("bigint").alias("meaning_id"), F.col("_m.mnemonic_id").cast("string").alias("row_id"), F.col("_m.text").alias("value")
    )
    addressed = plain.unionByName(deep).unionByName(hooks).withColumn("table_name", F.col("target"))
    found = cut_lineage(addressed.where("row_id IS NOT NULL"))
    # The first delete of a row, and of the meaning above it, by order of the patches.
    deletes = found.where("op = 'delete'")
    row_end = deletes.groupBy("target", "row_id").agg(F.min("seq").alias("_row_end"))
    top_end = deletes.where("target = 'meaning'").groupBy("meaning_id").agg(F.min("seq").alias("_top_end"))
    ended = join_to_parent(found, row_end, ["target", "row_id"], "left", floor)
    # Patches of mnemonics have no meaning above them; they would all meet under the NULL key.
    timed = join_to_parent(ended.where("meaning_id IS NOT NULL"), top_end, ["meaning_id"], "left", floor).unionByName(
        ended.where("meaning_id IS NULL").withColumn("_top_end", F.lit(None).cast(top_end.schema["_top_end"].dataType))
    )
    late = (F.col("seq") > F.col("_row_end")) | (F.col("seq") > F.col("_top_end"))
    timed = cut_lineage(timed.withColumn("_late", F.coalesce(late, F.lit(False))))
    deleting = timed.where("op = 'delete'").select(
        "change_id", "target", "row_id",
        F.when(~F.col("_late") & (F.col("seq") == F.col("_row_end")), "applied").otherwise("none").alias("status"),
    )
    updates = timed.where("op = 'update'")
    too_late = updates.where("_late").select(
        "change_id", F.when((F.col("target") == "meaning") & F.col("old_value").isNotNull(), "drift").otherwise("none").alias("status")
    )
    live = updates.where("NOT _late")
    cells = live.select(*C.CELL, "value").groupBy(*C.CELL).agg(F.max("value").alias("value"))
    folded = C.fold_changes(cells, live.select(*C.CELL, "seq", "change_id", "old_value", "new_value"), floor=floor)
    status = deleting.select("change_id", "status").unionByName(too_late).unionByName(folded.outcomes)
    outcomes = parsed.join(by_rows(status), "change_id", "left").select("word_id", "seq", "op", "path", F.coalesce("status", F.lit("none")).alias("status"))
    gone_m = deleting.where("target = 'meaning'").select(F.col("row_id").try_cast("bigint").alias("meaning_id")).distinct()
    gone_s = deleting.where("target = 'sentence' AND status = 'applied'").select(
        F.col("row_id").try_cast(sentences.schema["sentence_id"].dataType).alias("sentence_id")
    ).distinct()
    before = cells.withColumnRenamed("value", "_before")
    values = folded.values.join(by_rows(before), C.CELL).where(~F.col("value").eqNullSafe(F.col("_before"))).drop("_before")
    return {"values": values, "gone_meanings": gone_m, "gone_sentences": gone_s, "outcomes": outcomes}


def apply_patches_skip(
    meanings: DataFrame, sentences: DataFrame, mnemonics: DataFrame, patches: DataFrame,
    sentence_order: tuple = ("sentence_id",), floor: int = HOT_FLOOR,
) -> dict[str, DataFrame]:
    """The next three tables after `resolve_patches`, and its `outcomes`."""
    plan = resolve_patches(meanings, sentences, mnemonics, patches, sentence_order, floor)
    tables = {"meanings": meanings, "sentences": sentences, "mnemonics": mnemonics}
    out = {name: C.write_cells(tables[name], *PATCHED[name], plan["values"]).drop("written") for name in tables}
    out["meanings"] = out["meanings"].join(by_rows(plan["gone_meanings"]), "meaning_id", "left_anti")
    out["sentences"] = out["sentences"].join(by_rows(plan["gone_meanings"]), "meaning_id", "left_anti").join(by_rows(plan["gone_sentences"]), "sentence_id", "left_anti")
    return out | {"outcomes": plan["outcomes"]}


def apply_patches_in_place(
    tables: dict[str, BucketedTable], patches: DataFrame, sentence_order: tuple = ("sentence_id",), floor: int = HOT_FLOOR
) -> dict[str, DataFrame]:
    """`apply_patches_skip` written into bucketed meanings, sentences and mnemonics, each keyed by its own id.

    Only buckets in which a value changes or a row goes are rewritten. Returns the tables as
    they are then, and `outcomes`.
    """
    rows = {name: table.read() for name, table in tables.items()}
    plan = resolve_patches(rows["meanings"], rows["sentences"], rows["mnemonics"], patches, sentence_order, floor)
    # Everything is settled before the first file is replaced.
    values, outcomes, gone_m = (cut_lineage(plan[name]) for name in ("values", "outcomes", "gone_meanings"))
    below = rows["sentences"].join(by_rows(gone_m), "meaning_id", "left_semi").select("sentence_id")
    gone = {"meanings": gone_m, "sentences": cut_lineage(plan["gone_sentences"].unionByName(below).distinct())}
    for name, table in tables.items():
        target, key, columns = PATCHED[name]
        touched = values.where(F.col("table_name") == target).select(F.col("row_id").try_cast(table.schema[key].dataType).alias(key))
        if name in gone:
            touched = touched.unionByName(gone[name])
        buckets = table.buckets_of(touched)
        if buckets:
            written = C.write_cells(table.part(buckets), target, key, columns, values).drop("written")
            table.replace(written.join(by_rows(gone[name]), key, "left_anti") if name in gone else written, buckets)
    return {name: table.read() for name, table in tables.items()} | {"outcomes": outcomes}


def review_records(blobs: DataFrame, gathered: DataFrame, proposed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One record per reviewed word, as the result log keeps it; `error` tells of failed calls."""
    counted = outcomes.groupBy("word_id").agg(
        F.count_if(F.col("status") == "applied").alias("applied"), F.count_if(F.col("status") == "drift").alias("drift_skipped")
    )
    out = blobs.select("word_id", "form").join(by_rows(gathered), "word_id").join(by_rows(proposed), "word_id", "left").join(by_rows(counted), "word_id", "left")
    return out.withColumn("issue_count", F.size("issues")).withColumn("error", F.coalesce("check_error", "fix_error")).drop("check_error", "fix_error")


def review_words(
    targets: DataFrame, tables: dict[str, DataFrame | BucketedTable], packages: DataFrame, cache: DataFrame | I.AnswerStore, fn: I.ModelFn, model: str,
    sentence_order: tuple = ("sentence_id",), parallel: int | None = None,
) -> dict[str, DataFrame]:
    """Review the target words (a DataFrame with word_id) from documents to refreshed serving rows.

    Words are shown to the checkers, those with issues to the fixer, and the patches it proposes
    are applied where the values have not drifted. A word with a failed check gets no patch.
    Returns `records` for the log, the next `meanings`, `sentences` and `mnemonics`, the patch
    `outcomes`, and the serving rows to `upsert` and `remove` of the words that changed.

    Where these three tables are given as bucketed tables, patches are written into them: only
    buckets with a patched row are rewritten, and the tables are read again afterwards.
    """
    buckets = {name: table for name, table in tables.items() if isinstance(table, BucketedTable)}
    tables = tables | {name: table.read() for name, table in buckets.items()}
    ids = targets.select("word_id").distinct()
    words = tables["words"].join(by_rows(ids), "word_id", "left_semi")
    meanings = tables["meanings"].join(by_rows(ids), "word_id", "left_semi")
    sentences = tables["sentences"].join(by_rows(meanings.select("meaning_id")), "meaning_id", "left_semi")
    mnemonics = tables["mnemonics"].join(by_rows(ids), "word_id", "left_semi")
    blobs = cut_lineage(review_blob(words, meanings, sentences, mnemonics, sentence_order, whole=tables))
    gathered = cut_lineage(gather_issues(run_checkers(blobs, cache, fn, model, parallel)))
    proposed = cut_lineage(propose_patches(by_rows(gathered.where("check_error IS NULL")).join(by_rows(blobs), "word_id"), cache, fn, model, parallel))
    patches = proposed.select("word_id", F.inline("patches"))
    if PATCHED.keys() <= buckets.keys():
        done = apply_patches_in_place({name: buckets[name] for name in PATCHED}, patches, sentence_order)
    else:
        done = apply_patches_skip(tables["meanings"], tables["sentences"], tables["mnemonics"], patches, sentence_order)
    outcomes = cut_lineage(done["outcomes"])
    changed = outcomes.where("status = 'applied'").select("word_id").distinct()
    following = tables | {name: done[name] for name in ("meanings", "sentences", "mnemonics")}
    refresh = serving_refresh(changed, following, packages, sentence_order=sentence_order)
    return {
        "records": review_records(blobs, gathered, proposed, outcomes),
        "outcomes": outcomes,
        **{name: done[name] for name in ("meanings", "sentences", "mnemonics")},
        **refresh,
    }


def reviewed(records: DataFrame) -> DataFrame:
    """The records that count as done: those without an error."""
    return records.where("error IS NULL")

"""Keyed tables, constraints and versions."""

from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.hashing import to_json
from lexmill.operators import tables as O
from lexmill.plans.registry import query

BENCH_FORMS = r"""
cur AS (SELECT normalized_form, min(item_id) AS id FROM
        (SELECT item_id, replace(lower(unnest(string_split_regex(text, '[ \t\r\n\f]+'))), 'ß', 'ss') AS normalized_form FROM benchmark)
        WHERE normalized_form <> '' GROUP BY 1)"""


def _known_forms(t):
    tokens = t.read("benchmark").select("item_id", F.explode(F.split("text", "[ \t\r\n\f]+")).alias("raw_form"))
    forms = T.with_normalized(tokens.where(~T.is_blank(F.col("raw_form"))), "raw_form")
    return forms.groupBy("normalized_form", "type").agg(F.min("item_id").alias("id"))


@query(
    "insert_ignore",
    f"""WITH {BENCH_FORMS}
    SELECT (SELECT max(id) FROM cur) + row_number() OVER (ORDER BY first_seen) AS id, raw_form, normalized_form, type, batch_id
    FROM first_forms WHERE normalized_form NOT IN (SELECT normalized_form FROM cur)""",
)
def insert_ignore(t):
    return O.insert_ignore(_known_forms(t), t.raw_tokens, ["line_no"], keep=["batch_id"])


@query(
    "insert_outcome",
    f"""WITH {BENCH_FORMS},
    n AS (SELECT count(*) AS total, count(*) FILTER (raw_form = '') AS blank FROM raw_tokens),
    i AS (SELECT count(*) AS inserted FROM first_forms WHERE normalized_form NOT IN (SELECT normalized_form FROM cur))
    SELECT inserted, total - blank - inserted AS deduped, blank AS skipped_empty FROM n, i""",
)
def insert_outcome(t):
    return O.insert_outcome(_known_forms(t), t.raw_tokens)


@query(
    "first_spelling",
    "SELECT normalized_form, type, raw_form, batch_id FROM first_forms",
)
def first_spelling(t):
    rows = O.first_spelling(t.raw_tokens, ["line_no"], keep=["batch_id"])
    return rows.select("normalized_form", "type", "raw_form", "batch_id")


@query(
    "missing_batches",
    """SELECT DISTINCT source AS id, 'running' AS status, CAST(0 AS DECIMAL(12, 6)) AS total_cost_usd FROM documents
       WHERE source NOT IN (SELECT 'src' || n_nationkey FROM nation WHERE n_nationkey % 2 = 0)""",
)
def missing_batches(t):
    have = t.read("nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("src"), "n_nationkey").alias("id"))
    return O.missing_batches(have, t.raw_tokens.select("batch_id"))


@query(
    "upsert_by_key",
    """WITH ch AS (SELECT o_custkey + 700 AS word_id, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS quality_flag FROM orders GROUP BY 1)
    SELECT coalesce(w.word_id, ch.word_id) AS word_id, w.form, coalesce(ch.quality_flag, w.quality_flag) AS quality_flag,
           CASE WHEN ch.word_id IS NOT NULL THEN TIMESTAMP '2024-03-01' ELSE w.updated_at END AS updated_at
    FROM dom_words w FULL OUTER JOIN ch ON w.word_id = ch.word_id""",
)
def upsert_by_key(t):
    current = t.dom_words.select("word_id", "form", "quality_flag", "updated_at")
    changes = t.read("orders").select(
        (F.col("o_custkey") + 700).alias("word_id"), F.col("o_orderstatus").alias("quality_flag"), "o_orderdate", "o_orderkey"
    )
    stamp = F.lit("2024-03-01").cast("timestamp_ntz")
    return O.upsert_by_key(current, changes, ["word_id"], ["o_orderdate", "o_orderkey"], stamp)


@query(
    "guarded_upsert",
    """WITH inc AS (SELECT form, type, 'pipeline:local:m2:paraphrase_v2' AS source, 'new' AS phonetic_us FROM dom_words WHERE word_id % 2 = 0
                    UNION ALL SELECT s_name, CAST(1 AS SMALLINT), 'pipeline:local:m2:paraphrase_v2', 'new' FROM supplier),
    j AS (SELECT w.word_id, coalesce(w.form, i.form) AS form, coalesce(w.type, i.type) AS type, w.status AS s, w.source AS os,
                 w.phonetic_us AS op, i.source AS ns, i.phonetic_us AS np,
                 CASE WHEN w.form IS NULL THEN 'insert' WHEN i.form IS NULL THEN 'kept'
                      WHEN starts_with(w.source, 'pipeline:') THEN 'update' ELSE 'refused' END AS action
          FROM dom_words w FULL OUTER JOIN inc i ON w.form = i.form AND w.type = i.type)
    SELECT word_id, form, type, CASE WHEN action = 'insert' THEN CAST(1 AS SMALLINT) ELSE s END AS status,
           CASE WHEN action IN ('insert', 'update') THEN ns ELSE os END AS source,
           CASE WHEN action IN ('insert', 'update') THEN np ELSE op END AS phonetic_us, action FROM j""",
)
def guarded_upsert(t):
    fresh = [F.lit("pipeline:local:m2:paraphrase_v2").alias("source"), F.lit("new").alias("phonetic_us")]
    again = t.dom_words.where("word_id % 2 = 0").select("form", "type", *fresh)
    more = t.read("supplier").select(F.col("s_name").alias("form"), F.lit(1).cast("smallint").alias("type"), *fresh)
    return O.guarded_upsert(t.dom_words, again.unionByName(more))


@query(
    "prune_older_than",
    """SELECT event_type AS label, count(*) AS n FROM events WHERE NOT ts < TIMESTAMP '2024-01-20' - INTERVAL 10 DAY GROUP BY 1
       UNION ALL SELECT 'deleted', count(*) FROM events WHERE ts < TIMESTAMP '2024-01-20' - INTERVAL 10 DAY""",
)
def prune_older_than(t):
    now = F.lit("2024-01-20").cast("timestamp_ntz")
    kept, deleted = O.prune_older_than(t.read("events"), O.parse_days("10d"), now, "ts")
    counts = kept.groupBy(F.col("event_type").alias("label")).agg(F.count("*").alias("n"))
    return counts.unionByName(deleted.select(F.lit("deleted").alias("label"), F.col("deleted").alias("n")))


@query(
    "cascade_delete",
    """WITH w AS (SELECT word_id FROM dom_words WHERE status = 2),
    gone AS (SELECT meaning_id FROM dom_meanings WHERE word_id IN (SELECT word_id FROM w) AND starts_with(source, 'pipeline:'))
    SELECT 'meanings' AS table_name, count(*) AS n, sum(meaning_id) AS id_sum FROM dom_meanings WHERE meaning_id NOT IN (SELECT meaning_id FROM gone)
    UNION ALL SELECT 'sentences', count(*), sum(meaning_id) FROM dom_sentences WHERE meaning_id NOT IN (SELECT meaning_id FROM gone)
    UNION ALL SELECT 'mnemonics', count(*), sum(mnemonic_id) FROM dom_mnemonics WHERE word_id NOT IN (SELECT word_id FROM w)
    UNION ALL SELECT 'phrases', count(*), sum(phrase_id) FROM dom_phrases WHERE owner_word_id NOT IN (SELECT word_id FROM w)""",
)
def cascade_delete(t):
    tables = {"meanings": t.dom_meanings, "sentences": t.dom_sentences, "mnemonics": t.dom_mnemonics, "phrases": t.dom_phrases}
    left = O.cascade_delete(t.dom_words.where("status = 2"), tables)
    ids = {"meanings": "meaning_id", "sentences": "meaning_id", "mnemonics": "mnemonic_id", "phrases": "phrase_id"}
    out = None
    for name, df in left.items():
        row = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.sum(ids[name]).alias("id_sum"))
        out = row if out is None else out.unionByName(row)
    return out


def _replaced(t):
    words = t.read("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("word_id"), "c_mktsegment", "c_name")
    source = F.lit("pipeline:local:m2:paraphrase_v2").alias("source")
    meanings = words.select("word_id", F.posexplode(F.array("c_mktsegment", "c_name")).alias("meaning_index", "cn_paraphrase"), source)
    sentences = words.select(
        "word_id", F.lit(1).alias("meaning_index"), F.lit(0).alias("example_index"), F.col("c_name").alias("form"), source
    )
    old = t.dom_sentences.select((F.col("meaning_id") * 100 + F.col("line_no")).alias("sentence_id"), "meaning_id", "form", "source")
    return O.replace_children(t.dom_meanings, old, meanings, sentences)


REPLACED = """
    g AS (SELECT meaning_id FROM dom_meanings WHERE word_id % 2 = 0 AND starts_with(source, 'pipeline:')),
    nm AS (SELECT (SELECT max(meaning_id) FROM dom_meanings) + row_number() OVER (ORDER BY word_id, i) AS meaning_id, word_id, i, cn FROM
           (SELECT c_custkey AS word_id, 0 AS i, c_mktsegment AS cn FROM customer WHERE c_custkey % 2 = 0
            UNION ALL SELECT c_custkey, 1, c_name FROM customer WHERE c_custkey % 2 = 0))"""


@query(
    "replace_children",
    f"""WITH {REPLACED}
    SELECT meaning_id, word_id, cn_paraphrase, source FROM dom_meanings WHERE meaning_id NOT IN (SELECT meaning_id FROM g)
    UNION ALL SELECT meaning_id, word_id, cn, 'pipeline:local:m2:paraphrase_v2' FROM nm""",
)
def replace_children(t):
    return _replaced(t)[0].select("meaning_id", "word_id", "cn_paraphrase", "source")


@query(
    "replace_children_sentences",
    f"""WITH {REPLACED}
    SELECT meaning_id * 100 + line_no AS sentence_id, meaning_id, form FROM dom_sentences WHERE meaning_id NOT IN (SELECT meaning_id FROM g)
    UNION ALL SELECT (SELECT max(meaning_id * 100 + line_no) FROM dom_sentences) + row_number() OVER (ORDER BY meaning_id), meaning_id, cn
              FROM nm WHERE i = 1""",
)
def replace_children_sentences(t):
    return _replaced(t)[1].select("sentence_id", "meaning_id", "form")


REMAPPED = {"dom_words": "word_id", "dom_meanings": "word_id", "dom_mnemonics": "word_id", "dom_phrases": "owner_word_id", "dom_packages": "word_id"}


@query(
    "remap_ids",
    " UNION ALL ".join(
        f"SELECT '{v}' AS table_name, sum(CASE WHEN {c} > 700 THEN {c} - 800 ELSE {c} END) AS id_sum, "
        f"max(CASE WHEN {c} > 700 THEN {c} - 800 ELSE {c} END) AS id_max FROM {v}"
        for v, c in REMAPPED.items()
    ),
)
def remap_ids(t):
    tables = O.remap_ids({v: (getattr(t, v), c) for v, c in REMAPPED.items()}, 700, 800)
    out = None
    for name, df in tables.items():
        key = REMAPPED[name]
        row = df.agg(F.lit(name).alias("table_name"), F.sum(key).alias("id_sum"), F.max(key).alias("id_max"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "backfill_by_membership",
    """SELECT word_id, form, CASE WHEN word_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN CAST(1 AS SMALLINT)
              ELSE status END AS status FROM dom_words""",
)
def backfill_by_membership(t):
    served = t.read("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("word_id"))
    return O.backfill_by_membership(t.dom_words, served, "word_id", "status", 1).select("word_id", "form", "status")


@query(
    "check_constraints",
    """SELECT 'source_prefix' AS rule, count(*) FILTER (NOT regexp_matches(source, '^(pipeline|human):')) AS violations FROM dom_words
       UNION ALL SELECT 'status_enum', count(*) FILTER (status NOT IN (0, 1)) FROM dom_words
       UNION ALL SELECT 'audio_needs_sound', count(*) FILTER (audio_us IS NOT NULL AND phonetic_us IS NULL) FROM dom_words
       UNION ALL SELECT 'quality_enum', count(*) FILTER (quality_flag NOT IN ('none', 'fixed')) FROM dom_words""",
)
def check_constraints(t):
    rules = {
        "source_prefix": F.col("source").rlike("^(pipeline|human):"),
        "status_enum": F.col("status").isin(0, 1),
        "audio_needs_sound": F.col("audio_us").isNull() | F.col("phonetic_us").isNotNull(),
        "quality_enum": F.col("quality_flag").isin("none", "fixed"),
    }
    return O.check_constraints(t.dom_words, rules)


@query(
    "check_unique_and_foreign_keys",
    """SELECT 'unique sentence line' AS rule, l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
       UNION ALL SELECT 'mnemonic has label', word_id, count(*) FROM dom_mnemonics WHERE word_id NOT IN (SELECT doc_id FROM labels) GROUP BY 2""",
)
def check_keys(t):
    twice = O.duplicate_keys(t.read("lineitem"), ["l_orderkey", "l_linenumber"])
    alone = O.orphans(t.dom_mnemonics, "word_id", t.read("labels"), "doc_id").groupBy("word_id").agg(F.count("*").alias("n"))
    return twice.select(F.lit("unique sentence line").alias("rule"), F.col("l_orderkey").alias("key"), "n").unionByName(
        alone.select(F.lit("mnemonic has label").alias("rule"), F.col("word_id").alias("key"), "n")
    )


CHILD_SOURCES = """
cs AS (SELECT word_id, 'meaning' AS child, source FROM dom_meanings
       UNION ALL SELECT m.word_id, 'sentence', s.source FROM dom_sentences s JOIN dom_meanings m USING (meaning_id)
       UNION ALL SELECT word_id, 'mnemonic', source FROM dom_mnemonics
       UNION ALL SELECT owner_word_id, 'phrase', source FROM dom_phrases)"""


def _child_sources(t):
    from lexmill.operators.documents import sentences_with_word

    sentences = sentences_with_word(t.dom_sentences, t.dom_meanings)
    return O.union_child_sources(t.dom_meanings, sentences, t.dom_mnemonics, t.dom_phrases)


@query("union_child_sources", f"WITH {CHILD_SOURCES} SELECT word_id, child, source, count(*) AS n FROM cs GROUP BY ALL")
def union_child_sources(t):
    return _child_sources(t).groupBy("word_id", "child", "source").agg(F.count("*").alias("n"))


@query(
    "prefix_guard",
    f"""WITH {CHILD_SOURCES}
    SELECT word_id, split_part(w.source, ':', 1) AS parent_origin, min(cs.source) AS offender, count(*) AS offenders
    FROM cs JOIN dom_words w USING (word_id) WHERE split_part(w.source, ':', 1) <> split_part(cs.source, ':', 1) GROUP BY 1, 2""",
)
def prefix_guard(t):
    return O.prefix_guard(t.dom_words, _child_sources(t))


@query(
    "next_version",
    """SELECT b.parent_id, coalesce(max(version), 0) + 1 AS next_version FROM
       (SELECT DISTINCT 'Brand#' || n_nationkey AS parent_id FROM nation) b LEFT JOIN versions v ON v.parent_id = b.parent_id GROUP BY 1""",
)
def next_version(t):
    parents = t.read("nation").select(F.concat(F.lit("Brand#"), "n_nationkey").alias("parent_id"))
    return O.next_version(parents, t.versions)


@query(
    "version_history",
    """SELECT parent_id, id, version, content, row_number() OVER (PARTITION BY parent_id ORDER BY version DESC) AS rank FROM versions""",
)
def version_history(t):
    return O.version_history(t.versions).select("parent_id", "id", "version", "content", "rank")


@query(
    "current_versions",
    """SELECT h.parent_id, h.current_version_id, v.version, v.content, v.model FROM version_heads h JOIN versions v ON v.id = h.current_version_id""",
)
def current_versions(t):
    rows = O.current_versions(t.version_heads, t.versions)
    return rows.select("parent_id", "current_version_id", "version", "content", "model")


EDITED = """
    ed AS (SELECT DISTINCT p_brand AS parent_id, CASE WHEN length(p_brand) = 7 THEN 'edited' END AS content, 'm9' AS model
           FROM part WHERE p_brand <> 'Brand#3'),
    cv AS (SELECT h.parent_id, v.content, v.model FROM version_heads h JOIN versions v ON v.id = h.current_version_id),
    tv AS (SELECT parent_id, max(version) + 1 AS version FROM versions GROUP BY 1),
    ad AS (SELECT (SELECT max(id) FROM versions) + row_number() OVER (ORDER BY parent_id) AS id, parent_id, tv.version,
                  coalesce(ed.content, cv.content) AS content, coalesce(ed.model, cv.model) AS model
           FROM ed JOIN tv USING (parent_id) LEFT JOIN cv USING (parent_id))"""


def _edits(t):
    brand = F.col("p_brand")
    return t.read("part").where(brand != "Brand#3").select(
        brand.alias("parent_id"), F.when(F.length(brand) == 7, "edited").alias("content"), F.lit("m9").alias("model")
    ).distinct()


@query(
    "save_version",
    f"""WITH {EDITED}
    SELECT h.parent_id, coalesce(ad.id, h.current_version_id) AS current_version_id, v.version, v.content, v.model
    FROM version_heads h LEFT JOIN ad USING (parent_id)
    JOIN (SELECT id, version, content, model FROM versions UNION ALL SELECT id, version, content, model FROM ad) v
      ON v.id = coalesce(ad.id, h.current_version_id)""",
)
def save_version(t):
    heads, versions = O.save_version(t.version_heads, t.versions, _edits(t))
    return O.current_versions(heads, versions).select("parent_id", "current_version_id", "version", "content", "model")


@query(
    "rollback_version",
    """WITH wanted AS (SELECT p_brand AS parent_id, CASE WHEN p_brand = 'Brand#5' THEN -1 ELSE min(p_partkey) END AS version FROM part GROUP BY 1)
    SELECT h.parent_id, coalesce(v.id, h.current_version_id) AS current_version_id FROM version_heads h
    LEFT JOIN wanted w USING (parent_id) LEFT JOIN versions v ON v.parent_id = w.parent_id AND v.version = w.version""",
)
def rollback_version(t):
    lowest = t.versions.groupBy("parent_id").agg(F.min("version").alias("version"))
    wanted = lowest.withColumn("version", F.when(F.col("parent_id") == "Brand#5", -1).otherwise(F.col("version")))
    return O.rollback_version(t.version_heads, t.versions, wanted)[0]


def _resolved(t):
    part = t.read("part")
    brand, key = F.col("p_brand"), F.col("p_partkey")
    recipes = part.select(
        key.alias("recipe_id"), F.col("p_name").alias("recipe_name"), F.col("p_size").alias("recipe_version"),
        F.col("p_type").alias("model"), brand.alias("provider_id"), key.alias("provider_version"),
        brand.alias("prompt_id"), (key + F.when(key % 3 == 0, 1).otherwise(0)).alias("prompt_version"),
    )
    parents = part.select(brand.alias("id"), F.lower(brand).alias("name"), F.lit("paraphrase").alias("stage")).distinct()
    provider_versions = part.select(
        brand.alias("parent_id"), key.alias("version"), F.concat(F.lit("https://"), F.lower("p_type")).alias("base_url"), F.lit("http").alias("transport")
    )
    return O.resolve_pinned_versions(recipes, parents, provider_versions, parents, t.versions)


PINNED = """
    r AS (SELECT p_partkey AS recipe_id, p_name AS recipe_name, p_size AS recipe_version, p_type AS model, p_brand,
                 p_partkey + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS prompt_version FROM part),
    x AS (SELECT r.*, v.content, CASE WHEN v.id IS NULL THEN 'prompt version' END AS missing FROM r
          LEFT JOIN versions v ON v.parent_id = r.p_brand AND v.version = r.prompt_version)"""


@query(
    "resolve_pinned_versions",
    f"WITH {PINNED} SELECT recipe_id, 'https://' || lower(model) AS base_url, content AS prompt_content, missing FROM x",
)
def resolve_pinned_versions(t):
    return _resolved(t).select("recipe_id", "base_url", "prompt_content", "missing")


@query(
    "config_snapshot",
    f"""WITH {PINNED}
    SELECT recipe_id, CAST(to_json({{'recipe': {{'id': recipe_id, 'name': recipe_name, 'version': recipe_version}},
       'provider': {{'id': p_brand, 'name': lower(p_brand), 'version': recipe_id, 'base_url': 'https://' || lower(model), 'transport': 'http'}},
       'model': model, 'prompt': {{'id': p_brand, 'name': lower(p_brand), 'version': prompt_version, 'sha256': left(sha256(content), 16)}}}}) AS VARCHAR)
       AS snapshot FROM x WHERE missing IS NULL""",
)
def config_snapshot(t):
    return O.config_snapshot(_resolved(t)).withColumn("snapshot", to_json(F.col("snapshot")))

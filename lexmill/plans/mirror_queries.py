"""The mirror, its checks, and the app package."""

from pyspark.sql import functions as F

from lexmill.operators import documents as D
from lexmill.operators import mirror as M
from lexmill.plans.document_queries import PACKAGE_SQL
from lexmill.operators.drift import drift_rows as drift_rows_of
from lexmill.plans.registry import query
from lexmill.session import fresh_path
from lexmill.sources import writers as W


def _mirror(t):
    return M.mirror_tables(
        t.dom_words, t.dom_meanings, t.dom_sentences, t.dom_mnemonics, t.dom_phrases, F.struct("kind", "text"), t.sentence_order
    )


@query(
    "mirror_words",
    """WITH m AS (SELECT word_id, CAST(to_json(list({'id': meaning_id} ORDER BY meaning_id)) AS VARCHAR) AS meanings FROM dom_meanings GROUP BY 1),
    n AS (SELECT word_id, CAST(to_json(list({'id': mnemonic_id} ORDER BY mnemonic_id)) AS VARCHAR) AS mnemonics FROM dom_mnemonics GROUP BY 1),
    p AS (SELECT owner_word_id AS word_id, CAST(to_json(list({'id': phrase_id} ORDER BY phrase_id)) AS VARCHAR) AS phrases FROM dom_phrases GROUP BY 1)
    SELECT word_id, form, coalesce(phonetic_us, '') AS phonetic_us, audio_us, meanings, mnemonics, phrases, CAST(NULL AS VARCHAR) AS plural, source, status
    FROM dom_words LEFT JOIN m USING (word_id) LEFT JOIN n USING (word_id) LEFT JOIN p USING (word_id)""",
)
def mirror_words(t):
    return _mirror(t)["word"].select(
        "word_id", "form", "phonetic_us", "audio_us", "meanings", "mnemonics", "phrases", "plural", "source", "status"
    )


@query(
    "mirror_meanings",
    """WITH s AS (SELECT meaning_id, CAST(to_json(list({'sentence_id': sentence_id} ORDER BY line_no, part_no_key, supp_key, cents)) AS VARCHAR) AS sentences
                  FROM dom_sentences GROUP BY 1)
    SELECT meaning_id, word_id, pos, CASE WHEN len(synonyms) > 0 THEN CAST(to_json(synonyms) AS VARCHAR) END AS synonyms, cn_paraphrase, en_paraphrase, sentences, source
    FROM dom_meanings LEFT JOIN s USING (meaning_id)""",
)
def mirror_meanings(t):
    return _mirror(t)["meaning"].select("meaning_id", "word_id", "pos", "synonyms", "cn_paraphrase", "en_paraphrase", "sentences", "source")


@query(
    "mirror_sentences",
    """SELECT s.sentence_id, m.word_id, s.meaning_id, s.form, s.translation, s.source, CAST(NULL AS VARCHAR) AS audio_us
       FROM dom_sentences s JOIN dom_meanings m USING (meaning_id)""",
)
def mirror_sentences(t):
    return _mirror(t)["sentence"].select("sentence_id", "word_id", "meaning_id", "form", "translation", "source", "audio_us")


@query(
    "mirror_mnemonics",
    """SELECT mnemonic_id, word_id, type, 0 AS user_group, CAST(to_json({'kind': kind, 'text': text}) AS VARCHAR) AS content, source, 0 AS creator_id FROM dom_mnemonics""",
)
def mirror_mnemonics(t):
    return _mirror(t)["mnemonic"]


@query("mirror_phrases", "SELECT phrase_id, form, meaning, '' AS audio_us, '' AS audio_uk FROM dom_phrases")
def mirror_phrases(t):
    return _mirror(t)["phrase"]


@query(
    "nullable_defaults",
    """SELECT word_id, coalesce(phonetic_us, '') AS phonetic_us, phonetic_uk, audio_uk, CAST(NULL AS VARCHAR) AS base FROM dom_words""",
)
def nullable_defaults(t):
    return _mirror(t)["word"].select("word_id", "phonetic_us", "phonetic_uk", "audio_uk", "base")


COUNTS = {"word": "dom_words", "meaning": "dom_meanings", "sentence": "dom_sentences", "mnemonic": "dom_mnemonics", "phrase": "dom_phrases"}


@query(
    "mirror_refresh",
    " UNION ALL ".join(
        f"SELECT '{k}' AS table_name, count(*) AS source_count, count(*) AS target_count, true AS same, true AS published FROM {v}" for k, v in COUNTS.items()
    ),
)
def mirror_refresh(t):
    snapshots = W.Snapshots(t.spark, fresh_path(t.spark, "mirror"))
    return W.mirror_refresh(snapshots, _mirror(t), _mirror_sources(t))


def _mirror_sources(t):
    return {"word": t.dom_words, "meaning": t.dom_meanings, "sentence": t.dom_sentences, "mnemonic": t.dom_mnemonics, "phrase": t.dom_phrases}


@query(
    "mirror_refresh_orphans",
    """SELECT 'sentence' AS table_name, (SELECT count(*) FROM dom_sentences) AS source_count,
              (SELECT count(*) FROM dom_sentences JOIN dom_meanings USING (meaning_id) WHERE meaning_id % 10 <> 3) AS target_count,
              false AS same, false AS published, (SELECT count(*) FROM dom_phrases) AS still_read
       UNION ALL SELECT 'phrase', count(*), count(*), true, false, count(*) FROM dom_phrases""",
)
def mirror_refresh_orphans(t):
    """Sentences without a meaning stop the publication; readers keep the tables published before."""
    snapshots = W.Snapshots(t.spark, fresh_path(t.spark, "mirror"))
    phrases = {"phrase": M.mirror_phrases(t.dom_phrases)}
    W.mirror_refresh(snapshots, phrases, {"phrase": t.dom_phrases})
    kept = t.dom_meanings.where("meaning_id % 10 <> 3")
    tables = {"sentence": M.mirror_sentences(t.dom_sentences, kept), "phrase": M.mirror_phrases(t.dom_phrases.limit(0))}
    report = W.mirror_refresh(snapshots, tables | phrases, {"sentence": t.dom_sentences, "phrase": t.dom_phrases})
    return report.withColumn("still_read", F.lit(snapshots.read("phrase").count()))


def _sides(t):
    """Orders as sentences of a source, and a copy without some rows and with some changed."""
    orders = t.read("orders").select(
        F.col("o_orderkey").alias("sentence_id"), F.col("o_custkey").alias("word_id"), F.col("o_orderpriority").alias("form")
    )
    phrases = t.dom_phrases
    changed = orders.withColumn("form", F.when(F.col("sentence_id") % 100 == 0, "x").otherwise(F.col("form")))
    return {
        "sentence": (orders, orders.where("sentence_id % 50 <> 7")),
        "phrase": (phrases, phrases.orderBy(F.col("phrase_id").desc())),
        "word": (
            changed.select("word_id", "form", F.lit(1).alias("type"), F.col("sentence_id").alias("source")),
            orders.select("word_id", "form", F.lit(1).alias("type"), F.col("sentence_id").alias("source")),
        ),
    }


@query(
    "count_check",
    """SELECT 'sentence' AS table_name, count(*) AS source_count, count(*) FILTER (o_orderkey % 50 <> 7) AS target_count, false AS same FROM orders
       UNION ALL SELECT 'phrase', count(*), count(*), true FROM supplier UNION ALL SELECT 'word', count(*), count(*), true FROM orders""",
)
def count_check(t):
    return W.count_check(_sides(t))


def _digest(text, rows, keep="true"):
    d = f"CAST('0x' || left(md5({text}), 8) AS BIGINT)"
    return f"(SELECT count(*) AS n, bit_xor({d}) AS x, CAST(sum({d}) AS DECIMAL(38, 0)) AS s FROM {rows} WHERE {keep})"


@query(
    "table_checksums",
    f"""SELECT table_name, a.n AS source_count, b.n AS target_count, a.x AS source_xor, b.x AS target_xor, a.s AS source_sum, b.s AS target_sum,
               a.n <> b.n OR a.x <> b.x OR a.s <> b.s AS drift FROM (
        SELECT 'sentence' AS table_name, a, b FROM {_digest("concat_ws('|', o_orderkey, o_custkey, o_orderpriority)", "orders")} a,
               {_digest("concat_ws('|', o_orderkey, o_custkey, o_orderpriority)", "orders", "o_orderkey % 50 <> 7")} b
        UNION ALL SELECT 'phrase', a, b FROM {_digest("concat_ws('|', s_suppkey, s_name)", "supplier")} a, {_digest("concat_ws('|', s_suppkey, s_name)", "supplier")} b
        UNION ALL SELECT 'word', a, b FROM
               {_digest("concat_ws('|', o_custkey, CASE WHEN o_orderkey % 100 = 0 THEN 'x' ELSE o_orderpriority END, 1, o_orderkey)", "orders")} a,
               {_digest("concat_ws('|', o_custkey, o_orderpriority, 1, o_orderkey)", "orders")} b)""",
)
def table_checksums(t):
    return M.table_checksums(_sides(t))


@query(
    "append_run_report",
    """SELECT 'sentence' AS table_name, false AS same, 2 AS runs UNION ALL SELECT 'phrase', true, 2 UNION ALL SELECT 'word', true, 2""",
)
def append_run_report(t):
    path = fresh_path(t.spark, "report")
    for _ in range(2):
        W.append_run_report(W.count_check(_sides(t)), path)
    back = t.spark.read.schema("table_name string, source_count bigint, target_count bigint, same boolean").json(path)
    return back.groupBy("table_name", "same").agg(F.count("*").cast("int").alias("runs"))


@query("export_packaged_json", PACKAGE_SQL + "SELECT word_id, word_json FROM d")
def export_packaged_json(t):
    path = fresh_path(t.spark, "package")
    entries = D.package_entry(t.dom_words, t.dom_meanings, t.dom_sentences, t.dom_mnemonics, t.sentence_order, ranged=True)
    W.export_packaged_json(entries, path)
    return t.spark.read.schema("word_id bigint, word_json string").json(path)


@query(
    "drift_rows",
    """SELECT sentence_id, CASE sum_ % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'changed' END AS drift
       FROM (SELECT sentence_id, cents % 500 AS sum_ FROM dom_sentences) WHERE sum_ IN (0, 1)
       UNION ALL SELECT 'new ' || word_id, 'extra' FROM dom_words WHERE word_id % 400 = 7""",
)
def drift_rows(t):
    """The differences planted in a copy of all sentences: rows taken out, changed and added."""
    source = t.dom_sentences.select("sentence_id", "meaning_id", "form", "translation")
    mark = F.col("cents") % 500
    copy = t.dom_sentences.where(mark != 0).withColumn("translation", F.when(mark == 1, F.concat("translation", F.lit("!"))).otherwise(F.col("translation")))
    added = t.dom_words.where("word_id % 400 = 7").select(
        F.concat(F.lit("new "), "word_id").alias("sentence_id"), F.lit(0).cast(source.schema["meaning_id"].dataType).alias("meaning_id"), F.lit("f").alias("form"), F.lit("t").alias("translation")
    )
    return drift_rows_of(source, copy.select(*source.columns).unionByName(added), ["sentence_id"])

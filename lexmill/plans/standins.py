"""Vocabulary tables derived from the driver's tables, in Spark and, equally, in SQL.

words / meanings / sentences   customer / orders / lineitem
mnemonics, phrases, packages   part, supplier, nation
pipeline words, artifacts      documents, conversations
ledger, resolutions, audit     events
raw word lines                 documents, part names
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.session import spread_table

STAGES = ("fetch_dict", "paraphrase", "phonetic", "derivatives", "examples", "mnemonic", "quality_gate", "export")
AUDIO_BASE = "https://audio.example.com/voice?audio="
SPLIT = "[ \t\r\n\f]+"

_STAGE_LIST_SQL = "[" + ", ".join(f"'{s}'" for s in STAGES) + "]"

VIEW_SQL: dict[str, str] = {
    "raw_tokens": rf"""
        SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS pos, unnest(parts) AS raw_form, batch_id
        FROM (SELECT doc_id, source AS batch_id, string_split_regex(text, '[ \t\r\n\f]+') AS parts FROM documents)""",
    "first_forms": r"""
        SELECT normalized_form, CAST(1 AS SMALLINT) AS type,
               arg_min(raw_form, doc_id * 1000000 + pos) AS raw_form,
               arg_min(batch_id, doc_id * 1000000 + pos) AS batch_id,
               min(doc_id * 1000000 + pos) AS first_seen
        FROM (SELECT *, replace(lower(raw_form), 'ß', 'ss') AS normalized_form FROM raw_tokens WHERE raw_form <> '')
        GROUP BY normalized_form""",
    "dom_words": f"""
        SELECT c_custkey AS word_id, CAST(CASE WHEN c_custkey % 10 = 0 THEN 2 ELSE 1 END AS SMALLINT) AS type,
               c_name AS form,
               CASE WHEN c_custkey % 3 <> 0 THEN lower(c_mktsegment) END AS phonetic_us,
               c_mktsegment AS phonetic_uk,
               CASE WHEN c_custkey % 4 <> 0 THEN '{AUDIO_BASE}' || c_name || '&type=2' END AS audio_us,
               CAST(NULL AS VARCHAR) AS audio_uk,
               CASE WHEN c_nationkey % 5 = 0 THEN 'human:web' ELSE 'pipeline:local:m1:paraphrase_v1' END AS source,
               CAST(CASE WHEN c_acctbal >= 0 THEN 1 WHEN c_custkey % 2 = 0 THEN 0 ELSE 2 END AS SMALLINT) AS status,
               CASE c_nationkey % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'suspect' ELSE 'fixed' END AS quality_flag,
               TIMESTAMP '2024-01-01' + to_days(c_nationkey) AS updated_at,
               c_nationkey
        FROM customer""",
    "dom_meanings": """
        SELECT o_orderkey AS meaning_id, o_custkey AS word_id,
               CAST(left(o_orderpriority, 1) AS SMALLINT) AS pos, CAST(NULL AS SMALLINT) AS pos_sub,
               o_orderpriority || '；' || o_orderstatus AS cn_paraphrase,
               CASE WHEN o_orderkey % 4 <> 0 THEN 'status ' || o_orderstatus END AS en_paraphrase,
               CASE WHEN o_orderstatus = 'P' THEN [o_orderpriority] END AS synonyms,
               CASE WHEN o_orderkey % 97 = 0 THEN 'human:web' ELSE 'pipeline:local:m1:paraphrase_v1' END AS source
        FROM orders""",
    "dom_sentences": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         CAST(round(l_extendedprice * 100) AS BIGINT)) AS sentence_id,
               l_orderkey AS meaning_id, l_linenumber AS line_no, l_partkey AS part_no_key, l_suppkey AS supp_key,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
               l_returnflag || l_linestatus || ' ' || l_partkey AS form,
               'q' || CAST(l_quantity AS BIGINT) AS translation,
               'pipeline:local:m1:examples_v1' AS source
        FROM lineitem""",
    "dom_mnemonics": """
        SELECT p_partkey AS mnemonic_id, p_partkey // 2 AS word_id, CAST(1 AS SMALLINT) AS type,
               'phonetic' AS kind, p_name AS text, 'pipeline:local:m1:mnemonic_v1' AS source
        FROM part""",
    "dom_phrases": """
        SELECT s_suppkey AS phrase_id, s_suppkey AS owner_word_id, s_name AS form,
               'nation ' || s_nationkey AS meaning, 'pipeline:local:m1:phrases_v1' AS source
        FROM supplier""",
    "dom_packages": """
        SELECT CAST(n_regionkey AS BIGINT) AS package_id, CAST(n_nationkey AS BIGINT) AS unit_id,
               c_custkey AS word_id, CAST(c_custkey AS DOUBLE) AS sort_order, CAST(c_custkey % 5 AS INTEGER) AS importance
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "pipe_words": """
        SELECT doc_id AS id, lang || ' ' || doc_id AS normalized_form, CAST(2 AS SMALLINT) AS type,
               source AS batch_id, CASE WHEN doc_id % 3 = 0 THEN 'done' ELSE 'new' END AS status,
               CASE WHEN doc_id % 3 = 0 THEN doc_id END AS app_word_id
        FROM documents""",
    "pipe_artifacts": f"""
        SELECT conv_id AS word_id, {_STAGE_LIST_SQL}[CAST(turn AS INTEGER) + 1] AS stage_name,
               sha256(text) AS fingerprint, text AS payload, 'pipeline:local:' || role AS source, turn
        FROM conversations""",
    "ledger": f"""
        SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS batch_id, user_id AS word_id,
               {_STAGE_LIST_SQL}[CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 1] AS stage_name,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
               CAST(value AS DECIMAL(10, 6)) AS cost_usd,
               CASE WHEN event_type = 'error' THEN 'bad answer for ' || user_id || chr(10) || props END AS error,
               ts AS started_at
        FROM events WHERE event_type <> 'signup'""",
    "resolutions": f"""
        SELECT user_id AS word_id,
               {_STAGE_LIST_SQL}[CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 1] AS stage_name,
               ts AS resolved_at
        FROM events WHERE event_type = 'signup'""",
    "editors": """
        SELECT c_custkey AS id, c_name AS display_name, c_acctbal >= 0 AS is_active FROM customer""",
    "audit": """
        SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS word_id,
               CASE event_type WHEN 'error' THEN 'words.form' WHEN 'click' THEN 'meanings.cn_paraphrase'
                    WHEN 'view' THEN 'sentences.form' WHEN 'purchase' THEN 'words.status'
                    ELSE 'phrases.meaning' END AS field_path,
               event_id % 7 AS target_id, 'update' AS op, CAST(value AS VARCHAR) AS new_value,
               user_id AS editor_id, ts AS created_at
        FROM events""",
    "versions": """
        SELECT p_brand AS parent_id, p_partkey AS id, CAST(p_partkey AS BIGINT) AS version, p_name AS content,
               p_type AS model, p_size AS temperature
        FROM part""",
    "version_heads": """
        SELECT p_brand AS parent_id, max(p_partkey) FILTER (p_size <= 25) AS current_version_id
        FROM part GROUP BY p_brand""",
}


class Tables:
    """The driver's tables of one scale factor, and the vocabulary tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def documents(self) -> DataFrame:
        """The texts, which most queries work hard on row by row."""
        return spread_table(self.read("documents"), "doc_id")

    @staticmethod
    def stage_of(index) -> F.Column:
        return F.element_at(F.array(*[F.lit(s) for s in STAGES]), index + 1)

    @property
    def raw_tokens(self) -> DataFrame:
        tokens = self.documents.select(
            "doc_id", F.posexplode(F.split("text", SPLIT)).alias("pos", "raw_form"), F.col("source").alias("batch_id")
        )
        return tokens.withColumn("line_no", F.col("doc_id") * 1_000_000 + F.col("pos"))

    @property
    def dom_words(self) -> DataFrame:
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        return self.read("customer").select(
            key.alias("word_id"),
            F.when(key % 10 == 0, 2).otherwise(1).cast("smallint").alias("type"),
            F.col("c_name").alias("form"),
            F.when(key % 3 != 0, F.lower("c_mktsegment")).alias("phonetic_us"),
            F.col("c_mktsegment").alias("phonetic_uk"),
            F.when(key % 4 != 0, T.compose_url(AUDIO_BASE, F.concat("c_name", F.lit("&type=2")))).alias("audio_us"),
            F.lit(None).cast("string").alias("audio_uk"),
            F.when(nation % 5 == 0, "human:web").otherwise("pipeline:local:m1:paraphrase_v1").alias("source"),
            F.when(F.col("c_acctbal") >= 0, 1).when(key % 2 == 0, 0).otherwise(2).cast("smallint").alias("status"),
            F.when(nation % 3 == 0, "none").when(nation % 3 == 1, "suspect").otherwise("fixed").alias("quality_flag"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(nation)).alias("updated_at"),
            nation,
        )

    @property
    def dom_meanings(self) -> DataFrame:
        key, prio, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
        return self.read("orders").select(
            key.alias("meaning_id"),
            F.col("o_custkey").alias("word_id"),
            F.left(prio, F.lit(1)).cast("smallint").alias("pos"),
            F.lit(None).cast("smallint").alias("pos_sub"),
            F.concat(prio, F.lit("；"), status).alias("cn_paraphrase"),
            F.when(key % 4 != 0, F.concat(F.lit("status "), status)).alias("en_paraphrase"),
            F.when(status == "P", F.array(prio)).alias("synonyms"),
            F.when(key % 97 == 0, "human:web").otherwise("pipeline:local:m1:paraphrase_v1").alias("source"),
        )

    sentence_order = ("line_no", "part_no_key", "supp_key", "cents")

    @property
    def dom_sentences(self) -> DataFrame:
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        return self.read("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents).alias("sentence_id"),
            F.col("l_orderkey").alias("meaning_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("part_no_key"),
            F.col("l_suppkey").alias("supp_key"),
            cents.alias("cents"),
            F.concat("l_returnflag", "l_linestatus", F.lit(" "), "l_partkey").alias("form"),
            F.concat(F.lit("q"), F.col("l_quantity").cast("bigint")).alias("translation"),
            F.lit("pipeline:local:m1:examples_v1").alias("source"),
        )

    @property
    def dom_mnemonics(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("mnemonic_id"),
            F.expr("p_partkey div 2").alias("word_id"),
            F.lit(1).cast("smallint").alias("type"),
            F.lit("phonetic").alias("kind"),
            F.col("p_name").alias("text"),
            F.lit("pipeline:local:m1:mnemonic_v1").alias("source"),
        )

    @property
    def dom_phrases(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").alias("phrase_id"),
            F.col("s_suppkey").alias("owner_word_id"),
            F.col("s_name").alias("form"),
            F.concat(F.lit("nation "), "s_nationkey").alias("meaning"),
            F.lit("pipeline:local:m1:phrases_v1").alias("source"),
        )

    @property
    def dom_packages(self) -> DataFrame:
        nations = self.read("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return self.read("customer").join(nations, "c_nationkey").select(
            F.col("n_regionkey").cast("bigint").alias("package_id"),
            F.col("c_nationkey").cast("bigint").alias("unit_id"),
            F.col("c_custkey").alias("word_id"),
            F.col("c_custkey").cast("double").alias("sort_order"),
            (F.col("c_custkey") % 5).cast("int").alias("importance"),
        )

    @property
    def pipe_words(self) -> DataFrame:
        done = F.col("doc_id") % 3 == 0
        return self.read("documents").select(
            F.col("doc_id").alias("id"),
            F.concat("lang", F.lit(" "), "doc_id").alias("normalized_form"),
            F.lit(2).cast("smallint").alias("type"),
            F.col("source").alias("batch_id"),
            F.when(done, "done").otherwise("new").alias("status"),
            F.when(done, F.col("doc_id")).alias("app_word_id"),
        )

    @property
    def pipe_artifacts(self) -> DataFrame:
        return self.read("conversations").select(
            F.col("conv_id").alias("word_id"),
            self.stage_of(F.col("turn").cast("int")).alias("stage_name"),
            F.sha2("text", 256).alias("fingerprint"),
            F.col("text").alias("payload"),
            F.concat(F.lit("pipeline:local:"), "role").alias("source"),
            "turn",
        )

    @cached_property
    def _event_stage(self):
        return self.stage_of(F.get_json_object("props", "$.k").cast("int") % 4)

    def as_ledger(self, events: DataFrame) -> DataFrame:
        failed = F.col("event_type") == "error"
        return events.where(F.col("event_type") != "signup").select(
            F.col("event_id").alias("id"),
            F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
            F.col("user_id").alias("word_id"),
            self._event_stage.alias("stage_name"),
            F.when(failed, "failed").otherwise("ok").alias("status"),
            F.col("value").cast("decimal(10,6)").alias("cost_usd"),
            F.when(failed, F.concat(F.lit("bad answer for "), "user_id", F.lit("\n"), "props")).alias("error"),
            F.col("ts").alias("started_at"),
        )

    @property
    def ledger(self) -> DataFrame:
        return self.as_ledger(self.read("events"))

    @property
    def resolutions(self) -> DataFrame:
        return self.read("events").where(F.col("event_type") == "signup").select(
            F.col("user_id").alias("word_id"), self._event_stage.alias("stage_name"), F.col("ts").alias("resolved_at")
        )

    @property
    def editors(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("display_name"), (F.col("c_acctbal") >= 0).alias("is_active")
        )

    @property
    def audit(self) -> DataFrame:
        kind = F.col("event_type")
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("word_id"),
            F.when(kind == "error", "words.form")
            .when(kind == "click", "meanings.cn_paraphrase")
            .when(kind == "view", "sentences.form")
            .when(kind == "purchase", "words.status")
            .otherwise("phrases.meaning")
            .alias("field_path"),
            (F.col("event_id") % 7).alias("target_id"),
            F.lit("update").alias("op"),
            F.col("value").cast("string").alias("new_value"),
            F.col("user_id").alias("editor_id"),
            F.col("ts").alias("created_at"),
        )

    @property
    def versions(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_brand").alias("parent_id"),
            F.col("p_partkey").alias("id"),
            F.col("p_partkey").alias("version"),
            F.col("p_name").alias("content"),
            F.col("p_type").alias("model"),
            F.col("p_size").alias("temperature"),
        )

    @property
    def version_heads(self) -> DataFrame:
        older = F.when(F.col("p_size") <= 25, F.col("p_partkey"))
        return self.read("part").groupBy(F.col("p_brand").alias("parent_id")).agg(F.max(older).alias("current_version_id"))

"""The operators over the driver's tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import (
    byte_bpe, chat, fingerprints, jaccard, licenses, mixing, quality, quality_rules, suffix_model, toxicity, vector_codes, vector_dedup, whitening,
)

QUALITY_LEAST = 0.3
TOXIC_LEAST = 0.7
BPE_FILE = "byte_bpe_multi_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Lengths and digests of every text's ids and of what they decode to."""
    import public_tokenizers

    return byte_bpe.digest_documents(docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op1_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(spark, _table(spark, sf_dir, "documents"))


def _predictions(scored: DataFrame, folds: int, held_out: int, least: float) -> DataFrame:
    return scored.select(
        "doc_id",
        (quality.fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def op4_quality_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return _predictions(quality.score_quality(docs, model), 5, 0, QUALITY_LEAST)


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), folds=3, held_out=1)
    return _predictions(toxicity.find_toxic(docs, model), 3, 1, TOXIC_LEAST)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan_licenses(_table(spark, sf_dir, "documents")))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_model.suffix_scores(_table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transcripts made of all conversations, parsed by a model that learns from four fifths of them."""
    pieces = chat.raw_pieces(_table(spark, sf_dir, "conversations"))
    model = chat.train(pieces.where(quality.fold(F.col("conv"), 5) != 0))
    turns = chat.parse_transcripts(pieces, model)
    return turns.select(F.col("conv").alias("conv_id"), "turn", "role", "rendered")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(_table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten_vectors(_table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(_table(spark, sf_dir, "documents"))


# The turns that the transcripts were made of.
CHAT_SQL = """
SELECT conv_id, turn, role, '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' AS rendered
FROM conversations"""


def _license_sql() -> str:
    """Brute force: every template at every position of every text."""
    cells = []
    for t in licenses.TEMPLATES:
        key, wording = t.key.split(), t.wording.split()
        lead = next(i for i in range(len(wording)) if wording[i : i + len(key)] == key)
        stands = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(key))
        agree = " + ".join(
            f"(CASE WHEN i + {k - lead} >= 0 AND w[i + {k - lead + 1}] = '{x}' THEN 1 ELSE 0 END)" for k, x in enumerate(wording)
        )
        cells.append(
            f"list_transform(list_filter(range(len(w)), lambda i: {stands}), lambda i: "
            f"{{'label': '{t.label}', 'base': {str(t.base).lower()}, 'start': i, 'share': ({agree})::DOUBLE / {len(wording)}}})"
        )
    return f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), found AS (
  SELECT doc_id, len(w) AS n_words, flatten([{", ".join(cells)}]) AS places FROM texts
), based AS (
  SELECT *, list_filter(places, lambda p: p.base) AS b FROM found
)
SELECT doc_id, n_words::BIGINT AS n_words, len(b)::BIGINT AS n_base,
  list_min(list_transform(b, lambda p: p.start))::BIGINT AS first_word,
  list_max(list_transform(b, lambda p: p.start))::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(b, lambda p: p.label))), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label))), ','), '') AS labels,
  coalesce(list_max(list_transform(places, lambda p: p.share)), 0.0)::DOUBLE AS score
FROM based"""


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS slot
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS most,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM totals
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM weighed
), settled AS (
  SELECT min_by(rate, place) AS rate FROM ranked WHERE most >= weight * rate
), targets AS (
  SELECT source, source_size, least(most, weight * rate) AS target FROM weighed, settled
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), lined AS (
  SELECT s.*, b.source_size, b.target, b.whole, b.target - b.whole * b.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.slot) AS reached,
    sum(s.size) OVER (PARTITION BY s.source, s.slot) AS at_slot
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
), edged AS (
  SELECT *, min(CASE WHEN reached > rest THEN slot END) OVER (PARTITION BY source) AS edge FROM lined
), counted AS (
  SELECT *, whole + CASE
    WHEN edge IS NULL THEN CASE WHEN source_size = 0 OR rest = 0 THEN 0 ELSE 1 END
    WHEN slot < edge THEN 1
    WHEN slot = edge AND at_slot > 0 AND (rest - (reached - at_slot)) * 2 >= at_slot THEN 1
    ELSE 0 END AS copies
  FROM edged
)
SELECT doc_id, size, source_size, target, least(copies, 2)::BIGINT * size AS taken, least(copies, 2)::BIGINT AS copies
FROM counted"""


def _codes_sql() -> str:
    """Every part against every entry, round by round; the tables' vectors have 64 components."""
    k, parts, width = vector_codes.ENTRIES, vector_codes.PARTS, 64 // vector_codes.PARTS
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS rid, vec_id, label,
    list_transform(embedding, lambda v: floor({vector_codes.SCALE} * v::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), cells AS MATERIALIZED (
  SELECT rid, d // {width} AS part, d % {width} AS place, x[d + 1] AS v
  FROM (SELECT rid, x, unnest(range({parts * width})) AS d FROM kept)
), book0 AS MATERIALIZED (
  SELECT part, rid AS entry, place, v FROM cells WHERE rid < {k}
)"""]
    for r in range(vector_codes.ROUNDS + 1):
        steps.append(f""", near{r} AS MATERIALIZED (
  SELECT rid, part, arg_min(entry, apart * {k} + entry) AS entry, min(apart) AS apart FROM (
    SELECT c.rid, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) AS apart
    FROM cells c JOIN book{r} b ON c.part = b.part AND c.place = b.place GROUP BY ALL)
  GROUP BY ALL
)""")
        if r < vector_codes.ROUNDS:
            steps.append(f""", book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
    SELECT n.part, n.entry, c.place, floor(sum(c.v)::DOUBLE / count(*))::BIGINT AS v
    FROM near{r} n JOIN cells c ON n.rid = c.rid AND n.part = c.part GROUP BY ALL
  ) m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place
)""")
    return "".join(steps) + f""", coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(apart)::BIGINT AS error
  FROM near{vector_codes.ROUNDS} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{vector_codes.ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (rid)"""


RULES_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), split AS MATERIALIZED (
  SELECT rid, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), runs AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, run) AS times FROM (
    SELECT rid, unnest(range(1, len(w) - 3)) AS i,
      unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS run
    FROM split)
), covered AS (
  SELECT rid, sum(step)::BIGINT AS n FROM (
    SELECT rid, least(5, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), 5)) AS step FROM runs WHERE times > 1)
  GROUP BY rid
), placed AS (
  SELECT rid, source, t, line, regexp_replace(lower(line), '[\x20\x09-\x0D0-9]+', '', 'g') AS form
  FROM (SELECT rid, source, t, unnest(lines) AS line FROM split)
), frequent AS (
  SELECT source, form FROM placed GROUP BY source, form HAVING count(DISTINCT t) > {quality_rules.MOST_TEXTS}
), lost AS (
  SELECT rid, sum(length(line))::BIGINT AS chars, sum(CASE WHEN f.form IS NOT NULL THEN length(line) ELSE 0 END)::BIGINT AS gone
  FROM placed p LEFT JOIN frequent f ON p.source IS NOT DISTINCT FROM f.source AND p.form = f.form GROUP BY rid
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lost.chars, 0) AS chars, coalesce(lost.gone, 0)::BIGINT AS n_lost_chars
  FROM split LEFT JOIN covered c USING (rid) LEFT JOIN lost USING (rid)
), judged AS (
  SELECT *, n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lost_chars,
  NOT base_failed AND NOT 100 * (chars - n_lost_chars) < {quality_rules.LEAST_LEFT} * chars AS kept
FROM judged"""


def queries() -> dict[str, Query]:
    return {
        "op1_vector_dedup": op1_vector_dedup,
        "op2_simhash": op2_simhash,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_quality_vote": op4_quality_vote,
        "op5_license_scan": op5_license_scan,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_suffix_tree": op7_suffix_tree,
        "op8_toxic_segments": op8_toxic_segments,
        "op9_mix_sources": op9_mix_sources,
        "op10_chat_turns": op10_chat_turns,
        "op11_vector_codes": op11_vector_codes,
        "op12_whitening": op12_whitening,
        "op13_quality_rules": op13_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_license_scan": _license_sql(), "op9_mix_sources": MIX_SQL, "op10_chat_turns": CHAT_SQL,
        "op11_vector_codes": _codes_sql(), "op13_quality_rules": RULES_SQL,
    }

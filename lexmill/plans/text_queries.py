"""Sources and scalar functions, over whole driver tables."""

from pyspark.sql import functions as F

from lexmill.functions import hashing as H
from lexmill.functions import lookups as L
from lexmill.functions import text as T
from lexmill.plans.registry import query
from lexmill.plans.standins import AUDIO_BASE
from lexmill.session import fresh_path
from lexmill.sources import readers as R

FOLD = "replace(lower({}), 'ß', 'ss')"


@query(
    "scan_word_lines",
    """SELECT raw_form, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS raw_form FROM documents)
       GROUP BY raw_form""",
)
def scan_word_lines(t):
    path = fresh_path(t.spark, "lines")
    t.documents.select("text").write.text(path)
    return R.read_word_lines(t.spark, path).groupBy("raw_form").agg(F.count("*").alias("n"))


@query(
    "scan_entity_tables",
    """SELECT 'words' AS table_name, count(*) AS n, sum(word_id) AS id_sum FROM dom_words
       UNION ALL SELECT 'meanings', count(*), sum(meaning_id) FROM dom_meanings WHERE word_id IN (SELECT word_id FROM dom_words)
       UNION ALL SELECT 'sentences', count(*), sum(meaning_id) FROM dom_sentences
                 WHERE meaning_id IN (SELECT meaning_id FROM dom_meanings)
       UNION ALL SELECT 'mnemonics', count(*), sum(mnemonic_id) FROM dom_mnemonics
                 WHERE word_id IN (SELECT word_id FROM dom_words)""",
)
def scan_entity_tables(t):
    tables = R.scan_entity_tables(t.dom_words, t.dom_meanings, t.dom_sentences, t.dom_mnemonics)
    ids = {"words": "word_id", "meanings": "meaning_id", "sentences": "meaning_id", "mnemonics": "mnemonic_id"}
    out = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.sum(ids[name]).alias("id_sum"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "scan_glossary",
    """WITH e AS (SELECT 'w' || o_orderkey AS word, o_orderpriority AS pos,
                  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS cn, o_orderstatus || ' x' AS en FROM orders)
       SELECT word, pos, cn, en FROM e WHERE cn <> ''""",
)
def scan_glossary(t):
    key, prio = F.col("o_orderkey"), F.col("o_orderpriority")
    hint = F.when(key % 3 == 0, F.concat(F.lit("（"), "o_orderstatus", F.lit("） "), prio)).otherwise(prio)
    entry = F.struct(
        prio.alias("pos"), F.when(key % 7 == 0, "").otherwise(hint).alias("cn"),
        F.concat(F.lit("<b>"), "o_orderstatus", F.lit("</b> x")).alias("en"),
    )
    path = fresh_path(t.spark, "glossary")
    t.read("orders").select(F.to_json(F.create_map(F.concat(F.lit("w"), key), F.array(entry)))).write.text(path)
    return R.read_glossary(t.spark, path).select("word", F.inline("meanings"))


@query(
    "scan_result_log",
    """SELECT DISTINCT o_custkey AS word_id FROM orders WHERE o_orderkey % 3 = 0""",
)
def scan_result_log(t):
    key, word = F.col("o_orderkey"), F.col("o_custkey")
    line = (
        F.when(key % 3 == 0, F.to_json(F.struct(F.col("o_orderstatus").alias("form"), word.alias("word_id"))))
        .when(key % 3 == 1, F.concat(F.lit('{"word_id": '), word))
        .otherwise(F.to_json(F.struct(word.cast("string").alias("word_id"))))
    )
    path = fresh_path(t.spark, "results")
    t.read("orders").select(line).write.text(path)
    return R.read_result_log(t.spark, path)


@query(
    "normalize_form",
    f"""SELECT {FOLD.format('raw_form')} AS normalized_form, CAST(1 AS SMALLINT) AS type, count(*) AS n
        FROM raw_tokens WHERE raw_form <> '' GROUP BY 1
        UNION ALL SELECT lower(p_name), CAST(2 AS SMALLINT), count(*) FROM part GROUP BY 1""",
)
def normalize_form(t):
    raw = t.raw_tokens.select("raw_form").unionByName(t.read("part").select(F.concat(F.lit("  "), "p_name").alias("raw_form")))
    # Equal raw forms are counted first, so each spelling is normalised once.
    spellings = raw.where(~T.is_blank(F.col("raw_form"))).groupBy("raw_form").agg(F.count("*").alias("n"))
    forms = T.with_normalized(spellings, "raw_form")
    return forms.groupBy("normalized_form", "type").agg(F.sum("n").alias("n"))


@query(
    "source_tag",
    """SELECT word_id AS conv_id, turn,
              'pipeline:' || split_part(source, ':', 3) || ':x.claude-' || turn || '-mini:' || stage_name || '_v1' AS source,
              'claude-' || turn AS short_model FROM pipe_artifacts""",
)
def source_tag(t):
    model = F.concat(F.lit("x.claude-"), "turn", F.lit("-mini"))
    return t.read("conversations").select(
        "conv_id", "turn",
        T.source_tag(F.col("role"), model, t.stage_of(F.col("turn").cast("int")), F.lit("1")).alias("source"),
        T.short_model_tag(model).alias("short_model"),
    )


@query(
    "source_origin",
    """SELECT split_part(source, ':', 1) AS origin, count(*) AS n FROM
       (SELECT source FROM dom_words UNION ALL SELECT source FROM dom_meanings) GROUP BY 1""",
)
def source_origin(t):
    rows = t.dom_words.select("source").unionByName(t.dom_meanings.select("source"))
    return rows.groupBy(T.source_origin(F.col("source")).alias("origin")).agg(F.count("*").alias("n"))


@query(
    "strip_markup",
    r"""SELECT page_id, md5(regexp_replace(regexp_replace(html, '</?b>', '', 'gi'), '^\s+|\s+$', '', 'g')) AS cleaned FROM pages""",
)
def strip_markup(t):
    html = F.concat(F.lit(" <B>"), "html", F.lit("</b>\t"))
    return t.read("pages").select("page_id", F.md5(T.strip_markup(html)).alias("cleaned"))


@query(
    "split_gloss",
    """SELECT meaning_id, unnest(string_split(cn_paraphrase, '；')) AS gloss FROM dom_meanings""",
)
def split_gloss(t):
    padded = F.concat(F.lit(" ； "), "cn_paraphrase", F.lit(";"))
    return t.dom_meanings.select("meaning_id", F.explode(T.split_gloss(padded)).alias("gloss"))


@query(
    "parse_gloss_line",
    """WITH g AS (SELECT o_orderkey, o_orderpriority AS a, o_orderstatus AS b,
              CASE o_orderkey % 5 WHEN 0 THEN 'n' WHEN 1 THEN 'v' WHEN 2 THEN 'adj' WHEN 4 THEN 'v' END AS pos,
              CASE WHEN o_orderkey % 11 = 0 THEN '[see 过去式] ' ELSE '' END AS tag FROM orders)
       SELECT o_orderkey, 0 AS idx, pos, tag || a AS cn FROM g WHERE pos IS NOT NULL
       UNION ALL SELECT o_orderkey, 1, pos, tag || b FROM g WHERE pos IS NOT NULL""",
)
def parse_gloss_line(t):
    key = F.col("o_orderkey")
    pos = F.when(key % 5 == 0, "n").when(key % 5 == 1, "vt").when(key % 5 == 2, "adj").when(key % 5 == 3, "x").otherwise("v")
    note = F.when(key % 11 == 0, "（see的过去式）").otherwise("")
    line = F.concat(F.lit(" "), pos, F.lit(". "), "o_orderpriority", F.lit("； "), "o_orderstatus", note)
    rows = t.read("orders").select("o_orderkey", F.posexplode(T.parse_gloss_line(line)).alias("idx", "item"))
    return rows.select("o_orderkey", "idx", "item.pos", "item.cn")


@query(
    "pos_code",
    """SELECT o_orderkey, CAST(map {'n': 1, 'v': 2, 'adj': 3, 'adv': 4}[p] AS SMALLINT) AS code FROM
       (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'n' WHEN 1 THEN 'v' WHEN 2 THEN 'adj' WHEN 3 THEN 'adv' ELSE 'x' END AS p
        FROM orders)""",
)
def pos_code(t):
    key = F.col("o_orderkey") % 5
    name = F.when(key == 0, "n").when(key == 1, "v").when(key == 2, "adj").when(key == 3, "adv").otherwise("x")
    return t.read("orders").select("o_orderkey", L.pos_code(name).alias("code"))


@query(
    "pos_display",
    """SELECT meaning_id,
              coalesce(map {1: 'n.', 2: 'v.', 3: 'adj.', 4: 'adv.'}[CAST(pos % 5 AS INTEGER)], '') AS pos_en,
              coalesce(map {1: '名词', 2: '动词', 3: '形容词', 4: '副词'}[CAST(pos % 5 AS INTEGER)], '') AS pos_cn FROM dom_meanings""",
)
def pos_display(t):
    return t.dom_meanings.select("meaning_id", L.pos_display(F.col("pos") % 5).alias("d")).select("meaning_id", "d.*")


@query(
    "compose_url",
    f"""SELECT c_custkey, CASE WHEN c_custkey % 4 > 1 THEN '{AUDIO_BASE}' || c_name END AS url FROM customer""",
)
def compose_url(t):
    key = F.col("c_custkey") % 4
    suffix = F.when(key > 1, F.col("c_name")).when(key == 1, "")
    return t.read("customer").select("c_custkey", T.compose_url(AUDIO_BASE, suffix).alias("url"))


@query(
    "truncate_text",
    """SELECT doc_id, md5(left(text, 5500)) AS cut, length(text) > 5500 AS truncated, left(text, 180) AS en FROM documents""",
)
def truncate_text(t):
    text = F.col("text")
    return t.documents.select(
        "doc_id", F.md5(T.truncate_text(text, "blob")).alias("cut"), T.is_truncated(text, "blob").alias("truncated"),
        T.truncate_text(text, "en_paraphrase").alias("en"),
    )


TEMPLATE = "Word: {word}\nDictionary:\n{dict_summary}\nAgain: {word}"


@query(
    "render_prompt",
    """SELECT doc_id, md5(replace(replace(concat('Word: {word}', chr(10), 'Dictionary:', chr(10), '{dict_summary}', chr(10), 'Again: {word}'),
              '{word}', lang || ' ' || doc_id), '{dict_summary}', text)) AS prompt FROM documents""",
)
def render_prompt(t):
    values = {"word": F.concat("lang", F.lit(" "), "doc_id"), "dict_summary": F.col("text")}
    return t.documents.select("doc_id", F.md5(T.render_prompt(F.lit(TEMPLATE), values)).alias("prompt"))


@query(
    "canonical_json",
    """SELECT o_orderkey, '{"a":{"k":null,"z":' || o_custkey || '},"n":["' || o_orderstatus || '",' || o_orderkey || '],"ü":"'
              || o_orderpriority || '"}' AS canonical FROM orders""",
)
def canonical_json(t):
    loose = F.concat(
        F.lit('{"ü": "'), "o_orderpriority", F.lit('", "n": [ "'), "o_orderstatus", F.lit('", '), "o_orderkey",
        F.lit('], "a": {"z": '), "o_custkey", F.lit(', "k": null}}'),
    )
    return t.read("orders").select("o_orderkey", H.canonical_json(loose).alias("canonical"))


@query(
    "cache_key",
    """SELECT doc_id, sha256('["call:' || lang || ':m1","m1",{"max_tokens":10,"temperature":0},' || CAST(to_json(text) AS VARCHAR)
              || ',{"word":"' || source || '"}]') AS cache_key FROM documents""",
)
def cache_key(t):
    key = H.cache_key(
        F.concat(F.lit("call:"), "lang", F.lit(":m1")), F.lit("m1"), F.lit('{"temperature": 0, "max_tokens": 10}'),
        F.col("text"), F.concat(F.lit('{"word": "'), "source", F.lit('"}')),
    )
    return t.documents.select("doc_id", key.alias("cache_key"))


@query(
    "stage_fingerprint",
    """WITH u AS (SELECT word_id, list_sort(list(fingerprint)) AS fps FROM pipe_artifacts
                  WHERE stage_name IN ('paraphrase', 'derivatives', 'examples', 'mnemonic') GROUP BY word_id)
       SELECT word_id, sha256('[' || CAST(to_json(fps) AS VARCHAR) || ',{"model":"m1","parser_version":"1"},null,null,"1"]') AS fingerprint FROM u""",
)
def stage_fingerprint(t):
    upstream = ("paraphrase", "derivatives", "examples", "mnemonic")
    picked = t.pipe_artifacts.where(F.col("stage_name").isin(*upstream)).groupBy("word_id").agg(
        F.array_compact(
            F.array(*[F.max(F.when(F.col("stage_name") == s, F.col("fingerprint"))) for s in reversed(upstream)])
        ).alias("fps")
    )
    none = F.lit(None).cast("string")
    key = H.stage_fingerprint(F.col("fps"), F.lit('{"parser_version": "1", "model": "m1"}'), none, none, F.lit("1"))
    return picked.select("word_id", key.alias("fingerprint"))


MODELS = ("us.claude-sonnet-4-5-x", "gemini-2.5-flash-lite", "gpt-5-mini", "gpt-5", "unknown-1")
RATES = ((3.0, 15.0), (0.05, 0.20), (0.5, 2.0), (5.0, 15.0), (3.0, 15.0))


@query(
    "cost_usd",
    f"""SELECT event_id, CAST((CAST(tokens AS DECIMAL(18, 0)) * CAST({[r[0] for r in RATES]}[m + 1] AS DECIMAL(9, 4))
              + CAST(7 AS DECIMAL(18, 0)) * CAST({[r[1] for r in RATES]}[m + 1] AS DECIMAL(9, 4))) * CAST(0.000001 AS DECIMAL(7, 6))
              AS DECIMAL(10, 6)) AS cost_usd, m <> 4 AS price_known FROM
        (SELECT event_id, CAST(event_id % 5 AS INTEGER) AS m, event_id % 1000 * 100 AS tokens FROM events)""",
)
def cost_usd(t):
    names = F.array(*[F.lit(m) for m in MODELS])
    calls = t.read("events").select(
        "event_id", F.element_at(names, (F.col("event_id") % 5 + 1).cast("int")).alias("model"),
        (F.col("event_id") % 1000 * 100).alias("tokens_input"), F.lit(7).alias("tokens_output"),
    )
    return L.with_cost(calls).select("event_id", "cost_usd", "price_known")


@query(
    "error_summary",
    """SELECT id, left(split_part(error, chr(10), 1), 80) AS summary FROM ledger WHERE status = 'failed'""",
)
def error_summary(t):
    failed = t.ledger.where("status = 'failed'")
    return failed.select("id", T.error_summary(F.col("error")).alias("summary"))

"""Inference, worklists, stages, quality and export."""

from pyspark.sql import functions as F

from lexmill.functions.hashing import to_json
from lexmill.operators import export as X
from lexmill.operators import inference as I
from lexmill.operators import stages as S
from lexmill.plans import dictionary_stages as DS
from lexmill.plans.nested_queries import dictionary
from lexmill.plans.registry import query
from lexmill.plans.standins import VIEW_SQL
from lexmill.session import fresh_path


def _digest_calls(t):
    return t.documents.select(
        "doc_id", F.lit("call:digest").alias("kind"), F.lit("gpt-5-mini").alias("model"),
        F.when(F.col("doc_id") % 50 == 1, '{"model": "x"}').otherwise('{"temperature": 0}').alias("params_json"),
        F.col("text").alias("prompt"), F.lit("{}").alias("input_json"),
    )


def _digest_cache(t):
    from lexmill.functions.hashing import cache_key

    seen = _digest_calls(t).where("doc_id % 4 = 0").withColumn("params_json", F.lit('{"temperature": 0}'))
    keyed = seen.withColumn("cache_key", cache_key(*[F.col(c) for c in I.CALL]))
    return keyed.groupBy("kind", "cache_key").agg(
        F.min(F.md5("prompt")).alias("text"), F.lit(0.5).cast("decimal(10,6)").alias("cost_usd")
    )


@query(
    "cached_inference",
    """WITH seen AS (SELECT DISTINCT text FROM documents WHERE doc_id % 4 = 0),
    f AS (SELECT text, min(doc_id) AS first_call FROM documents WHERE doc_id % 50 <> 1 GROUP BY text)
    SELECT doc_id, CASE WHEN doc_id % 50 <> 1 THEN md5(d.text) END AS text,
           CASE WHEN doc_id % 50 = 1 THEN NULL WHEN s.text IS NOT NULL THEN CAST(0.5 AS DECIMAL(10, 6))
                ELSE CAST((CAST(length(d.text) AS DECIMAL(18, 0)) * CAST(0.5 AS DECIMAL(9, 4)) + CAST(32 AS DECIMAL(18, 0)) * CAST(2.0 AS DECIMAL(9, 4))) * CAST(0.000001 AS DECIMAL(7, 6)) AS DECIMAL(10, 6)) END AS cost_usd,
           CASE WHEN s.text IS NULL AND doc_id = first_call THEN CAST((CAST(length(d.text) AS DECIMAL(18, 0)) * CAST(0.5 AS DECIMAL(9, 4)) + CAST(32 AS DECIMAL(18, 0)) * CAST(2.0 AS DECIMAL(9, 4))) * CAST(0.000001 AS DECIMAL(7, 6)) AS DECIMAL(10, 6))
                ELSE CAST(0 AS DECIMAL(10, 6)) END AS spent_usd,
           s.text IS NOT NULL AND doc_id % 50 <> 1 AS hit,
           CASE WHEN doc_id % 50 = 1 THEN 'request parameters must not contain reserved keys' END AS error
    FROM documents d LEFT JOIN seen s ON s.text = d.text LEFT JOIN f ON f.text = d.text""",
)
def cached_inference(t):
    out = I.cached_inference(_digest_calls(t), _digest_cache(t), I.model_fn("digest"), "doc_id")
    return out.results.select("doc_id", "text", "cost_usd", "spent_usd", "hit", "error")


@query(
    "cached_inference_new_rows",
    """SELECT md5(text) AS text, count(DISTINCT text) AS n FROM documents WHERE doc_id % 50 <> 1
       AND text NOT IN (SELECT text FROM documents WHERE doc_id % 4 = 0) GROUP BY 1""",
)
def cached_inference_new_rows(t):
    out = I.cached_inference(_digest_calls(t), _digest_cache(t), I.model_fn("digest"), "doc_id")
    return out.new_cache.groupBy("text").agg(F.count("*").alias("n"))


@query("hash_sample", "SELECT id, normalized_form FROM pipe_words ORDER BY sha256('7:' || id) LIMIT 200")
def hash_sample(t):
    return I.hash_sample(t.pipe_words, "id", 7, 200).select("id", "normalized_form")


@query(
    "run_experiment",
    """WITH p AS (SELECT id, normalized_form FROM pipe_words ORDER BY sha256('3:' || id) LIMIT 150)
    SELECT id AS word_id, normalized_form AS form, true AS ok, true AS valid,
           CAST((CAST(length('List the meanings of ' || normalized_form || ' as JSON. Dictionary:' || chr(10) || '(no dictionary data)') AS DECIMAL(18, 0)) * CAST(0.14 AS DECIMAL(9, 4)) + CAST(100 AS DECIMAL(18, 0)) * CAST(0.28 AS DECIMAL(9, 4))) * CAST(0.000001 AS DECIMAL(7, 6)) AS DECIMAL(10, 6)) AS cost_usd FROM p""",
)
def run_experiment(t):
    words = t.pipe_words.select(F.col("id").alias("word_id"), F.col("normalized_form").alias("form"), F.lit("").alias("dict_summary"))
    cache = t.spark.createDataFrame([], DS.EMPTY_CACHE)
    fn = _stub_for("paraphrase")
    out = I.run_experiment(words, cache, DS.TEMPLATES["paraphrase"], DS.MODEL, fn, "paraphrase", 3, 150)
    return out.select("word_id", "form", "ok", "valid", "cost_usd")


def _stub_for(stage, model=DS.stub_model):
    # Functions that travel to executors hold functions, never this package's modules.
    def fn(calls):
        return model(calls.assign(input_json=f'{{"stage": "{stage}"}}'))

    return fn


@query(
    "compare_runs",
    """SELECT user_id AS word_id, bool_or(value > 50) FILTER (event_type = 'click') AS click,
              bool_or(value > 50) FILTER (event_type = 'view') AS view FROM events GROUP BY 1""",
)
def compare_runs(t):
    items = t.read("events").groupBy(F.col("user_id").alias("word_id"), F.col("event_type").alias("run_id")).agg(
        F.bool_or(F.col("value") > 50).alias("valid")
    )
    return I.compare_runs(items, ["click", "view"])


@query(
    "choose_meanings",
    """SELECT doc_id AS word_id, CASE WHEN quality = 1 THEN 'glossary' WHEN doc_id % 2 = 0 THEN 'gloss' WHEN doc_id % 3 = 0 THEN 'model' END AS origin,
              CASE WHEN quality = 1 THEN 'g' || doc_id WHEN doc_id % 2 = 0 THEN 'd' || doc_id WHEN doc_id % 3 = 0 THEN 'm' || doc_id END AS first_cn
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def choose_meanings(t):
    def listed(df, key, prefix):
        one = F.struct(F.lit("n").alias("pos"), F.concat(F.lit(prefix), key).alias("cn"), F.lit(None).cast("string").alias("en"))
        return df.select(F.col(key).alias("word_id"), F.array(one).alias("meanings"))

    docs = t.read("documents")
    out = I.choose_meanings(
        docs.select(F.col("doc_id").alias("word_id")), listed(t.read("labels").where("quality = 1"), "doc_id", "g"),
        listed(docs.where("doc_id % 2 = 0"), "doc_id", "d"), listed(docs.where("doc_id % 3 = 0"), "doc_id", "m"),
    )
    return out.select("word_id", "origin", F.get("meanings", F.lit(0))["cn"].alias("first_cn"))


@query(
    "rerank_meanings",
    """WITH l AS (SELECT doc_id, CAST(unnest(range(len(ls))) AS INTEGER) AS i, len(ls) AS n, unnest(ls) AS line
                  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
    o AS (SELECT *, CASE WHEN n <= 3 OR doc_id % 3 = 2 THEN i WHEN i = 2 THEN -2 WHEN i = 0 THEN -1 ELSE i END AS place FROM l)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS INTEGER) AS position, md5(line) AS cn FROM o""",
)
def rerank_meanings(t):
    meanings = F.transform(F.split("text", "\n"), lambda line: F.struct(F.md5(line).alias("cn")))
    answer = F.when(F.col("doc_id") % 3 == 2, '{"order": "none"}').otherwise('{"order": [2, 0, 2, 9999999, -1, "1", 0.5]}')
    rows = t.documents.select("doc_id", meanings.alias("m"), F.parse_json(answer).alias("a"))
    placed = rows.select("doc_id", F.posexplode_outer(I.rerank_meanings(F.col("m"), F.col("a"))).alias("position", "v"))
    return placed.select("doc_id", "position", "v.cn")


# Payloads for the gate: one part of every word is broken in a way that depends on its id.
def _payloads(t):
    key = F.col("doc_id")

    def j(**fields):
        return to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))

    def meaning(mod):
        broken = key % 7 == mod
        return F.struct(
            F.when(broken & (key % 2 == 0), "").otherwise("n").alias("pos"),
            F.when(broken & (key % 2 == 1), None).otherwise(F.concat(F.lit("义"), key)).alias("cn"), F.lit("x").alias("en"),
        )

    meanings = F.when(key % 5 == 4, F.slice(F.array(meaning(1)), 1, 0)).otherwise(F.array(meaning(1), meaning(2)))
    example = F.struct(F.concat(F.lit("e"), key).alias("en"), F.when(key % 8 != 0, "c").alias("cn"))
    examples = F.when(key % 6 == 5, F.slice(F.array(example), 1, 0)).otherwise(F.array(example))
    per = F.array(F.struct((key % 2).alias("meaning_index"), examples.alias("examples")))
    derived = F.struct(
        F.struct(F.concat(F.lit("p"), key).alias("plural")).alias("word_forms"),
        F.array(
            F.struct(F.lit(1).alias("meaning_index"), F.array("lang").alias("synonyms")),
            F.struct(F.lit(1).alias("meaning_index"), F.array(F.lit("no")).alias("synonyms")),
        ).alias("per_meaning"),
    )
    return {
        "paraphrase": j(meanings=meanings),
        "derivatives": to_json(derived),
        "examples": j(per_meaning=per),
        "mnemonic": j(mnemonic=F.when(key % 9 == 8, "").otherwise(F.concat(F.lit("m"), key)), kind=F.lit("phonetic")),
        "phonetic": j(phonetic_us=F.col("lang"), audio_us=F.lit(None).cast("string")),
        "fetch_dict": j(raw_json=F.col("source")),
    }


GATE_SQL = """
b AS (SELECT doc_id, doc_id % 5 = 4 AS no_m, doc_id % 7 AS k, doc_id % 2 AS p, doc_id % 6 = 5 AS no_e, doc_id % 9 = 8 AS no_n, doc_id % 11 = 10 AS no_art FROM documents),
r AS (SELECT *, list_filter([
    CASE WHEN no_m THEN 'meanings_non_empty: paraphrase has 0 meanings' END,
    CASE WHEN NOT no_m AND k = 1 AND p = 1 THEN 'each_meaning_has_cn: meaning[0] missing cn' END,
    CASE WHEN NOT no_m AND k = 2 AND p = 1 THEN 'each_meaning_has_cn: meaning[1] missing cn' END,
    CASE WHEN NOT no_m AND k = 1 AND p = 0 THEN 'each_meaning_has_pos: meaning[0] missing pos' END,
    CASE WHEN NOT no_m AND k = 2 AND p = 0 THEN 'each_meaning_has_pos: meaning[1] missing pos' END,
    CASE WHEN NOT no_m AND no_e THEN 'examples_coverage: no meaning has any example' END,
    CASE WHEN no_n THEN 'mnemonic_present: empty mnemonic' END], lambda x: x IS NOT NULL) AS failed FROM b)"""


@query(
    "quality_gate",
    f"""WITH {GATE_SQL}
    SELECT doc_id, CASE WHEN no_art THEN 'derivatives artifact missing' END AS error, NOT no_art AND len(failed) = 0 AS passed,
           array_to_string(failed, '|') AS failed_rules FROM r""",
)
def quality_gate(t):
    payloads = _payloads(t)
    rows = t.documents.select("doc_id", *[payloads[s].alias(f"up_{s}") for s in S.GATED])
    rows = rows.withColumn("up_derivatives", F.when(F.col("doc_id") % 11 != 10, F.col("up_derivatives")))
    return S.quality_gate(rows).select("doc_id", "error", "passed", F.array_join("failed_rules", "|").alias("failed_rules"))


def _artifacts(t):
    """Long artifacts of the gated payloads, with the gate's own verdict as payload."""
    payloads = _payloads(t)
    wide = t.documents.select("doc_id", *[p.alias(f"up_{s}") for s, p in payloads.items()])
    judged = S.quality_gate(wide).withColumn("up_quality_gate", to_json(F.struct("passed", "failed_rules")))
    pairs = F.array(*[F.struct(F.lit(s).alias("stage_name"), F.col(f"up_{s}").alias("payload")) for s in S.EXPORT_UPSTREAM])
    rows = judged.select(F.col("doc_id").alias("word_id"), F.inline(pairs))
    rows = rows.where(~((F.col("stage_name") == "phonetic") & (F.col("word_id") % 13 == 12)))
    return rows.withColumn("source", F.concat(F.lit("pipeline:stub:"), "stage_name"))


VIEW_SQL["good_words"] = f"""WITH {GATE_SQL}
    SELECT b.*, d.lang, d.source FROM r b JOIN documents d USING (doc_id) WHERE len(failed) = 0 AND doc_id % 13 <> 12"""


def _domain_rows(t):
    words = t.pipe_words.select(F.col("id").alias("word_id"), F.col("normalized_form").alias("form"), "type")
    return S.build_domain_rows(words, _artifacts(t))


@query(
    "build_domain_words",
    """SELECT doc_id AS word_id, lang || ' ' || doc_id AS form, lang AS phonetic_us, 'p' || doc_id AS plural, CAST(NULL AS VARCHAR) AS past_tense,
              'pipeline:stub:paraphrase' AS source FROM good_words""",
)
def build_domain_words(t):
    return _domain_rows(t)["words"].select("word_id", "form", "phonetic_us", "plural", "past_tense", "source")


@query(
    "build_domain_meanings",
    """SELECT doc_id AS word_id, CAST(i AS INTEGER) AS meaning_index, CAST(1 AS SMALLINT) AS pos, '义' || doc_id AS cn_paraphrase, 'x' AS en_paraphrase,
              CASE WHEN i = 1 THEN lang END AS synonyms FROM (SELECT *, unnest([0, 1]) AS i FROM good_words)""",
)
def build_domain_meanings(t):
    rows = _domain_rows(t)["meanings"].withColumn("synonyms", F.array_join("synonyms", ","))
    return rows.select("word_id", "meaning_index", "pos", "cn_paraphrase", "en_paraphrase", "synonyms")


@query(
    "build_domain_sentences",
    """SELECT doc_id AS word_id, CAST(doc_id % 2 AS INTEGER) AS meaning_index, 0 AS example_index, 'e' || doc_id AS form, 'c' AS translation
       FROM good_words WHERE doc_id % 8 <> 0""",
)
def build_domain_sentences(t):
    return _domain_rows(t)["sentences"].drop("source")


@query(
    "build_domain_mnemonics",
    """SELECT doc_id AS word_id, CAST(1 AS SMALLINT) AS type, 'phonetic' AS kind, 'm' || doc_id AS text FROM good_words""",
)
def build_domain_mnemonics(t):
    return _domain_rows(t)["mnemonics"].drop("source")


@query(
    "build_domain_refused",
    f"""WITH {GATE_SQL}
    SELECT doc_id AS word_id, CASE WHEN doc_id % 13 = 12 THEN 'missing upstream artifact phonetic' ELSE 'quality gate did not pass' END AS reason
    FROM r WHERE len(failed) > 0 OR doc_id % 13 = 12""",
)
def build_domain_refused(t):
    return _domain_rows(t)["refused"]


@query(
    "classify_export",
    """SELECT i.form, i.type, w.word_id AS existing_id,
              CASE WHEN w.word_id IS NULL THEN 'A' WHEN starts_with(w.source, 'pipeline:') THEN 'B' ELSE 'C' END AS case
       FROM (SELECT c_name AS form, CAST(1 AS SMALLINT) AS type FROM customer UNION ALL SELECT s_name, CAST(1 AS SMALLINT) FROM supplier) i
       LEFT JOIN dom_words w ON w.form = i.form AND w.type = i.type""",
)
def classify_export(t):
    one = F.lit(1).cast("smallint").alias("type")
    names = t.read("customer").select(F.col("c_name").alias("form"), one).unionByName(
        t.read("supplier").select(F.col("s_name").alias("form"), one)
    )
    return S.classify_export(names, t.dom_words)


@query(
    "link_words",
    """SELECT id, CASE WHEN id % 2 = 0 THEN 'done' ELSE status END AS status, CASE WHEN id % 2 = 0 THEN id + 100000 ELSE app_word_id END AS app_word_id
       FROM pipe_words""",
)
def link_words(t):
    exported = t.pipe_words.where("id % 2 = 0").select("id", (F.col("id") + 100000).alias("app_word_id"))
    return S.link_words(t.pipe_words, exported).select("id", "status", "app_word_id")


@query(
    "stage_worklist",
    """SELECT d.doc_id AS word_id, coalesce(a.fingerprint = sha256(CASE WHEN doc_id % 2 = 0 THEN a.payload ELSE 'changed' END), false) AS hit
       FROM documents d LEFT JOIN pipe_artifacts a ON a.word_id = d.doc_id AND a.stage_name = 'paraphrase'
       WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def stage_worklist(t):
    stored = t.pipe_artifacts.where("stage_name = 'paraphrase'").select(F.col("word_id").alias("doc_id"), "payload")
    text = F.when(F.col("doc_id") % 2 == 0, F.col("payload")).otherwise("changed")
    expected = t.read("documents").join(stored, "doc_id", "left").select(
        F.col("doc_id").alias("word_id"), F.coalesce(F.sha2(text, 256), F.lit("none")).alias("expected")
    )
    failed = t.read("labels").where("toxic = 1").select(F.col("doc_id").alias("word_id"))
    return S.stage_worklist(expected, t.pipe_artifacts, "paraphrase", failed).select("word_id", "hit")


@query(
    "expected_fingerprints",
    """SELECT d.doc_id AS word_id, sha256('[' || CASE WHEN a.fingerprint IS NULL THEN '[]' ELSE '["' || a.fingerprint || '"]' END
              || ',{"parser_version":"1"},null,null,"1"]') AS expected
       FROM documents d LEFT JOIN pipe_artifacts a ON a.word_id = d.doc_id AND a.stage_name = 'fetch_dict'""",
)
def expected_fingerprints(t):
    words = t.read("documents").select(F.col("doc_id").alias("word_id"))
    return S.expected_fingerprints(words, t.pipe_artifacts, S.Stage("phonetic", ("fetch_dict",), lambda df: df))


def _count_stage():
    def count_words(df):
        failed = F.col("word_id") % 10 == 3
        return df.select(
            "word_id", F.when(~failed, to_json(F.struct(F.length("up_fetch_dict").alias("n")))).alias("payload"),
            F.when(failed, "cannot count").alias("error"), F.lit(0.001).cast("decimal(10,6)").alias("cost_usd"),
        )

    return S.Stage("paraphrase", ("fetch_dict",), count_words)


@query(
    "run_stage",
    """WITH up AS (SELECT word_id, payload FROM pipe_artifacts WHERE stage_name = 'fetch_dict')
    SELECT doc_id AS word_id, CASE WHEN payload IS NULL OR doc_id % 10 = 3 THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN payload IS NULL THEN 'missing upstream artifact fetch_dict' WHEN doc_id % 10 = 3 THEN 'cannot count' END AS error,
           CASE WHEN payload IS NOT NULL AND doc_id % 10 <> 3 THEN CAST(0.001 AS DECIMAL(10, 6)) END AS cost_usd,
           CASE WHEN payload IS NOT NULL AND doc_id % 10 <> 3 THEN '{"n":' || length(payload) || '}' END AS payload
    FROM documents LEFT JOIN up ON word_id = doc_id""",
)
def run_stage(t):
    words = t.read("documents").select(F.col("doc_id").alias("word_id"))
    artifacts = t.pipe_artifacts.withColumn("model", F.lit(None).cast("string")).withColumn("prompt_version", F.lit(None).cast("string"))
    run = S.run_stage(_count_stage(), words, artifacts.where("stage_name <> 'paraphrase'"), F.lit("b1"))
    made = run.artifacts.select("word_id", "payload")
    return run.ledger.join(made, "word_id", "left").select("word_id", "status", "error", "cost_usd", "payload")


@query(
    "registered_stages",
    """WITH d AS (SELECT doc_id AS word_id, text FROM documents)
    SELECT word_id, 'lines' AS stage_name, 'ok' AS status, CAST(len(string_split(text, chr(10))) AS VARCHAR) AS payload FROM d
    UNION ALL SELECT word_id, 'digest', CASE WHEN len(string_split(text, chr(10))) > 1 THEN 'ok' ELSE 'failed' END,
           CASE WHEN len(string_split(text, chr(10))) > 1 THEN '"' || md5(text) || '"' END FROM d""",
)
def registered_stages(t):
    """Stages, a model, a validator and a rule of a user's own, found by name and run over the texts."""
    texts = t.read("documents").select(F.col("doc_id").alias("word_id"), "text")

    def lines(df):
        return df.join(texts, "word_id").select("word_id", F.size(F.split("text", "\n")).cast("string").alias("payload"))

    def digest(df):
        calls = df.join(texts, "word_id").select(
            "word_id", "up_lines", F.lit("call:digest").alias("kind"), F.lit("gpt-5-mini").alias("model"), F.lit("{}").alias("params_json"),
            F.col("text").alias("prompt"), F.lit("{}").alias("input_json"),
        )
        answered = I.call(calls, t.spark.createDataFrame([], DS.EMPTY_CACHE), I.model_fn("digest of texts"), "word_id", parallel=8)
        parsed = answered.withColumn("v", F.try_parse_json(F.concat(F.lit('"'), "text", F.lit('"'))))
        good = I.validator("digest of texts")(F.col("v")) & (F.col("up_lines").cast("int") > 1)
        return parsed.select("word_id", F.when(good, F.to_json("v")).alias("payload"), F.when(~good, "refused").alias("error"))

    I.register_model("digest of texts", I.digest_model)
    I.register_validator("digest of texts", lambda answer: F.length(F.try_variant_get(answer, "$", "string")) == 32)
    mine = [S.Stage("lines", (), lines), S.Stage("digest", ("lines",), digest)]
    for stage in mine:
        S.register_stage(stage)
    stages = [s for s in S.registered_stages() if s.name in ("lines", "digest")]
    run = S.stage_chain(sorted(stages, key=lambda s: len(s.upstream)), texts.select("word_id"), t.spark.createDataFrame([], DS.EMPTY_ARTIFACTS))
    made = run.artifacts.select("word_id", "stage_name", "payload")
    return run.ledger.join(made, ["word_id", "stage_name"], "left").select("word_id", "stage_name", "status", "payload")


ARTIFACT_BUCKETS = 8


def run_dictionary(t, tables=None):
    """All eight stages over every document, twice, the second time with force; answers are kept in between."""
    raw = dictionary(t).select(F.col("doc_id").alias("word_id"), F.to_json("doc").alias("raw")).where("word_id % 17 <> 16")
    one = F.struct(F.lit("n").alias("pos"), F.concat(F.lit("g"), "doc_id").alias("cn"), F.lit(None).cast("string").alias("en"))
    glossary = t.read("labels").where("quality = 1").select(F.col("doc_id").alias("word_id"), F.array(one).alias("meanings"))
    store = I.AnswerStore(t.spark, fresh_path(t.spark, "answers"))
    words = t.pipe_words.select(F.col("id").alias("word_id"), F.col("normalized_form").alias("form"), "type")
    export = None if tables is None else X.Exporter(tables)
    stages = DS.dictionary_stages(raw, glossary, store, DS.stub_model, parallel=8, export=export)
    artifacts = S.ArtifactStore(t.spark, fresh_path(t.spark, "artifacts"), t.spark.createDataFrame([], DS.EMPTY_ARTIFACTS).schema, ARTIFACT_BUCKETS)
    run = S.stage_chain(stages, words, artifacts)
    return run, export, lambda force=True: S.stage_chain(DS.dictionary_stages(raw, glossary, store, DS.stub_model, parallel=8), words, artifacts, force=force)


CHAIN_SQL = """WITH s AS (SELECT unnest(['fetch_dict', 'paraphrase', 'phonetic', 'derivatives', 'examples', 'mnemonic', 'quality_gate', 'export']) AS stage_name)
    SELECT stage_name, 'ok' AS status, (SELECT count(*) FROM documents WHERE doc_id % 17 <> 16) AS n FROM s
    UNION ALL SELECT 'fetch_dict', 'failed', count(*) FROM documents WHERE doc_id % 17 = 16"""


@query("stage_chain", CHAIN_SQL)
def stage_chain(t):
    return run_dictionary(t)[0].ledger.groupBy("stage_name", "status").agg(F.count("*").alias("n"))


@query(
    "stage_chain_again",
    """SELECT unnest(['fetch_dict', 'paraphrase', 'phonetic', 'derivatives', 'examples', 'mnemonic', 'quality_gate', 'export']) AS stage_name,
       CAST(0 AS BIGINT) AS tokens""",
)
def stage_chain_again(t):
    """A forced second run does all the work again and pays for no answer."""
    again = run_dictionary(t)[2]()
    tokens = F.coalesce("tokens_input", F.lit(0)) + F.coalesce("tokens_output", F.lit(0))
    return again.ledger.groupBy("stage_name").agg(F.sum(tokens).alias("tokens"))


@query(
    "stage_chain_idle",
    """SELECT stage_name, CASE WHEN stage_name = 'fetch_dict' THEN (SELECT count(*) FROM documents WHERE doc_id % 17 = 16) ELSE 0 END AS attempts,
              (SELECT count(*) FROM documents WHERE doc_id % 17 <> 16) AS hits
       FROM (SELECT unnest(['fetch_dict', 'paraphrase', 'phonetic', 'derivatives', 'examples', 'mnemonic', 'quality_gate', 'export']) AS stage_name)""",
)
def stage_chain_idle(t):
    """An unforced second run asks again for what failed and finds everything else in the store."""
    report = run_dictionary(t)[2](force=False).report
    return t.spark.createDataFrame([(name, ok + failed, hits) for name, ok, failed, hits in report], "stage_name string, attempts bigint, hits bigint")


def _small_chain(version="1"):
    def copy(df):
        return df.select("word_id", F.lit("{}").alias("payload"))

    return [S.Stage("a", (), copy), S.Stage("b", ("a",), copy, parser_version=version), S.Stage("c", ("b",), copy), S.Stage("d", ("a",), copy)]


@query(
    "stale_closure",
    """SELECT doc_id AS word_id, stage_name, CASE WHEN doc_id % 4 = 0 THEN 'missing' WHEN stage_name = 'b' THEN 'changed' ELSE 'upstream' END AS reason
       FROM documents, (SELECT unnest(['a', 'b', 'c', 'd']) AS stage_name) WHERE doc_id % 4 = 0 OR stage_name IN ('b', 'c')""",
)
def stale_closure(t):
    """Three quarters of the documents have run; then a stage in the middle gets another parser."""
    words = t.read("documents").select(F.col("doc_id").alias("word_id"))
    run = S.stage_chain(_small_chain(), words.where("word_id % 4 <> 0"), t.spark.createDataFrame([], DS.EMPTY_ARTIFACTS))
    return S.stale_closure(_small_chain("2"), words, run.artifacts)


# --- export -----------------------------------------------------------------

VIEW_SQL["old_words"] = """
    SELECT doc_id + 1 AS word_id, lang || ' ' || doc_id AS form, CAST(2 AS SMALLINT) AS type, 'old' AS phonetic_us, 'old' AS plural,
           CASE WHEN doc_id % 5 = 0 THEN 'human:web' ELSE 'pipeline:old' END AS source, CAST(doc_id % 2 AS SMALLINT) AS status, doc_id
    FROM documents WHERE doc_id % 3 = 0"""
VIEW_SQL["old_meanings"] = """
    SELECT doc_id AS meaning_id, word_id, 'old ' || doc_id AS cn_paraphrase, CASE WHEN doc_id % 21 = 0 THEN 'import:x' ELSE source END AS source, doc_id FROM old_words"""
VIEW_SQL["export_rows"] = """
    SELECT g.doc_id, o.word_id AS old_id, CASE WHEN o.word_id IS NULL THEN 'A' WHEN starts_with(o.source, 'pipeline:') THEN 'B' ELSE 'C' END AS kind,
           o.word_id IS NOT NULL AND g.doc_id % 21 = 0 AS refused,
           coalesce(o.word_id, (SELECT max(word_id) FROM old_words) + row_number() OVER (PARTITION BY o.word_id IS NULL ORDER BY g.doc_id)) AS app_word_id
    FROM good_words g LEFT JOIN old_words o USING (doc_id)"""


def _old_tables(t):
    docs = t.read("documents")
    key = F.col("doc_id")
    old = docs.where(key % 3 == 0).select(
        (key + 1).alias("word_id"), F.concat("lang", F.lit(" "), key).alias("form"), F.lit(2).cast("smallint").alias("type"),
        F.lit("old").alias("phonetic_us"), F.lit(None).cast("string").alias("phonetic_uk"), F.lit(None).cast("string").alias("audio_us"),
        F.lit(None).cast("string").alias("audio_uk"), F.lit("old").alias("plural"), F.lit("none").alias("quality_flag"),
        F.when(key % 5 == 0, "human:web").otherwise("pipeline:old").alias("source"), (key % 2).cast("smallint").alias("status"), "doc_id",
    )
    text = "string"
    meanings = old.select(
        F.col("doc_id").alias("meaning_id"), "word_id", F.lit(1).cast("smallint").alias("pos"), F.lit(None).cast("smallint").alias("pos_sub"),
        F.concat(F.lit("old "), "doc_id").alias("cn_paraphrase"), F.lit(None).cast(text).alias("en_paraphrase"),
        F.lit(None).cast("array<string>").alias("synonyms"), F.when(key % 21 == 0, "import:x").otherwise(F.col("source")).alias("source"),
    )
    sentences = meanings.select(
        F.col("meaning_id").alias("sentence_id"), "meaning_id", F.lit("old").alias("form"), F.lit("old").alias("translation"), "source"
    )
    mnemonics = old.select(
        F.col("doc_id").alias("mnemonic_id"), "word_id", F.lit(1).cast("smallint").alias("type"), F.lit("phonetic").alias("kind"), F.lit("old").alias("text"), "source"
    )
    phrases = old.limit(0).select(F.col("doc_id").alias("phrase_id"), F.col("word_id").alias("owner_word_id"), "form", F.lit("").alias("meaning"), "source")
    return {"words": old.drop("doc_id"), "meanings": meanings, "sentences": sentences, "mnemonics": mnemonics, "phrases": phrases}


def _exported(t):
    tables = _old_tables(t)
    return tables, X.export_words(_domain_rows(t), tables)


@query("export_run_payloads", 'SELECT doc_id AS word_id, app_word_id, kind AS "case" FROM export_rows WHERE NOT refused')
def export_run_payloads(t):
    return _exported(t)[1]["payloads"]


@query(
    "export_run_words",
    """SELECT o.word_id, o.form, CASE WHEN e.kind = 'B' AND NOT refused THEN g.lang ELSE phonetic_us END AS phonetic_us,
              CASE WHEN e.kind = 'B' AND NOT refused THEN 'p' || o.doc_id ELSE plural END AS plural,
              CASE WHEN e.kind = 'B' AND NOT refused THEN 'pipeline:stub:paraphrase' ELSE o.source END AS source, status
       FROM old_words o LEFT JOIN export_rows e USING (doc_id) LEFT JOIN good_words g USING (doc_id)
       UNION ALL SELECT app_word_id, g.lang || ' ' || doc_id, g.lang, 'p' || doc_id, 'pipeline:stub:paraphrase', CAST(1 AS SMALLINT)
       FROM export_rows JOIN good_words g USING (doc_id) WHERE kind = 'A'""",
)
def export_run_words(t):
    return _exported(t)[1]["words"].select("word_id", "form", "phonetic_us", "plural", "source", "status")


VIEW_SQL["new_meanings"] = """
    SELECT (SELECT max(meaning_id) FROM old_meanings) + row_number() OVER (ORDER BY app_word_id, i) AS meaning_id, app_word_id AS word_id, i, doc_id
    FROM (SELECT *, unnest([0, 1]) AS i FROM export_rows WHERE kind IN ('A', 'B') AND NOT refused)"""
VIEW_SQL["kept_meanings"] = """
    SELECT * FROM old_meanings WHERE word_id NOT IN (SELECT app_word_id FROM export_rows WHERE kind = 'B' AND NOT refused) OR NOT starts_with(source, 'pipeline:')"""


@query(
    "export_run_meanings",
    """SELECT meaning_id, word_id, cn_paraphrase, source FROM kept_meanings
       UNION ALL SELECT meaning_id, word_id, '义' || doc_id, 'pipeline:stub:paraphrase' FROM new_meanings""",
)
def export_run_meanings(t):
    return _exported(t)[1]["meanings"].select("meaning_id", "word_id", "cn_paraphrase", "source")


@query(
    "export_run_sentences",
    """SELECT meaning_id AS sentence_id, meaning_id, 'old' AS form FROM kept_meanings
       UNION ALL SELECT (SELECT max(meaning_id) FROM old_meanings) + row_number() OVER (ORDER BY meaning_id), meaning_id, 'e' || doc_id
       FROM new_meanings WHERE i = doc_id % 2 AND doc_id % 8 <> 0""",
)
def export_run_sentences(t):
    return _exported(t)[1]["sentences"].select("sentence_id", "meaning_id", "form")


@query(
    "export_run_mnemonics",
    """WITH w AS (SELECT * FROM export_rows WHERE kind IN ('A', 'B') AND NOT refused)
    SELECT doc_id AS mnemonic_id, word_id, 'old' AS text FROM old_words
    WHERE word_id NOT IN (SELECT app_word_id FROM w WHERE kind = 'B') OR NOT starts_with(source, 'pipeline:')
    UNION ALL SELECT (SELECT max(doc_id) FROM old_words) + row_number() OVER (ORDER BY app_word_id), app_word_id, 'm' || doc_id FROM w""",
)
def export_run_mnemonics(t):
    return _exported(t)[1]["mnemonics"].select("mnemonic_id", "word_id", "text")


@query(
    "export_run_refused",
    f"""WITH {GATE_SQL}
    SELECT doc_id AS word_id, 'child of another origin: import:x' AS reason FROM export_rows WHERE refused
    UNION ALL SELECT doc_id, CASE WHEN doc_id % 13 = 12 THEN 'missing upstream artifact phonetic' ELSE 'quality gate did not pass' END
    FROM r WHERE len(failed) > 0 OR doc_id % 13 = 12""",
)
def export_run_refused(t):
    return _exported(t)[1]["refused"]


@query(
    "serving_refresh",
    """SELECT word_id, 'old ' || (word_id - 1) AS first_cn, 1 AS meanings, 'old' AS hook FROM old_words
       WHERE status = 1 AND word_id NOT IN (SELECT app_word_id FROM export_rows WHERE kind = 'B' AND NOT refused)
       UNION ALL SELECT app_word_id, '义' || doc_id, 2, 'm' || doc_id FROM export_rows WHERE NOT refused AND (kind = 'A' OR kind = 'B' AND doc_id % 2 = 1)""",
)
def serving_refresh(t):
    """Serving rows of all old words, brought up to date for the words that an export wrote."""
    tables, done = _exported(t)
    packages = t.dom_packages.limit(0)
    before = X.serving_refresh(tables["words"], tables, packages)["upsert"]
    after = X.serving_refresh(done["affected"], {k: done[k] for k in tables}, packages)
    served = X.apply_refresh(before, after)
    return served.select(
        "word_id", F.get_json_object("payload", "$.meanings[0].cn").alias("first_cn"),
        F.size(F.from_json(F.get_json_object("payload", "$.meanings"), "array<string>")).alias("meanings"),
        F.get_json_object("payload", "$.mnemonic.content.text").alias("hook"),
    )


@query(
    "stage_chain_payloads",
    """WITH d AS (SELECT doc_id, o.word_id AS old_id, o.source FROM documents LEFT JOIN old_words o USING (doc_id) WHERE doc_id % 17 <> 16),
    c AS (SELECT *, CASE WHEN old_id IS NULL THEN 'A' WHEN starts_with(source, 'pipeline:') THEN 'B' ELSE 'C' END AS kind,
          coalesce(old_id, (SELECT max(word_id) FROM old_words) + row_number() OVER (PARTITION BY old_id IS NULL ORDER BY doc_id)) AS app_word_id FROM d)
    SELECT doc_id AS word_id, CASE WHEN old_id IS NOT NULL AND doc_id % 21 = 0 THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN old_id IS NULL OR doc_id % 21 > 0 THEN '{"app_word_id":' || app_word_id || ',"case":"' || kind || '"}' END AS payload FROM c""",
)
def stage_chain_payloads(t):
    """All eight stages, ending in the real export into existing tables."""
    run, _, _ = run_dictionary(t, _old_tables(t))
    made = run.artifacts.where("stage_name = 'export'").select("word_id", "payload")
    return run.ledger.where("stage_name = 'export'").join(made, "word_id", "left").select("word_id", "status", "payload")

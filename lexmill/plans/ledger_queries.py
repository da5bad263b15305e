"""The ledger: events as attempts, sign-ups as resolutions, conversations as artifacts."""

from pyspark.sql import functions as F

from lexmill.operators import ledger as G
from lexmill.plans.registry import query
from lexmill.plans.standins import STAGES
from lexmill.session import cut_lineage, fresh_path
from lexmill.sources import writers as W

BATCH_ROWS = """
b AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS id, CAST(CASE WHEN day(ts) % 4 = 0 THEN NULL ELSE 10 END AS DECIMAL(12, 6)) AS total_cost_usd,
             CAST(CASE WHEN day(ts) % 3 = 0 THEN NULL ELSE 12000 + 100 * day(ts) END AS DECIMAL(12, 6)) AS budget_cap_usd
      FROM events WHERE day(ts) < 29),
s AS (SELECT batch_id AS id, CAST(sum(cost_usd) AS DECIMAL(12, 6)) AS spent FROM ledger WHERE status = 'ok' GROUP BY 1)"""


def _batches(t):
    day = F.dayofmonth("ts")
    return t.read("events").where(day < 29).select(
        F.date_format("ts", "yyyy-MM-dd").alias("id"),
        F.when(day % 4 != 0, 10).cast("decimal(12,6)").alias("total_cost_usd"),
        F.when(day % 3 != 0, 12000 + 100 * day).cast("decimal(12,6)").alias("budget_cap_usd"),
    ).distinct()


@query("batch_cost", """SELECT batch_id, CAST(sum(cost_usd) AS DECIMAL(12, 6)) AS spent FROM ledger WHERE status = 'ok' GROUP BY 1""")
def batch_cost(t):
    return G.batch_cost(t.ledger)


@query(
    "add_batch_cost",
    f"""WITH {BATCH_ROWS}
    SELECT id, CAST(CASE WHEN spent IS NULL THEN total_cost_usd ELSE coalesce(total_cost_usd, 0) + spent END AS DECIMAL(12, 6)) AS total_cost_usd,
           'known' AS state FROM b LEFT JOIN s USING (id)
    UNION ALL SELECT id, NULL, 'unknown' FROM s WHERE id NOT IN (SELECT id FROM b)""",
)
def add_batch_cost(t):
    updated, unknown = G.add_batch_cost(_batches(t), t.ledger)
    known = updated.select("id", "total_cost_usd", F.lit("known").alias("state"))
    return known.unionByName(unknown.select("id", F.lit(None).cast(G.TOTAL).alias("total_cost_usd"), F.lit("unknown").alias("state")))


@query(
    "budget_gate",
    f"""WITH {BATCH_ROWS},
    u AS (SELECT id, coalesce(total_cost_usd, 0) + coalesce(spent, 0) AS total, budget_cap_usd FROM b LEFT JOIN s USING (id)),
    r AS (SELECT DISTINCT batch_id FROM ledger UNION ALL SELECT NULL)
    SELECT batch_id, CASE WHEN batch_id IS NULL THEN 'pass' WHEN u.id IS NULL THEN 'unknown' WHEN total >= budget_cap_usd THEN 'blocked' ELSE 'pass' END AS verdict
    FROM r LEFT JOIN u ON u.id = batch_id""",
)
def budget_gate(t):
    batches, _ = G.add_batch_cost(_batches(t), t.ledger)
    asked = t.ledger.select("batch_id").distinct().unionByName(
        t.read("region").agg(F.max(F.lit(None).cast("string")).alias("batch_id"))
    )
    return G.budget_gate(asked, batches)


SINCE = """
r AS (SELECT word_id, stage_name, max(resolved_at) AS resolved FROM resolutions GROUP BY ALL),
f AS (SELECT l.*, l.started_at > coalesce(resolved, TIMESTAMP '1970-01-01') AS counts FROM ledger l LEFT JOIN r USING (word_id, stage_name)
      WHERE status = 'failed')"""


@query("failures_since_resolution", f"WITH {SINCE} SELECT word_id, stage_name, count(*) FILTER (counts) AS failures FROM f GROUP BY ALL")
def failures_since_resolution(t):
    return G.failures_since_resolution(t.ledger, t.resolutions)


THIRD = f"""{SINCE},
    k AS (SELECT *, row_number() OVER (PARTITION BY word_id, stage_name ORDER BY started_at, id) AS attempt FROM f WHERE counts)"""


@query("third_failure", f"WITH {THIRD} SELECT id, word_id, stage_name, error, attempt, started_at FROM k WHERE attempt = 3")
def third_failure(t):
    return G.third_failure(t.ledger, t.resolutions).select("id", "word_id", "stage_name", "error", "attempt", "started_at")


def _dead(t):
    columns = "id bigint, word_id bigint, stage_name string, error string, attempt int, created_at timestamp_ntz, resolved_at timestamp_ntz"
    empty = t.spark.createDataFrame([], columns)
    return G.dead_letter_record(empty, G.third_failure(t.ledger, t.resolutions))


DEAD = f"""{THIRD},
    d AS (SELECT row_number() OVER (ORDER BY started_at, word_id, stage_name) AS id, word_id, stage_name, error, attempt, started_at AS created_at
          FROM k WHERE attempt = 3)"""


@query("dead_letter_record", f"WITH {DEAD} SELECT id, word_id, stage_name, attempt, created_at FROM d")
def dead_letter_record(t):
    return _dead(t).select("id", "word_id", "stage_name", "attempt", "created_at")


@query("dead_letters_second_run", f"WITH {DEAD} SELECT id, word_id, stage_name FROM d WHERE false")
def dead_letters_second_run(t):
    """A rerun over the same ledger finds its letters open and records none."""
    first = cut_lineage(_dead(t))
    return G.dead_letter_record(first, G.third_failure(t.ledger, t.resolutions)).select("id", "word_id", "stage_name")


@query("open_items", f"WITH {DEAD} SELECT id, word_id, stage_name FROM d ORDER BY id DESC LIMIT 100")
def open_items(t):
    return G.open_items(_dead(t)).select("id", "word_id", "stage_name")


REPLAYED = f"""{DEAD},
    w AS (SELECT DISTINCT user_id AS word_id FROM events WHERE event_type = 'purchase' AND value > 100),
    kn AS (SELECT word_id FROM w WHERE word_id IN (SELECT id FROM pipe_words WHERE id % 2 = 0))"""


def _replay(t):
    wanted = t.read("events").where("event_type = 'purchase' AND value > 100").select(F.col("user_id").alias("word_id"))
    words = t.pipe_words.where("id % 2 = 0")
    return G.replay(_dead(t), words, wanted, F.lit("2024-02-01").cast("timestamp_ntz"))


@query(
    "replay",
    f"""WITH {REPLAYED}
    SELECT 'resolved' AS kind, word_id, (SELECT count(*) FROM d WHERE d.word_id = kn.word_id) AS n FROM kn
    UNION ALL SELECT 'unknown', word_id, 0 FROM w WHERE word_id NOT IN (SELECT word_id FROM kn)
    UNION ALL SELECT 'still open', word_id, count(*) FROM d WHERE word_id NOT IN (SELECT word_id FROM kn) GROUP BY 2
    UNION ALL SELECT 'reset', id, 1 FROM pipe_words WHERE id % 2 = 0 AND (status = 'new' OR id IN (SELECT word_id FROM kn))""",
)
def replay(t):
    out = _replay(t)
    still = out["dead_letters"].where("resolved_at IS NULL").groupBy("word_id").agg(F.count("*").alias("n"))
    rows = out["resolved"].select(F.lit("resolved").alias("kind"), "word_id", F.col("resolved").alias("n"))
    rows = rows.unionByName(out["unknown"].select(F.lit("unknown").alias("kind"), "word_id", F.lit(0).cast("bigint").alias("n")))
    rows = rows.unionByName(still.select(F.lit("still open").alias("kind"), "word_id", "n"))
    reset = out["words"].where("status = 'new'")
    return rows.unionByName(reset.select(F.lit("reset").alias("kind"), F.col("id").alias("word_id"), F.lit(1).cast("bigint").alias("n")))


@query(
    "words_with_artifact",
    """SELECT id, normalized_form, batch_id, fingerprint FROM pipe_words JOIN pipe_artifacts ON word_id = id WHERE stage_name = 'paraphrase'""",
)
def words_with_artifact(t):
    return G.words_with_artifact(t.pipe_words, t.pipe_artifacts, "paraphrase").select("id", "normalized_form", "batch_id", "fingerprint")


@query(
    "words_missing_artifact",
    """SELECT id, normalized_form FROM pipe_words WHERE id NOT IN (SELECT word_id FROM pipe_artifacts WHERE stage_name = 'paraphrase')""",
)
def words_missing_artifact(t):
    return G.words_missing_artifact(t.pipe_words, t.pipe_artifacts, "paraphrase").select("id", "normalized_form")


@query(
    "sample_forms",
    """SELECT normalized_form FROM pipe_words WHERE id NOT IN (SELECT word_id FROM pipe_artifacts WHERE stage_name = 'paraphrase')
       ORDER BY normalized_form LIMIT 10""",
)
def sample_forms(t):
    return G.sample_forms(G.words_missing_artifact(t.pipe_words, t.pipe_artifacts, "paraphrase"))


UNIT_COST = {"paraphrase": 0.0002, "derivatives": 0.00005, "examples": 0.0002, "mnemonic": 0.0004, "export": 0.0}


@query(
    "stage_plan",
    f"""WITH sc AS (SELECT unnest({list(UNIT_COST)}) AS stage_name, unnest({list(UNIT_COST.values())}) AS unit),
    st AS (SELECT w.id, w.batch_id, w.normalized_form, sc.stage_name, unit, a.fingerprint AS have, a.turn,
                  row_number() OVER (PARTITION BY w.batch_id, sc.stage_name, a.word_id IS NULL ORDER BY normalized_form) AS r
           FROM pipe_words w CROSS JOIN sc LEFT JOIN pipe_artifacts a ON a.word_id = w.id AND a.stage_name = sc.stage_name)
    SELECT batch_id, stage_name, count(*) AS candidates, count(have) AS has_artifact,
           count(*) FILTER (have IS NOT NULL AND id % 2 = 1) AS stale, count(*) FILTER (have IS NULL) AS needs_rerun,
           CAST(count(*) FILTER (have IS NULL) * max(unit) AS DECIMAL(12, 6)) AS estimated_cost_usd,
           coalesce(list(normalized_form ORDER BY normalized_form) FILTER (have IS NULL AND r <= 10), []) AS sample_forms
    FROM st GROUP BY ALL""",
)
def stage_plan(t):
    fresh = F.when(F.col("word_id") % 2 == 0, F.col("fingerprint")).otherwise("changed").alias("fingerprint")
    expected = t.pipe_artifacts.select("word_id", "stage_name", fresh)
    return G.stage_plan(t.pipe_words, t.pipe_artifacts, expected, UNIT_COST)


@query(
    "words_to_review",
    """SELECT w.word_id, w.form FROM pipe_words p JOIN dom_words w ON w.word_id = p.app_word_id
       WHERE p.status = 'done' AND w.word_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def words_to_review(t):
    done = t.read("labels").where("toxic = 1").select(F.col("doc_id").alias("word_id"))
    return G.words_to_review(t.pipe_words, t.dom_words, done)


@query("resume_filter", "SELECT word_id, form FROM dom_words WHERE word_id NOT IN (SELECT doc_id FROM labels)")
def resume_filter(t):
    return G.resume_filter(t.dom_words, t.read("labels").select(F.col("doc_id").alias("word_id"))).select("word_id", "form")


@query(
    "resume_by_bitmap",
    """SELECT word_id, form FROM dom_words WHERE word_id NOT IN (SELECT doc_id FROM labels UNION SELECT conv_id FROM conversations UNION SELECT user_id FROM events)""",
)
def resume_by_bitmap(t):
    """What three logs leave to do, the logs kept and merged as bitmaps."""
    sets = [
        G.done_bitmaps(t.read(name).select(F.col(key).alias("word_id"))) for name, key in (("labels", "doc_id"), ("conversations", "conv_id"), ("events", "user_id"))
    ]
    return G.resume_by_bitmap(t.dom_words, G.merge_bitmaps(*sets)).select("word_id", "form")


@query("merge_done_sets", "SELECT doc_id AS word_id FROM labels UNION SELECT conv_id FROM conversations UNION SELECT user_id FROM events")
def merge_done_sets(t):
    return G.merge_done_sets(
        t.read("labels").select(F.col("doc_id").alias("word_id")), t.read("conversations").select(F.col("conv_id").alias("word_id")),
        t.read("events").select(F.col("user_id").alias("word_id")),
    )


@query(
    "run_summary",
    f"""SELECT count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'failed') AS failed,
              (SELECT count(*) FROM resolutions) AS skipped,
              20000 * {len(STAGES)} - count(*) - (SELECT count(*) FROM resolutions) AS pruned FROM ledger""",
)
def run_summary(t):
    return G.run_summary(t.ledger, t.resolutions, 20000, len(STAGES))


@query(
    "experiment_summary",
    """SELECT event_type AS run_id, count(*) FILTER (value > 10) AS ok_count, count(*) FILTER (value > 50) AS valid_count,
              CAST(sum(CAST(value AS DECIMAL(12, 6))) AS DECIMAL(12, 6)) AS total_cost_usd FROM events GROUP BY 1""",
)
def experiment_summary(t):
    items = t.read("events").select(
        F.col("event_type").alias("run_id"), (F.col("value") > 10).alias("ok"), (F.col("value") > 50).alias("valid"),
        F.col("value").cast("decimal(12,6)").alias("cost_usd"),
    )
    return G.experiment_summary(items)


@query(
    "append_ledger",
    """SELECT CAST(started_at AS DATE) AS date, status, count(*) AS n, CAST(sum(cost_usd) AS DECIMAL(12, 6)) AS cost FROM ledger GROUP BY ALL""",
)
def append_ledger(t):
    path = fresh_path(t.spark, "ledger")
    W.append_ledger(t.ledger.where("status = 'ok'"), path)
    W.append_ledger(t.ledger.where("status = 'failed'"), path)
    back = t.spark.read.parquet(path)
    return back.groupBy("date", "status").agg(F.count("*").alias("n"), F.sum("cost_usd").cast(G.TOTAL).alias("cost"))


@query(
    "append_result_log",
    """SELECT doc_id AS word_id, quality = 1 AS has_issues FROM labels UNION ALL SELECT conv_id, NULL FROM conversations""",
)
def append_result_log(t):
    path = fresh_path(t.spark, "log")
    W.append_json_log(t.read("labels").select(F.col("doc_id").alias("word_id"), (F.col("quality") == 1).alias("has_issues")), path)
    W.append_json_log(t.read("conversations").select(F.col("conv_id").alias("word_id"), F.lit(None).cast("boolean").alias("has_issues")), path)
    return t.spark.read.schema("word_id bigint, has_issues boolean").json(path)

"""Streams over the driver's files; each must equal what a batch over the same rows gives."""

from pyspark.sql import functions as F

from lexmill.plans.ledger_queries import _batches
from lexmill.plans.registry import query
from lexmill.session import fresh_path
from lexmill.streaming import jobs as J


# Files of a table that one micro-batch takes.
FILES = 64


def _stream(t, table):
    """The table's own files as a stream, several micro-batches if there are more than FILES.

    A stream takes directories and patterns only, and a table may be a single file.
    """
    rows = t.read(table)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(f"{t.sf_dir}/{table}.parque[t]")


@query("stream_ingest", "SELECT normalized_form, type, raw_form FROM first_forms")
def stream_ingest(t):
    tokens = _stream(t, "documents").select("doc_id", F.posexplode(F.split("text", "[ \t\r\n\f]+")).alias("pos", "raw_form"))
    lines = tokens.select("raw_form", (F.col("doc_id") * 1_000_000 + F.col("pos")).alias("line_no"))
    return J.stream_ingest(lines, "line_no").select("normalized_form", "type", "raw_form")


@query("stream_dedupe", "SELECT DISTINCT replace(lower(event_type || ' ' || user_id), 'ß', 'ss') AS normalized_form, CAST(2 AS SMALLINT) AS type FROM events")
def stream_dedupe(t):
    lines = _stream(t, "events").select("ts", F.concat(F.upper("event_type"), F.lit(" "), "user_id").alias("raw_form"))
    return J.run_available(J.stream_dedupe(lines, "ts", "60 days").select("normalized_form", "type"), "dedupe")


@query(
    "stream_dead_letters",
    """WITH a AS (SELECT word_id, stage_name, id, started_at AS tm, 0 AS resolves FROM ledger WHERE status = 'failed'
                  UNION ALL SELECT word_id, stage_name, -1, resolved_at, 1 FROM resolutions),
    e AS (SELECT *, sum(resolves) OVER (PARTITION BY word_id, stage_name ORDER BY tm, id) AS epoch FROM a),
    k AS (SELECT *, row_number() OVER (PARTITION BY word_id, stage_name, epoch ORDER BY tm, id) AS attempt FROM e WHERE resolves = 0)
    SELECT word_id, stage_name, id, CAST(attempt AS INTEGER) AS attempt, tm AS created_at FROM k WHERE attempt = 3""",
)
def stream_dead_letters(t):
    return J.run_available(J.stream_dead_letters(_attempts(t)), "dead-letters")


def _attempts(t):
    events = _stream(t, "events").where("event_type IN ('error', 'signup')")
    resolves = F.col("event_type") == "signup"
    return events.select(
        F.col("user_id").alias("word_id"), t.stage_of(F.get_json_object("props", "$.k").cast("int") % 4).alias("stage_name"),
        F.when(resolves, -1).otherwise(F.col("event_id")).alias("id"), F.col("ts").alias("at"), resolves.alias("resolves"),
    )


@query(
    "stream_dead_letters_in_order",
    """WITH a AS (SELECT word_id, stage_name, id, started_at AS tm, 0 AS resolves FROM ledger WHERE status = 'failed'
                  UNION ALL SELECT word_id, stage_name, -1, resolved_at, 1 FROM resolutions),
    e AS (SELECT *, sum(resolves) OVER (PARTITION BY word_id, stage_name ORDER BY tm, id) AS epoch FROM a),
    k AS (SELECT *, row_number() OVER (PARTITION BY word_id, stage_name, epoch ORDER BY tm, id) AS attempt FROM e WHERE resolves = 0)
    SELECT word_id, stage_name, id, CAST(attempt AS INTEGER) AS attempt, tm AS created_at FROM k
    WHERE attempt = 3 AND tm < (SELECT max(tm) FROM a) - INTERVAL 10 MINUTE""",
)
def stream_dead_letters_in_order(t):
    """Letters in order of event time, as far as the watermark has come."""
    with J.with_state_store(t.spark):
        return J.run_available(J.stream_dead_letters_in_order(_attempts(t), "10 minutes", "400 days"), "dead-letters-in-order")


@query(
    "stream_silence_alert",
    """SELECT CAST(word_id AS VARCHAR) AS key, min(started_at) AS busy_from, max(started_at) AS quiet_from, count(*) AS attempts FROM ledger GROUP BY 1""",
)
def stream_silence_alert(t):
    """Alerts of a stream that has gone silent: every word's, two seconds of the clock after its last row arrived."""
    attempts = t.as_ledger(_stream(t, "events"))
    expected = t.ledger.count()
    with J.with_state_store(t.spark):
        alerts = J.run_until(
            J.stream_silence_alert(attempts, "word_id", gap=2), fresh_path(t.spark, "silence"),
            lambda out: (out.agg(F.sum("attempts")).first()[0] or 0) >= expected, 300,
        )
    # A word whose rows came in several batches may have been told of more than once.
    return alerts.groupBy("key").agg(F.min("busy_from").alias("busy_from"), F.max("quiet_from").alias("quiet_from"), F.sum("attempts").alias("attempts"))


@query(
    "stream_progress",
    """WITH m AS (SELECT date_trunc('minute', started_at) AS minute, stage_name, status FROM ledger)
    SELECT minute, stage_name, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'failed') AS failed FROM m
    WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(started_at) FROM ledger) - INTERVAL 10 MINUTE GROUP BY minute, stage_name""",
)
def stream_progress(t):
    return J.run_available(J.stream_progress(t.as_ledger(_stream(t, "events"))), "progress")


@query(
    "stream_stall_alert",
    """WITH o AS (SELECT word_id, started_at, CASE WHEN started_at >= lag(started_at) OVER (PARTITION BY word_id ORDER BY started_at) + INTERVAL 180 SECOND
                         OR lag(started_at) OVER (PARTITION BY word_id ORDER BY started_at) IS NULL THEN 1 ELSE 0 END AS fresh FROM ledger),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY word_id ORDER BY started_at) AS s FROM o)
    SELECT word_id, min(started_at) AS busy_from, max(started_at) AS quiet_from, count(*) AS attempts FROM g GROUP BY word_id, s
    HAVING max(started_at) + INTERVAL 180 SECOND <= (SELECT max(started_at) FROM ledger) - INTERVAL 10 MINUTE""",
)
def stream_stall_alert(t):
    return J.run_available(J.stream_stall_alert(t.as_ledger(_stream(t, "events")), ["word_id"]), "stalls")


@query(
    "stalls",
    """SELECT quiet_from, quiet_to FROM (SELECT lag(started_at) OVER (ORDER BY started_at) AS quiet_from, started_at AS quiet_to
       FROM (SELECT DISTINCT started_at FROM ledger)) WHERE quiet_from + INTERVAL 180 SECOND < quiet_to""",
)
def stalls(t):
    return J.stalls(t.ledger)


@query(
    "stream_batch_cost",
    """WITH b AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS batch_id, CAST(CASE WHEN day(ts) % 3 = 0 THEN NULL ELSE 12000 + 100 * day(ts) END AS DECIMAL(12, 6)) AS budget_cap_usd
                  FROM events WHERE day(ts) < 29),
    s AS (SELECT batch_id, CAST(sum(cost_usd) AS DECIMAL(12, 6)) AS spent FROM ledger WHERE status = 'ok' GROUP BY 1)
    SELECT batch_id, spent, budget_cap_usd, CASE WHEN spent >= budget_cap_usd THEN 'blocked' ELSE 'pass' END AS verdict FROM s LEFT JOIN b USING (batch_id)""",
)
def stream_batch_cost(t):
    return J.stream_batch_cost(t.as_ledger(_stream(t, "events")), _batches(t))

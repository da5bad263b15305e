"""The same rules run continuously over arriving rows."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from lexmill.functions import text as T
from lexmill.operators.ledger import DEAD_AFTER, TOTAL
from lexmill.session import fresh_path

STALL_SECONDS = 180


def event_time(stream: DataFrame, at: str) -> DataFrame:
    """Watermarks need a timestamp with a zone; one without is read in the session's zone."""
    return stream.withColumn(at, F.col(at).cast("timestamp"))


AVAILABLE = {"availableNow": True}


def _root(stream: DataFrame, label: str, root: str | None) -> str:
    return fresh_path(stream.sparkSession, label) if root is None else root.rstrip("/")


def run_available(stream: DataFrame, label: str, mode: str = "append", root: str | None = None, trigger: dict | None = None) -> DataFrame:
    """Run a stream into the Parquet table `<root>/out` and read that; its checkpoint is `<root>/state`.

    Started again with the same root it goes on after the last batch that was finished; without
    one it starts anew in a folder of its own. By default it ends when it has seen what has
    arrived; with another trigger it runs until it is stopped.
    """
    root = _root(stream, label, root)
    job = (
        stream.writeStream.format("parquet").outputMode(mode).option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/state").trigger(**(trigger or AVAILABLE)).start()
    )
    job.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def run_batches(
    stream: DataFrame, root: str, sink: Callable[[DataFrame, int], None], mode: str = "append", trigger: dict | None = None
) -> None:
    """Run a stream through a batch function; `<root>/state` is its checkpoint."""
    job = (
        stream.writeStream.outputMode(mode).foreachBatch(sink)
        .option("checkpointLocation", f"{root}/state").trigger(**(trigger or AVAILABLE)).start()
    )
    job.awaitTermination()


def _epochs(root: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes every batch to a directory of its own, so that a repeated one replaces itself."""
    def add(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("epoch", F.lit(epoch).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch:09d}")

    return add


MANIFEST = "upto bigint, path string"


def _compacted(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The last epoch that a compaction holds, and where; (-1, None) without one."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{root}/compacted.list").orderBy(F.col("upto").desc()).limit(1).collect()
    except AnalysisException:
        return -1, None
    return (rows[0]["upto"], rows[0]["path"]) if rows else (-1, None)


def read_epochs(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """What the batches of a stream wrote: the newest compaction and the epochs after it.

    Epochs are told by their directories, so those that a compaction holds are not opened.
    """
    upto, path = _compacted(spark, root)
    later = spark.read.schema(schema).option("basePath", f"{root}/out").parquet(f"{root}/out").where(F.col("epoch") > upto)
    return later if path is None else spark.read.schema(schema).parquet(path).unionByName(later)


def compact_epochs(spark: SparkSession, root: str, schema: str, merge: Callable[[DataFrame], DataFrame]) -> int:
    """Replace all epochs but the newest by one table, reduced by `merge`; returns the last epoch in it.

    The newest may be written again when its stream is restarted, so it stays. The table is
    written first and then added to the list that readers follow; a job that dies in between
    changes nothing.
    """
    rows = read_epochs(spark, root, schema)
    last = rows.agg(F.max("epoch")).first()[0]
    upto = _compacted(spark, root)[0]
    if last is None or last - 1 <= upto:
        return upto
    path = f"{root}/compacted/{last - 1:09d}-{uuid.uuid4().hex}"
    merge(rows.where(F.col("epoch") < last)).select(*rows.columns).write.parquet(path)
    spark.createDataFrame([(last - 1, path)], MANIFEST).coalesce(1).write.mode("append").json(f"{root}/compacted.list")
    return last - 1


# --- ingest -----------------------------------------------------------------

INGESTED = "normalized_form string, type smallint, raw_form string, first_seen bigint, epoch bigint"


def stream_ingest(lines: DataFrame, order: str, raw: str = "raw_form", root: str | None = None, trigger: dict | None = None) -> DataFrame:
    """(normalized_form, type, raw_form, first_seen): the first spelling of every form that arrives.

    The stream's state has one number per spelling; no batch reads what earlier ones wrote. Equal
    spellings are reduced before they are normalised. A batch writes the spellings that it touched,
    and a form is the first one that the first batch that saw it wrote: a later spelling changes
    nothing. Started again with the same root, it goes on.
    """
    spark = lines.sparkSession
    root = _root(lines, "ingest", root)
    # One number per spelling is aggregated in hash tables; a spelling beside it would be sorted.
    # A place that is not known counts as the first.
    seen = F.when(F.count(order) == F.count(F.lit(1)), F.min(order)).alias("first_seen")
    first = lines.where(~T.is_blank(F.col(raw))).groupBy(F.col(raw).alias("raw_form")).agg(seen)
    rows = T.with_normalized(first, "raw_form").select("normalized_form", "type", "raw_form", "first_seen")
    run_batches(rows, root, _epochs(root), "update", trigger)
    return first_epoch(read_epochs(spark, root, INGESTED)).drop("epoch")


def first_epoch(written: DataFrame) -> DataFrame:
    """The first spelling of what the first epoch that saw a form wrote of it."""
    first = F.min(F.struct("epoch", "first_seen", "raw_form")).alias("_f")
    return written.groupBy("normalized_form", "type").agg(first).select("normalized_form", "type", "_f.raw_form", "_f.first_seen", "_f.epoch")


def stream_dedupe(lines: DataFrame, at: str, delay: str, raw: str = "raw_form") -> DataFrame:
    """A stream with one row per form inside the watermark; state older than that is dropped."""
    formed = T.with_normalized(lines.where(~T.is_blank(F.col(raw))), raw)
    return event_time(formed, at).withWatermark(at, delay).dropDuplicatesWithinWatermark(["normalized_form", "type"])


# --- dead letters -----------------------------------------------------------

DEAD_LETTER = "word_id bigint, stage_name string, id bigint, attempt int, created_at timestamp_ntz"


def _count_failures(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counts failures of one word and stage in time order; a resolution starts over."""
    count = state.get[0] if state.exists else 0
    # Most keys have a few rows, which plain tuples sort in less time than a frame is made in.
    rows = [r for batch in batches for r in zip(batch["at"], batch["id"].tolist(), batch["resolves"].tolist(), strict=True)]
    if len(rows) > 1:
        rows.sort(key=_in_time)
    due: list[tuple[Any, ...]] = []
    for at, event_id, resolves in rows:
        count = 0 if resolves else count + 1
        if count == DEAD_AFTER:
            due.append((key[0], key[1], event_id, DEAD_AFTER, at))
    state.update((count,))
    if due:
        yield pd.DataFrame(due, columns=["word_id", "stage_name", "id", "attempt", "created_at"])


def _in_time(row: tuple) -> tuple:
    """Order of (at, id, …); what is missing comes last."""
    at, event_id = row[0], row[1]
    no_at, no_id = pd.isna(at), pd.isna(event_id)
    return no_at, 0 if no_at else at, no_id, 0 if no_id else event_id


def stream_dead_letters(attempts: DataFrame) -> DataFrame:
    """A stream of dead letters from (word_id, stage_name, id, at, resolves).

    Only failures and resolutions are let in. The state of a key is one number. A micro-batch
    holds few rows of a key, which its trigger or maxFilesPerTrigger bounds.
    """
    return attempts.groupBy("word_id", "stage_name").applyInPandasWithState(
        _count_failures, DEAD_LETTER, "failures int", "append", GroupStateTimeout.NoTimeout
    )


# Rows of a key that wait for the watermark, and what is known of it.
PENDING = "at timestamp, id bigint, resolves boolean"
COUNTED = "failures int, last timestamp"
MS = 1_000


class FailureOrder(StatefulProcessor):
    """Counts a key's failures in event time: rows wait in a list until the watermark has passed them.

    One timer per key stands at its earliest waiting row, and after the last one at the end of
    `idle`; when that fires without new rows, the key's state is gone.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", PENDING)
        self.known = handle.getValueState("known", COUNTED)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # Each call of the handle is a round trip, so a new key, which has no timer yet, takes three.
        timers = list(self.handle.listTimers())
        earliest = min(timers) if timers and self.pending.exists() else None
        arrived: list[tuple[Any, ...]] = []
        for batch in rows:
            times = batch["at"].dt.tz_localize(None) if batch["at"].dt.tz is not None else batch["at"]
            arrived += [(at.to_pydatetime(), int(i), bool(r)) for at, i, r in zip(times, batch["id"], batch["resolves"], strict=True)]
            first = _ms(times.min())
            earliest = first if earliest is None else min(earliest, first)
        if arrived:
            self.pending.appendList(arrived)
        if earliest is not None:
            wake = max(earliest, timerValues.getCurrentWatermarkInMs() + 1)
            for old in timers:
                if old != wake:
                    self.handle.deleteTimer(old)
            if wake not in timers:
                self.handle.registerTimer(wake)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(self.pending.get(), key=lambda r: (r[0], r[1]))
        due = [r for r in waiting if _ms(r[0]) <= mark]
        count, last = self.known.get() or (0, None)
        letters: list[tuple[Any, ...]] = []
        for at, event_id, resolves in due:
            # Whether or not the timer of the idle time came first, the key was to be forgotten.
            if last is not None and _ms(at) >= _ms(last) + self.idle_ms:
                count = 0
            count, last = 0 if resolves else count + 1, at
            if count == DEAD_AFTER:
                letters.append((key[0], key[1], event_id, DEAD_AFTER, at))
        left = waiting[len(due):]
        # The timer that fired is the key's only one, and Spark takes it away.
        if left:
            if due:
                self.pending.put([tuple(r) for r in left])
            self.handle.registerTimer(max(_ms(left[0][0]), mark + 1))
        elif due:
            self.pending.clear()
        if due:
            self.known.update((count, last))
        if not left and last is not None:
            if due or mark < _ms(last) + self.idle_ms:
                self.handle.registerTimer(max(_ms(last) + self.idle_ms, mark + 1))
            else:
                self.known.clear()
        if letters:
            yield pd.DataFrame(letters, columns=["word_id", "stage_name", "id", "attempt", "created_at"])

    def close(self) -> None:
        pass


def _ms(at: Any) -> int:
    """Milliseconds since 1970 of a time without a zone, which stands for UTC; a part of one counts as whole."""
    return -(-int((pd.Timestamp(at).tz_localize(None) if pd.Timestamp(at).tzinfo else pd.Timestamp(at)).value) // 1_000_000)


def stream_dead_letters_in_order(attempts: DataFrame, delay: str = "10 minutes", idle: str = "30 days") -> DataFrame:
    """A stream of dead letters from (word_id, stage_name, id, at, resolves), counted in order of `at`.

    Rows may arrive in any order within the watermark's `delay`; a letter comes when the
    watermark has passed its third failure. After `idle` of event time without rows a key is
    forgotten: its state goes, and a later failure is its first. Needs a state store that holds several states
    of a key (`with_state_store`).
    """
    idle_ms = int(pd.Timedelta(idle).total_seconds() * MS)
    timed = event_time(attempts, "at").withWatermark("at", delay)
    letters = timed.groupBy("word_id", "stage_name").transformWithStateInPandas(
        statefulProcessor=FailureOrder(idle_ms), outputStructType=LETTER, outputMode="Append", timeMode="EventTime"
    )
    return letters.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


LETTER = "word_id bigint, stage_name string, id bigint, attempt int, created_at timestamp"


@contextmanager
def with_state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which holds several states and timers for each key."""
    name, store = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, store)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


# --- progress ---------------------------------------------------------------


def stream_progress(attempts: DataFrame, at: str = "started_at", delay: str = "10 minutes", window: str = "1 minute") -> DataFrame:
    """Per stage and minute: ok and failed attempts; rows later than the watermark are dropped."""
    timed = event_time(attempts, at).withWatermark(at, delay).groupBy(F.window(at, window), "stage_name").agg(
        F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "failed").alias("failed")
    )
    return timed.select(F.col("window.start").cast("timestamp_ntz").alias("minute"), "stage_name", "ok", "failed")


def stream_stall_alert(attempts: DataFrame, keys: list[str], at: str = "started_at", delay: str = "10 minutes", gap: int = STALL_SECONDS) -> DataFrame:
    """Stretches of work without a pause of `gap` seconds, per key: each end is a stall.

    A session closes `gap` seconds after its last row; `quiet_from` is when the work stopped.
    """
    active = event_time(attempts, at).withWatermark(at, delay).groupBy(F.session_window(at, f"{gap} seconds"), *keys).agg(F.count(F.lit(1)).alias("attempts"))
    ends = F.col("session_window.end") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap))
    start = F.col("session_window.start").cast("timestamp_ntz")
    return active.select(*keys, start.alias("busy_from"), ends.cast("timestamp_ntz").alias("quiet_from"), "attempts")


class Silence(StatefulProcessor):
    """Tells when a key has been silent for `gap_ms` of the clock, without waiting for a later row."""

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.busy = handle.getValueState("busy", "first timestamp, last timestamp, attempts bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first, last, count = tuple(self.busy.get()) if self.busy.exists() else (None, None, 0)
        for batch in rows:
            times = batch["at"].dt.tz_localize(None) if batch["at"].dt.tz is not None else batch["at"]
            low, high = times.min().to_pydatetime(), times.max().to_pydatetime()
            first, last = low if first is None else min(first, low), high if last is None else max(last, high)
            count += len(batch)
        self.busy.update((first, last, count))
        for old in self.handle.listTimers():
            self.handle.deleteTimer(old)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.gap_ms)
        yield pd.DataFrame(columns=["key", "busy_from", "quiet_from", "attempts"])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first, last, count = tuple(self.busy.get())
        self.busy.clear()
        yield pd.DataFrame([(key[0], first, last, count)], columns=["key", "busy_from", "quiet_from", "attempts"])

    def close(self) -> None:
        pass


def stream_silence_alert(attempts: DataFrame, key: str, at: str = "started_at", gap: float = STALL_SECONDS) -> DataFrame:
    """(key, busy_from, quiet_from, attempts): an alert `gap` seconds of the clock after a key's last row arrived.

    The alert needs no later row, of this key or another. A key that goes on is watched anew. Needs a
    state store that holds timers (`with_state_store`) and a trigger that goes on.
    """
    rows = event_time(attempts.select(F.col(key).cast("string").alias("key"), F.col(at).alias("at")), "at")
    alerts = rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Silence(int(gap * MS)), outputStructType="key string, busy_from timestamp, quiet_from timestamp, attempts bigint",
        outputMode="Append", timeMode="ProcessingTime",
    )
    return alerts.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("busy_from", "quiet_from")})


def run_until(stream: DataFrame, root: str, done: Callable[[DataFrame], bool], seconds: float, every: str = "1 second") -> DataFrame:
    """Run a stream into `<root>/out` until `done` says so of what it wrote, at most so many seconds."""
    job = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/state").trigger(processingTime=every).start()
    )
    end = time.monotonic() + seconds
    read = stream.sparkSession.read.schema(stream.schema)
    try:
        while time.monotonic() < end:
            if job.exception() is not None:
                raise job.exception()
            if job.lastProgress is not None and done(read.parquet(f"{root}/out")):
                break
            time.sleep(0.5)
    finally:
        job.stop()
    return read.parquet(f"{root}/out")


def stalls(attempts: DataFrame, at: str = "started_at", gap: int = STALL_SECONDS) -> DataFrame:
    """Batch form: (quiet_from, quiet_to) where nothing completed for more than `gap` seconds.

    Rows are first reduced to the earliest and latest time of each slot of `gap` seconds: no
    such gap fits inside a slot. The window then runs over slots, whose number depends on the
    time covered and not on the rows.
    """
    zone = attempts.schema[at].dataType
    slot = F.floor(F.unix_micros(F.col(at).cast("timestamp")) / (gap * 1_000_000))
    slots = attempts.groupBy(slot.alias("slot")).agg(F.min(at).alias("quiet_to"), F.max(at).alias("_last"))
    ordered = slots.withColumn("quiet_from", F.lag("_last").over(Window.orderBy("slot")))
    pause = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap))
    late = (F.col("quiet_from") + pause).cast(zone) < F.col("quiet_to")
    return ordered.where(late).select("quiet_from", "quiet_to")


# --- cost -------------------------------------------------------------------


SPENT = f"batch_id string, spent {TOTAL}, epoch bigint"


def last_epoch(emitted: DataFrame) -> DataFrame:
    """The newest total of each batch."""
    newest = F.max_by(F.struct("spent", "epoch"), "epoch").alias("_n")
    return emitted.groupBy("batch_id").agg(newest).select("batch_id", "_n.*")


def stream_batch_cost(attempts: DataFrame, batches: DataFrame, root: str | None = None, trigger: dict | None = None) -> DataFrame:
    """(batch_id, spent, budget_cap_usd, verdict): the newest total per batch, against its cap.

    The stream keeps one sum per batch and emits the sums that changed. Every micro-batch
    writes its own directory; the largest epoch of a batch is its current total. Started again
    with the same root, it goes on.
    """
    spark = attempts.sparkSession
    root = _root(attempts, "cost", root)
    sums = attempts.where((F.col("status") == "ok") & F.col("batch_id").isNotNull()).groupBy("batch_id").agg(
        F.sum("cost_usd").cast(TOTAL).alias("spent")
    )
    run_batches(sums, root, _epochs(root), "update", trigger)
    newest = last_epoch(read_epochs(spark, root, SPENT)).drop("epoch")
    caps = batches.select(F.col("id").alias("batch_id"), "budget_cap_usd")
    verdict = F.when(F.col("spent") >= F.col("budget_cap_usd"), "blocked").otherwise("pass")
    return newest.join(caps, "batch_id", "left").withColumn("verdict", verdict)

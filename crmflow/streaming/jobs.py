"""Streaming jobs: the batch operators behind ``foreachBatch``, and windowed counts.

Raw rows are published once per batch below their day (``write_once``). Other outputs of a micro-batch
are a directory named by its batch id and written with overwrite, so a replayed batch replaces its own
output. Offsets live in the query's checkpoint. Messages that earlier batches brought are known from the
job's ledger (``SeenIds``): a redelivered message changes nothing, and another content under a known
event id goes to the dead letters. Started jobs try a failing batch again (``Attempts``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from crmflow.operators import parse, quality, routing
from crmflow.operators.history import boundaries
from crmflow.operators.query import union_raw
from crmflow.registry import HISTORY_TABLES, OBJECT_TYPES
from crmflow.sources import staged
from crmflow.sources.seen import CONFLICT, FIRST, SeenIds
from crmflow.sources.versions import VersionsTable
from crmflow.sources.writers import drop_expired
from crmflow.streaming.attempts import MAX_ATTEMPTS, RETRY_SECONDS, Attempts
from crmflow.streaming.windows import WindowJob

# Windows, lateness and triggers of the two paths.
RAW_WINDOW = "10 seconds"
HISTORY_WINDOW = "1 hour"
LATENESS = "600 seconds"


def distinct_messages(parsed: DataFrame) -> DataFrame:
    """One message per content, the first published; copies combine map-side."""
    order = F.struct("value", *[c for c in ("publish_time", "message_id") if c in parsed.columns])
    return (
        parsed.groupBy(F.coalesce("text", F.base64("value")).alias("__content"), F.col("text").isNull().alias("__bytes"))
        .agg(F.min_by(F.struct(*parsed.columns), order).alias("row")).select("row.*")
    )


def mark_conflicts(messages: DataFrame) -> DataFrame:
    """Add ``conflict``: another message (the one with the smaller text) has the same event id.

    Needs distinct messages. An absent or empty event id never conflicts. Only ids that really
    repeat take part in the join, with one row each.
    """
    name = F.nullif(F.try_variant_get("event", "$.event_id", "string"), F.lit(""))
    named = messages.withColumn("__event_id", name)
    repeated = (
        named.where(F.col("__event_id").isNotNull()).groupBy("__event_id")
        .agg(F.min("text").alias("__kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    return (
        named.join(repeated, "__event_id", "left")
        .withColumn("conflict", F.coalesce(F.col("text") != F.col("__kept"), F.lit(False)))
        .select(*messages.columns, "conflict")
    )


def arrivals(messages: DataFrame, ledger: SeenIds, batch_id: int, clock: Column) -> DataFrame:
    """Distinct parsed messages of a micro-batch with their ``arrival``, judged by the ledger."""
    parsed = distinct_messages(parse.parse_messages(messages, clock))
    return ledger.judge(parsed, batch_id, F.try_variant_get("event", "$.event_id", "string"), F.col("value"))


def conflict_letters(marked: DataFrame, where: str = "conflict") -> DataFrame:
    return marked.where(where).select(
        F.lit("conflicting event id").alias("error"), F.col("text").alias("original_message"),
        F.col("ingestion_time").alias("timestamp"),
    )


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Iterable[str] = ()) -> None:
    """Replace the output of a micro-batch; rebalancing avoids many small files and splits a
    partition that holds most rows."""
    df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")


@dataclass
class CdcJob:
    """Change messages to raw tables, alerts, dead letters and history below ``base``."""

    spark: SparkSession
    base: str
    as_of: Column | None = None
    enabled: tuple[str, ...] = OBJECT_TYPES
    tracked: tuple[str, ...] = OBJECT_TYPES
    rules: tuple[str, ...] | None = None
    lateness: str = LATENESS
    buckets: int = 64
    tracked_fields: tuple[str, ...] | None = None
    max_attempts: int = MAX_ATTEMPTS
    retry_seconds: float = RETRY_SECONDS
    on_failure: str = "dlq"
    last_metrics: dict = field(default_factory=dict)

    def _clock(self) -> Column:
        return F.current_timestamp() if self.as_of is None else self.as_of

    def _events(self, parsed: DataFrame) -> DataFrame:
        validated = routing.validate_events(parse.envelope(parsed), self._clock(), self.rules)
        return routing.route_by_object(validated, self.enabled, self.tracked)

    def ledger(self, name: str) -> SeenIds:
        """What the job ``name`` (raw, history) has seen."""
        return SeenIds(self.spark, f"{self.base}/seen/{name}", source=stream_of(self.spark))

    def raw_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Raw rows, alerts, late events and dead letters of one micro-batch."""
        ledger = self.ledger("raw")
        marked = arrivals(batch, ledger, batch_id, self._clock()).persist(StorageLevel.MEMORY_AND_DISK)
        parsed = _new(marked)
        events = self._events(parsed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = self._raw_rows(events)
            fits = F.size("cast_errors") == 0
            staged.write_once(rows.where(fits).drop("cast_errors", "text", "ingestion_time"),
                              f"{self.base}/raw", batch_id, RAW_LAYOUT, stream_of(self.spark))
            seen = Observation("cdc_events")
            measured = events.observe(seen, *quality.metric_columns(self._clock()))
            write_batch(routing.alert_messages(routing.quality_alerts(measured, self._clock())),
                        f"{self.base}/alerts", batch_id)
            self.last_metrics = seen.get
            late = quality.late_events(events.where("is_valid"), "event_timestamp", "publish_time", self.lateness)
            write_batch(late.select("event_id", "object_type", "record_id", "event_timestamp", "publish_time", "text"),
                        f"{self.base}/late", batch_id)
            unrouted = events.where(F.col("is_valid") & (F.col("table_route") == "unknown")).select(
                F.lit("unknown object type").alias("error"), F.col("text").alias("original_message"),
                F.col("ingestion_time").alias("timestamp"),
            )
            unfit = rows.where(~fits).select(
                F.concat(F.lit("wrong type: "), F.array_join("cast_errors", ",")).alias("error"),
                F.col("text").alias("original_message"), F.col("ingestion_time").alias("timestamp"),
            )
            letters = parse.dead_letters(parsed).unionByName(unrouted).unionByName(unfit)
            write_batch(letters.unionByName(conflict_letters(marked, CONFLICTS)), f"{self.base}/dead_letters", batch_id)
            ledger.record(marked, batch_id)
            ledger.fold()
        finally:
            events.unpersist()
            marked.unpersist()

    def _raw_rows(self, events: DataFrame) -> DataFrame:
        """Typed rows of all enabled objects; ``cast_errors`` names values that do not fit."""
        valid = events.where("is_valid")
        rows = union_raw([
            parse.extract_record(valid.where(F.col("table_route") == o), o, self._clock(), flag_casts=True,
                                 keep=("text", "ingestion_time"))
            for o in self.enabled
        ])
        return rows.withColumn("ingest_date", F.to_date("ingestion_timestamp"))

    def versions(self, object_type: str) -> VersionsTable:
        return VersionsTable(self.spark, f"{self.base}/{HISTORY_TABLES[object_type]}", buckets=self.buckets)

    def history_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Fold one micro-batch into the history of every tracked object.

        Messages left out for their event id go to ``history_dead_letters``.
        """
        ledger = self.ledger("history")
        marked = arrivals(batch, ledger, batch_id, self._clock()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(conflict_letters(marked, CONFLICTS), f"{self.base}/history_dead_letters", batch_id)
            self._fold_history(self._events(_new(marked)), batch_id)
            ledger.record(marked, batch_id)
            ledger.fold()
        finally:
            marked.unpersist()

    def _fold_history(self, events: DataFrame, batch_id: int) -> None:
        wanted = events.where(F.col("is_valid") & F.col("to_history"))
        moved = boundaries(wanted, self.tracked_fields, keep=("object_type",))
        write_batch(moved, f"{self.base}/boundary_log", batch_id, ("object_type",))
        written = self.spark.read.schema(moved.schema).parquet(f"{self.base}/boundary_log/batch_id={batch_id}")
        for name in self.tracked:
            self.versions(name).merge(written.where(F.col("object_type") == name).drop("object_type"), batch_id=batch_id, source=stream_of(self.spark))

    def rebuild_history(self) -> None:
        """History tables anew from the boundary log."""
        log = self.spark.read.parquet(f"{self.base}/boundary_log").drop("batch_id")
        for name in self.tracked:
            self.versions(name).rebuild(log.where(F.col("object_type") == name).drop("object_type"))

    def fold_raw(self, day: str) -> bool:
        """Rewrite a day's raw files, of a day that gets no more rows, as sorted ones with disjoint id ranges."""
        return staged.fold_day(self.spark, f"{self.base}/raw", day, ["id"], ["object_type"])

    def drop_raw(self, as_of: dt.date, days: int = 30) -> int:
        """Delete raw days older than the retention; returns how many."""
        return drop_expired(self.spark, f"{self.base}/raw", as_of, days)

    def _probe(self, batch: DataFrame) -> None:
        """Evaluate everything a batch evaluates, and store nothing."""
        events = self._events(parse.parse_messages(batch, self._clock()))
        alerts = routing.quality_alerts(events, self._clock()).select(F.to_json(F.struct("*")).alias("value"))
        rows = self._raw_rows(events).select(F.to_json(F.struct("*")).alias("value"))
        moved = boundaries(events.where("is_valid"), self.tracked_fields).select(F.to_json(F.struct("*")).alias("value"))
        alerts.unionByName(rows).unionByName(moved).write.format("noop").mode("overwrite").save()

    def attempt(self, batch: DataFrame, batch_id: int, history: bool = False) -> None:
        """``raw_batch`` or ``history_batch`` under the job's attempts and failure policy."""
        name, work, letters = ("history", self.history_batch, "history_dead_letters") if history else ("raw", self.raw_batch, "dead_letters")

        def reject(rows: DataFrame, batch_id: int) -> None:
            original = F.coalesce(F.try_validate_utf8(F.col("value").cast("string")), F.base64("value"))
            rows.select(
                F.lit("processing failed").alias("error"), original.alias("original_message"), self._clock().alias("timestamp"),
            ).write.mode("append").parquet(f"{self.base}/{letters}/batch_id={batch_id}")

        attempts = Attempts(self.spark, f"{self.base}/attempts/{name}", self.max_attempts, self.retry_seconds, self.on_failure)
        attempts.run(work, self._probe, reject, batch, batch_id, stream_of(self.spark))

    def start_raw(self, messages: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        return self._start(messages, self.attempt, checkpoint, once, RAW_WINDOW)

    def start_history(self, messages: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        return self._start(messages, lambda batch, i: self.attempt(batch, i, history=True), checkpoint, once, HISTORY_WINDOW)

    def windows(self, width: str = HISTORY_WINDOW) -> WindowJob:
        return WindowJob(self.spark, f"{self.base}/windows", width, self.lateness)

    def start_windows(self, messages: DataFrame, checkpoint: str, once: bool = False, width: str = HISTORY_WINDOW) -> StreamingQuery:
        """Valid events per object and window: each window once, when it closes; late events aside."""
        def count(batch: DataFrame, batch_id: int) -> None:
            events = self._events(distinct_messages(parse.parse_messages(batch, self._clock()))).where("is_valid")
            narrow = events.select("event_id", "object_type", "record_id", "event_timestamp", "publish_time")
            self.windows(width).batch(narrow, batch_id, stream_of(self.spark))

        return self._start(messages, count, checkpoint, once, RAW_WINDOW)

    def _start(self, messages, batch_fn, checkpoint, once, every) -> StreamingQuery:
        writer = messages.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
        return trigger(writer, once, every).start()


# Partition columns of raw rows, outermost first.
RAW_LAYOUT = ("ingest_date", "object_type")


def stream_of(spark: SparkSession) -> str:
    """The id of the streaming query whose batch is being processed; it outlives restarts. Empty outside of one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


CONFLICTS = f"arrival = '{CONFLICT}'"


def _new(marked: DataFrame) -> DataFrame:
    """Messages no earlier batch brought."""
    return marked.where(F.col("arrival") == FIRST).drop("arrival", "__key", "__content")


def trigger(writer: DataStreamWriter, once: bool, every: str) -> DataStreamWriter:
    """Everything available and stop, or a micro-batch per interval."""
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)


@dataclass
class IngestJob:
    """Generic events: parse, required keys, score, append; failures to the dead letters."""

    base: str
    ingestion_time: Column | None = None

    def batch(self, messages: DataFrame, batch_id: int) -> None:
        ledger = SeenIds(messages.sparkSession, f"{self.base}/seen", source=stream_of(messages.sparkSession))
        clock = F.current_timestamp() if self.ingestion_time is None else self.ingestion_time
        marked = arrivals(messages, ledger, batch_id, clock).persist(StorageLevel.MEMORY_AND_DISK)
        checked = parse.check_generic(_new(marked)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(parse.raw_events(checked), f"{self.base}/raw_events", batch_id)
            invalid = checked.where(F.col("route") == "invalid").select(
                F.lit("missing required key").alias("error"), F.col("text").alias("original_message"),
                F.col("ingestion_time").alias("timestamp"),
            )
            letters = parse.dead_letters(checked).unionByName(invalid).unionByName(conflict_letters(marked, CONFLICTS))
            write_batch(letters, f"{self.base}/dead_letters", batch_id)
            ledger.record(marked, batch_id)
            ledger.fold()
        finally:
            checked.unpersist()
            marked.unpersist()

    def start(self, messages: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        writer = messages.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
        return trigger(writer, once, RAW_WINDOW).start()


def watermarked(events: DataFrame, lateness: str = LATENESS, ts: str = "event_timestamp") -> DataFrame:
    return events.withWatermark(ts, lateness)


def deduplicated(events: DataFrame, lateness: str = LATENESS, ts: str = "event_timestamp") -> DataFrame:
    """First arrival per event id; state is kept for the lateness only."""
    return watermarked(events, lateness, ts).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(events: DataFrame, width: str, by: Iterable[str] = ("object_type",),
                    lateness: str = LATENESS, ts: str = "event_timestamp") -> DataFrame:
    """Streaming form of ``tumbling_counts``: append mode emits a window when it closes."""
    return quality.tumbling_counts(watermarked(events, lateness, ts), width, by, ts)

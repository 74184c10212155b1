"""Stored state over several batches: what was redelivered, versions merged batch by batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmflow.operators import history as h
from crmflow.plans.catalog import query
from crmflow.plans.feed import FEED_SQL, TRACKED, events, numbered_events, result, state_feed
from crmflow.session import reliable, shared_path
from crmflow.sources.seen import SeenIds
from crmflow.sources.versions import VersionsTable
from crmflow.streaming.windows import WindowJob

# Three deliveries of the events as (versions of the message, condition on k): ids come again with the
# same and with another content, in the same and in later deliveries.
DELIVERIES = (
    (("a", "k < 60"), ("b", "k BETWEEN 20 AND 24")),
    (("a", "k >= 40"), ("b", "k BETWEEN 10 AND 24"), ("c", "k = 99")),
    (("a", "k >= 90"), ("b", "k < 15"), ("c", "k BETWEEN 95 AND 99")),
)
_DELIVERY_SQL = " UNION ALL ".join(
    f"SELECT {i} AS batch, event_id, '{version}' AS version FROM e WHERE {condition}"
    for i, parts in enumerate(DELIVERIES) for version, condition in parts
)


@query(f"""WITH e AS (SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events),
delivered AS (SELECT DISTINCT * FROM ({_DELIVERY_SQL})),
came AS (SELECT *, min(batch) OVER (PARTITION BY event_id, version) AS first_batch,
  first_value(version) OVER (PARTITION BY event_id ORDER BY batch, version) AS winner FROM delivered)
SELECT batch, event_id, version, CASE WHEN first_batch < batch THEN 'repeated' WHEN version <> winner THEN 'conflict'
  ELSE 'first' END AS arrival FROM came""")
def redelivered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivered message with what the ledger of earlier deliveries says of it."""
    ledger = SeenIds(spark, shared_path(spark, "seen"), fold_every=2)
    rows, judged = numbered_events(spark, sf_dir).select("event_id", "value", "k"), []
    for batch, parts in enumerate(DELIVERIES):
        messages = reduce(DataFrame.unionByName, [
            rows.where(condition).withColumn("version", F.lit(version)) for version, condition in parts])
        text = F.to_json(F.struct("event_id", "version"))
        messages = messages.select("event_id", "version", text.alias("text")).distinct()
        judged.append(reliable(ledger.judge(messages, batch, F.col("event_id"), F.col("text"))))
        ledger.record(judged[-1], batch)
        ledger.fold()
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(batch).alias("batch"), "event_id", "version", "arrival") for batch, df in enumerate(judged)])


@query(f"""WITH {FEED_SQL}
SELECT id, valid_from, valid_to, is_current, change_type, changed_fields, state_type, state_value, event_id FROM versions""")
def scd2_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as stored by three merges out of order, one of them twice: the first two are compacted, the third is pending."""
    feed, _ = state_feed(spark, sf_dir)
    feed = reliable(feed)
    types = {f.name: f.dataType for f in feed.schema.fields}
    table = VersionsTable(
        spark, shared_path(spark, "versions"), types["after"], buckets=4, event_id_type=types["event_id"], compact_after=2)
    moves = h.boundaries(feed, TRACKED)
    turn = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for batch in (0, 1, 1, 2):
        table.merge(moves.where(turn == batch), batch_id=batch)
    state = F.col("record_data")
    return result(table.history().select(
        "id", "valid_from", "valid_to", "is_current", "change_type", F.concat_ws(",", "changed_fields").alias("changed_fields"),
        state["event_type"].alias("state_type"), state["value"].alias("state_value"), "event_id"))


# Days of the month that three deliveries bring; one event in seven comes with the delivery after its own.
_ARRIVALS_SQL = """
e AS (SELECT event_id, event_type, ts, least(2, CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END
  + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS batch FROM events),
tops AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch) AS until FROM e GROUP BY batch),
marks AS (SELECT batch, until - INTERVAL 600 SECOND AS watermark, lag(until) OVER (ORDER BY batch) - INTERVAL 600 SECOND AS before FROM tops),
placed AS (SELECT e.*, date_trunc('hour', ts) AS window_start, before, coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR <= before, FALSE) AS late
  FROM e JOIN marks USING (batch)),
counts AS (SELECT window_start, event_type, count(*) AS n FROM placed WHERE NOT late GROUP BY ALL)"""


@query(f"""WITH {_ARRIVALS_SQL},
ended AS (SELECT window_start, event_type, n, (SELECT min(batch) FROM marks WHERE watermark >= window_start + INTERVAL 1 HOUR) AS batch FROM counts)
SELECT CASE WHEN batch IS NULL THEN 'open' ELSE 'closed' END AS state, batch, window_start, event_type, n FROM ended
UNION ALL SELECT 'late', batch, window_start, event_type, count(*) FROM placed WHERE late GROUP BY ALL""")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts over three deliveries: each window with the batch that closed it, open windows, late rows."""
    job = WindowJob(spark, shared_path(spark, "windows"), "1 hour", "600 seconds", ("event_type",), "ts")
    day, rows = F.dayofmonth("ts"), events(spark, sf_dir).select("event_id", "event_type", "ts")
    own = F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    rows = rows.withColumn("batch", F.least(F.lit(2), own))
    for batch in (0, 1, 1, 2):
        job.batch(rows.where(F.col("batch") == batch).drop("batch"), batch)
    late = spark.read.schema("window_start timestamp, event_type string, batch_id long").parquet(f"{job.base}/late")
    parts = [
        job.closed().select(F.lit("closed").alias("state"), F.col("batch_id").alias("batch"), "window_start", "event_type", "n"),
        job.open().select(F.lit("open").alias("state"), F.lit(None).cast("long").alias("batch"), "window_start", "event_type", "n"),
        late.groupBy(F.lit("late").alias("state"), F.col("batch_id").alias("batch"), "window_start", "event_type").agg(F.count("*").alias("n")),
    ]
    return result(reduce(DataFrame.unionByName, parts))

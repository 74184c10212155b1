"""Change data capture and history over the events table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmflow.functions.rules import apply_rules, codes, history_rules
from crmflow.functions.values import FEED_METADATA_FIELDS, changed_fields, field_changes, once
from crmflow.operators import history as h
from crmflow.operators import quality
from crmflow.plans.catalog import query
from crmflow.plans.feed import (
    FEED_SQL, OPPORTUNITY_SQL, TRACKED, as_of, events, opportunities, record_id, result, state_feed,
)
from crmflow.session import reliable

_VERSION_SQL = f"""WITH {FEED_SQL}
SELECT id, valid_from, valid_to, is_current, change_type, changed_fields, state_type, state_value FROM versions"""


def _joined(values: Column) -> Column:
    return F.array_join(values, ",")


def _flat(history: DataFrame) -> DataFrame:
    return result(history.select(
        "id", "valid_from", "valid_to", "is_current", "change_type",
        _joined(F.col("changed_fields")).alias("changed_fields"),
        F.col("record_data.event_type").alias("state_type"), F.col("record_data.value").alias("state_value"),
    ))


@query(_VERSION_SQL)
def scd2_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full history of the feed."""
    feed, hot = state_feed(spark, sf_dir)
    return _flat(h.apply_scd2(feed, hot, TRACKED))


@query(_VERSION_SQL)
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history in two merges: low values first, then high ones (late, interleaved in
    time) with all purchases replayed."""
    feed, hot = state_feed(spark, sf_dir)
    moves = reliable(h.boundaries(feed, TRACKED))
    low = F.col("record_data.value") < 50
    first, second = moves.where(low), moves.where(~low | (F.col("record_data.event_type") == "purchase"))
    store = reliable(h.as_history(h.chain(first, hot), emit_tombstones=True))
    return _flat(h.without_tombstones(h.merged_store(store, second, hot)))


def tied_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events at full hours with repeated and null ids: purchases delete, all others insert."""
    gone = F.col("event_type") == "purchase"
    state = F.struct("event_type", "value")
    return events(spark, sf_dir).select(
        F.when(F.col("event_id") % 3 != 0, F.floor(F.col("event_id") / 4)).alias("event_id"),
        record_id().alias("record_id"), F.when(gone, "DELETE").otherwise("INSERT").alias("event_type"),
        F.date_trunc("hour", "ts").alias("event_timestamp"),
        F.when(gone, state).alias("before"), F.when(~gone, state).alias("after"),
    )


@query("""WITH rows AS (
  SELECT CASE WHEN event_id % 3 <> 0 THEN event_id // 4 END AS eid, lpad(user_id::VARCHAR, 15, '0') AS id,
    CASE WHEN event_type = 'purchase' THEN 'DELETE' ELSE 'INSERT' END AS change_type,
    date_trunc('hour', ts) AS valid_from, event_type AS state_type, value AS state_value FROM events
), moves AS (
  SELECT * FROM rows WHERE eid IS NULL AND id IS NOT NULL UNION ALL
  SELECT * FROM rows WHERE eid IS NOT NULL AND id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY eid ORDER BY valid_from, id, change_type, state_type NULLS FIRST, state_value NULLS FIRST) = 1
), lasts AS (
  SELECT * FROM moves QUALIFY row_number() OVER (PARTITION BY id, valid_from ORDER BY eid DESC NULLS LAST,
    change_type DESC, state_type DESC NULLS LAST, state_value DESC NULLS LAST) = 1
), chained AS (SELECT *, lead(valid_from) OVER (PARTITION BY id ORDER BY valid_from) AS valid_to FROM lasts)
SELECT id, valid_from, valid_to, valid_to IS NULL AS is_current, eid AS event_id, state_type, state_value
FROM chained WHERE change_type <> 'DELETE'""")
def scd2_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of events that share instants and event ids, or have none."""
    feed = tied_events(spark, sf_dir)
    versions = h.apply_scd2(feed, h.hot_records(feed), repeated_ids=True)
    return result(versions.select(
        "id", "valid_from", "valid_to", "is_current", "event_id",
        F.col("record_data.event_type").alias("state_type"), F.col("record_data.value").alias("state_value"),
    ))


@query(f"""WITH {FEED_SQL}
SELECT count(*) AS total_events, count(DISTINCT record_id) AS records_processed,
  count(*) FILTER (change_type = 'INSERT') AS records_inserted,
  count(*) FILTER (change_type = 'UPDATE' AND before_type IS DISTINCT FROM state_type) AS records_updated,
  count(*) FILTER (change_type <> 'INSERT' AND is_first) AS errors
FROM changes""")
def scd2_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch statistics of the history path."""
    feed, _ = state_feed(spark, sf_dir)
    return h.scd2_stats(feed, TRACKED)


@query(f"""WITH {FEED_SQL}
SELECT event_id, concat_ws(',', CASE WHEN before_type IS DISTINCT FROM state_type THEN 'event_type' END,
    CASE WHEN before_value IS DISTINCT FROM state_value THEN 'value' END) AS changed_fields,
  before_type IS DISTINCT FROM state_type OR before_value IS DISTINCT FROM state_value AS has_changes
FROM changes""")
def detect_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difference of semi-structured states; metadata members never count."""
    feed, _ = state_feed(spark, sf_dir)
    stamped = feed.withColumns({
        "before": F.to_variant_object(F.when(F.col("before").isNotNull(), F.struct("before.*", F.lit("a").alias("source")))),
        "after": F.to_variant_object(F.struct("after.*", F.lit("b").alias("source"))),
    })
    found = once(stamped, {"changed": changed_fields(stamped)})
    changed = F.col("changed")
    return found.select("event_id", _joined(changed).alias("changed_fields"), (F.size(changed) > 0).alias("has_changes"))


@query(f"""WITH {FEED_SQL}, each_field AS (
  SELECT change_type, 'event_type' AS field FROM changes WHERE before_type IS DISTINCT FROM state_type
  UNION ALL SELECT change_type, 'value' FROM changes WHERE before_value IS DISTINCT FROM state_value)
SELECT change_type, field, count(*) AS events FROM each_field GROUP BY ALL""")
def changed_fields_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each field changes, by kind of change."""
    feed, _ = state_feed(spark, sf_dir)
    changed = changed_fields(feed, skip=FEED_METADATA_FIELDS)
    return (
        feed.select(F.col("event_type").alias("change_type"), F.explode(changed).alias("field"))
        .groupBy("change_type", "field").agg(F.count("*").alias("events"))
    )


@query(f"""WITH {FEED_SQL}
SELECT event_id, before_type, before_value, state_type AS after_type, state_value AS after_value FROM changes""")
def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both states of every change."""
    feed, _ = state_feed(spark, sf_dir)
    return feed.select(
        "event_id", F.col("before.event_type").alias("before_type"), F.col("before.value").alias("before_value"),
        F.col("after.event_type").alias("after_type"), F.col("after.value").alias("after_value"),
    )


@query(f"""WITH {FEED_SQL}
SELECT record_id AS id, ts AS valid_from, FALSE AS is_closed, TRUE AS is_current, change_type,
  CASE WHEN change_type = 'UPDATE' THEN 1 ELSE 0 END AS n_changed,
  CASE WHEN change_type = 'DELETE' THEN before_type ELSE state_type END AS state_type,
  CASE WHEN change_type = 'DELETE' THEN before_value ELSE state_value END AS state_value,
  TIMESTAMP '2024-02-01' AS ingestion_timestamp
FROM changes""")
def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One open history row per change event, its states as JSON text."""
    feed, _ = state_feed(spark, sf_dir)
    listed = F.when(F.col("event_type") == "UPDATE", F.array(F.lit("value")))
    rows = h.history_record(feed.withColumn("changed_fields", listed), as_of())
    return result(rows.select(
        "id", "valid_from", F.col("valid_to").isNotNull().alias("is_closed"), "is_current", "change_type",
        F.json_array_length("changed_fields").alias("n_changed"),
        F.get_json_object("record_data", "$.event_type").alias("state_type"),
        F.get_json_object("record_data", "$.value").cast("double").alias("state_value"),
        "ingestion_timestamp",
    ))


@query(f"""WITH {FEED_SQL}, dirty AS (
  SELECT id, valid_from, CASE WHEN state_value > 100 THEN valid_from - INTERVAL 1 SECOND ELSE valid_to END AS valid_to,
    CASE WHEN state_value < 1 THEN NOT is_current ELSE is_current END AS is_current,
    CASE WHEN state_type = 'signup' THEN 'MERGE' ELSE change_type END AS change_type FROM versions)
SELECT id, valid_from, concat_ws(',', CASE WHEN NOT (valid_to IS NULL OR valid_from < valid_to) THEN 'valid_dates' END,
    CASE WHEN change_type = 'MERGE' THEN 'valid_change_type' END,
    CASE WHEN is_current <> (valid_to IS NULL) THEN 'current_record_validation' END) AS codes
FROM dirty""")
def history_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row rules of a history table, on versions with faults put in."""
    feed, hot = state_feed(spark, sf_dir)
    state = F.col("record_data")
    dirty = h.apply_scd2(feed, hot, TRACKED).withColumns({
        "valid_to": F.when(state["value"] > 100, F.col("valid_from") - F.expr("interval 1 second")).otherwise(F.col("valid_to")),
        "is_current": F.when(state["value"] < 1, ~F.col("is_current")).otherwise(F.col("is_current")),
        "change_type": F.when(state["event_type"] == "signup", "MERGE").otherwise(F.col("change_type")),
    })
    return result(dirty.select("id", "valid_from", _joined(codes(apply_rules(history_rules()))).alias("codes")))


@query(f"""WITH {FEED_SQL}
SELECT id, count(*) AS n FROM versions WHERE is_current OR change_type = 'INSERT' GROUP BY id HAVING count(*) > 1""")
def history_single_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with several current rows, on versions whose first row was never closed."""
    feed, hot = state_feed(spark, sf_dir)
    unclosed = F.col("is_current") | (F.col("change_type") == "INSERT")
    return quality.history_problems(h.apply_scd2(feed, hot, TRACKED).withColumn("is_current", unclosed))


@query(f"""WITH {FEED_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY ts DESC, event_id DESC) AS rn FROM changes)
SELECT record_id, change_type AS event_type, ts AS event_timestamp, state_type, state_value
FROM ranked WHERE rn = 1 AND change_type <> 'DELETE'""")
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state per record; deleted records are gone."""
    feed, _ = state_feed(spark, sf_dir)
    return result(h.current_state(feed).select(
        "record_id", "event_type", "event_timestamp",
        F.col("after.event_type").alias("state_type"), F.col("after.value").alias("state_value"),
    ))


@query(_VERSION_SQL + " WHERE is_current")
def current_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows of the history."""
    feed, hot = state_feed(spark, sf_dir)
    return _flat(h.current_view(h.apply_scd2(feed, hot, TRACKED)))


@query(f"""WITH {OPPORTUNITY_SQL}, a AS (SELECT * FROM opportunities WHERE amount < 400000),
b AS (SELECT id, CASE WHEN stage_name = '' THEN 'Closed Won' ELSE stage_name END AS stage_name,
        CASE WHEN amount < 1000 THEN amount + 1 ELSE amount END AS amount
      FROM opportunities WHERE created_date >= DATE '1995-06-01'),
d AS (SELECT coalesce(a.id, b.id) AS record_id,
        CASE WHEN a.id IS NULL THEN 'INSERT' WHEN b.id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS event_type,
        CASE WHEN a.id IS NULL OR b.id IS NULL THEN '' ELSE
          concat_ws(',', CASE WHEN a.amount IS DISTINCT FROM b.amount THEN 'amount' END,
            CASE WHEN a.stage_name IS DISTINCT FROM b.stage_name THEN 'stage_name' END) END AS changed_fields,
        a.stage_name AS before_stage, b.stage_name AS after_stage
      FROM a FULL OUTER JOIN b ON a.id = b.id)
SELECT * FROM d WHERE event_type <> 'UPDATE' OR changed_fields <> ''""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events between two snapshots of orders."""
    rows = opportunities(spark, sf_dir).select("id", "stage_name", "amount", "created_date")
    before = rows.where(F.col("amount") < 400000).drop("created_date")
    after = rows.where(F.col("created_date") >= "1995-06-01").select(
        "id", F.when(F.col("stage_name") == "", "Closed Won").otherwise(F.col("stage_name")).alias("stage_name"),
        F.when(F.col("amount") < 1000, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(38,9)").alias("amount"),
    )
    diff = h.snapshot_diff(before, after, "id")
    return diff.select(
        "record_id", "event_type", _joined(F.col("changed_fields")).alias("changed_fields"),
        F.col("before.stage_name").alias("before_stage"), F.col("after.stage_name").alias("after_stage"),
    )


@query(f"""WITH {FEED_SQL}, facts AS (
  SELECT event_id, lpad(CAST(user_id AS VARCHAR), 15, '0') AS record_id, ts + INTERVAL 30 MINUTE AS at FROM events)
SELECT f.event_id, f.record_id, f.at, v.valid_from, v.state_type
FROM facts f JOIN versions v ON v.id = f.record_id AND f.at >= v.valid_from AND (v.valid_to IS NULL OR f.at < v.valid_to)""")
def history_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version of each user that was valid half an hour after each event."""
    feed, hot = state_feed(spark, sf_dir)
    history = h.apply_scd2(feed, hot, TRACKED)
    facts = events(spark, sf_dir).select(
        "event_id", record_id().alias("record_id"), (F.col("ts") + F.expr("interval 30 minutes")).alias("at")
    )
    found = h.as_of_join(facts, history, "record_id", "at", ["record_data"], ["event_id"], hot)
    return result(found.select("event_id", "record_id", "at", "valid_from",
                               F.col("record_data.event_type").alias("state_type")))


@query(f"""WITH {FEED_SQL}, sides AS (
  SELECT event_id, 'event_type' AS field, '"' || before_type || '"' AS before, '"' || state_type || '"' AS after FROM changes
  WHERE before_type IS DISTINCT FROM state_type
  UNION ALL SELECT event_id, 'value', CAST(before_value IS NOT NULL AS VARCHAR), CAST(state_value IS NOT NULL AS VARCHAR) FROM changes
  WHERE before_value IS DISTINCT FROM state_value)
SELECT * FROM sides""")
def field_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each field that differs with its old and new text; numbers, whose texts engines write in their own ways, as present or not."""
    feed, _ = state_feed(spark, sf_dir)
    states = once(feed, {
        "before": F.to_variant_object(F.when(F.col("before").isNotNull(), F.col("before"))), "after": F.to_variant_object("after")})
    changes = once(states, {"changed": changed_fields(states)})
    rows = changes.select("event_id", F.explode(field_changes(F.col("changed"), F.col("before"), F.col("after"))).alias("field", "sides"))

    def shown(side: str) -> Column:
        text = F.col(f"sides.{side}")
        return F.when(F.col("field") == "value", text.isNotNull().cast("string")).otherwise(text).alias(side)

    return rows.select("event_id", "field", shown("before"), shown("after"))

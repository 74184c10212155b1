"""Validation, routing, alert and table-quality queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmflow.functions.rules import (
    EVENT_ID_CHARS, RECORD_RULES, apply_rules, codes, messages, with_cdc_errors, with_schema_errors,
)
from crmflow.functions.values import iso_text, once
from crmflow.operators import parse, quality, routing
from crmflow.plans.catalog import query
from crmflow.plans.feed import (
    ACCOUNT_SQL, CASE_SQL, CONTACT_SQL, DIRTY_SQL, OBJECT_TABLES, OPPORTUNITY_SQL, accounts, as_of,
    cdc_messages, events, opportunities, result, table,
)
from crmflow.registry import OBJECTS
from crmflow.sources.readers import spread


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_messages(cdc_messages(spark, sf_dir), as_of())
    return routing.validate_events(parse.envelope(parsed), as_of())


def _joined_codes(errors: Column) -> Column:
    return F.array_join(F.array_distinct(codes(errors)), ",")


@query(f"WITH {DIRTY_SQL} SELECT eid AS event_id, codes, n_errors = 0 AS is_valid FROM checked")
def validate_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight rules on every change event."""
    return _validated(spark, sf_dir).select("event_id", _joined_codes(F.col("errors")).alias("codes"), "is_valid")


@query(f"""WITH {DIRTY_SQL}
SELECT CASE k WHEN 29 THEN 'Invalid event_timestamp format' WHEN 31 THEN 'event_timestamp is in the future'
  ELSE 'event_timestamp is too old' END AS problem, count(*) AS events
FROM cdc WHERE NOT broken AND k IN (29, 31, 37) GROUP BY 1""")
def stale_or_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed, future and stale event times."""
    rows = parse.envelope(parse.parse_messages(cdc_messages(spark, sf_dir), as_of()))
    checked = with_cdc_errors(rows, as_of(), ["validate_timestamp_format"])
    found = checked.select(F.explode(messages(F.col("errors"))).alias("message"))
    return found.groupBy(F.substring_index("message", ":", 1).alias("problem")).agg(F.count("*").alias("events"))


@query(f"WITH {DIRTY_SQL} SELECT count(*) AS total_events, count(*) FILTER (n_errors = 0) AS valid_events, "
       "count(*) FILTER (n_errors > 0) AS invalid_events, count(*) FILTER (n_errors > 0) / count(*) AS error_rate, "
       "count(*) FILTER (n_errors > 0) / count(*) > 0.05 AS exceeds_threshold FROM checked")
def validation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation statistics and the alert decision."""
    return quality.validation_stats(_validated(spark, sf_dir))


@query(f"""WITH {DIRTY_SQL}
SELECT code, count(*) AS events FROM (SELECT unnest(string_split(codes, ',')) AS code FROM checked WHERE n_errors > 0) GROUP BY code""")
def error_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per failed rule."""
    return quality.error_types(_validated(spark, sf_dir))


@query(f"""WITH {DIRTY_SQL}
SELECT count(*) AS total, count(*) FILTER (n_errors > 0) AS invalid,
  round(100.0 * count(*) FILTER (n_errors > 0) / count(*), 6) AS error_percent,
  100.0 * count(*) FILTER (n_errors > 0) / count(*) <= 5 AS passed FROM checked""")
def threshold_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a write would be committed at 5 percent bad rows."""
    return quality.threshold_gate(_validated(spark, sf_dir)).withColumn("error_percent", F.round("error_percent", 6))


@query(f"""WITH {DIRTY_SQL}, timed AS (
  SELECT n_errors, CASE WHEN k = 31 THEN TIMESTAMP '2099-12-31 23:59:59' WHEN k = 37 THEN TIMESTAMP '2020-01-01' ELSE ts END AS happened
  FROM checked WHERE k <> 29)
SELECT time_bucket(INTERVAL 1 HOUR, happened, TIMESTAMP '1970-01-01') AS window_start, count(*) AS total_events,
  count(*) FILTER (n_errors > 0) AS invalid_events, count(*) FILTER (n_errors > 0) / count(*) AS error_rate,
  count(*) FILTER (n_errors > 0) / count(*) > 0.05 AS alert FROM timed GROUP BY 1""")
def windowed_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly error rates with the alert flag."""
    return result(quality.windowed_error_rate(_validated(spark, sf_dir), "1 hour"))


@query(f"""WITH {DIRTY_SQL}
SELECT 'data_quality_violation' AS alert_type, 'ERROR' AS severity, TIMESTAMP '2024-02-01' AS timestamp, eid AS event_id,
  obj AS object_type, rid AS record_id, n_errors, eid AS event_id_in_data FROM checked WHERE n_errors > 0""")
def dq_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert per invalid event, with the whole event inside."""
    alerts = routing.quality_alerts(_validated(spark, sf_dir), as_of())
    return result(alerts.select(
        "alert_type", "severity", "timestamp", "event_id", "object_type", "record_id",
        F.size("validation_errors").alias("n_errors"),
        F.try_variant_get("event_data", "$.event_id", "string").alias("event_id_in_data"),
    ))


@query(f"WITH {DIRTY_SQL} SELECT CASE WHEN n_errors = 0 THEN 'valid' ELSE 'invalid' END AS route, obj AS object_type, count(*) AS n FROM checked GROUP BY ALL")
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per route and object."""
    return _validated(spark, sf_dir).groupBy("route", "object_type").agg(F.count("*").alias("n"))


@query(f"""WITH {DIRTY_SQL}
SELECT CASE obj WHEN 'Lead' THEN 'unknown' WHEN 'Case' THEN 'disabled' ELSE obj END AS table_route,
  obj IN ('Account', 'Case') AS to_history, count(*) AS n FROM checked GROUP BY ALL""")
def route_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object routes with Case switched off and history kept for Account and Case."""
    routed = routing.route_by_object(
        parse.envelope(parse.parse_messages(cdc_messages(spark, sf_dir), as_of())),
        enabled=("Account", "Contact", "Opportunity"), tracked=("Account", "Case"),
    )
    return routed.groupBy("table_route", "to_history").agg(F.count("*").alias("n"))


def text_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opportunities as arrived: small orders lack the id, some statuses have malformed times."""
    rows = opportunities(spark, sf_dir)
    stamp = iso_text(F.col("created_date"))
    return rows.select(
        F.when(F.col("amount") > 1000, F.col("id")).otherwise("").alias("id"), "name",
        F.when(F.col("stage_name") == "", "sometime").otherwise(stamp).alias("created_date"),
        F.when(F.col("probability") == 90, "").otherwise(stamp).alias("last_modified_date"),
        F.when(F.col("probability") == 75, "2023").alias("system_modstamp"),
    )


@query(f"""WITH {OPPORTUNITY_SQL}
SELECT name, concat_ws(',', CASE WHEN amount <= 1000 THEN 'Null primary key: id' END,
    CASE WHEN stage_name = '' THEN 'Invalid timestamp format: created_date' END,
    CASE WHEN probability = 75 THEN 'Invalid timestamp format: system_modstamp' END) AS errors,
  NOT (amount <= 1000 OR stage_name = '' OR probability = 75) AS is_valid, TIMESTAMP '2024-02-01' AS validated
FROM opportunities""")
def validate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch validation of opportunities as text; invalid rows are kept."""
    rows = quality.validate_batch(text_opportunities(spark, sf_dir), as_of())
    return result(rows.select("name", F.array_join("_validation_errors", ",").alias("errors"),
                              F.col("_is_valid").alias("is_valid"), F.col("_validation_timestamp").alias("validated")))


@query(f"""WITH {OPPORTUNITY_SQL}
SELECT o_orderkey AS "row", concat_ws(',', CASE WHEN stage_name = '' THEN 'Missing required field: stage_name' END,
    CASE WHEN probability = 110 THEN 'Missing required field: system_modstamp' END,
    CASE WHEN amount <= 1000 THEN 'Invalid type for id: expected STRING' END,
    CASE WHEN probability = 90 THEN 'Invalid type for amount: expected NUMERIC' END,
    CASE WHEN stage_name = 'Closed Won' THEN 'Invalid type for is_won: expected BOOLEAN' END) AS errors
FROM opportunities""")
def validate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required fields and JSON types of opportunities as semi-structured records."""
    rows = spread(opportunities(spark, sf_dir))
    number = F.col("amount").cast("decimal(18,2)")
    record = F.concat(
        F.lit('{"id":'), F.when(F.col("amount") <= 1000, F.lit("7")).otherwise(F.concat(F.lit('"'), F.col("id"), F.lit('"'))),
        F.lit(',"name":"'), F.col("name"), F.lit('","stage_name":"'), F.col("stage_name"), F.lit('","amount":'),
        F.when(F.col("probability") == 90, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number.cast("string")),
        F.lit(',"is_won":'), F.when(F.col("is_won"), F.lit("1")).otherwise("null"),
        F.lit(',"created_date":"2024-01-01T00:00:00Z","last_modified_date":"2024-01-01T00:00:00Z"'),
        F.when(F.col("probability") == 110, F.lit("")).otherwise(',"system_modstamp":"2024-01-01T00:00:00Z"'), F.lit("}"),
    )
    parsed = once(rows, {"record": F.try_parse_json(record)})
    checked = with_schema_errors(parsed, OBJECTS["Opportunity"], "record")
    return checked.select(F.substring(F.col("id"), 4, 15).cast("long").alias("row"),
                          F.array_join(messages(F.col("errors")), ",").alias("errors"))


def _broken(df: DataFrame, name: str) -> DataFrame:
    """Rows that break a record rule, with the rules' codes."""
    checked = df.withColumn("errors", apply_rules(RECORD_RULES[name]()))
    return checked.where(F.size("errors") > 0).select("id", F.array_join(codes(F.col("errors")), ",").alias("codes"))


@query(f"""WITH {ACCOUNT_SQL}, c AS (SELECT id, concat_ws(',', CASE WHEN trim(name) = '' THEN 'required_field' END,
  CASE WHEN type = 'Household' THEN 'valid_account_type' END, CASE WHEN annual_revenue < 0 THEN 'valid_revenue' END,
  CASE WHEN phone = '555-0100' THEN 'valid_phone_format' END, CASE WHEN website LIKE 'ftp%' THEN 'valid_website_format' END) AS codes
  FROM accounts) SELECT * FROM c WHERE codes <> ''""")
def rules_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account rules."""
    return _broken(accounts(spark, sf_dir), "Account")


@query(f"""WITH {CONTACT_SQL}, c AS (SELECT id, concat_ws(',', CASE WHEN email NOT LIKE '%@%' THEN 'required_email' END,
  CASE WHEN trim(first_name) = '' THEN 'valid_name_format' END, CASE WHEN title = 'Intern' THEN 'valid_title' END) AS codes
  FROM contacts) SELECT * FROM c WHERE codes <> ''""")
def rules_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact rules."""
    return _broken(OBJECT_TABLES["Contact"](spark, sf_dir), "Contact")


@query(f"""WITH {OPPORTUNITY_SQL}, c AS (SELECT id, concat_ws(',', CASE WHEN stage_name = '' THEN 'required_stage' END,
  CASE WHEN probability > 100 THEN 'valid_probability' END, CASE WHEN amount < 0 THEN 'valid_amount' END,
  CASE WHEN close_date < CAST(created_date AS DATE) THEN 'valid_close_date' END) AS codes
  FROM opportunities) SELECT * FROM c WHERE codes <> ''""")
def rules_opportunity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opportunity rules."""
    return _broken(opportunities(spark, sf_dir), "Opportunity")


@query(f"""WITH {CASE_SQL}, c AS (SELECT id, concat_ws(',', CASE WHEN trim(subject) = '' THEN 'required_subject' END,
  CASE WHEN status = 'Returned' THEN 'valid_status' END, CASE WHEN priority = 'Urgent' THEN 'valid_priority' END,
  CASE WHEN origin = 'Fax' THEN 'valid_origin' END) AS codes
  FROM cases) SELECT * FROM c WHERE codes <> ''""")
def rules_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case rules."""
    return _broken(OBJECT_TABLES["Case"](spark, sf_dir), "Case")


@query(f"WITH {CASE_SQL} SELECT id, count(*) AS n FROM cases GROUP BY id HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case ids that occur more than once."""
    return quality.duplicate_keys(OBJECT_TABLES["Case"](spark, sf_dir), ["id"])


@query("SELECT event_id, ts AS event_timestamp, event_type, value, ts AS arrived FROM events")
def dedup_event_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered twice, kept once."""
    once = events(spark, sf_dir).select(
        "event_id", F.col("ts").alias("event_timestamp"), "event_type", "value", F.col("ts").alias("arrived")
    )
    again = once.withColumn("arrived", F.col("arrived") + F.expr("interval 5 minutes"))
    return result(quality.deduplicate(again.unionByName(once), "event_id"))


@query(f"""WITH {ACCOUNT_SQL}, {OPPORTUNITY_SQL}
SELECT o.id, o.account_id FROM opportunities o
WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.id = o.account_id AND a.annual_revenue > 0)""")
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opportunities whose account is not among the accounts with revenue."""
    parents = accounts(spark, sf_dir).where(F.col("annual_revenue") > 0)
    children = opportunities(spark, sf_dir).select("id", "account_id")
    return quality.orphans(children, "account_id", parents, "id").select("id", "account_id")


@query(f"""WITH {DIRTY_SQL}, r AS (SELECT k, CASE WHEN k < 3 THEN NULL WHEN k = 5 THEN 'bad id' ELSE eid END AS rule_id FROM cdc)
SELECT 'completeness' AS rule, round(avg(CASE WHEN rule_id IS NOT NULL AND k <> 29 THEN 1 ELSE 0 END), 9) AS pass_ratio,
  avg(CASE WHEN rule_id IS NOT NULL AND k <> 29 THEN 1 ELSE 0 END) > 0.95 AS passed FROM r
UNION ALL
SELECT 'validity', round(avg(CASE WHEN regexp_matches(rule_id, '^[a-zA-Z0-9_-]+$') THEN 1 ELSE 0 END), 9),
  avg(CASE WHEN regexp_matches(rule_id, '^[a-zA-Z0-9_-]+$') THEN 1 ELSE 0 END) > 0.98 FROM r""")
def dq_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness and validity ratios of the events table."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events(spark, sf_dir).select(
        F.when(k < 3, None).when(k == 5, "bad id").otherwise(F.concat(F.lit("EVT-"), F.col("event_id"))).alias("event_id"),
        F.when(k != 29, F.col("ts")).alias("timestamp"),
    )
    rules = {
        "completeness": (F.col("event_id").isNotNull() & F.col("timestamp").isNotNull(), quality.COMPLETENESS),
        "validity": (F.col("event_id").rlike(EVENT_ID_CHARS), quality.VALIDITY),
    }
    return quality.row_rules(rows, rules).withColumn("pass_ratio", F.round("pass_ratio", 9))


@query("""WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT event_type, n, round(n * 100.0 / sum(n) OVER (), 1) AS percent FROM c""")
def event_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type with their share."""
    return quality.distribution(table(spark, sf_dir, "events"), "event_type")


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumnRenamed("ts", "event_timestamp")


@query("SELECT time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n FROM events GROUP BY 1")
def tumbling_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per raw window."""
    return result(quality.tumbling_counts(_timed(spark, sf_dir), "10 seconds"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per history window and type."""
    return result(quality.tumbling_counts(_timed(spark, sf_dir), "1 hour", ["event_type"]))


@query("""WITH m AS (SELECT date_trunc('minute', ts) AS m, count(*) AS n FROM events GROUP BY 1)
SELECT count(*) AS minutes, round(avg(n), 9) AS mean_per_minute FROM m""")
def throughput_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean events per minute."""
    return quality.throughput(_timed(spark, sf_dir)).withColumn("mean_per_minute", F.round("mean_per_minute", 9))


def _arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an arrival time ``value`` seconds times ten later."""
    delay = F.make_dt_interval(secs=(F.col("value") * 10).cast("decimal(18,6)"))
    return _timed(spark, sf_dir).withColumn("arrived", F.col("event_timestamp") + delay)


@query("SELECT event_id, ts AS event_timestamp, value FROM events WHERE value * 10 > 600")
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events beyond the allowed lateness."""
    late = quality.late_events(_arrived(spark, sf_dir), "event_timestamp", "arrived")
    return result(late.select("event_id", "event_timestamp", "value"))


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, round(max(value) * 10, 3) AS lag_seconds,
  max(value) * 10 > 300 AS alert FROM events GROUP BY 1""")
def lag_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest lag per hour and whether it alerts."""
    rows = quality.lag_alerts(_arrived(spark, sf_dir), "1 hour", "event_timestamp", "arrived")
    return result(rows.withColumn("lag_seconds", F.round("lag_seconds", 3)))


@query(f"""WITH {DIRTY_SQL}
SELECT count(*) AS events_received, count(*) FILTER (n_errors = 0) AS events_processed, CAST(sum(n_errors) AS BIGINT) AS validation_errors,
  count(*) FILTER (n_errors = 0 AND kind = 'INSERT') AS records_inserted,
  count(*) FILTER (n_errors = 0 AND kind <> 'INSERT') AS history_updates,
  round(epoch(TIMESTAMP '2024-02-01' - min(ts) FILTER (n_errors = 0)), 3) AS max_latency_seconds FROM checked""")
def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's metrics in one pass."""
    rows = _validated(spark, sf_dir).agg(*quality.metric_columns(as_of()))
    return rows.withColumn("max_latency_seconds", F.round("max_latency_seconds", 3))

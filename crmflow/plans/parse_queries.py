"""Parsing, extraction, typing and message queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmflow.functions.values import encode_nested, snake_case
from crmflow.operators import parse, quality
from crmflow.operators.query import union_raw
from crmflow.plans.catalog import query
from crmflow.plans.feed import (
    ACCOUNT_SQL, CASE_SQL, CONTACT_SQL, DIRTY_SQL, OBJECT_TABLES, OPPORTUNITY_SQL, as_of, cdc_messages,
    generic_messages, opportunities, result, table,
)
from crmflow.registry import BATCH_META, to_api_names
from crmflow.sources.readers import extract_all, extract_envelopes

_SIDES = """kind <> 'INSERT' AND k <> 61 AS has_before, kind <> 'DELETE' AND k <> 59 AS has_after"""
_TIME = """CASE WHEN k = 29 THEN NULL WHEN k = 31 THEN TIMESTAMP '2099-12-31 23:59:59'
  WHEN k = 37 THEN TIMESTAMP '2020-01-01' ELSE ts END"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.envelope(parse.parse_messages(cdc_messages(spark, sf_dir), as_of()))


@query(f"""WITH {DIRTY_SQL}
SELECT eid AS event_id, kind AS event_type, obj AS object_type, rid AS record_id, {_TIME} AS event_timestamp,
  {_SIDES}, 'salesforce_cdc' AS source FROM cdc WHERE NOT broken""")
def cdc_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages as envelope columns."""
    return result(_events(spark, sf_dir).select(
        "event_id", "event_type", "object_type", "record_id", "event_timestamp",
        F.col("before").isNotNull().alias("has_before"), F.col("after").isNotNull().alias("has_after"), "source",
    ))


@query(f"""WITH {DIRTY_SQL}
SELECT lpad(CAST(user_id AS VARCHAR), 15, '0') AS id, 'Name ' || user_id AS name,
  CASE WHEN kind = 'DELETE' THEN 0 ELSE value END AS annual_revenue, ts AS created_date,
  CASE WHEN kind <> 'DELETE' AND k IN (47, 53) THEN NULL ELSE ts END AS last_modified_date,
  'salesforce_cdc' AS source, eid AS _cdc_event_id, kind AS _cdc_event_type, {_TIME} AS _cdc_event_timestamp
FROM cdc WHERE NOT broken AND obj = 'Account' AND kind IN ('INSERT', 'UPDATE', 'DELETE')
  AND NOT (kind = 'DELETE' AND k = 61) AND NOT (kind <> 'DELETE' AND k = 59)""")
def cdc_extract_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed Account rows of the change events."""
    rows = parse.extract_record(_events(spark, sf_dir), "Account", as_of())
    return result(rows.select(
        "id", "name", F.col("annual_revenue").cast("double").alias("annual_revenue"), "created_date",
        "last_modified_date", "source", "_cdc_event_id", "_cdc_event_type", "_cdc_event_timestamp",
    ))


@query(f"""WITH {DIRTY_SQL}
SELECT eid AS event_id, CASE WHEN k IN (41) THEN 0 WHEN k = 43 THEN 0 WHEN kind = 'UPDATE' THEN 1 ELSE 0 END AS n_fields
FROM cdc WHERE NOT broken""")
def event_changed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of changed fields an event itself carries, empty by default."""
    return _events(spark, sf_dir).select(
        "event_id", F.size(parse.changed_field_list(F.col("changed_fields"))).alias("n_fields")
    )


@query(f"""WITH {DIRTY_SQL}
SELECT 'MSG-' || event_id AS message_id, ts AS publish_time, CASE WHEN k < 20 THEN NULL ELSE obj END AS object_attribute,
  CASE WHEN broken THEN NULL ELSE eid END AS event_id FROM cdc""")
def parse_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message metadata next to the parsed event; empty attributes are absent."""
    parsed = parse.with_message_metadata(parse.parse_messages(cdc_messages(spark, sf_dir), as_of()))
    return result(parsed.select(
        F.col("_pubsub_message_id").alias("message_id"), F.col("_pubsub_publish_time").alias("publish_time"),
        F.try_element_at("_pubsub_attributes", F.lit("object_type")).alias("object_attribute"),
        F.try_variant_get("event", "$.event_id", "string").alias("event_id"),
    ))


_GENERIC = "e AS (SELECT *, CAST(props->>'k' AS INTEGER) AS k FROM events)"


@query(f"""WITH {_GENERIC}
SELECT 'EVT-' || event_id AS event_id, CASE WHEN k < 10 OR k = 11 THEN -1 ELSE k END AS k_in_data,
  TIMESTAMP '2024-02-01' AS ingestion_time FROM e WHERE k NOT IN (71, 73)""")
def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generic messages that parse."""
    parsed = parse.parse_messages(generic_messages(spark, sf_dir), as_of())
    return result(parsed.where(F.col("parse_error").isNull()).select(
        F.try_variant_get("event", "$.event_id", "string").alias("event_id"),
        F.coalesce(F.try_variant_get("event", "$.data.k", "int"), F.lit(-1)).alias("k_in_data"), "ingestion_time",
    ))


@query(f"""WITH {_GENERIC}
SELECT CASE WHEN k = 71 THEN 'invalid json' ELSE 'invalid utf-8' END AS error, count(*) AS messages,
  TIMESTAMP '2024-02-01' AS first_seen FROM e WHERE k IN (71, 73) GROUP BY 1""")
def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters by error."""
    letters = parse.dead_letters(parse.parse_messages(generic_messages(spark, sf_dir), as_of()))
    return result(letters.where(F.length("original_message") > 0).groupBy("error").agg(
        F.count("*").alias("messages"), F.min("timestamp").alias("first_seen")
    ))


@query(f"""WITH {_GENERIC}
SELECT count(*) FILTER (k NOT IN (71, 73)) AS parsed_count, count(*) FILTER (k IN (71, 73)) AS error_count,
  count(*) FILTER (k NOT IN (71, 73)) / count(*) AS success_rate FROM e""")
def parse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parser statistics."""
    return quality.parse_stats(parse.parse_messages(generic_messages(spark, sf_dir), as_of()))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.check_generic(parse.parse_messages(generic_messages(spark, sf_dir), as_of()))


@query(f"""WITH {_GENERIC}
SELECT CASE WHEN k IN (71, 73) THEN 'failed' WHEN k = 79 THEN 'invalid' ELSE 'valid' END AS route, count(*) AS n
FROM e GROUP BY 1""")
def required_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generic events per route."""
    return _checked(spark, sf_dir).groupBy("route").agg(F.count("*").alias("n"))


@query(f"""WITH {_GENERIC}
SELECT 'EVT-' || event_id AS event_id, CASE WHEN k = 83 THEN NULL ELSE event_type END AS event_type, ts AS timestamp,
  'feed' AS source, CASE WHEN k < 10 THEN 0.8 ELSE 1.0 END AS quality_score
FROM e WHERE k NOT IN (71, 73, 79)""")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of raw_events with their score."""
    return result(parse.raw_events(_checked(spark, sf_dir)).select(
        "event_id", "event_type", "timestamp", "source", "quality_score"
    ))


@query(f"""WITH {_GENERIC}
SELECT 'EVT-' || event_id AS id, CASE WHEN k = 83 THEN NULL ELSE event_type END AS data_type, TIMESTAMP '2024-02-01' AS processed_at,
  CASE WHEN k < 10 OR k = 11 THEN -1 ELSE k END AS original_k,
  CASE WHEN k < 10 OR k = 11 THEN -1 ELSE k END AS transformed_k,
  '1.0' AS pipeline_version, CASE WHEN k < 10 THEN 0.8 ELSE 1.0 END AS quality_score
FROM e WHERE k NOT IN (71, 73, 79)""")
def transformed_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_events to transformed_data."""
    raw = parse.raw_events(_checked(spark, sf_dir))
    wrapped = F.to_json(F.struct(F.get_json_object("data", "$.k").cast("int").alias("payload")))
    rows = parse.transformed_data(raw, as_of(), "1.0", wrapped)

    def number(column: str, path: str) -> Column:
        return F.coalesce(F.get_json_object(column, path).cast("int"), F.lit(-1))

    return result(rows.select(
        "id", "data_type", "processed_at", number("original_data", "$.k").alias("original_k"),
        number("transformed_data", "$.payload").alias("transformed_k"),
        "pipeline_version", "quality_score",
    ))


@query("""SELECT c_custkey, c_name AS plain, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END AS segment,
  c_nationkey AS nation, c_mktsegment AS first_tag, 2 AS n_tags,
  c_acctbal AS balance, c_nationkey = 3 AS null_member_kept FROM customer""")
def json_encode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested columns become JSON text; scalars stay."""
    address = F.struct(
        F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("segment"), F.col("c_nationkey").alias("nation")
    )
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("plain"), address.alias("address"),
        F.array("c_mktsegment", F.lit("tag")).alias("tags"), F.col("c_acctbal").alias("balance"),
    )
    encoded = encode_nested(rows)
    return encoded.select(
        "c_custkey", "plain", F.get_json_object("address", "$.segment").alias("segment"),
        F.get_json_object("address", "$.nation").cast("int").alias("nation"),
        F.get_json_object("tags", "$[0]").alias("first_tag"), F.json_array_length("tags").alias("n_tags"), "balance",
        F.col("address").contains('"segment":null').alias("null_member_kept"),
    )


@query("""SELECT event_id, event_type, CASE WHEN value > 100 THEN '' ELSE 'Account' END AS object_attribute,
  'salesforce_cdc' AS source_attribute, event_type AS type_attribute, value FROM events""")
def to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages: JSON value and routing attributes."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("value") <= 100, "Account").alias("object_type"), "value"
    )
    text, attributes = F.col("value").cast("string"), F.col("attributes")
    return parse.to_messages(rows).select(
        F.get_json_object(text, "$.event_id").cast("long").alias("event_id"),
        F.get_json_object(text, "$.event_type").alias("event_type"),
        attributes["object_type"].alias("object_attribute"), attributes["source"].alias("source_attribute"),
        attributes["event_type"].alias("type_attribute"),
        F.get_json_object(text, "$.value").cast("double").alias("value"),
    )


@query("""SELECT o_orderkey, lower(regexp_replace(regexp_replace(o_orderpriority, '([A-Z])', '_\\1', 'g'), '^_+', '')) AS name
FROM orders""")
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The field-name rule applied to values."""
    return table(spark, sf_dir, "orders").select("o_orderkey", snake_case(F.col("o_orderpriority")).alias("name"))


@query(f"""WITH {OPPORTUNITY_SQL}
SELECT id AS "Id", account_id AS "AccountId", stage_name AS "StageName", CAST(amount AS DOUBLE) AS "Amount",
  CAST(close_date AS VARCHAR) AS "CloseDate", is_won AS "IsWon", created_date AS "CreatedDate" FROM opportunities""")
def rename_to_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opportunities under their API names."""
    rows = result(opportunities(spark, sf_dir).withColumn("amount", F.col("amount").cast("double")))
    rows = rows.withColumn("close_date", F.date_format("close_date", "yyyy-MM-dd"))
    return to_api_names(rows, "Opportunity").select(
        "Id", "AccountId", "StageName", "Amount", "CloseDate", "IsWon", "CreatedDate"
    )


def _text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as text; low priorities have malformed amounts, some statuses malformed dates."""
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_totalprice") > 1000, F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount"),
        F.when(F.col("o_orderstatus") == "P", F.lit("someday")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("created_date"),
        F.col("o_orderkey").cast("string").alias("row"),
    )


_TARGET = T.StructType([
    T.StructField("id", T.StringType(), False), T.StructField("amount", T.DecimalType(38, 9)),
    T.StructField("created_date", T.TimestampType(), False), T.StructField("row", T.StringType()),
])


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS row, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS amount,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS created_date,
  concat_ws(',', CASE WHEN o_orderpriority = '5-LOW' THEN 'amount' END, CASE WHEN o_orderstatus = 'P' THEN 'created_date' END) AS failed
FROM orders""")
def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to declared types; values that do not fit are named."""
    rows = parse.conform(_text_orders(spark, sf_dir), _TARGET)
    return result(rows.select("row", F.col("amount").cast("double").alias("amount"), "created_date",
                              F.array_join("cast_errors", ",").alias("failed")))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS row,
  concat_ws(',', CASE WHEN o_totalprice <= 1000 THEN 'id' END, CASE WHEN o_orderstatus = 'P' THEN 'created_date' END) AS missing
FROM orders WHERE o_totalprice <= 1000 OR o_orderstatus = 'P'""")
def required_mode_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose required columns are null at the sink."""
    rows = parse.missing_required(parse.conform(_text_orders(spark, sf_dir), _TARGET), _TARGET)
    return rows.where(F.size("missing") > 0).select("row", F.array_join("missing", ",").alias("missing"))


@query("""WITH r AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS id, c_name AS name, c_acctbal AS annual_revenue FROM customer
  UNION ALL SELECT lpad(CAST(c_nationkey AS VARCHAR), 18, '1'), c_mktsegment, NULL FROM customer)
SELECT *, TIMESTAMP '2024-02-01' AS ingestion_timestamp, 'salesforce_api' AS source, 'Account' AS object_type FROM r""")
def extract_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records out of extract responses, with their ingestion metadata."""
    own = F.struct(F.lpad(F.col("c_custkey").cast("string"), 18, "0").alias("id"), F.col("c_name").alias("name"),
                   F.col("c_acctbal").alias("annual_revenue"))
    other = F.struct(F.lpad(F.col("c_nationkey").cast("string"), 18, "1").alias("id"), F.col("c_mktsegment").alias("name"),
                     F.lit(None).cast("double").alias("annual_revenue"))
    envelope = F.to_json(F.struct(F.array(own, other).alias("records"), F.lit(2).alias("totalSize"), F.lit(True).alias("done")))
    texts = table(spark, sf_dir, "customer").select(envelope.alias("body"))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("annual_revenue", T.DoubleType())])
    return result(extract_envelopes(texts, "body", "Account", as_of(), schema))


@query(f"""WITH {ACCOUNT_SQL}, {CONTACT_SQL}, {OPPORTUNITY_SQL}, {CASE_SQL}, u AS (
  SELECT id, created_date, 'Account' AS object_type FROM accounts UNION ALL SELECT id, created_date, 'Contact' FROM contacts
  UNION ALL SELECT id, created_date, 'Opportunity' FROM opportunities UNION ALL SELECT id, created_date, 'Case' FROM cases)
SELECT *, 'salesforce_api' AS source, TIMESTAMP '2024-02-01' AS ingestion_timestamp FROM u""")
def extract_all_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extracts of all four objects with their metadata."""
    extracts = extract_all({n: read(spark, sf_dir) for n, read in OBJECT_TABLES.items()}, as_of())
    own = [m[0] for m in BATCH_META[:3]]
    return result(union_raw([e.select("id", "created_date", *own) for e in extracts.values()]))




@query(f"""WITH {DIRTY_SQL}
SELECT obj AS object_type, lpad(CAST(user_id AS VARCHAR), 15, '0') AS id, eid AS event_id,
  CASE obj WHEN 'Account' THEN 'Name ' || user_id WHEN 'Contact' THEN 'First Last' WHEN 'Opportunity' THEN 'Name ' || user_id || ' Open'
    ELSE 'Help New' END AS label,
  CASE WHEN obj = 'Account' THEN NULL WHEN k = 67 THEN 'short' ELSE lpad(CAST(user_id AS VARCHAR), 15, '0') END AS account_id,
  ts AS created_date, CASE WHEN kind <> 'DELETE' AND k IN (47, 53) THEN NULL ELSE ts END AS last_modified_date,
  CASE WHEN kind <> 'DELETE' AND k = 47 THEN 'last_modified_date' ELSE '' END AS unfit
FROM cdc WHERE NOT broken AND obj <> 'Lead' AND kind IN ('INSERT', 'UPDATE', 'DELETE')
  AND NOT (kind = 'DELETE' AND k = 61) AND NOT (kind <> 'DELETE' AND k = 59)""")
def cdc_extract_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows of all four objects, with the fields whose value does not fit."""
    labels = {
        "Account": ["name"], "Contact": ["first_name", "last_name"], "Opportunity": ["name", "stage_name"], "Case": ["subject", "status"]}

    def columns(name: str) -> dict[str, Callable[[Column], Column]]:
        return {
            "object_type": lambda r: r["object_type"], "id": lambda r: r["id"], "event_id": lambda r: r["_cdc_event_id"],
            "label": lambda r: F.concat_ws(" ", *[r[c] for c in labels[name]]),
            "account_id": lambda r: r["account_id"] if name != "Account" else F.lit(None).cast("string"),
            "created_date": lambda r: r["created_date"], "last_modified_date": lambda r: r["last_modified_date"],
            "unfit": lambda r: F.array_join(r["cast_errors"], ","),
        }

    return result(parse.extract_records(_events(spark, sf_dir), {name: columns(name) for name in labels}, as_of()))

"""The star-schema tables read as CRM objects and change feeds.

customer ~ Account, supplier ~ Contact, orders ~ Opportunity, lineitem ~ Case, events ~ feed.
Timestamps become UTC instants on reading and plain timestamps again in query results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmflow.functions.values import once
from crmflow.operators.history import hot_records
from crmflow.operators.ordered import HotKeys, with_neighbour
from crmflow.sources.readers import spread

# Clock of every query: nothing reads the wall clock.
AS_OF_TEXT = "2024-02-01 00:00:00"
TRACKED = ("event_type",)


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def result(df: DataFrame) -> DataFrame:
    """Instants as plain timestamps, as stored in the given tables."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def record_id() -> Column:
    return F.lpad(F.col("user_id").cast("string"), 15, "0")


def state_feed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, HotKeys | None]:
    """A change feed over users: the first event inserts, errors delete, others update.

    The state is (event_type, value); ``before`` is the state of the previous event.
    """
    rows = events(spark, sf_dir).where(F.col("user_id").isNotNull()).select(
        "event_id", record_id().alias("record_id"), F.col("ts").alias("event_timestamp"),
        "event_type", "value",
    )
    hot = hot_records(rows)
    state = F.struct("event_type", "value")
    feed = with_neighbour(
        rows, ["record_id"], ["event_timestamp", "event_id"], {"before": state}, "previous",
        hot and hot.renamed("record_id"),
    )
    kind = (
        F.when(F.col("before").isNull(), "INSERT")
        .when(F.col("event_type") == "error", "DELETE")
        .otherwise("UPDATE")
    )
    return feed.select(
        "event_id", "record_id", kind.alias("event_type"), "event_timestamp", "before", state.alias("after")
    ), hot


def k() -> Column:
    return F.col("k")


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k``, the number in their props; rules on it make some events dirty."""
    number = F.get_json_object("props", "$.k").cast("int")
    return once(spread(events(spark, sf_dir)), {"k": number})


def cdc_kind() -> Column:
    kind = F.col("event_type")
    return (
        F.when(k() == 13, "UPSERT").when(kind == "signup", "INSERT").when(kind == "error", "DELETE")
        .otherwise("UPDATE")
    )


def cdc_object() -> Column:
    return (
        F.when(k() == 17, "Lead").when(k() < 25, "Account").when(k() < 50, "Contact")
        .when(k() < 75, "Opportunity").otherwise("Case")
    )


def cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a JSON change message, dirty where ``k`` or ``value`` says so.

    k=13 bad type, 17 unknown object, 23 or value > 200 bad id, 29/31/37 malformed, future and
    stale time, 41/43 empty and non-list changed fields, 47 wrong field type, 53 required field
    absent, 59/61 missing side, 67 bad reference, 71 broken JSON, 73 broken UTF-8.
    """
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    stamp = F.when(k() == 47, F.lit(12345).cast("variant")).when(k() == 53, None).otherwise(ts_text.cast("variant"))
    common = [
        record_id().alias("id"), F.concat(F.lit("Name "), F.col("user_id")).alias("name"),
        F.lit("First").alias("first_name"), F.lit("Last").alias("last_name"),
        F.lit("Open").alias("stage_name"), F.lit("Help").alias("subject"), F.lit("New").alias("status"),
        F.when(k() == 67, "short").otherwise(record_id()).alias("account_id"), ts_text.alias("created_date"),
    ]
    after = F.struct(*common, stamp.alias("last_modified_date"),
                     F.col("value").cast("decimal(18,2)").alias("annual_revenue"))
    before = F.struct(*common, ts_text.alias("last_modified_date"), F.lit(0).alias("annual_revenue"))
    kind = cdc_kind()
    listed = {text: F.parse_json(F.lit(text)) for text in ("[]", '"annual_revenue"', '["annual_revenue"]')}
    changed = F.when(k() == 41, listed["[]"]).when(k() == 43, listed['"annual_revenue"']).otherwise(listed['["annual_revenue"]'])
    body = F.struct(
        F.concat(F.lit("EVT-"), F.col("event_id")).alias("event_id"),
        kind.alias("event_type"), cdc_object().alias("object_type"),
        F.when((k() == 23) | (F.col("value") > 200), F.concat(F.lit("x-"), F.col("user_id")))
        .otherwise(record_id()).alias("record_id"),
        F.when(k() == 29, "not-a-timestamp").when(k() == 31, "2099-12-31T23:59:59Z")
        .when(k() == 37, "2020-01-01T00:00:00Z").otherwise(ts_text).alias("event_timestamp"),
        F.when(kind == "UPDATE", changed).alias("changed_fields"),
        F.when((kind != "INSERT") & (k() != 61), before).alias("before"),
        F.when((kind != "DELETE") & (k() != 59), after).alias("after"),
    )
    # One column for the text: a copy of it in each case below is more code than the JVM compiles.
    rows = once(numbered_events(spark, sf_dir), {"text": F.to_json(body)})
    text = F.col("text")
    value = (
        F.when(k() == 71, F.concat(F.lit("{"), text).cast("binary"))
        .when(k() == 73, F.concat(text.cast("binary"), F.unhex(F.lit("FF"))))
        .otherwise(text.cast("binary"))
    )
    attributes = F.when(k() < 20, F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(F.lit("event_type"), kind, F.lit("object_type"), cdc_object())
    )
    return rows.select(
        value.alias("value"), attributes.alias("attributes"), F.concat(F.lit("MSG-"), F.col("event_id")).alias("message_id"),
        F.col("ts").alias("publish_time"))


def generic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a generic JSON message.

    k=79 no timestamp key, 83 a null event type, below 10 no data, 11 null data; 71 and 73 as
    above.
    """
    pieces = [
        F.concat(F.lit('{"event_id":"EVT-'), F.col("event_id"), F.lit('"')),
        F.when(k() == 83, ',"event_type":null').otherwise(F.concat(F.lit(',"event_type":"'), F.col("event_type"), F.lit('"'))),
        F.when(k() == 79, "").otherwise(
            F.concat(F.lit(',"timestamp":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit('"'))),
        F.when(k() < 10, "").when(k() == 11, ',"data":null').otherwise(F.concat(F.lit(',"data":'), F.col("props"))),
        F.lit(',"source":"feed"}'),
    ]
    text = F.concat(*pieces)
    value = (
        F.when(k() == 71, F.concat(F.lit("{"), text).cast("binary"))
        .when(k() == 73, F.concat(text.cast("binary"), F.unhex(F.lit("FF"))))
        .otherwise(text.cast("binary"))
    )
    return once(numbered_events(spark, sf_dir), {"value": value}).select("value")


def key(prefix: str, *columns: Column, width: int = 15) -> Column:
    """18-character ids: object prefix and zero-padded key."""
    parts = [F.lpad(c.cast("string"), width // len(columns), "0") for c in columns]
    return F.concat(F.lit(prefix), *parts)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as Account. Some segments, balances, phones and sites break rules."""
    nation, segment = F.col("c_nationkey"), F.col("c_mktsegment")
    created = F.lit("2020-01-01").cast("timestamp") + F.make_dt_interval(nation)
    return table(spark, sf_dir, "customer").select(
        key("001", F.col("c_custkey")).alias("id"),
        F.when(nation != 9, F.col("c_name")).otherwise("  ").alias("name"),
        F.when(segment == "AUTOMOBILE", "Customer").when(segment == "BUILDING", "Prospect")
        .when(segment == "FURNITURE", "Partner").when(segment == "MACHINERY", "Household").alias("type"),
        F.lower(segment).alias("industry"),
        F.col("c_acctbal").cast("decimal(38,9)").alias("annual_revenue"),
        F.when(nation == 7, "555-0100").when(nation == 8, "").otherwise("+14155550100").alias("phone"),
        F.when(nation == 3, "ftp://example.com").when(nation == 5, "").otherwise("https://example.com").alias("website"),
        created.alias("created_date"), created.alias("last_modified_date"), created.alias("system_modstamp"),
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as Contact."""
    nation = F.col("s_nationkey")
    created = F.lit("2020-06-01").cast("timestamp") + F.make_dt_interval(nation)
    return table(spark, sf_dir, "supplier").select(
        key("003", F.col("s_suppkey")).alias("id"), key("001", F.col("s_suppkey")).alias("account_id"),
        F.when(nation != 4, "Sam").otherwise(" ").alias("first_name"), F.col("s_name").alias("last_name"),
        F.when(F.col("s_acctbal") < 0, "no-address").otherwise("sam@example.com").alias("email"),
        F.lit("+14155550101").alias("phone"),
        F.when(nation < 8, "CEO").when(nation < 16, "IT Manager").when(nation < 20, "Intern").alias("title"),
        F.lit("Web").alias("lead_source"),
        created.alias("created_date"), created.alias("last_modified_date"), created.alias("system_modstamp"),
    )


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as Opportunity; some stages, probabilities and close dates break rules."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    created = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        key("006", F.col("o_orderkey")).alias("id"), key("001", F.col("o_custkey")).alias("account_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("name"),
        F.when(status == "F", "Closed Won").when(status == "O", "Prospecting").otherwise("").alias("stage_name"),
        F.lit("New Business").alias("type"), F.lit("Web").alias("lead_source"),
        F.col("o_totalprice").cast("decimal(38,9)").alias("amount"),
        F.when(priority == "1-URGENT", 90).when(priority == "2-HIGH", 75).when(priority == "3-MEDIUM", 50)
        .when(priority == "5-LOW", 10).otherwise(110).cast("decimal(38,9)").alias("probability"),
        F.date_add(F.to_date("o_orderdate"), F.when(priority == "5-LOW", -1).when(priority == "2-HIGH", 0).otherwise(30))
        .alias("close_date"),
        (status == "F").alias("is_won"), (status == "F").alias("is_closed"),
        created.alias("created_date"), created.alias("last_modified_date"), created.alias("system_modstamp"),
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as Case; ids repeat, and some states, priorities and origins break rules."""
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    created = F.col("l_shipdate").cast("timestamp")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("500"), F.lpad(F.col("l_orderkey").cast("string"), 13, "0"),
                 F.lpad(line.cast("string"), 2, "0")).alias("id"),
        key("001", F.col("l_suppkey")).alias("account_id"), key("003", F.col("l_suppkey")).alias("contact_id"),
        F.when(F.col("l_tax") > 0, F.concat(F.lit("Part "), F.col("l_partkey"))).otherwise(" ").alias("subject"),
        F.lit(None).cast("string").alias("description"),
        F.when(F.col("l_returnflag") == "A", "New").when(F.col("l_returnflag") == "N", "Working")
        .otherwise("Returned").alias("status"),
        F.when(line == 1, "Web").when(line == 2, "Email").when(line == 3, "Phone").when(line == 4, "Chat")
        .when(line == 5, "Social Media").when(line == 6, "Fax").alias("origin"),
        F.when(quantity <= 15, "Low").when(quantity <= 35, "Medium").when(quantity < 50, "High")
        .otherwise("Urgent").alias("priority"),
        F.lit(False).alias("is_escalated"), (F.col("l_linestatus") == "F").alias("is_closed"),
        F.when(F.col("l_linestatus") == "F", created).alias("closed_date"),
        created.alias("created_date"), created.alias("last_modified_date"), created.alias("system_modstamp"),
    )


OBJECT_TABLES = {"Account": accounts, "Contact": contacts, "Opportunity": opportunities, "Case": cases}

# SQL for the same mappings.
FEED_SQL = """
feed AS (
  SELECT event_id, lpad(CAST(user_id AS VARCHAR), 15, '0') AS record_id, ts, event_type AS state_type,
         value AS state_value, lag(event_type) OVER w AS before_type, lag(value) OVER w AS before_value,
         row_number() OVER w = 1 AS is_first
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
changes AS (
  SELECT *, CASE WHEN is_first THEN 'INSERT' WHEN state_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END AS change_type
  FROM feed),
bounds AS (
  SELECT * FROM changes WHERE change_type <> 'UPDATE' OR before_type IS DISTINCT FROM state_type),
chained AS (
  SELECT *, lead(ts) OVER (PARTITION BY record_id ORDER BY ts, event_id) AS valid_to FROM bounds),
versions AS (
  SELECT record_id AS id, ts AS valid_from, valid_to, valid_to IS NULL AS is_current, change_type,
         CASE WHEN change_type = 'UPDATE' THEN 'event_type' ELSE '' END AS changed_fields,
         state_type, state_value, event_id
  FROM chained WHERE change_type <> 'DELETE' AND (valid_to IS NULL OR valid_to > ts))
"""

DIRTY_SQL = """
e AS (SELECT *, CAST(props->>'k' AS INTEGER) AS k FROM events),
cdc AS (
  SELECT *, 'EVT-' || event_id AS eid,
    CASE WHEN k = 13 THEN 'UPSERT' WHEN event_type = 'signup' THEN 'INSERT' WHEN event_type = 'error' THEN 'DELETE'
         ELSE 'UPDATE' END AS kind,
    CASE WHEN k = 17 THEN 'Lead' WHEN k < 25 THEN 'Account' WHEN k < 50 THEN 'Contact' WHEN k < 75 THEN 'Opportunity'
         ELSE 'Case' END AS obj,
    CASE WHEN k = 23 OR value > 200 THEN 'x-' || user_id ELSE lpad(CAST(user_id AS VARCHAR), 15, '0') END AS rid,
    k IN (71, 73) AS broken
  FROM e),
coded AS (
  SELECT *,
    CASE WHEN kind = 'UPSERT' THEN 1 ELSE 0 END AS bad_type,
    CASE WHEN obj = 'Lead' THEN 1 ELSE 0 END AS bad_object,
    CASE WHEN k = 23 OR value > 200 THEN 1 ELSE 0 END AS bad_id,
    CASE WHEN k IN (29, 31, 37) THEN 1 ELSE 0 END AS bad_time,
    CASE WHEN kind = 'UPDATE' AND k IN (41, 43) THEN 1 ELSE 0 END AS bad_changed,
    CASE WHEN (k = 59 AND kind IN ('INSERT', 'UPDATE')) OR (k = 61 AND kind IN ('UPDATE', 'DELETE'))
           OR (k = 53 AND kind IN ('INSERT', 'UPDATE')) THEN 1 ELSE 0 END AS bad_null,
    CASE WHEN k = 47 AND kind IN ('INSERT', 'UPDATE', 'UPSERT') THEN 1 ELSE 0 END AS bad_field,
    CASE WHEN k = 67 AND kind IN ('INSERT', 'UPDATE') THEN 1 ELSE 0 END AS bad_fk
  FROM cdc WHERE NOT broken),
checked AS (
  SELECT *,
    concat_ws(',', CASE WHEN bad_type = 1 THEN 'event_type' END, CASE WHEN bad_object = 1 THEN 'object_type' END,
      CASE WHEN bad_id = 1 THEN 'record_id' END, CASE WHEN bad_time = 1 THEN 'timestamp' END,
      CASE WHEN bad_changed = 1 THEN 'changed_fields' END, CASE WHEN bad_null = 1 THEN 'null_fields' END,
      CASE WHEN bad_field = 1 THEN 'field_types' END, CASE WHEN bad_fk = 1 THEN 'foreign_keys' END) AS codes,
    bad_type + bad_object + bad_id + bad_time + bad_changed + bad_null + bad_field + bad_fk AS n_errors
  FROM coded)
"""

ACCOUNT_SQL = """
accounts AS (
  SELECT '001' || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS id,
    CASE WHEN c_nationkey <> 9 THEN c_name ELSE '  ' END AS name,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Customer' WHEN 'BUILDING' THEN 'Prospect' WHEN 'FURNITURE' THEN 'Partner'
      WHEN 'MACHINERY' THEN 'Household' END AS type,
    lower(c_mktsegment) AS industry, c_acctbal AS annual_revenue,
    CASE WHEN c_nationkey = 7 THEN '555-0100' WHEN c_nationkey = 8 THEN '' ELSE '+14155550100' END AS phone,
    CASE WHEN c_nationkey = 3 THEN 'ftp://example.com' WHEN c_nationkey = 5 THEN '' ELSE 'https://example.com' END AS website,
    TIMESTAMP '2020-01-01' + to_days(c_nationkey) AS created_date, c_nationkey, c_mktsegment
  FROM customer)
"""
CONTACT_SQL = """
contacts AS (
  SELECT '003' || lpad(CAST(s_suppkey AS VARCHAR), 15, '0') AS id, '001' || lpad(CAST(s_suppkey AS VARCHAR), 15, '0') AS account_id,
    CASE WHEN s_nationkey <> 4 THEN 'Sam' ELSE ' ' END AS first_name, s_name AS last_name,
    CASE WHEN s_acctbal < 0 THEN 'no-address' ELSE 'sam@example.com' END AS email,
    CASE WHEN s_nationkey < 8 THEN 'CEO' WHEN s_nationkey < 16 THEN 'IT Manager' WHEN s_nationkey < 20 THEN 'Intern' END AS title,
    TIMESTAMP '2020-06-01' + to_days(s_nationkey) AS created_date
  FROM supplier)
"""
OPPORTUNITY_SQL = """
opportunities AS (
  SELECT '006' || lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS id, '001' || lpad(CAST(o_custkey AS VARCHAR), 15, '0') AS account_id,
    'Order ' || o_orderkey AS name,
    CASE o_orderstatus WHEN 'F' THEN 'Closed Won' WHEN 'O' THEN 'Prospecting' ELSE '' END AS stage_name,
    o_totalprice AS amount,
    CASE o_orderpriority WHEN '1-URGENT' THEN 90 WHEN '2-HIGH' THEN 75 WHEN '3-MEDIUM' THEN 50 WHEN '5-LOW' THEN 10 ELSE 110 END AS probability,
    CAST(o_orderdate AS DATE) + CASE o_orderpriority WHEN '5-LOW' THEN -1 WHEN '2-HIGH' THEN 0 ELSE 30 END AS close_date,
    o_orderstatus = 'F' AS is_won, o_orderstatus = 'F' AS is_closed, o_orderdate AS created_date, o_orderkey, o_custkey
  FROM orders)
"""
CASE_SQL = """
cases AS (
  SELECT '500' || lpad(CAST(l_orderkey AS VARCHAR), 13, '0') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS id,
    '001' || lpad(CAST(l_suppkey AS VARCHAR), 15, '0') AS account_id, '003' || lpad(CAST(l_suppkey AS VARCHAR), 15, '0') AS contact_id,
    CASE WHEN l_tax > 0 THEN 'Part ' || l_partkey ELSE ' ' END AS subject,
    CASE l_returnflag WHEN 'A' THEN 'New' WHEN 'N' THEN 'Working' ELSE 'Returned' END AS status,
    CASE l_linenumber WHEN 1 THEN 'Web' WHEN 2 THEN 'Email' WHEN 3 THEN 'Phone' WHEN 4 THEN 'Chat' WHEN 5 THEN 'Social Media'
      WHEN 6 THEN 'Fax' END AS origin,
    CASE WHEN l_quantity <= 15 THEN 'Low' WHEN l_quantity <= 35 THEN 'Medium' WHEN l_quantity < 50 THEN 'High' ELSE 'Urgent' END AS priority,
    l_linestatus = 'F' AS is_closed, l_shipdate AS created_date
  FROM lineitem)
"""

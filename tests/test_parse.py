"""Parsing, extraction, messages and typing."""

import importlib
import json
import re
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmflow import registry
from crmflow.functions.values import encode_nested, snake_case
from crmflow.operators import parse, query

AT = datetime(2025, 10, 31, tzinfo=UTC)
EVENT = {"event_id": "E1", "event_type": "UPDATE", "object_type": "Account", "record_id": "001000000000001AAA",
         "event_timestamp": "2025-10-30T16:00:00Z", "changed_fields": ["name"],
         "before": {"id": "1", "name": "Acme"},
         "after": {"id": "1", "name": "Acme Corp", "annual_revenue": 1.5, "billing_address": {"city": "X"}, "extra": 1}}


def at():
    return F.lit(AT)


def parsed(spark, *values, attributes=None):
    rows = [(v if isinstance(v, bytes) else json.dumps(v).encode(), attributes, "m1", AT) for v in values]
    df = spark.createDataFrame(rows, "value binary, attributes map<string,string>, message_id string, publish_time timestamp")
    return parse.parse_messages(df, at())


def test_failures_are_kept_whole(spark):
    rows = parsed(spark, EVENT, b"{broken", b"\xff\xfe", b'{"a":1,"a":2}')
    letters = [(r.error, r.original_message) for r in parse.dead_letters(rows).collect()]
    assert letters[0] == ("invalid json", "{broken")
    assert letters[1][0] == "invalid utf-8" and letters[1][1] == "//4="
    assert letters[2] == ("invalid json", '{"a":1,"a":2}')
    assert rows.where("parse_error IS NULL").count() == 1


def test_metadata(spark):
    with_some = parse.with_message_metadata(parsed(spark, EVENT, attributes={"k": "v"})).first()
    assert with_some._pubsub_message_id == "m1" and with_some._pubsub_attributes == {"k": "v"}
    assert parse.with_message_metadata(parsed(spark, EVENT, attributes={})).first()._pubsub_attributes is None


def test_extract_record(spark):
    delete = dict(EVENT, event_type="DELETE", after=None)
    odd = dict(EVENT, event_type="MERGE")
    events = parse.envelope(parsed(spark, EVENT, delete, odd))
    rows = {r._cdc_event_type: r for r in parse.extract_record(events, "Account", at()).collect()}
    assert set(rows) == {"UPDATE", "DELETE"}
    assert rows["UPDATE"].name == "Acme Corp" and rows["DELETE"].name == "Acme"
    assert rows["UPDATE"].billing_address == '{"city":"X"}' and float(rows["UPDATE"].annual_revenue) == 1.5
    assert rows["UPDATE"].source == "salesforce_cdc" and rows["UPDATE"]._pubsub_message_id == "m1"
    kept = parse.extract_record(events, "Account", at(), on_unknown="empty")
    empty = kept.where("_cdc_event_type = 'MERGE'").first()
    assert empty.id is None and empty._cdc_event_id is None
    unfit = dict(EVENT, after=dict(EVENT["after"], created_date="soon", annual_revenue="much"))
    flagged = parse.extract_record(parse.envelope(parsed(spark, EVENT, unfit)), "Account", at(), flag_casts=True, keep=["text"])
    assert [r.cast_errors for r in flagged.collect()] == [[], ["annual_revenue", "created_date"]]
    assert "_processing_timestamp" in parse.with_processing_time(flagged, at()).columns
    bare = parse.extract_record(events, "Account", at(), include_metadata=False)
    assert "source" not in bare.columns


def test_event_fields(spark):
    rows = parse.envelope(parsed(spark, EVENT, dict(EVENT, changed_fields=None)))
    assert [r[0] for r in rows.select(parse.changed_field_list(F.col("changed_fields"))).collect()] == [["name"], []]


def test_messages(spark):
    df = spark.createDataFrame([("UPDATE", None, AT, 5)], "event_type string, object_type string, event_timestamp timestamp, n int")
    row = parse.to_messages(df).first()
    assert row.attributes == {"event_type": "UPDATE", "object_type": "", "source": "salesforce_cdc",
                              "event_timestamp": "2025-10-31T00:00:00.000000Z"}
    body = json.loads(bytes(row.value))
    assert body["n"] == 5 and body["object_type"] is None and body["event_timestamp"].startswith("2025-10-31T00:00:00")


def test_generic_events(spark):
    full = {"event_id": "1", "event_type": "t", "timestamp": "2025-10-30T16:00:00Z", "data": {"a": 1}}
    rows = parse.check_generic(parsed(spark, full, {k: v for k, v in full.items() if k != "data"},
                                      dict(full, data=None, event_type=None), {"event_id": "2"}, b"x"))
    assert [(r.route, r.quality_score) for r in rows.collect()] == [
        ("valid", 1.0), ("valid", 0.8), ("valid", 1.0), ("invalid", None), ("failed", None)]
    out = parse.transformed_data(parse.raw_events(rows), at(), "2.0").collect()
    assert [r.pipeline_version for r in out] == ["2.0"] * 3 and out[0].original_data == '{"a":1}'


def test_encode_nested(spark):
    df = spark.createDataFrame(
        [({"street": "s", "city": None}, ["a"], [], None, True, 95.5, "t")],
        T.StructType([T.StructField("address", T.StructType([T.StructField("street", T.StringType()), T.StructField("city", T.StringType())])),
                      T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("none", T.ArrayType(T.StringType())),
                      T.StructField("missing", T.MapType(T.StringType(), T.StringType())),
                      T.StructField("flag", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("text", T.StringType())]))
    r = encode_nested(df.withColumn("any", F.parse_json(F.lit('{"x":1}'))).withColumn("plain", F.parse_json(F.lit("7")))).first()
    assert json.loads(r.address) == {"street": "s", "city": None} and r.tags == '["a"]' and r.none == "[]"
    assert r.missing is None and r.flag is True and r.score == 95.5 and r.any == '{"x":1}' and r.plain == "7"


def test_names(spark):
    df = spark.createDataFrame([("AnnualRevenue",), ("URL",), ("id",), ("_Private",)], "n string")
    assert [r[0] for r in df.select(snake_case(F.col("n"))).collect()] == ["annual_revenue", "u_r_l", "id", "private"]


def test_registry(spark):
    for name, obj in registry.OBJECTS.items():
        df = spark.createDataFrame([], registry.object_schema(name))
        assert registry.from_api_names(registry.to_api_names(df, name), name).columns == obj.field_names
        sink = registry.sink_schema(name)
        assert [f.name for f in sink if not f.nullable] == [
            "id", "ingestion_timestamp", "source", "object_type", "_is_valid", "_validation_timestamp"]
    assert registry.OBJECTS["Account"].api_names["system_modstamp"] == "SystemModstamp"
    assert len(registry.sink_schema("Lead").fields) == 10
    rows = registry.describe_object(spark, "History").collect()
    assert [r.name for r in rows if r.required] == ["id", "valid_from", "is_current", "change_type", "record_data", "ingestion_timestamp"]
    assert registry.table_path("/lake/", "Opportunity", "history") == "/lake/opportunities_history"


def test_conform(spark):
    schema = T.StructType([T.StructField("n", T.DecimalType(38, 9)), T.StructField("t", T.TimestampType(), False),
                           T.StructField("d", T.DateType()), T.StructField("gone", T.StringType())])
    df = spark.createDataFrame([("1.5", "2025-10-30T16:00:00Z", "2025-10-30"), ("x", None, "x")], "n string, t string, d string")
    rows = parse.missing_required(parse.conform(df, schema), schema).collect()
    assert rows[0].cast_errors == [] and float(rows[0].n) == 1.5 and rows[0].gone is None
    assert rows[1].cast_errors == ["n", "d"] and rows[1].missing == ["t"]


def test_object_queries(spark):
    rows = [(f"{i:03d}", f"a{i % 3}", f"c{i % 2}", datetime(2024, 1, 1 + i % 5, tzinfo=UTC)) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, account_id string, contact_id string, created_date timestamp")
    top = [(r.created_date.day, r.id) for r in query.newest(df, 4).collect()]
    assert [i for _, i in top] == ["004", "009", "014", "019"]
    both = query.query_cases(df, 100, ["a0"], ["c0"]).collect()
    assert {(r.account_id, r.contact_id) for r in both} == {("a0", "c0")} and len(both) == 5
    assert query.query_contacts(df, 2, ["a1"]).count() == 2
    many = [f"a{i}" for i in range(2000)]
    assert query.query_opportunities(df, 100, many).count() == 30
    assert query.query_accounts(df, fields=["id"], where="id = '007'").first().id == "007"
    changed = df.withColumnRenamed("created_date", "last_modified_date")
    assert query.recent_changes(changed, datetime(2024, 1, 5, tzinfo=UTC), None).count() == 6
    with pytest.raises(Exception):
        query.query_accounts(df, fields=["no_such_column"]).collect()


def test_sizing():
    from crmflow.session import sizing

    assert sizing(1)["spark.sql.shuffle.partitions"] == "200"
    assert sizing(10 << 40)["spark.sql.shuffle.partitions"] == "81920"


def test_long_inputs_are_spread_by_rows(spark):
    from crmflow.sources.readers import spread

    few = spread(spark.range(1000, numPartitions=2), 100).rdd
    assert few.getNumPartitions() == 10 and max(few.glom().map(len).collect()) <= 110
    assert spread(spark.range(10, numPartitions=1), 100).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(spark.range(10, numPartitions=20), 100).rdd.getNumPartitions() == 20


@pytest.fixture
def one_full_split(spark, sf_dir, tmp_path):
    """A copy of the events in one row group, so that one of its many splits holds every row."""
    spark.read.parquet(f"{sf_dir}/events.parquet").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    size = max(p.stat().st_size for p in (tmp_path / "events.parquet").glob("*.parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 30))
    yield str(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_full_split_among_empty_ones_is_spread(spark, one_full_split):
    from crmflow.sources.readers import spread

    events = spark.read.parquet(f"{one_full_split}/events.parquet")
    rows, had = events.count(), [len(x) for x in events.rdd.glom().collect()]
    assert len(had) >= 30 and max(had) == rows
    got = [len(x) for x in spread(events, rows // 20).rdd.glom().collect()]
    assert sum(got) == rows and max(got) <= rows // 10
    empty = spark.createDataFrame([], "n long").repartition(20)
    assert spread(empty, 10).count() == 0


@pytest.mark.parametrize("name", ["threshold_gate", "route_counts", "validate_cdc", "validation_stats"])
def test_queries_spread_a_full_split(spark, one_full_split, sf_dir, name):
    query = importlib.import_module("__spark_entry__").queries()[name]
    got = query(spark, one_full_split)
    assert "RoundRobinPartitioning" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, got.collect())) == sorted(map(str, query(spark, sf_dir).collect()))


def test_members_in_one_walk_equal_single_lookups(spark):
    from crmflow.functions.values import chosen, member, text_member

    texts = ['{"a": 1, "b": null}', '{"a": "x", "b": {"c": [1, null]}, "d": 2}', '{"a": {"b": 1}}', '{}', '[1]', '"a"', 'null', None]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select(F.try_parse_json("x").alias("v"))
    both = rows.select(chosen(F.col("v"), {"a": "string", "b": "variant"}).alias("s"), "v").select(
        F.col("s")["a"].eqNullSafe(text_member(F.col("v"), "a")), F.to_json(F.col("s")["b"]).eqNullSafe(F.to_json(member(F.col("v"), "b"))),
        F.col("s")["b"].isNull() == member(F.col("v"), "b").isNull())
    assert [tuple(r) for r in both.collect()] == [(True, True, True)] * len(texts)


def test_all_objects_in_one_pass_equal_single_extracts(spark):
    events = [dict(EVENT, object_type=o, event_type=k, after=a) for o in ("Account", "Contact", "Case", "Lead") for k in ("INSERT", "UPDATE", "DELETE", "MERGE")
              for a in (EVENT["after"], {"id": 7, "created_date": "no", "account_id": "A"}, None)]
    found = parse.envelope(parsed(spark, *events))
    wanted = {o: {"object_type": lambda r: r["object_type"], "id": lambda r: r["id"], "unfit": lambda r: r["cast_errors"],
                  "account": (lambda r: F.lit(None).cast("string")) if o == "Account" else (lambda r: r["account_id"])}
              for o in ("Account", "Contact", "Case")}
    singles = [tuple(r) for o in wanted for r in parse.extract_record(found, o, at(), flag_casts=True).select(
        "object_type", "id", F.col("cast_errors").alias("unfit"), F.lit(None).alias("account") if o == "Account" else "account_id").collect()]
    assert singles and sorted(map(str, singles)) == sorted(str(tuple(r)) for r in parse.extract_records(found, wanted, at()).collect())


def test_all_objects_read_the_events_once(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.queries()["cdc_extract_objects"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


# Bytes of a method above which the JVM does not compile it, so that it runs interpreted for every row.
HUGE_METHOD = 8000


@pytest.mark.parametrize("name", ["error_types", "threshold_gate", "route_counts", "validate_cdc", "validation_stats"])
def test_generated_methods_are_small_enough_to_be_compiled(spark, sf_dir, capsys, name):
    df = importlib.import_module("__spark_entry__").queries()[name](spark, sf_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < HUGE_METHOD


def test_dirty_messages_keep_their_texts(spark, sf_dir):
    from crmflow.plans.feed import cdc_messages

    text = {r.message_id: bytes(r.value) for r in cdc_messages(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    of = {(r.k, r.event_type): text[f"MSG-{r.event_id}"] for r in rows.collect()}
    assert all(v.startswith(b"{{") for (k, _), v in of.items() if k == 71) and all(v.endswith(b"}\xff") for (k, _), v in of.items() if k == 73)
    updates = {k: v for (k, kind), v in of.items() if kind not in ("signup", "error") and k != 13}
    assert b'"changed_fields":[],' in updates[41] and b'"changed_fields":"annual_revenue",' in updates[43]
    assert b'"changed_fields":["annual_revenue"],' in updates[1]
    after = {k: v[v.index(b'"after"'):] for k, v in updates.items() if k in (1, 47, 53)}
    assert b'"last_modified_date":12345' in after[47] and b"last_modified_date" not in after[53] and b'"last_modified_date":"2024' in after[1]

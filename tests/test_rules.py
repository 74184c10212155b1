"""Validation rules on small literal records."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from crmflow.functions.rules import (
    CDC_RULES, RECORD_RULES, Rule, apply_rules, codes, messages, with_cdc_errors, with_schema_errors,
)
from crmflow.operators import parse, quality, routing
from crmflow.registry import ACCOUNT, HISTORY

AS_OF = F.lit
ACCOUNT_ROW = {
    "id": "001700000000042QAB", "name": "Brook Mill", "type": "Customer", "annual_revenue": 730500,
    "created_date": "2023-01-15T05:06:07Z", "last_modified_date": "2023-08-09T10:11:12Z",
}
INSERT = {
    "event_id": "EV-2024-000017", "event_type": "INSERT", "object_type": "Account",
    "record_id": "001700000000042QAB", "event_timestamp": "2025-10-29T08:07:06Z",
    "changed_fields": [], "before": None, "after": ACCOUNT_ROW, "source": "salesforce_cdc",
}
UPDATE = dict(INSERT, event_type="UPDATE", changed_fields=["name"], before=ACCOUNT_ROW,
              after=dict(ACCOUNT_ROW, name="Brook Mill Works"))
DELETE = dict(INSERT, event_type="DELETE", before=ACCOUNT_ROW, after=None)
CONTACT = {
    "id": "003700000000042QAB", "account_id": "001700000000042QAB", "first_name": "Ann", "last_name": "Lee",
    "created_date": "2023-01-15T05:06:07Z", "last_modified_date": "2023-01-15T05:06:07Z",
}


def as_of():
    return F.lit(datetime(2025, 10, 31, tzinfo=UTC))


def without(record, *names):
    return {k: v for k, v in record.items() if k not in names}


def envelopes(spark, events):
    rows = [(json.dumps(e).encode(),) for e in events]
    return parse.envelope(parse.parse_messages(spark.createDataFrame(rows, "value binary"), as_of()))


def found(spark, event, **options):
    checked = with_cdc_errors(envelopes(spark, [event]), as_of(), **options)
    return checked.select(codes(F.col("errors"))).first()[0]


def contact(**changes):
    return dict(INSERT, object_type="Contact", after={**CONTACT, **changes})


CASES = [
    (INSERT, []), (UPDATE, []), (DELETE, []),
    (without(INSERT, "event_type"), ["event_type", "null_fields"]),
    (dict(INSERT, event_type="MERGE"), ["event_type"]),
    (dict(INSERT, event_type=""), ["event_type", "null_fields"]),
    (without(INSERT, "object_type"), ["object_type", "null_fields"]),
    (dict(INSERT, object_type="Lead"), ["object_type"]),
    (without(INSERT, "record_id"), ["record_id"]),
    (dict(INSERT, record_id="invalid-id"), ["record_id"]),
    (dict(INSERT, record_id="001ABC"), ["record_id"]),
    (dict(INSERT, record_id=123456789012345), []),
    (without(INSERT, "event_timestamp"), ["timestamp"]),
    (dict(INSERT, event_timestamp="not-a-timestamp"), ["timestamp"]),
    (dict(INSERT, event_timestamp="2023"), ["timestamp"]),
    (dict(INSERT, event_timestamp="2099-12-31T23:59:59Z"), ["timestamp"]),
    (dict(INSERT, event_timestamp="2024-10-31T00:00:00+00:00"), []),
    (dict(INSERT, event_timestamp="2024-10-29T23:59:59Z"), ["timestamp"]),
    (dict(UPDATE, changed_fields=None), ["changed_fields"]),
    (dict(UPDATE, changed_fields="name"), ["changed_fields"]),
    (dict(UPDATE, changed_fields=[]), ["changed_fields"]),
    (dict(INSERT, after=None), ["null_fields"]),
    (dict(INSERT, after={}), ["null_fields"] * 4),
    (dict(INSERT, after=dict(ACCOUNT_ROW, name=None)), ["null_fields"]),
    (dict(INSERT, after=without(ACCOUNT_ROW, "name", "created_date")), ["null_fields"] * 2),
    (dict(UPDATE, before=None), ["null_fields"]),
    (dict(DELETE, before=None), ["null_fields"]),
    (dict(INSERT, after=dict(ACCOUNT_ROW, name=5)), ["field_types"]),
    (dict(INSERT, after=dict(ACCOUNT_ROW, annual_revenue="much")), ["field_types"]),
    (dict(INSERT, after=dict(ACCOUNT_ROW, annual_revenue=1.5)), []),
    (dict(INSERT, after=dict(ACCOUNT_ROW, annual_revenue=None, phone=None)), []),
    (dict(INSERT, after=dict(ACCOUNT_ROW, annual_revenue=True)), ["field_types"]),
    (dict(INSERT, after=dict(ACCOUNT_ROW, billing_address={"name": 7})), []),
    (dict(UPDATE, before=dict(ACCOUNT_ROW, industry=[1])), ["field_types"]),
    (contact(), []), (contact(account_id="short"), ["foreign_keys"]),
    (contact(account_id=None), []),
    (dict(INSERT, event_type="MERGE", record_id="x", object_type="Lead"), ["event_type", "object_type", "record_id"]),
]


def test_cdc_rules(spark):
    events = [dict(e, event_id=str(i)) for i, (e, _) in enumerate(CASES)]
    checked = with_cdc_errors(envelopes(spark, events), as_of())
    got = {int(r[0]): r[1] for r in checked.select("event_id", codes(F.col("errors"))).collect()}
    wrong = [(i, got[i], want) for i, (_, want) in enumerate(CASES) if got[i] != want]
    assert not wrong


def test_rule_selection_and_parity(spark):
    bad = dict(INSERT, record_id="x", after=dict(ACCOUNT_ROW, annual_revenue=True))
    assert found(spark, bad, selected=["validate_record_id_format"]) == ["record_id"]
    assert found(spark, bad, selected=[]) == []
    assert found(spark, bad, bool_is_number=True) == ["record_id"]
    assert list(CDC_RULES)[0] == "validate_event_type"
    with pytest.raises(ValueError):
        found(spark, bad, selected=["no_such_rule"])


def test_statistics_and_strict_alert(spark):
    events = [dict(INSERT, event_id=str(i)) for i in range(9)] + [dict(INSERT, event_id="x", record_id="bad")]
    checked = routing.validate_events(envelopes(spark, events), as_of())
    at = quality.validation_stats(checked, 0.10).first()
    assert (at.total_events, at.valid_events, at.invalid_events, at.error_rate) == (10, 9, 1, 0.1)
    assert at.exceeds_threshold is False
    assert quality.validation_stats(checked, 0.05).first().exceeds_threshold is True
    empty = quality.validation_stats(checked.where("false")).first()
    assert empty.error_rate == 0.0 and empty.exceeds_threshold is False
    counts = {r.code: r.events for r in quality.error_types(
        routing.validate_events(envelopes(spark, [dict(INSERT, after={})]), as_of())).collect()}
    assert counts == {"null_fields": 1}


def test_alert_and_threshold(spark):
    checked = routing.validate_events(envelopes(spark, [INSERT, dict(INSERT, event_id="bad", record_id="x")]), as_of())
    alerts = routing.quality_alerts(checked, as_of())
    message = json.loads(bytes(routing.alert_messages(alerts).first().value))
    assert (message["alert_type"], message["severity"], message["event_id"]) == ("data_quality_violation", "ERROR", "bad")
    assert message["event_data"]["after"]["name"] == "Brook Mill"
    assert len(message["validation_errors"]) == 1
    with pytest.raises(quality.ThresholdExceeded):
        quality.require_threshold(checked, 5.0)
    quality.require_threshold(checked, 50.0)


def test_batch_validation(spark):
    rows = spark.createDataFrame([
        ("001", "2023-01-15T05:06:07Z"), (None, None), ("", "2023-01-15"), ("002", "invalid-timestamp"),
    ], "id string, created_date string")
    got = quality.validate_batch(rows, as_of()).collect()
    assert [r._is_valid for r in got] == [True, False, False, False]
    assert got[1]._validation_errors == ["Null primary key: id"]
    assert got[3]._validation_errors == ["Invalid timestamp format: created_date"]
    off = quality.validate_batch(rows, as_of(), rules={"check_null_primary_keys": True, "validate_timestamps": False})
    assert off.where("_is_valid").count() == 2
    listed = quality.validate_batch(rows, as_of(), rules=["validate_timestamps"])
    assert listed.where("_is_valid").count() == 3
    no_key = quality.validate_batch(rows.drop("id"), as_of())
    assert no_key.where("_is_valid").count() == 0


def schema_messages(spark, record, strict=False, obj=ACCOUNT):
    df = spark.createDataFrame([(json.dumps(record),)], "t string").select(F.parse_json("t").alias("r"))
    return with_schema_errors(df, obj, "r", strict).select(messages(F.col("errors"))).first()[0]


def test_schema_errors(spark):
    good = dict(ACCOUNT_ROW, system_modstamp="2023-01-01T00:00:00Z", billing_address=[{"city": "x"}])
    assert schema_messages(spark, good) == []
    assert schema_messages(spark, good, strict=True) == ["Invalid type for billing_address: expected JSON"]
    assert schema_messages(spark, dict(good, name="  ")) == ["Missing required field: name"]
    assert schema_messages(spark, dict(good, annual_revenue=True)) == ["Invalid type for annual_revenue: expected NUMERIC"]
    assert schema_messages(spark, dict(good, annual_revenue=True), strict=True)[0].endswith("expected JSON")
    closed = {"id": "1", "valid_from": "2023-01-01", "is_current": False, "change_type": "INSERT",
              "record_data": {}, "ingestion_timestamp": "2023-01-01"}
    assert schema_messages(spark, closed, obj=HISTORY) == []
    assert "Missing required field: is_current" in schema_messages(spark, closed, True, HISTORY)


@pytest.mark.parametrize(("name", "record", "want"), [
    ("Account", {"name": "A", "type": "Customer", "annual_revenue": 1.0, "phone": "+14155550100", "website": "http://x"}, []),
    ("Account", {"name": " ", "type": "Other", "annual_revenue": -1.0, "phone": "555-0199", "website": "ftp://x"},
     ["required_field", "valid_account_type", "valid_revenue", "valid_phone_format", "valid_website_format"]),
    ("Account", {"name": "A", "type": None, "annual_revenue": None, "phone": "", "website": None}, []),
    ("Contact", {"email": "a@b", "first_name": "A", "last_name": "B", "title": "CEO"}, []),
    ("Contact", {"email": None, "first_name": None, "last_name": "B", "title": "King"},
     ["required_email", "valid_name_format", "valid_title"]),
    ("Opportunity", {"stage_name": "x", "probability": 100.0, "amount": 0.0, "close_date": "2023-01-15",
                     "created_date": "2023-01-15T05:06:07Z"}, []),
    ("Opportunity", {"stage_name": "", "probability": 101.0, "amount": -1.0, "close_date": "2023-01-14",
                     "created_date": "2023-01-15T05:06:07Z"},
     ["required_stage", "valid_probability", "valid_amount", "valid_close_date"]),
    ("Case", {"subject": "s", "status": "New", "priority": "Low", "origin": None}, []),
    ("Case", {"subject": "", "status": None, "priority": "No", "origin": "Fax"},
     ["required_subject", "valid_status", "valid_priority", "valid_origin"]),
])
def test_record_rules(spark, name, record, want):
    schema = ", ".join(f"{k} {'double' if k in ('annual_revenue', 'probability', 'amount') else 'string'}" for k in record)
    df = spark.createDataFrame([tuple(record.values())], schema)
    assert df.select(codes(apply_rules(RECORD_RULES[name]()))).first()[0] == want


def test_strict_parity_and_own_rules(spark):
    df = spark.createDataFrame([("A", None, None, "", "")], "name string, type string, annual_revenue double, phone string, website string")
    strict = df.select(codes(apply_rules(RECORD_RULES["Account"](strict_parity=True)))).first()[0]
    assert strict == ["valid_account_type", "valid_revenue"]
    own = Rule("short_name", "Name must be long", lambda: F.length("name") > 3)
    assert df.select(messages(apply_rules([own]))).first()[0] == ["Validation failed: Name must be long"]


def test_history_rules(spark):
    t = [datetime(2024, 1, d, tzinfo=UTC) for d in (1, 2)]
    df = spark.createDataFrame([(t[0], t[1], False, "INSERT"), (t[1], t[0], True, "MERGE"), (t[0], None, True, "DELETE")],
                               "valid_from timestamp, valid_to timestamp, is_current boolean, change_type string")
    got = [r[0] for r in df.select(codes(apply_rules(RECORD_RULES["History"]()))).collect()]
    assert got == [[], ["valid_dates", "valid_change_type", "current_record_validation"], []]


def test_orphans_duplicates_and_dedup(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, fk string")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    assert [r.id for r in quality.orphans(child, "fk", parent, "key").collect()] == [2]
    rows = spark.createDataFrame([("e", 2), ("e", 1), ("f", 3)], "event_id string, n int")
    assert [(r.event_id, r.n) for r in quality.duplicate_keys(rows, ["event_id"]).collect()] == [("e", 2)]
    assert sorted(tuple(r) for r in quality.deduplicate(rows, "event_id").collect()) == [("e", 1), ("f", 3)]
    single = quality.row_rule(rows, "small", F.col("n") < 3, 0.5).first()
    assert single.passed is True and round(single.pass_ratio, 3) == 0.667

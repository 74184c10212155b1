"""Readers and writers on temporary folders."""

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from crmflow.operators.quality import ThresholdExceeded, validate_batch
from crmflow.registry import ACCOUNT, sink_schema
from crmflow.sources import batch, readers, writers

AT = datetime(2025, 10, 31, 1, tzinfo=UTC)
ENVELOPE = {"records": [
    {"id": "001700000000042QAB", "name": "Brook Mill", "type": "Customer", "annual_revenue": 730500, "phone": "555-0199",
     "created_date": "2023-01-15T05:06:07Z", "billing_address": {"city": "X"}},
    {"id": "001700000000043QAB", "name": "Lantern Yard", "type": "Prospect", "annual_revenue": 41250},
], "totalSize": 2, "done": True}


def accounts(spark, path):
    (path / "a.json").write_text(json.dumps(ENVELOPE, indent=1))
    return readers.read_envelopes(spark, str(path), "Account", F.lit(AT))


def test_read_envelopes(spark, tmp_path):
    rows = accounts(spark, tmp_path).orderBy("id").collect()
    assert [r.name for r in rows] == ["Brook Mill", "Lantern Yard"]
    assert rows[0].source == "salesforce_api" and rows[0].object_type == "Account"
    with pytest.raises(Exception):
        readers.read_envelopes(spark, str(tmp_path / "none"), "Account", F.lit(AT)).count()
    (tmp_path / "a.json").write_text("no json")
    with pytest.raises(Exception):
        readers.read_envelopes(spark, str(tmp_path), "Account", F.lit(AT)).collect()


def test_batch_ingest_end_to_end(spark, tmp_path):
    (tmp_path / "in").mkdir()
    checked = validate_batch(accounts(spark, tmp_path / "in"), F.lit(AT))
    from crmflow.functions.values import encode_nested
    rows = encode_nested(checked, skip=["_validation_errors"])
    out = str(tmp_path / "raw_accounts")
    writers.append_raw(rows, out, sink_schema("Account"), ACCOUNT.cluster_by)
    writers.append_raw(rows, out, sink_schema("Account"), ACCOUNT.cluster_by)
    back = spark.read.parquet(out)
    assert back.count() == 4 and back.where("ingest_date = '2025-10-31'").count() == 4
    row = back.where("id = '001700000000042QAB'").first()
    assert float(row.annual_revenue) == 730500 and row.billing_address == '{"city":"X"}' and row._validation_errors == []


def test_ingest(spark, tmp_path):
    for name in ("account", "contact"):
        (tmp_path / name).mkdir()
    (tmp_path / "account" / "a.json").write_text(json.dumps(ENVELOPE))
    bad = {"records": [{"id": "003", "created_date": "soon"}, {"id": ""}, {"id": "004"}]}
    (tmp_path / "contact" / "c.json").write_text(json.dumps(bad))
    paths = {"Account": str(tmp_path / "account"), "Contact": str(tmp_path / "contact")}
    base = str(tmp_path / "lake")
    assert batch.ingest(spark, paths, base, F.lit(AT), enabled=["Account"]) == [f"{base}/raw_accounts"]
    with pytest.raises(ThresholdExceeded):
        batch.ingest(spark, {"Contact": paths["Contact"]}, base, F.lit(AT), max_error_percent=5.0)
    batch.ingest(spark, {"Contact": paths["Contact"]}, base, F.lit(AT), rules={"check_null_primary_keys": True})
    rows = {r.id: r for r in spark.read.parquet(f"{base}/raw_contacts").collect()}
    assert [rows[k]._is_valid for k in ("", "004")] == [False, True]
    letters = spark.read.parquet(f"{base}/raw_contacts_dead_letters").collect()
    assert [r.error for r in letters] == ["created_date"]


def bad_rows(spark):
    return spark.createDataFrame(
        [("1", "x", AT, "s", "Account", True, AT), (None, "2", AT, "s", "Account", True, AT), ("3", "3", AT, "s", "Account", True, AT)],
        "id string, annual_revenue string, ingestion_timestamp timestamp, source string, object_type string, "
        "_is_valid boolean, _validation_timestamp timestamp")


def test_bad_row_policies(spark, tmp_path):
    df, schema = bad_rows(spark), sink_schema("Account")
    out = str(tmp_path / "t")
    with pytest.raises(writers.BadRows):
        writers.append_raw(df, out, schema, ["id"], on_bad="fail")
    writers.append_raw(df, out, schema, ["id"])
    assert spark.read.parquet(out).count() == 1
    letters = {r.error for r in spark.read.parquet(out + "_dead_letters").collect()}
    assert letters == {"annual_revenue", "id"}
    originals = [r.original_message for r in spark.read.parquet(out + "_dead_letters").collect()]
    assert any('"annual_revenue":"x"' in o for o in originals)
    writers.append_raw(df, str(tmp_path / "u"), schema, ["id"], on_bad="continue", skip_invalid=True)
    assert spark.read.parquet(str(tmp_path / "u")).count() == 2
    with pytest.raises(writers.BadRows):
        writers.split_conforming(df.withColumn("new", F.lit(1)), schema)
    good, _ = writers.split_conforming(df.withColumn("new", F.lit(1)), schema, ignore_unknown=True)
    assert "new" not in good.columns


def test_dispositions_codecs_and_layout(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit(AT).alias("at"))
    out = str(tmp_path / "t")
    for codec in writers.CODECS:
        writers.write_table(writers.lay_out(df, "at", ["id"], 2), out, "WRITE_TRUNCATE", codec)
        assert spark.read.parquet(out).count() == 100
    with pytest.raises(Exception):
        writers.write_table(df.withColumn("ingest_date", F.to_date("at")), out, "WRITE_EMPTY")
    with pytest.raises(ValueError):
        writers.write_table(df, out, codec="rar")
    files = spark.read.parquet(out).groupBy(F.input_file_name().alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    lo_hi = sorted((r.lo, r.hi) for r in files.collect())
    assert all(a[1] < b[0] for a, b in zip(lo_hi, lo_hi[1:]))


def test_retention_and_lake(spark, tmp_path):
    out = str(tmp_path / "t")
    days = spark.createDataFrame([(1, date(2025, 9, 1)), (2, date(2025, 10, 2)), (3, date(2025, 10, 30))], "n int, ingest_date date")
    days.write.partitionBy("ingest_date").parquet(out)
    days.drop("ingest_date").write.parquet(out + "/_temp/x")
    assert readers.read_lake(spark, out).count() == 3
    assert writers.drop_expired(spark, out, date(2025, 10, 31), 30) == 1
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == [2, 3]
    writers.write_json_lines(days.select("n"), str(tmp_path / "j"))
    assert readers.read_lake(spark, str(tmp_path / "j"), "json", schema="n int").count() == 3
    (tmp_path / "arr.json").write_text('[{"n":1},{"n":2}]')
    assert readers.read_json_array(spark, str(tmp_path / "arr.json"), "n int").count() == 2


def test_discovery(spark, tmp_path):
    for name in ("a/x.parquet", "a/b/tmp/y.parquet", "a/_temp/z.parquet", "tmp/w.parquet", "a/b/deep.parquet"):
        spark.createDataFrame([(name,)], "n string").coalesce(1).write.parquet(str(tmp_path / "lake" / name))
    (tmp_path / "lake" / "note.json").write_text('{"n":"j"}')
    (tmp_path / "lake" / "note.txt").write_text("x")
    root = str(tmp_path / "lake")

    def names(df):
        return sorted({r.path.split("/lake/")[1].split(".parquet")[0] for r in df.collect()})

    assert names(readers.discover(spark, root)) == ["a/b/deep", "a/b/tmp/y", "a/x", "note.json", "tmp/w"]
    assert names(readers.discover(spark, root, ["**/*.parquet"], ["tmp/**", "_temp/**"])) == ["a/b/deep", "a/x"]
    assert names(readers.discover(spark, root, ["a/*/part-*", "*.json"], [])) == ["a/x", "note.json"]
    assert names(readers.discover(spark, root, ["no?e.json"])) == ["note.json"]

    def run():
        new = readers.read_new_files(spark, root, "n string", exclude=["tmp/**"])
        query = new.writeStream.format("parquet").option("path", str(tmp_path / "out")).trigger(availableNow=True)
        assert query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination(120)
        return sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == ["a/b/deep.parquet", "a/x.parquet"]
    spark.createDataFrame([("new",)], "n string").coalesce(1).write.mode("append").parquet(f"{root}/a/x.parquet")
    spark.createDataFrame([("out",)], "n string").coalesce(1).write.mode("append").parquet(f"{root}/tmp/w.parquet")
    assert run() == ["a/b/deep.parquet", "a/x.parquet", "new"]
    assert run() == ["a/b/deep.parquet", "a/x.parquet", "new"]


@pytest.mark.parametrize("split", [40, 700, 5000])
def test_one_file_in_many_tasks(spark, tmp_path, split):
    """Braces, brackets, quotes and escapes in strings, nested values, several files: the rows of a one-task read."""
    import random

    from pyspark.sql import types as T

    from crmflow.sources.split_json import read_large_envelopes

    draw = random.Random(split)
    odd = ['}', '{"a":[', '\\"', "\\", "]", "é中😀", '"records":[{', "\n", "x" * 90, ",", "\\\\}"]
    schema = T.StructType.fromDDL("id string, note string, inner struct<a:string,b:array<struct<c:string>>>, tags array<string>")

    def text():
        return "".join(draw.choice(odd) for _ in range(draw.randrange(6)))

    (tmp_path / "in").mkdir()
    for f in range(3):
        records = [{"id": f"{f}-{i}", "note": text(), "inner": {"a": text(), "b": [{"c": text()}] * draw.randrange(3)}, "tags": [text()] * draw.randrange(3)}
                   for i in range(40 * f + 1)]
        envelope = {"meta": {"deep": {"x": [{"y": text()}]}}, "records": records, "totalSize": len(records), "more": {"z": {}}, "done": True}
        (tmp_path / "in" / f"{f}.json").write_text(json.dumps(envelope, indent=f or None, ensure_ascii=f == 1) + "\n" * f)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        got = read_large_envelopes(spark, str(tmp_path / "in"), schema).collect()
        if split == 700:
            assert spark.read.option("lineSep", "}").text(str(tmp_path / "in")).rdd.getNumPartitions() > 10
            (tmp_path / "in" / "2.json").write_text('{"records":[{"id":"1"},{"id":"2"}')
            with pytest.raises(Exception, match="ends early"):
                read_large_envelopes(spark, str(tmp_path / "in"), schema).collect()
            (tmp_path / "in" / "2.json").write_text('{"records":[{"id":"1"}],"errors":[{"id":"2"}]}')
            with pytest.raises(Exception, match="not one array"):
                read_large_envelopes(spark, str(tmp_path / "in"), schema).collect()
            return
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
        spark.conf.set("spark.sql.files.openCostInBytes", opened)
    want = spark.read.schema(T.StructType([T.StructField("records", T.ArrayType(schema))])).json(str(tmp_path / "in"), multiLine=True)
    want = want.select(F.inline("records")).collect()
    assert len(want) == 123 and sorted(map(str, got)) == sorted(map(str, want))

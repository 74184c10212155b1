"""The registered queries on the given tables, against brute force where that is short."""
import re
import zlib

import compare
import pytest

from crmflow.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def held_out(spark, sf_dir):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    return labels


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare.spark_rows(QUERIES[name](spark, sf_dir)) == compare.sql_rows(compare.duck(sf_dir), SQL[name])


def test_quality_of_held_out_rows(spark, held_out):
    got = [r for r in QUERIES["op6_quality_classifier"](spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    judged = [r["predicted"] == labels[r["doc_id"]] for r in got if r["doc_id"] in labels]
    assert len(judged) > 50 and sum(judged) >= 0.9 * len(judged)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_toxic_rows(spark, held_out):
    got = {r["doc_id"]: r["rejected"] for r in QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    assert sum(got[r["doc_id"]] for r in labels if r["toxic"] == 0) <= 3


def test_benchmark_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    texts = [(d["doc_id"], plain(d["text"])) for d in docs]
    want = {(d, i["item_id"]) for i in items for d, t in texts if plain(i["text"]) in t}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_benchmark_decontamination"](spark, "/root/testdata/sf0.01").collect()}
    assert want and len(want & got) >= 0.9 * len(want) and len(got - want) <= 0.2 * len(want)


def test_model_beats_unigrams(spark, sf_dir):
    got = [r for r in QUERIES["op9_language_model"](spark, sf_dir).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)

"""Streaming jobs give the batch answers."""

import pytest
from pyspark.sql import functions as F

from crmflow.operators import history as h
from crmflow.operators import parse, quality, routing
from crmflow.plans import feed
from crmflow.registry import OBJECT_TYPES
from crmflow.sources import readers
from crmflow.streaming import jobs


@pytest.fixture(scope="module")
def messages_dir(spark, sf_dir, tmp_path_factory):
    """All change messages in three files, the last one a replay of part of the second."""
    base = tmp_path_factory.mktemp("messages")
    rows = feed.cdc_messages(spark, sf_dir).cache()
    late = F.xxhash64("message_id") % 2 == 0
    rows.where(late).coalesce(1).write.parquet(str(base / "a"))
    rows.where(~late).coalesce(1).write.parquet(str(base / "b"))
    rows.where(~late & (F.length("message_id") == 6)).coalesce(1).write.parquet(str(base / "c"))
    return str(base)


def stream(spark, messages_dir, files=1):
    source = spark.readStream.schema(readers.MESSAGE_SCHEMA).option("maxFilesPerTrigger", files)
    return source.option("recursiveFileLookup", True).parquet(messages_dir)


def finish(query):
    assert query.awaitTermination(300)
    assert query.exception() is None


@pytest.fixture(scope="module")
def validated(spark, sf_dir):
    parsed = parse.parse_messages(feed.cdc_messages(spark, sf_dir), feed.as_of())
    return routing.validate_events(parse.envelope(parsed), feed.as_of()).cache()


def test_raw_job(spark, messages_dir, validated, tmp_path):
    job = jobs.CdcJob(spark, str(tmp_path / "out"), feed.as_of())
    finish(job.start_raw(stream(spark, messages_dir, 1000), str(tmp_path / "cp"), once=True))
    raw = spark.read.parquet(f"{job.base}/raw")
    want = {r.object_type: r.n for r in validated.where("is_valid").groupBy("object_type").agg(F.count("*").alias("n")).collect()}
    got = {r.object_type: r.n for r in raw.groupBy("object_type").agg(F.count("*").alias("n")).collect()}
    assert got == want
    assert spark.read.parquet(f"{job.base}/alerts").count() == validated.where("NOT is_valid").count()
    failed = parse.dead_letters(parse.parse_messages(feed.cdc_messages(spark, "/root/testdata/sf0.001"), feed.as_of()))
    assert spark.read.parquet(f"{job.base}/dead_letters").count() == failed.count() > 0
    assert spark.read.parquet(f"{job.base}/late").count() == 0
    assert job.last_metrics["events_received"] == validated.count()
    assert job.last_metrics["events_processed"] == sum(want.values())
    # A replayed batch replaces its own output.
    batch = spark.read.schema(readers.MESSAGE_SCHEMA).option("recursiveFileLookup", True).parquet(messages_dir)
    job.raw_batch(batch, 0)
    assert spark.read.parquet(f"{job.base}/raw").count() == sum(want.values())


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_history_job_equals_full_rebuild(spark, messages_dir, validated, tmp_path):
    job = jobs.CdcJob(spark, str(tmp_path / "out"), feed.as_of(), tracked=("Account", "Case"), buckets=2)
    finish(job.start_history(stream(spark, messages_dir), str(tmp_path / "cp"), once=True))
    for name in job.tracked:
        events = validated.where(F.col("is_valid") & (F.col("object_type") == name))
        full = h.apply_scd2(events, None)
        assert same(job.versions(name).history(), full)
        assert full.count() > 0
    job.rebuild_history()
    events = validated.where(F.col("is_valid") & (F.col("object_type") == "Case"))
    assert same(job.versions("Case").history(), h.apply_scd2(events, None))
    assert set(job.tracked) < set(OBJECT_TYPES)


def test_generic_job(spark, sf_dir, tmp_path):
    source = feed.generic_messages(spark, sf_dir)
    source.withColumns({"attributes": F.lit(None).cast("map<string,string>"), "message_id": F.lit(None).cast("string"),
                        "publish_time": F.lit(None).cast("timestamp")}).write.parquet(str(tmp_path / "in"))
    job = jobs.IngestJob(str(tmp_path / "out"), feed.as_of())
    finish(job.start(readers.read_messages(spark, str(tmp_path / "in")), str(tmp_path / "cp"), once=True))
    checked = parse.check_generic(parse.parse_messages(source, feed.as_of()))
    routes = {r.route: r.n for r in checked.groupBy("route").agg(F.count("*").alias("n")).collect()}
    assert spark.read.parquet(f"{job.base}/raw_events").count() == routes["valid"]
    assert spark.read.parquet(f"{job.base}/dead_letters").count() == routes["invalid"] + routes["failed"]


def test_windowed_counts(spark, sf_dir, tmp_path):
    rows = feed.events(spark, sf_dir).withColumnRenamed("ts", "event_timestamp")
    rows.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    counts = jobs.windowed_counts(source, jobs.HISTORY_WINDOW, ["event_type"])
    query = counts.writeStream.outputMode("complete").format("memory").queryName("hourly").trigger(availableNow=True)
    finish(query.option("checkpointLocation", str(tmp_path / "cp")).start())
    assert same(spark.table("hourly"), quality.tumbling_counts(rows, jobs.HISTORY_WINDOW, ["event_type"]))


def test_stream_deduplication(spark, sf_dir, tmp_path):
    rows = feed.events(spark, sf_dir).withColumnRenamed("ts", "event_timestamp")
    rows.unionByName(rows).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    once = jobs.deduplicated(source, "40 days").writeStream.format("memory").queryName("once").trigger(availableNow=True)
    finish(once.option("checkpointLocation", str(tmp_path / "cp")).start())
    assert same(spark.table("once"), rows)


def test_values_that_do_not_fit_are_dead_letters(spark, sf_dir, tmp_path):
    text = F.regexp_replace(F.col("value").cast("string"), '"created_date":"2024-01-0[^"]*"', '"created_date":"soon"')
    rows = feed.cdc_messages(spark, sf_dir).where("NOT value IS NULL AND try_validate_utf8(CAST(value AS STRING)) IS NOT NULL")
    job = jobs.CdcJob(spark, str(tmp_path / "out"), feed.as_of())
    job.raw_batch(rows.withColumn("value", text.cast("binary")), 1)
    letters = spark.read.parquet(f"{job.base}/dead_letters").where("error LIKE 'wrong type%'")
    raw = spark.read.parquet(f"{job.base}/raw")
    assert {r.error for r in letters.select("error").distinct().collect()} == {"wrong type: created_date"}
    assert letters.count() + raw.count() == job.last_metrics["events_processed"]


def test_late_events_are_kept_aside(spark, sf_dir, tmp_path):
    rows = feed.cdc_messages(spark, sf_dir).withColumn("publish_time", F.col("publish_time") + F.expr("interval 11 minutes"))
    job = jobs.CdcJob(spark, str(tmp_path / "out"), feed.as_of())
    job.raw_batch(rows, 7)
    late = spark.read.parquet(f"{job.base}/late")
    assert late.count() == spark.read.parquet(f"{job.base}/raw").count() > 0


def test_messages_with_one_event_id_are_not_lost(spark):
    texts = ['{"event_id":"A","n":1}', '{"event_id":"A","n":1}', '{"event_id":"A","n":2}', '{"event_id":"","n":3}',
             '{"event_id":"","n":4}', '{"n":5}', '{"n":6}', "broken", "broken", '{"event_id":"B","n":7}']
    rows = [(bytearray(t, "utf-8"), {}, str(i), None) for i, t in enumerate(texts)]
    rows += [(bytearray(b"\xff\xfe"), {}, "x", None), (bytearray(b"\xff\xfd"), {}, "y", None), (None, {}, "z", None)]
    batch = spark.createDataFrame(rows, "value binary, attributes map<string,string>, message_id string, publish_time timestamp")
    for n in (1, 5):
        parsed = parse.parse_messages(batch.repartition(n), feed.as_of())
        marked = jobs.mark_conflicts(jobs.distinct_messages(parsed)).cache()
        kept = sorted(r.text for r in marked.where("NOT conflict AND text IS NOT NULL").collect())
        assert kept == sorted(set(texts) - {texts[2]})
        assert marked.where("text IS NULL").count() == 3
        assert [r.original_message for r in jobs.conflict_letters(marked).collect()] == [texts[2]]


def counts(spark, path, column):
    return {r[0]: r.n for r in spark.read.parquet(path).groupBy(column).agg(F.count("*").alias("n")).collect()}


def test_redelivered_batches_change_nothing(spark, sf_dir, tmp_path):
    job = jobs.CdcJob(spark, str(tmp_path / "out"), feed.as_of(), tracked=("Account",), buckets=1)
    rows = feed.cdc_messages(spark, sf_dir)
    job.raw_batch(rows, 0)
    raw, letters = spark.read.parquet(f"{job.base}/raw").count(), counts(spark, f"{job.base}/dead_letters", "error")
    # All again, and for one kind of event the same id with another content.
    altered = rows.where("try_validate_utf8(CAST(value AS STRING)) IS NOT NULL AND message_id LIKE '%7'")
    altered = altered.withColumn("value", F.regexp_replace(F.col("value").cast("string"), '"Open"', '"Shut"').cast("binary"))
    job.raw_batch(rows.unionByName(altered), 1)
    now = counts(spark, f"{job.base}/dead_letters", "error")
    assert spark.read.parquet(f"{job.base}/raw").count() == raw == 840
    text = F.col("value").cast("string")
    whole = altered.where(F.try_parse_json(text).isNotNull() & text.contains('"Shut"')).count()
    assert now.pop("conflicting event id") == whole > 0
    # Broken messages have no id: a changed one is a new message.
    assert {k: v for k, v in now.items() if k != "invalid json"} == {k: v for k, v in letters.items() if k != "invalid json"}
    # The conflicting messages again: no second letter.
    job.raw_batch(altered, 2)
    assert counts(spark, f"{job.base}/dead_letters", "error")["conflicting event id"] == whole
    for n in (0, 1):
        job.history_batch(rows, n)
    assert same(job.versions("Account").history(), h.apply_scd2(_valid(spark, rows, "Account"), None))


def _valid(spark, rows, name):
    parsed = parse.parse_messages(rows, feed.as_of())
    return routing.validate_events(parse.envelope(parsed), feed.as_of()).where(F.col("is_valid") & (F.col("object_type") == name))


def test_redelivered_generic_events(spark, sf_dir, tmp_path):
    source = feed.generic_messages(spark, sf_dir)
    job = jobs.IngestJob(str(tmp_path / "out"), feed.as_of())
    job.batch(source, 0)
    first = spark.read.parquet(f"{job.base}/raw_events").count()
    letters = spark.read.parquet(f"{job.base}/dead_letters").count()
    other = F.regexp_replace(F.col("value").cast("string"), '"feed"', '"other"').cast("binary")
    job.batch(source.unionByName(source.limit(5).withColumn("value", other)), 1)
    assert spark.read.parquet(f"{job.base}/raw_events").count() == first > 0
    assert spark.read.parquet(f"{job.base}/dead_letters").count() == letters + 5


def test_ledger_folds_and_replays(spark, tmp_path):
    from crmflow.sources.seen import SeenIds

    ledger = SeenIds(spark, str(tmp_path / "seen"), fold_every=2)
    text = F.concat_ws("-", "id", "v")

    def arrivals(rows, batch):
        judged = ledger.judge(spark.createDataFrame(rows, "id string, v int"), batch, F.col("id"), text.cast("binary")).cache()
        ledger.record(judged, batch)
        ledger.fold()
        return sorted((r.id or "", r.v, r.arrival) for r in judged.collect())

    assert arrivals([("a", 1), ("a", 2), ("b", 1), (None, 1)], 0) == [("", 1, "first"), ("a", 1, "first"), ("a", 2, "conflict"), ("b", 1, "first")]
    assert arrivals([("a", 1), ("a", 2), ("a", 3), (None, 1), (None, 2), ("", 3), ("", 4)], 1) == [
        ("", 1, "repeated"), ("", 2, "first"), ("", 3, "first"), ("", 4, "first"),
        ("a", 1, "repeated"), ("a", 2, "repeated"), ("a", 3, "conflict")]
    for batch in range(2, 6):
        assert arrivals([("c", batch), ("a", 1)], batch) == [("a", 1, "repeated"), ("c", batch, "first" if batch == 2 else "conflict")]
    # Judged and recorded again, also after its run was folded: the same.
    assert arrivals([("c", 5), ("a", 1)], 5) == [("a", 1, "repeated"), ("c", 5, "conflict")]
    assert {r["level"] for r in ledger.generations.current()[1]["runs"]} == {1, 2}
    assert ledger.entries().groupBy("key", "content").count().where("count > 1").isEmpty()
    assert ledger.clean() >= 4 and ledger.entries().count() == 12


class Fragile(jobs.CdcJob):
    """A job whose evaluation raises on messages that say so."""

    def _events(self, parsed):
        bad = F.raise_error(F.concat(F.lit("cannot process "), F.col("text"))).cast("string")
        return super()._events(parsed).withColumn("table_route", F.when(F.col("text").contains("POISON"), bad).otherwise(F.col("table_route")))


def poisoned(spark, sf_dir, n=1):
    rows = feed.cdc_messages(spark, sf_dir).where("message_id LIKE '%32'").cache()
    good = rows.where("try_validate_utf8(CAST(value AS STRING)) IS NOT NULL")
    spoiled = good.orderBy("message_id").limit(n).withColumns({
        "value": F.regexp_replace(F.col("value").cast("string"), '"EVT-', '"POISON-').cast("binary"), "message_id": F.concat(F.lit("P"), "message_id")})
    return rows.unionByName(spoiled)


def test_poison_rows_end_in_the_letters(spark, sf_dir, tmp_path, n=2):
    job = Fragile(spark, str(tmp_path / "out"), feed.as_of(), retry_seconds=0.0)
    batch = poisoned(spark, sf_dir, n)
    job.attempt(batch, 0)
    letters = spark.read.parquet(f"{job.base}/dead_letters").where("error = 'processing failed'")
    assert letters.count() == n and letters.where("NOT original_message LIKE '%POISON-%'").isEmpty()
    clean = feed.cdc_messages(spark, sf_dir).where("message_id LIKE '%32'")
    parsed = parse.parse_messages(clean, feed.as_of())
    assert spark.read.parquet(f"{job.base}/raw").count() == routing.validate_events(parse.envelope(parsed), feed.as_of()).where("is_valid").count()
    attempts = jobs.Attempts(spark, f"{job.base}/attempts/raw")
    assert len(attempts.failures("", 0)) == 3 and all(f["error"] for f in attempts.failures("", 0))
    assert not attempts.failures("", 1)


def test_attempts_and_policies(spark, tmp_path):
    from crmflow.streaming.attempts import Attempts

    batch, waits, calls = spark.range(20).withColumnRenamed("id", "n"), [], []

    def work(df, batch_id, fail_times=99):
        calls.append(batch_id)
        if len(calls) <= fail_times:
            df.select(F.raise_error("no")).collect()

    def probe(df):
        df.select(F.when(F.col("n") == 7, F.raise_error("seven").cast("long")).otherwise(F.col("n"))).write.format("noop").mode("overwrite").save()

    once = Attempts(spark, str(tmp_path / "a"), delay=1.0, sleep=waits.append)
    once.run(lambda d, i: work(d, i, 2), probe, None, batch, 4)
    assert calls == [4, 4, 4] and waits == [1.0, 2.0] and len(once.failures("", 4)) == 2
    calls.clear()
    with pytest.raises(RuntimeError, match="failed 3 times"):
        Attempts(spark, str(tmp_path / "b"), policy="fail", sleep=waits.append).run(work, probe, None, batch, 0)
    assert len(calls) == 3
    # A restarted job goes on counting.
    calls.clear()
    with pytest.raises(RuntimeError, match="failed 3 times"):
        Attempts(spark, str(tmp_path / "b"), policy="fail", sleep=waits.append).run(work, probe, None, batch, 0)
    assert calls == []
    # The store fails, no row does.
    with pytest.raises(RuntimeError, match="no row"):
        Attempts(spark, str(tmp_path / "c"), sleep=waits.append).run(work, lambda df: df.collect(), None, batch, 0)
    kept, rejected = [], []

    def store(df, batch_id):
        probe(df)
        kept[:] = sorted(r.n for r in df.collect())

    for policy in ("continue", "dlq"):
        Attempts(spark, str(tmp_path / policy), policy=policy, sleep=waits.append).run(
            store, probe, lambda df, i: rejected.extend(r.n for r in df.collect()), batch, 0)
        assert kept == [n for n in range(20) if n != 7] and rejected == ([7] if policy == "dlq" else [])


def test_days_of_raw_rows(spark, sf_dir, tmp_path):
    """Days outermost; small files fold into sorted ones with disjoint ids; old days go; a day is pruned to."""
    from datetime import date

    rows = feed.cdc_messages(spark, sf_dir)
    job = jobs.CdcJob(spark, str(tmp_path / "out"), F.lit("2024-01-31").cast("timestamp"))
    job.raw_batch(rows.where("message_id LIKE '%1'"), 0)
    job.as_of = feed.as_of()
    for n, last in enumerate("234", 1):
        job.raw_batch(rows.where(f"message_id LIKE '%{last}'"), n)
    path = f"{job.base}/raw"
    raw = spark.read.parquet(path)
    before = sorted(map(str, raw.collect()))
    files = lambda: {f for f in (tmp_path / "out" / "raw").rglob("*.parquet") if "_staging" not in str(f)}
    assert {f.relative_to(tmp_path / "out" / "raw").parts[0] for f in files()} == {"ingest_date=2024-01-31", "ingest_date=2024-02-01"}
    many = len(files())
    assert job.fold_raw("2024-02-01") and not job.fold_raw("2023-01-01")
    assert len(files()) < many and sorted(map(str, spark.read.parquet(path).select(*raw.columns).collect())) == before
    spans = spark.read.parquet(path).where("ingest_date = '2024-02-01'").groupBy("object_type", F.input_file_name().alias("f")).agg(
        F.min("id").alias("lo"), F.max("id").alias("hi")).collect()
    for kind in {r.object_type for r in spans}:
        own = sorted((r.lo, r.hi) for r in spans if r.object_type == kind)
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))
    plan = spark.read.parquet(path).where("ingest_date = '2024-01-31'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert job.drop_raw(date(2024, 3, 2)) == 1
    assert {str(r[0]) for r in spark.read.parquet(path).select("ingest_date").distinct().collect()} == {"2024-02-01"}
    # A dropped batch stays recorded.
    job.raw_batch(rows.where("message_id LIKE '%1'"), 0)
    assert spark.read.parquet(path).where("ingest_date = '2024-01-31'").isEmpty()


def test_publication_is_finished_after_a_stop(spark, tmp_path, monkeypatch):
    from crmflow.sources import staged

    df = spark.range(8).selectExpr("id", "date'2024-01-01' + CAST(id % 2 AS INT) AS ingest_date")
    path, moves = str(tmp_path / "t"), []
    move = staged.Files.move

    def stops(self, source, target):
        if target[0].startswith("ingest_date"):
            moves.append(target)
            if len(moves) > 1:
                raise KeyboardInterrupt
        return move(self, source, target)

    monkeypatch.setattr(staged.Files, "move", stops)
    with pytest.raises(KeyboardInterrupt):
        staged.write_once(df.repartition(4), path, 0, ["ingest_date"])
    monkeypatch.undo()
    assert not staged.recorded(spark, path, "", 0)
    # The same batch again: what was decided is finished, nothing is written twice.
    assert staged.write_once(df, path, 0, ["ingest_date"]) is False
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(8))
    assert staged.write_once(df, path, 0, ["ingest_date"], "another stream") is True
    assert spark.read.parquet(path).count() == 16


def test_windows_close_once(spark, tmp_path):
    from crmflow.streaming.windows import WindowJob

    job = WindowJob(spark, str(tmp_path / "w"), "1 hour", "10 minutes", ("kind",), "at")

    def batch(i, *rows):
        return job.batch(spark.createDataFrame([(k, t and f"2024-01-01 {t}:00") for k, t in rows], "kind string, at string").withColumn("at", F.col("at").cast("timestamp")), i)

    def closed():
        return sorted(((r.window_start.hour, r.kind, r.n, r.batch_id) for r in job.closed().collect()), key=str)

    assert batch(0, ("a", "10:05"), ("a", "10:59"), ("b", "11:05"), (None, "10:00"), ("a", None))
    assert closed() == [] and job.open().count() == 3
    # 11:09 less ten minutes is before 11:00: nothing closes, and 10:20 still counts.
    assert batch(1, ("a", "10:20"), ("b", "11:09"))
    assert closed() == [] and not batch(1, ("a", "10:20"))
    assert batch(2, ("b", "11:10"))
    assert sorted(closed(), key=str) == sorted([(10, "a", 3, 2), (10, None, 1, 2)], key=str)
    assert batch(3, ("a", "10:30"), ("a", "11:30"))
    assert job.state()["late"] == 1 and spark.read.parquet(f"{job.base}/late").first().kind == "a"
    assert batch(4) and batch(5, ("z", "23:00"))
    assert [(h_, k, n, b) for h_, k, n, b in closed() if b == 5] == [(11, "a", 1, 5), (11, "b", 3, 5)]
    assert [(r.kind, r.n) for r in job.open().collect()] == [("z", 1)]


def test_windows_of_a_stream(spark, messages_dir, validated, tmp_path):
    from crmflow.streaming.metrics import StreamMetrics

    listener = StreamMetrics(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(listener)
    try:
        names = []
        for part in ("a", "b"):
            job = jobs.CdcJob(spark, str(tmp_path / part), feed.as_of())
            query = job.start_windows(stream(spark, f"{messages_dir}/{part}", 1000), str(tmp_path / f"cp-{part}"), once=True)
            finish(query)
            names.append((query.id, part))
            # Batches are numbered by stream: the state knows which one.
            assert job.windows().state(query.id)["batch"] == 0
            counts = job.windows().closed().select("window_start", "object_type", "n").unionByName(
                job.windows().open(query.id).select("window_start", "object_type", "n"))
            parsed = parse.parse_messages(spark.read.parquet(f"{messages_dir}/{part}"), feed.as_of())
            valid = routing.validate_events(parse.envelope(parsed), feed.as_of()).where("is_valid")
            assert same(counts, quality.tumbling_counts(valid, jobs.HISTORY_WINDOW, ["object_type"]))
        rows = listener.wait(2)
    finally:
        spark.streams.removeListener(listener)
    by_query = {r["query_id"]: r["rows"] for r in rows if r["rows"]}
    assert by_query == {str(i): spark.read.parquet(f"{messages_dir}/{part}").count() for i, part in names}
    stored = spark.read.json(str(tmp_path / "metrics"))
    assert stored.where("rows > 0").groupBy("query_id").count().count() == 2


def test_publish_counts(spark, tmp_path):
    from crmflow.sources import writers

    rows = spark.createDataFrame([(bytearray(b"a"),), (None,), (bytearray(b"b" * 50),)], "value binary")
    report = writers.publish(rows, "", "t", fmt="parquet", path=str(tmp_path / "p"), max_bytes=10)
    assert report == {"sent": 1, "failed": 2} and spark.read.parquet(str(tmp_path / "p")).count() == 1
    assert writers.publish(rows.limit(0), "", "t", fmt="parquet", path=str(tmp_path / "q")) == {"sent": 0, "failed": 0}

"""Type-2 history: fixed cases, and equality of every batching with the full rebuild."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crmflow.operators import history as h
from crmflow.operators import quality
from crmflow.functions.values import changed_fields, field_changes
from crmflow.sources.versions import VersionsTable

T0 = datetime(2025, 10, 30, 15, 30, tzinfo=UTC)
SCHEMA = "event_id string, record_id string, event_type string, event_timestamp timestamp, b string, a string"


def events_of(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({"before": F.parse_json("b"), "after": F.parse_json("a")}).drop("a", "b")


ACCOUNT = '{"id":"001","name":"Acme","annual_revenue":1000000,"last_modified_date":"2025-10-30","system_modstamp":"x"}'
CHANGED = '{"id":"001","name":"Acme Corporation","annual_revenue":1200000,"last_modified_date":"2025-10-31","system_modstamp":"y"}'


def hours(n):
    return T0 + timedelta(hours=n)


def summary(history):
    rows = history.orderBy("id", "valid_from").collect()
    return [(r.id, r.valid_from, r.valid_to, r.is_current, r.change_type, r.changed_fields) for r in rows]


def test_insert_update_delete(spark):
    events = events_of(spark, [
        ("E1", "001", "INSERT", hours(0), None, ACCOUNT),
        ("E2", "001", "UPDATE", hours(1), ACCOUNT, CHANGED),
        ("E3", "001", "DELETE", hours(2), CHANGED, None),
    ])
    naive = [hours(i).astimezone().replace(tzinfo=None) for i in range(3)]
    got = summary(h.apply_scd2(events, None))
    assert got == [
        ("001", naive[0], naive[1], False, "INSERT", []),
        ("001", naive[1], naive[2], False, "UPDATE", ["annual_revenue", "last_modified_date", "name"]),
    ]


def test_noop_update_tie_and_reopening(spark):
    events = events_of(spark, [
        ("E1", "r", "INSERT", hours(0), None, '{"n":1}'),
        ("E2", "r", "UPDATE", hours(1), '{"n":1,"source":"a"}', '{"n":1.0,"source":"b"}'),
        ("E3", "r", "UPDATE", hours(2), '{"n":1}', '{"n":2}'),
        ("E4", "r", "UPDATE", hours(2), '{"n":2}', '{"n":3}'),
        ("E5", "r", "UPDATE", hours(2), '{"n":3}', '{"n":3}'),
        ("E6", "r", "DELETE", hours(3), '{"n":3}', None),
        ("E7", "r", "UPDATE", hours(4), '{"n":3}', '{"n":4}'),
        ("E8", None, "INSERT", hours(4), None, '{"n":9}'),
        ("E9", "q", "DELETE", hours(4), '{"n":9}', None),
    ])
    rows = h.apply_scd2(events, None).orderBy("valid_from").collect()
    assert [(r.event_id, r.record_data, r.is_current) for r in rows] == [
        ("E1", '{"n":1}', False), ("E4", '{"n":3}', False), ("E7", '{"n":4}', True)]
    assert h.apply_scd2(events, None, emit_tombstones=True).where("change_type = 'DELETE'").count() == 2


def random_log(seed, size=160):
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        rid = "hot" if rng.random() < 0.4 else f"r{rng.randrange(6)}"
        kind = rng.choices(["INSERT", "UPDATE", "DELETE"], [1, 4, 1])[0]
        before, after = (f'{{"s":{rng.randrange(3)}}}' for _ in range(2))
        rows.append((f"E{i:04d}", rid, kind, T0 + timedelta(minutes=rng.randrange(90)),
                     None if kind == "INSERT" else before, None if kind == "DELETE" else after))
    return rows


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hot_rebuild_equals_plain(spark, seed):
    events = events_of(spark, random_log(seed)).cache()
    copies = events.unionByName(events)
    hot = h.hot_records(copies, 10)
    assert hot is not None
    assert same(h.apply_scd2(events, None), h.apply_scd2(copies, hot))


@pytest.mark.parametrize("ids", [None, "E1"])
def test_ties_give_one_answer(spark, ids):
    """Different changes of one instant with equal or null ids: the same row in every plan."""
    rows = [(ids, r, "UPDATE", hours(i % 2), '{"n":0}', f'{{"n":{i}}}') for i in range(1, 13) for r in ("x", "y")]
    events = events_of(spark, rows).cache()
    hot = h.hot_records(events, 3)
    assert hot is not None
    plain = [h.apply_scd2(events.repartition(n, F.rand(n)), None).cache() for n in (1, 3, 8)]
    assert [r.record_data for r in plain[0].orderBy("id", "valid_from").collect()] == ['{"n":8}', '{"n":9}'] * 2
    for other in [*plain[1:], h.apply_scd2(events, hot)]:
        assert same(plain[0], other)
    states = [h.current_state(events.repartition(n, F.rand(n))).orderBy("record_id").collect() for n in (1, 3, 8)]
    assert [r.after.toPython()["n"] for r in states[0]] == [9, 9]
    assert len({str(s) for s in states}) == 1


def test_resent_event_adds_no_version(spark):
    events = events_of(spark, [
        ("E1", "r", "INSERT", hours(0), None, '{"n":1}'),
        ("E2", "r", "UPDATE", hours(1), '{"n":1}', '{"n":2}'),
        ("E2", "r", "UPDATE", hours(5), '{"n":1}', '{"n":2}'),
        (None, "r", "UPDATE", hours(2), '{"n":2}', '{"n":3}'),
        (None, "r", "UPDATE", hours(3), '{"n":3}', '{"n":4}'),
    ])
    got = h.apply_scd2(events, None, repeated_ids=True).orderBy("valid_from").collect()
    assert [(r.event_id, r.record_data) for r in got] == [("E1", '{"n":1}'), ("E2", '{"n":2}'), (None, '{"n":3}'), (None, '{"n":4}')]
    assert h.apply_scd2(events, None).count() == 5


def test_small_doubles_compare_by_value(spark):
    pairs = [("1e-12", "5e-12", True), ("1e-12", "0.000000000001", False), ("1e2", "100", False), ("0.1e0", "0.1", False),
             ("1e300", "2e300", True), ("1e300", "1e300", False), ("-0.0e0", "0", False)]
    df = spark.createDataFrame([(i, f'{{"v":{b}}}', f'{{"v":{a}}}') for i, (b, a, _) in enumerate(pairs)], "i int, b string, a string")
    df = df.select("i", F.parse_json("b").alias("before"), F.parse_json("a").alias("after"))
    got = df.select("i", changed_fields(df).alias("c")).orderBy("i").collect()
    assert [bool(r.c) for r in got] == [x for *_, x in pairs]


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("max_rows", [12, 10_000])
def test_any_batches_equal_full_rebuild(spark, tmp_path, seed, max_rows):
    """Out of order, replayed, several events of a record per batch: one answer."""
    rng = random.Random(seed)
    log = random_log(seed)
    shuffled = log[:]
    rng.shuffle(shuffled)
    cuts = sorted(rng.sample(range(1, len(log)), 2))
    batches = [shuffled[: cuts[0]], shuffled[cuts[0]: cuts[1]], shuffled[cuts[1]:] + shuffled[:20]]
    batches.append(batches[1])
    full = h.apply_scd2(events_of(spark, log), None)
    table = VersionsTable(spark, str(tmp_path / "versions"), buckets=3)
    for batch in batches:
        table.merge(h.boundaries(events_of(spark, batch)), max_rows)
    stored = table.history().cache()
    assert same(stored, full)
    assert quality.history_problems(stored).isEmpty()
    overlap = stored.alias("x").join(stored.alias("y"), "id").where(
        "x.valid_from < y.valid_from AND (x.valid_to IS NULL OR x.valid_to > y.valid_from)")
    assert overlap.isEmpty()
    at = (T0 + timedelta(minutes=45)).isoformat()
    valid = stored.where(F.lit(at).cast("timestamp").between(F.col("valid_from"), F.coalesce("valid_to", F.lit("9999-01-01").cast("timestamp"))))
    valid = valid.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(at).cast("timestamp")))
    assert same(table.as_of(at), valid)
    table.rebuild(h.boundaries(events_of(spark, log)))
    assert same(table.history(), full)


def test_merge_touches_only_changed_days(spark, tmp_path):
    day = timedelta(days=1)
    rows = [(f"E{i}", f"r{i % 4}", "INSERT", T0 + i * day, None, f'{{"s":{i}}}') for i in range(12)]
    path = tmp_path / "v"
    table = VersionsTable(spark, str(path), buckets=1)
    table.merge(h.boundaries(events_of(spark, rows)))
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet") if "period=open" not in str(f)}
    table.merge(h.boundaries(events_of(spark, [("E99", "r0", "INSERT", T0 + 30 * day, None, '{"s":99}')])))
    after = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    assert before and all(after.get(f) == t for f, t in before.items())


def test_merged_store_equals_full(spark):
    log = random_log(9)
    moves = h.boundaries(events_of(spark, log)).cache()
    first, second = moves.where("event_id < 'E0080'"), moves.where("event_id >= 'E0060'")
    store = h.as_history(h.chain(first, None), emit_tombstones=True)
    merged = h.without_tombstones(h.merged_store(store, second, None))
    assert same(h.apply_scd2(events_of(spark, log), None), merged)


def test_changed_fields_and_values(spark):
    df = spark.createDataFrame([
        ('{"id":1,"name":"a","revenue":1}', '{"id":1,"name":"b","revenue":1}'),
        ('{"id":1,"name":"a","phone":null}', '{"id":1,"name":"a"}'),
        ('{"id":1,"system_modstamp":"x","source":"p"}', '{"id":1,"system_modstamp":"y","source":"q"}'),
        ('{"id":1,"x":1e0,"y":12,"z":[1]}', '{"id":1,"x":1,"y":"12","z":[1,2]}'),
    ], "b string, a string").withColumns({"before": F.parse_json("b"), "after": F.parse_json("a")})
    found = [r[0] for r in df.select(changed_fields(df)).collect()]
    assert found == [["name"], [], [], ["y", "z"]]
    tracked = [r[0] for r in df.select(changed_fields(df, tracked=["z"])).collect()]
    assert tracked == [[], [], [], ["z"]]
    changes = df.select(field_changes(changed_fields(df), F.col("before"), F.col("after"))).first()[0]
    assert changes["name"].before == '"a"' and changes["name"].after == '"b"'


def test_stats_count_before_collapse(spark):
    events = events_of(spark, [
        ("E1", "r", "INSERT", hours(0), None, '{"n":1}'),
        ("E2", "r", "UPDATE", hours(0), '{"n":1}', '{"n":2}'),
        ("E3", "q", "UPDATE", hours(0), '{"n":1}', '{"n":1}'),
        ("E4", "q", "INSERT", hours(0), None, None),
        ("E5", "q", None, hours(0), None, '{"n":1}'),
        ("E6", None, "INSERT", hours(0), None, '{"n":1}'),
    ])
    row = h.scd2_stats(events).first()
    assert (row.total_events, row.records_processed, row.records_inserted, row.records_updated, row.errors) == (6, 2, 1, 1, 2)


def test_current_state_and_snapshot_diff(spark):
    events = events_of(spark, [
        ("E1", "r", "INSERT", hours(0), None, '{"n":1}'), ("E2", "r", "UPDATE", hours(1), '{"n":1}', '{"n":2}'),
        ("E3", "q", "INSERT", hours(0), None, '{"n":1}'), ("E4", "q", "DELETE", hours(1), '{"n":1}', None),
    ])
    assert [(r.record_id, r.event_type) for r in h.current_state(events).collect()] == [("r", "UPDATE")]
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, "z")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "w"), (4, "n")], "id int, v string")
    diff = {r.record_id: (r.event_type, r.changed_fields) for r in h.snapshot_diff(a, b, "id").collect()}
    assert diff == {2: ("UPDATE", ["v"]), 3: ("DELETE", []), 4: ("INSERT", [])}


def test_as_of_join(spark):
    history = spark.createDataFrame([
        ("r", hours(0), hours(2), "a"), ("r", hours(2), hours(4), "b"), ("q", hours(0), None, "c"),
    ], "id string, valid_from timestamp, valid_to timestamp, state string")
    facts = spark.createDataFrame([
        (1, "r", hours(-1)), (2, "r", hours(0)), (3, "r", hours(2)), (4, "r", hours(4)), (5, "q", hours(9)), (6, "z", hours(1)),
    ], "n int, who string, at timestamp")
    for hot in (None, h.hot_records(facts.withColumnRenamed("who", "record_id"), 1)):
        got = h.as_of_join(facts, history, "who", "at", ["state"], ["n"], hot)
        assert sorted((r.n, r.state) for r in got.collect()) == [(2, "a"), (3, "b"), (5, "c")]


def test_snapshot_diff_sees_an_added_column(spark):
    from crmflow.operators.history import snapshot_diff

    old = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    new = spark.createDataFrame([("1", "a", "x"), ("2", "b", None)], "id string, name string, phone string")
    assert [(r.record_id, r.changed_fields) for r in snapshot_diff(old, new, "id").collect()] == [("1", ["phone"])]


def _boundary(spark, *rows):
    return h.boundaries(events_of(spark, [(e, r, "INSERT", at, None, f'{{"e":"{e}"}}') for e, r, at in rows]))


def test_a_merge_writes_only_its_delta(spark, tmp_path):
    table = VersionsTable(spark, str(tmp_path / "v"), buckets=2, compact_after=3)
    table.rebuild(_boundary(spark, *[(f"E{i}", f"r{i}", hours(0)) for i in range(50)]))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "v").rglob("*.parquet")}
    table.merge(_boundary(spark, ("N1", "r7", hours(1))), batch_id=0)
    new = [f for f in (tmp_path / "v").rglob("*.parquet") if f not in files]
    assert new and all("/deltas/" in str(f) for f in new)
    assert {f: f.stat().st_mtime_ns for f in files} == files
    assert table.history().count() == 51 and table.history().where("id = 'r7' AND is_current").first().event_id == "N1"
    # A recorded batch is not stored again, whatever it holds.
    table.merge(_boundary(spark, ("N1", "r7", hours(1))), batch_id=0)
    assert len(table._state()["deltas"]) == 1 and table._state()["batches"] == {"": [[0, 0]]}
    assert table.as_of(hours(0)).count() == 50 and table.as_of(hours(2)).where("event_id = 'N1'").count() == 1
    assert same(table.current(), table.history().where("is_current"))
    table.compact()
    assert not table._state()["deltas"] and table.history().count() == 51
    assert same(table.current(), table.history().where("is_current"))


def test_untouched_records_are_read_without_a_shuffle(spark, tmp_path):
    table = VersionsTable(spark, str(tmp_path / "v"), buckets=2)
    table.rebuild(_boundary(spark, *[(f"E{i}", f"r{i}", hours(i % 3)) for i in range(50)]))
    table.append(_boundary(spark, ("N1", "r7", hours(5))))
    plan = table.history()._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan
    physical = table.history()._jdf.queryExecution().executedPlan().toString()
    anti = next(x for x in physical.splitlines() if "LeftAnti" in x)
    assert "BroadcastHashJoin" in anti and "BuildRight" in anti


def test_a_reader_keeps_its_generation(spark, tmp_path):
    table = VersionsTable(spark, str(tmp_path / "v"), buckets=1, compact_after=1)
    table.merge(_boundary(spark, ("E1", "r", hours(0))))
    before = table.history()
    table.merge(_boundary(spark, ("E2", "r", hours(1))))
    assert [r.event_id for r in before.collect()] == ["E1"]
    now = table.history().orderBy("valid_from").collect()
    assert [(r.event_id, r.is_current) for r in now] == [("E1", False), ("E2", True)]
    assert table.clean() > 0
    assert table.history().count() == 2


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    table = VersionsTable(spark, str(tmp_path / "v"), buckets=1, compact_after=1)
    table.merge(_boundary(spark, ("E1", "r", hours(0))), batch_id=0)
    held = table.generations.current()

    def dies(change):
        raise KeyboardInterrupt

    monkeypatch.setattr(table.generations, "update", dies)
    for step in (lambda: table.append(_boundary(spark, ("E2", "r", hours(1))), 1), lambda: table.rebuild(_boundary(spark, ("E3", "q", hours(1))))):
        with pytest.raises(KeyboardInterrupt):
            step()
    monkeypatch.undo()
    assert table.generations.current() == held
    assert [r.event_id for r in table.history().collect()] == ["E1"]
    table.merge(_boundary(spark, ("E2", "r", hours(1))), batch_id=1)
    assert table.history().count() == 2


def test_two_writers(spark, tmp_path):
    """A delta that comes while another writer compacts stays pending; the slower of two compactions gives way."""
    one, two = (VersionsTable(spark, str(tmp_path / "v"), buckets=1, compact_after=99) for _ in range(2))
    one.merge(_boundary(spark, ("E1", "r", hours(0))))
    write = one._write

    def meanwhile(rows):
        done = write(rows)
        two.append(_boundary(spark, ("E2", "r", hours(1))))
        two.compact()
        return done

    one._write = meanwhile
    assert one.compact() is False
    assert not two._state()["deltas"]
    assert [(r.event_id, r.is_current) for r in two.history().orderBy("valid_from").collect()] == [("E1", False), ("E2", True)]
    number, content = two.generations.current()
    assert one.generations.publish(number, content) is False

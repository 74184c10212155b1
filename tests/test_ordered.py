"""Neighbour lookups: the sliced form for hot keys equals the plain window."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crmflow.operators.ordered import find_hot_keys, with_latest, with_neighbour
from crmflow.session import reliable

START = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(900):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}"
        # Hot bursts: most rows of the hot key share few instants.
        ts = START + timedelta(seconds=rng.randrange(30) if key == "hot" else rng.randrange(10_000))
        data.append((key, ts, i, None if rng.random() < 0.7 else f"v{i}"))
    return spark.createDataFrame(data, "k string, ts timestamp, i int, v string").repartition(5).cache()


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("limit", [8, 50, 400])
@pytest.mark.parametrize("direction", ["previous", "next"])
def test_neighbour(rows, direction, limit):
    hot = find_hot_keys(rows, ["k"], limit)
    assert hot is not None
    values = {"other": F.col("i"), "text": F.col("v")}
    plain = with_neighbour(rows, ["k"], ["ts", "i"], values, direction, None)
    assert same(plain, with_neighbour(rows, ["k"], ["ts", "i"], values, direction, hot))


@pytest.mark.parametrize("limit", [8, 50, 400])
def test_latest(rows, limit):
    hot = find_hot_keys(rows, ["k"], limit)
    plain = with_latest(rows, ["k"], ["ts", "i"], "last_v", F.col("v"), None)
    assert same(plain, with_latest(rows, ["k"], ["ts", "i"], "last_v", F.col("v"), hot))


def test_hot_key_is_really_split(rows):
    from crmflow.operators.ordered import _sliced

    hot = find_hot_keys(rows, ["k"], 50)
    sizes = _sliced(rows, ["ts", "i"], hot).groupBy("k", "__slice").count()
    assert sizes.agg(F.max("count")).first()[0] < rows.where("k = 'hot'").count() / 4


def test_no_hot_keys(rows):
    assert find_hot_keys(rows, ["k"], 10_000) is None


def test_a_cluster_needs_a_shared_checkpoint_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    class Frame:
        sparkSession = Session()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        reliable(Frame())

"""Connected components of a graph too large for the driver, by alternating large and small stars."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import saved


def _stars(edges: DataFrame) -> DataFrame:
    """One round on edges with a > b: every larger neighbour, then every smaller one, goes to the least neighbour.

    A hub's rows all carry one value, so the least is found by partial aggregation; the joins back are on narrow rows, and
    AQE splits a hub's side. Edges point down, so the least neighbour of b is that of its own edges, or b itself. Both
    ends of an edge leave one join: it isn't run once for each, and repeated rows go at the end of the round only.
    """
    below = edges.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("low"))
    large = edges.join(below, F.col("b") == F.col("at"), "left").select("a", F.coalesce("low", "b").alias("b"))
    small = large.join(large.groupBy("a").agg(F.min("b").alias("low")), "a")
    ends = F.explode(F.array("a", "b")).alias("a")
    return small.select(ends, F.col("low").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b, long) to (node, component), the least node that is reachable, for every node with an edge.

    Nulls: edges with a null end are dropped. Loops and repeated edges change nothing. No edges: no rows.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        edges = saved(_stars(edges), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components are not found after {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Neighbouring rows inside a key, safe when one key holds a large share of all rows.

A window partitioned by a key sorts that key's rows in one task. Where no key exceeds
``max_rows`` that is the best plan (one exchange) and it is used. A key above the limit is cut
into slices along its order; slices are processed like keys, and the value that crosses a slice
border is taken from a summary of one row per slice. Results are the same in both forms.
Keys must not be null, and positions (key and order columns) should be unique. With hot keys the
input is read up to three times: give a table or a checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crmflow.session import reliable

MAX_ROWS_PER_TASK = 2_000_000
# Expected split points per key: bounds the arrays that travel with a broadcast.
MAX_SPLITS_PER_KEY = 2048
# Rows (or split points) up to which a helper table is broadcast; measured, beyond it a join.
MAX_BROADCAST = 1_000_000
_SLICE, _BOUNDS, _VALUE, _CARRY = "__slice", "__bounds", "__value", "__carry"


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than ``max_rows`` rows: at most total rows / max_rows of them."""

    table: DataFrame
    keys: tuple[str, ...]
    max_rows: int
    count: int

    def renamed(self, *keys: str) -> HotKeys:
        """The same keys under other column names."""
        table = self.table.withColumnsRenamed(dict(zip(self.keys, keys, strict=True)))
        return HotKeys(table, keys, self.max_rows, self.count)


def find_hot_keys(
    df: DataFrame, keys: Sequence[str], max_rows: int = MAX_ROWS_PER_TASK
) -> HotKeys | None:
    """Count rows per key (combined map-side) and keep the keys above ``max_rows``.

    Pass the cheapest frame that has the keys: a scan of the key columns is enough, and counts
    may be larger than those of the frame to be ordered. One row of totals reaches the driver.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > max_rows)
    found = counts.agg(F.count("*")).first()[0]
    return HotKeys(reliable(counts), tuple(keys), max_rows, found) if found else None


def _sized(helper: DataFrame, size: int) -> DataFrame:
    """Broadcast a helper table of known, checked size; leave a larger one to the optimizer."""
    return F.broadcast(helper) if size <= MAX_BROADCAST else helper


def _split_points(df: DataFrame, order: Sequence[str], hot: HotKeys) -> DataFrame:
    """Per hot key a sorted array of row positions, one about every ``max_rows / 8`` rows.

    A hash of the position decides which rows become split points, so the choice is the same
    in every evaluation; it only places borders and never changes which rows are returned.
    """
    every = F.greatest(F.lit(max(1, hot.max_rows // 8)), (F.col("n") / MAX_SPLITS_PER_KEY).cast("long"))
    return (
        df.select(*hot.keys, *order)
        .join(_sized(hot.table, hot.count), list(hot.keys))
        .where(F.pmod(F.xxhash64(*hot.keys, *order), every) == 0)
        .groupBy(*hot.keys)
        .agg(F.array_sort(F.collect_set(F.struct(*order))).alias(_BOUNDS))
    )


def _slice_number(bounds: Column, position: Column) -> Column:
    """Number of bounds <= position, by binary search; -1 for keys that are not hot."""
    steps = F.array(*[F.lit(1 << i) for i in range(14, -1, -1)])

    def step(found: Column, width: Column) -> Column:
        inside = F.coalesce(F.get(bounds, found + width - 1) <= position, F.lit(False))
        return F.when(inside, found + width).otherwise(found)

    return F.when(bounds.isNull(), F.lit(-1)).otherwise(F.aggregate(steps, F.lit(0), step))


def _sliced(df: DataFrame, order: Sequence[str], hot: HotKeys) -> DataFrame:
    points = reliable(_split_points(df, order, hot))
    size = points.agg(F.coalesce(F.sum(F.size(_BOUNDS)), F.lit(0))).first()[0]
    return (
        df.join(_sized(points, size), list(hot.keys), "left")
        .withColumn(_SLICE, _slice_number(F.col(_BOUNDS), F.struct(*order)))
        .drop(_BOUNDS)
    )


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, Column],
    direction: str,
    hot: HotKeys | None,
) -> DataFrame:
    """Add ``values`` of the previous or next row of the same key; null where there is none."""
    shift, pick = {"previous": (F.lag, F.max_by), "next": (F.lead, F.min_by)}[direction]
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({n: shift(c).over(w) for n, c in values.items()})

    packed = F.struct(*[c.alias(n) for n, c in values.items()])
    rows = _sliced(df, order, hot).withColumn(_VALUE, packed)
    hot_rows = rows.where(F.col(_SLICE) >= 0)
    edges = hot_rows.groupBy(*keys, _SLICE).agg(pick(_VALUE, F.struct(*order)).alias(_CARRY))
    across = Window.partitionBy(*keys).orderBy(_SLICE)
    edges = edges.withColumn(_CARRY, shift(_CARRY).over(across))
    inside = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    out = (
        rows.withColumn(_VALUE, shift(_VALUE).over(inside))
        .join(edges, [*keys, _SLICE], "left")
        .withColumn(_VALUE, F.coalesce(F.col(_VALUE), F.col(_CARRY)))
    )
    return out.select(*df.columns, *[F.col(_VALUE)[n].alias(n) for n in values])


def with_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    value: Column,
    hot: HotKeys | None,
) -> DataFrame:
    """Add the last non-null ``value`` at or before each row of the same key."""
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.last(value, ignorenulls=True).over(w))

    rows = _sliced(df, order, hot).withColumn(_VALUE, value)
    # A slice without a value gets a null edge and still receives the carry of earlier ones.
    at = F.when(F.col(_VALUE).isNotNull(), F.struct(*order))
    hot_rows = rows.where(F.col(_SLICE) >= 0)
    edges = hot_rows.groupBy(*keys, _SLICE).agg(F.max_by(_VALUE, at).alias(_CARRY))
    back = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn(_CARRY, F.last(_CARRY, ignorenulls=True).over(back))
    inside = (
        Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.withColumn(_VALUE, F.last(_VALUE, ignorenulls=True).over(inside))
        .join(edges, [*keys, _SLICE], "left")
        .select(*df.columns, F.coalesce(F.col(_VALUE), F.col(_CARRY)).alias(name))
    )

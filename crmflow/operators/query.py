"""Object queries (projection, filter, in-list, newest first, limit) and table reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmflow.registry import OBJECTS

# Default row limits per object.
DEFAULT_LIMITS = {"Account": 1000, "Contact": 5000, "Opportunity": 2000, "Case": 1000}
# Longer id lists become a join instead of an IN expression.
MAX_IN_LIST = 1000


def restrict(df: DataFrame, column: str, ids: Sequence | DataFrame) -> DataFrame:
    """Rows whose ``column`` is in ``ids``: a list, or a frame with one id column."""
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
        return df.join(wanted, column, "left_semi")
    if len(ids) <= MAX_IN_LIST:
        return df.where(F.col(column).isin(*ids))
    spark = df.sparkSession
    wanted = spark.createDataFrame([(i,) for i in ids], df.select(column).schema).distinct()
    return df.join(wanted, column, "left_semi")


def newest(df: DataFrame, limit: int, order: str = "created_date", key: str = "id") -> DataFrame:
    """Top rows by date, the key breaking ties; planned as a top-k, never a full sort."""
    return df.orderBy(F.col(order).desc(), F.col(key)).limit(limit)


def query_object(
    df: DataFrame,
    object_name: str,
    limit: int | None = None,
    fields: Sequence[str] | None = None,
    where: Column | str | None = None,
    **id_filters,
) -> DataFrame:
    """Query one object: all filters apply, then newest first up to the limit, then the fields.

    Without a limit all rows are returned, unordered; ``DEFAULT_LIMITS`` has each object's usual one.

    Keyword filters name an id column and give its allowed values, for example
    ``account_id=[...]``; several are ANDed. None means unfiltered.
    """
    for column, ids in id_filters.items():
        if ids is not None:
            df = restrict(df, column, ids)
    if where is not None:
        df = df.where(where)
    top = df if limit is None else newest(df, limit)
    own = [n for n in OBJECTS[object_name].field_names if n in df.columns]
    return top.select(*(fields or own))


def query_accounts(df, limit=None, fields=None, where=None) -> DataFrame:
    return query_object(df, "Account", limit, fields, where)


def query_contacts(df, limit=None, account_ids=None) -> DataFrame:
    return query_object(df, "Contact", limit, account_id=account_ids)


def query_opportunities(df, limit=None, account_ids=None) -> DataFrame:
    return query_object(df, "Opportunity", limit, account_id=account_ids)


def query_cases(df, limit=None, account_ids=None, contact_ids=None) -> DataFrame:
    return query_object(df, "Case", limit, account_id=account_ids, contact_id=contact_ids)


def recent_changes(df: DataFrame, since, limit: int | None = None) -> DataFrame:
    """Rows changed at or after ``since``, oldest first; without a limit, unordered."""
    rows = df.where(F.col("last_modified_date") >= since)
    return rows if limit is None else rows.orderBy("last_modified_date", "id").limit(limit)


def union_raw(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def count_by_object(tables: Sequence[DataFrame]) -> DataFrame:
    narrow = [t.select("object_type") for t in tables]
    return union_raw(narrow).groupBy("object_type").agg(F.count("*").alias("n"))


def quality_percent(tables: Sequence[DataFrame]) -> DataFrame:
    narrow = [t.select("object_type", "_is_valid") for t in tables]
    return (
        union_raw(narrow).groupBy("object_type")
        .agg(F.count_if("_is_valid").alias("valid_records"),
             F.count_if(~F.col("_is_valid")).alias("invalid_records"), F.count("*").alias("n"))
        .select("object_type", "valid_records", "invalid_records",
                F.round(F.col("valid_records") * 100.0 / F.col("n"), 2).alias("quality_percent"))
    )


def preview(df: DataFrame, order: Sequence[str], rows: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def retained(df: DataFrame, date_column: str, as_of: Column, days: int = 30) -> DataFrame:
    """Rows inside the retention period; on a partition column this prunes directories."""
    return df.where(F.col(date_column) >= F.date_sub(as_of.cast("date"), days))


def account_rollup(accounts: DataFrame, opportunities: DataFrame, cases: DataFrame) -> DataFrame:
    """Accounts with totals of their opportunities and cases.

    Children are aggregated to one row per account before joining, so nothing fans out and a
    hot account combines map-side.
    """
    won = opportunities.groupBy("account_id").agg(
        F.count("*").alias("opportunities"), F.sum("amount").alias("amount")
    )
    open_cases = cases.groupBy("account_id").agg(F.count("*").alias("cases"))
    return (
        accounts.join(won, accounts["id"] == won["account_id"], "left").drop("account_id")
        .join(open_cases, F.col("id") == open_cases["account_id"], "left").drop("account_id")
        .select("id", "name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("opportunities", "amount", "cases")])
    )

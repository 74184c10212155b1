"""Statistics, thresholds and table-level checks. Aggregates combine map-side throughout."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmflow.functions.rules import batch_errors, codes, messages

# Thresholds of the quality rules and alerts.
ERROR_RATE_ALERT = 0.05
LAG_ALERT_SECONDS = 300
COMPLETENESS = 0.95
VALIDITY = 0.98


class ThresholdExceeded(RuntimeError):
    """The share of bad rows is above the limit; nothing should be committed."""


def validate_batch(df: DataFrame, at: Column, primary_key: str = "id", rules=None) -> DataFrame:
    """Add ``_validation_errors``, ``_is_valid`` and ``_validation_timestamp``; rows are kept."""
    found = messages(batch_errors(df.columns, primary_key, rules))
    return df.withColumn("_validation_errors", found).withColumns({
        "_is_valid": F.size("_validation_errors") == 0, "_validation_timestamp": at,
    })


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def validation_stats(validated: DataFrame, threshold: float = ERROR_RATE_ALERT) -> DataFrame:
    """Totals, error rate (0 if empty) and whether it is strictly above the threshold."""
    return (
        validated.agg(
            F.count("*").alias("total_events"),
            F.count_if("is_valid").alias("valid_events"),
            F.count_if(~F.col("is_valid")).alias("invalid_events"),
        )
        .withColumn("error_rate", ratio(F.col("invalid_events"), F.col("total_events")))
        .withColumn("exceeds_threshold", F.col("error_rate") > threshold)
    )


def error_types(validated: DataFrame) -> DataFrame:
    """Events per rule; a rule counts once per event however many errors it found."""
    return (
        validated.select(F.explode(F.array_distinct(codes(F.col("errors")))).alias("code"))
        .groupBy("code").agg(F.count("*").alias("events"))
    )


def windowed_error_rate(validated: DataFrame, width: str, ts: str = "event_timestamp",
                        threshold: float = ERROR_RATE_ALERT) -> DataFrame:
    """Error rate and alert flag per tumbling window."""
    return (
        validated.groupBy(F.window(ts, width))
        .agg(F.count("*").alias("total_events"), F.count_if(~F.col("is_valid")).alias("invalid_events"))
        .select(F.col("window.start").alias("window_start"), "total_events", "invalid_events",
                ratio(F.col("invalid_events"), F.col("total_events")).alias("error_rate"))
        .withColumn("alert", F.col("error_rate") > threshold)
    )


def parse_stats(parsed: DataFrame) -> DataFrame:
    ok = F.col("parse_error").isNull()
    return parsed.agg(F.count_if(ok).alias("parsed_count"), F.count_if(~ok).alias("error_count")).withColumn(
        "success_rate", ratio(F.col("parsed_count"), F.col("parsed_count") + F.col("error_count"))
    )


def threshold_gate(validated: DataFrame, max_error_percent: float = 5.0) -> DataFrame:
    """One row that says whether a write may be committed."""
    stats = validated.agg(F.count("*").alias("total"), F.count_if(~F.col("is_valid")).alias("invalid"))
    percent = 100 * ratio(F.col("invalid"), F.col("total"))
    return stats.withColumn("error_percent", percent).withColumn(
        "passed", F.col("error_percent") <= max_error_percent
    )


def require_threshold(validated: DataFrame, max_error_percent: float = 5.0) -> None:
    """Raise before the write if too many rows are bad; one row reaches the driver."""
    row = threshold_gate(validated, max_error_percent).first()
    if not row["passed"]:
        raise ThresholdExceeded(f"{row['invalid']} of {row['total']} rows are invalid")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def deduplicate(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest in column order: the same pick in every evaluation.

    An aggregate, not a window: copies combine map-side, so a large group of copies is no
    hot spot. Columns must be orderable.
    """
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key).agg(F.min(F.struct(*rest)).alias("row"))
        .select(*[F.col(key) if c == key else F.col("row")[c].alias(c) for c in df.columns])
    )


def orphans(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null reference has no parent.

    The parent side is distinct keys only; the physical join is left to the optimizer, which
    splits a hot reference when it sorts and merges.
    """
    known = parent.where(F.col(key).isNotNull()).select(F.col(key).alias(fk)).distinct()
    return child.where(F.col(fk).isNotNull()).join(known, fk, "left_anti")


def row_rule(df: DataFrame, name: str, holds: Column, threshold: float) -> DataFrame:
    """Pass ratio of a row condition (null counts as not passed), strict against a threshold."""
    passed = F.coalesce(holds, F.lit(False)).cast("int")
    return df.agg(F.lit(name).alias("rule"), F.coalesce(F.avg(passed), F.lit(0.0)).alias("pass_ratio")).withColumn(
        "passed", F.col("pass_ratio") > threshold
    )


def row_rules(df: DataFrame, rules: dict[str, tuple[Column, float]]) -> DataFrame:
    """Several row conditions in one pass over the data: one result row per rule."""
    measured = df.agg(*[
        F.coalesce(F.avg(F.coalesce(holds, F.lit(False)).cast("int")), F.lit(0.0)).alias(name)
        for name, (holds, _) in rules.items()
    ])
    entries = F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("pass_ratio"), (F.col(n) > t).alias("passed"))
        for n, (_, t) in rules.items()
    ])
    return measured.select(F.inline(entries))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percent (one decimal) per value; the total is a scalar subquery."""
    total = df.agg(F.count("*").alias("total")).scalar()
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.select(column, "n", F.round(F.col("n") * 100.0 / total, 1).alias("percent"))


def tumbling_counts(df: DataFrame, width: str, by: Iterable[str] = (), ts: str = "event_timestamp") -> DataFrame:
    return (
        df.groupBy(F.window(ts, width), *by).agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), *by, "n")
    )


def throughput(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Mean events per non-empty minute, and how many minutes there were."""
    return tumbling_counts(df, "1 minute", (), ts).agg(
        F.count("*").alias("minutes"), F.avg("n").alias("mean_per_minute")
    )


def lag_alerts(df: DataFrame, width: str, ts: str, arrived: str, limit: int = LAG_ALERT_SECONDS) -> DataFrame:
    """Largest arrival lag per window, flagged when above the limit."""
    lag = (F.unix_micros(arrived) - F.unix_micros(ts)) / 1e6
    return (
        df.groupBy(F.window(ts, width)).agg(F.max(lag).alias("lag_seconds"))
        .select(F.col("window.start").alias("window_start"), "lag_seconds")
        .withColumn("alert", F.col("lag_seconds") > limit)
    )


def late_events(df: DataFrame, ts: str, arrived: str, lateness: str = "600 seconds") -> DataFrame:
    """Events that arrived more than the allowed lateness after they happened."""
    return df.where(F.col(arrived) > F.col(ts) + F.expr(f"interval {lateness}"))


def metric_columns(at: Column) -> list[Column]:
    """Named pipeline metrics, for ``observe`` during a write or for one aggregate."""
    kind = F.col("event_type")
    lag = (F.unix_micros(at) - F.unix_micros("event_timestamp")) / 1e6
    return [
        F.count("*").alias("events_received"),
        F.count_if("is_valid").alias("events_processed"),
        F.sum(F.size("errors")).alias("validation_errors"),
        F.count_if(F.col("is_valid") & (kind == "INSERT")).alias("records_inserted"),
        F.count_if(F.col("is_valid") & (kind != "INSERT")).alias("history_updates"),
        F.max(F.when(F.col("is_valid"), lag)).alias("max_latency_seconds"),
    ]


def history_problems(history: DataFrame) -> DataFrame:
    """Records with more than one current row; no result means the history is sound."""
    return (
        history.where(F.col("is_current")).groupBy("id").agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )

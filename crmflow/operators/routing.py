"""Routes, alerts and gates. A route is a column; outputs are filters on it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmflow.functions.rules import messages, with_cdc_errors
from crmflow.registry import ALERT_SEVERITY, ALERT_TYPE, OBJECT_TYPES


def validate_events(events: DataFrame, as_of: Column, selected: Iterable[str] | None = None) -> DataFrame:
    """Add ``errors``, ``is_valid`` and ``route`` (valid / invalid) to change events."""
    return (
        with_cdc_errors(events, as_of, selected)
        .withColumn("is_valid", F.size("errors") == 0)
        .withColumn("route", F.when(F.col("is_valid"), "valid").otherwise("invalid"))
    )


def route_by_object(
    events: DataFrame, enabled: Iterable[str] = OBJECT_TYPES, tracked: Iterable[str] = OBJECT_TYPES
) -> DataFrame:
    """Add ``table_route`` (object type, 'disabled' or 'unknown') and ``to_history``."""
    kind = F.col("object_type")
    known = F.coalesce(kind.isin(*OBJECT_TYPES), F.lit(False))
    on = [o for o in OBJECT_TYPES if o in set(enabled)]
    kept = [o for o in OBJECT_TYPES if o in set(tracked)]
    return events.withColumns({
        "table_route": F.when(~known, "unknown").when(kind.isin(*on), kind).otherwise("disabled"),
        "to_history": known & kind.isin(*kept),
    })


def quality_alerts(validated: DataFrame, at: Column) -> DataFrame:
    """One alert row per invalid event; ``event_data`` is the whole event."""
    return validated.where(~F.col("is_valid")).select(
        F.lit(ALERT_TYPE).alias("alert_type"), F.lit(ALERT_SEVERITY).alias("severity"),
        at.alias("timestamp"), "event_id", "object_type", "record_id",
        messages(F.col("errors")).alias("validation_errors"),
        (F.col("event") if "event" in validated.columns else F.lit(None).cast("variant")).alias("event_data"),
    )


def alert_messages(alerts: DataFrame) -> DataFrame:
    return alerts.select(F.to_json(F.struct(*alerts.columns), {"ignoreNullFields": "false"}).cast("binary").alias("value"))

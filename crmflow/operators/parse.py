"""Messages to events to records.

A message is ``value BINARY`` with optional ``attributes, message_id, publish_time``. Parsing
adds columns and never drops a row: failures carry ``parse_error`` and go to the dead letters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmflow.functions.rules import has_required_keys, quality_score
from crmflow.functions.values import chosen, iso_text, iso_timestamp, member, once, present, text_member
from crmflow.registry import OBJECTS, SOURCE_CDC, SPARK_TYPES


# Members of a change event and how they are read.
ENVELOPE = {
    **dict.fromkeys(("event_id", "event_type", "object_type", "record_id", "event_timestamp", "source"), "string"),
    **dict.fromkeys(("changed_fields", "before", "after"), "variant"),
}


def parse_messages(messages: DataFrame, ingestion_time: Column | None = None) -> DataFrame:
    """Add ``text``, ``event`` (VARIANT, null on failure), ``parse_error``, ``ingestion_time``."""
    read = once(messages, {"text": F.try_validate_utf8(F.col("value").cast("string"))})
    read = once(read, {"event": F.try_parse_json("text")})
    return read.withColumns({
        "parse_error": F.when(F.col("text").isNull(), "invalid utf-8").when(F.col("event").isNull(), "invalid json"),
        "ingestion_time": F.current_timestamp() if ingestion_time is None else ingestion_time,
    })


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Failed messages with their whole original text (base64 where it is not text)."""
    original = F.coalesce(F.col("text"), F.base64("value"))
    return parsed.where(F.col("parse_error").isNotNull()).select(
        F.col("parse_error").alias("error"), original.alias("original_message"),
        F.col("ingestion_time").alias("timestamp"),
    )


def with_message_metadata(parsed: DataFrame) -> DataFrame:
    """Message id, publish time and, unless empty, attributes under their event-side names."""
    return parsed.withColumns({
        "_pubsub_message_id": F.col("message_id"),
        "_pubsub_publish_time": F.col("publish_time"),
        "_pubsub_attributes": F.when(F.size("attributes") > 0, F.col("attributes")),
    })


def envelope(parsed: DataFrame) -> DataFrame:
    """Change-event columns of parsed messages; other columns stay.

    ``event_timestamp_text`` keeps the text for validation, ``event_timestamp`` is the instant.
    """
    event = F.col("event")
    read = once(parsed.where(event.isNotNull()), {"__event": chosen(event, ENVELOPE)})

    def part(name: str) -> Column:
        return F.col("__event")[name]

    def side(name: str) -> Column:
        return F.when(present(part(name)), part(name))

    return once(read, {
        "event_id": part("event_id"),
        "event_type": part("event_type"),
        "object_type": part("object_type"),
        "record_id": part("record_id"),
        "event_timestamp_text": part("event_timestamp"),
        "event_timestamp": iso_timestamp(part("event_timestamp")),
        "changed_fields": part("changed_fields"),
        "before": side("before"),
        "after": side("after"),
        "source": F.coalesce(part("source"), F.lit(SOURCE_CDC)),
    }).drop("__event")


def changed_field_list(changed: Column) -> Column:
    """The event's own list of changed fields, empty by default."""
    listed = changed.try_cast(T.ArrayType(T.StringType()))
    return F.coalesce(listed, F.array().cast("array<string>"))


def extract_record(
    events: DataFrame,
    object_type: str,
    ingestion_time: Column,
    include_metadata: bool = True,
    on_unknown: str = "drop",
    flag_casts: bool = False,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Typed rows of one object: ``after`` of INSERT and UPDATE, ``before`` of DELETE.

    Another event type gives no row, or with ``on_unknown='empty'`` a row of nulls. Nested
    values are JSON text. ``flag_casts`` adds ``cast_errors``, the fields whose value does not fit
    its type; ``keep`` names event columns to carry along.
    """
    rows = events.where(F.col("object_type") == object_type).withColumn("__record", _record())
    if on_unknown == "drop":
        rows = rows.where(F.col("__record").isNotNull())
    columns = _record_columns(object_type, ingestion_time, include_metadata, flag_casts, "message_id" in events.columns)
    return rows.select(*columns, *keep)


def extract_records(
    events: DataFrame, wanted: dict[str, dict[str, Callable[[Column], Column]]], ingestion_time: Column
) -> DataFrame:
    """Typed rows of several objects under shared columns, in one pass over the events.

    ``wanted`` gives per object the columns to return, each as a function of its record (what ``extract_record`` with
    ``flag_casts`` returns, as a struct). A union of single extracts would parse every event once for each object.
    """
    rows = events.where(F.col("object_type").isin(*wanted)).withColumn("__record", _record())
    kept = F.col("object_type")
    typed = once(rows.where(F.col("__record").isNotNull()), {
        f"__{name}": F.when(kept == name, F.struct(*_record_columns(name, ingestion_time, True, True, "message_id" in events.columns)))
        for name in wanted
    })
    names = list(next(iter(wanted.values())))
    return typed.select(*[
        F.coalesce(*[F.when(kept == name, columns[out](F.col(f"__{name}"))) for name, columns in wanted.items()]).alias(out)
        for out in names
    ])


def _record() -> Column:
    kind = F.col("event_type")
    return F.when(kind.isin("INSERT", "UPDATE"), F.col("after")).when(kind == "DELETE", F.col("before"))


def _record_columns(object_type: str, ingestion_time: Column, include_metadata: bool, flag_casts: bool, with_message: bool) -> list[Column]:
    kind = F.col("event_type")
    fields = OBJECTS[object_type].fields
    typed = {f.name: _typed_member(f.name, f.type) for f in fields}
    columns = [c.alias(n) for n, c in typed.items()]
    if flag_casts:
        failed = [
            F.when(present(member(F.col("__record"), f.name)) & typed[f.name].isNull(), F.lit(f.name))
            for f in fields if f.type not in ("STRING", "JSON")
        ]
        columns.append(F.array_compact(F.array(*failed)).alias("cast_errors"))
    if include_metadata:
        known = kind.isin("INSERT", "UPDATE", "DELETE")
        columns += [
            ingestion_time.alias("ingestion_timestamp"), F.lit(SOURCE_CDC).alias("source"),
            F.col("object_type"), F.when(known, F.col("event_id")).alias("_cdc_event_id"),
            kind.alias("_cdc_event_type"), F.col("event_timestamp").alias("_cdc_event_timestamp"),
        ]
        if with_message:
            columns.append(F.col("message_id").alias("_pubsub_message_id"))
    return columns


def _typed_member(name: str, type_: str) -> Column:
    value = member(F.col("__record"), name)
    if type_ == "TIMESTAMP":
        return iso_timestamp(text_member(F.col("__record"), name))
    if type_ == "JSON":
        return F.when(present(value), F.coalesce(value.try_cast("string"), F.to_json(value)))
    return F.try_variant_get("__record", f"$.{name}", SPARK_TYPES[type_].simpleString())


def with_processing_time(df: DataFrame, at: Column) -> DataFrame:
    return df.withColumn("_processing_timestamp", at)


def to_messages(events: DataFrame) -> DataFrame:
    """Rows as messages: JSON value, and attributes for routing with '' for absent ones."""
    have = set(events.columns)

    def attribute(name: str, default: str) -> Column:
        if name not in have:
            return F.lit(default)
        value = F.col(name)
        if isinstance(events.schema[name].dataType, T.TimestampType):
            value = iso_text(value)
        return F.coalesce(value.cast("string"), F.lit(default))

    attributes = {"event_type": "", "object_type": "", "source": SOURCE_CDC, "event_timestamp": ""}
    pairs = [x for n, d in attributes.items() for x in (F.lit(n), attribute(n, d))]
    body = F.to_json(
        F.struct(*events.columns),
        {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"},
    )
    return events.select(body.cast("binary").alias("value"), F.create_map(*pairs).alias("attributes"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared types; a value that does not fit is null and named in ``cast_errors``."""
    casts, failed = {}, []
    have = set(df.columns)
    for field in schema.fields:
        if field.name not in have:
            casts[field.name] = F.lit(None).cast(field.dataType)
            continue
        source = F.col(field.name)
        text = isinstance(df.schema[field.name].dataType, T.StringType)
        if isinstance(field.dataType, T.TimestampType) and text:
            value = iso_timestamp(source)
        else:
            value = source.try_cast(field.dataType)
        casts[field.name] = value
        failed.append(F.when(source.isNotNull() & value.isNull(), F.lit(field.name)))
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(
        *[c.alias(n) for n, c in casts.items()], *extra,
        F.array_compact(F.array(*failed)).alias("cast_errors"),
    )


def missing_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add ``missing``: required columns of the sink schema that are null."""
    needed = [F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable]
    return df.withColumn("missing", F.array_compact(F.array(*needed)))


def check_generic(parsed: DataFrame) -> DataFrame:
    """Generic events: ``route`` valid / invalid / failed and the quality score of valid ones."""
    event = F.col("event")
    route = (
        F.when(F.col("parse_error").isNotNull(), "failed")
        .when(has_required_keys(event), "valid")
        .otherwise("invalid")
    )
    return parsed.withColumn("route", route).withColumn(
        "quality_score", F.when(F.col("route") == "valid", quality_score(event))
    )


def raw_events(checked: DataFrame) -> DataFrame:
    """Rows of the raw_events table: valid generic events, ``data`` nullable."""
    event = F.col("event")
    return checked.where(F.col("route") == "valid").select(
        text_member(event, "event_id").alias("event_id"),
        text_member(event, "event_type").alias("event_type"),
        iso_timestamp(text_member(event, "timestamp")).alias("timestamp"),
        F.to_json(member(event, "data")).alias("data"),
        text_member(event, "source").alias("source"),
        F.col("ingestion_time"), F.col("quality_score"),
    )


def transformed_data(raw: DataFrame, processed_at: Column, version: str, transform: Column | None = None) -> DataFrame:
    """raw_events to transformed_data; ``transform`` is the new JSON text (default: unchanged)."""
    return raw.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("data_type"),
        processed_at.alias("processed_at"), F.col("data").alias("original_data"),
        (F.col("data") if transform is None else transform).alias("transformed_data"),
        F.lit(version).alias("pipeline_version"), F.col("quality_score"),
    )

"""Type-2 history from a change log.

Every change that starts or ends a version is a *boundary*; a version lasts from its boundary to
the next one of the same record. Versions therefore follow from the set of boundaries alone, in
whatever order, batches or multiplicity the events arrived.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmflow.functions.values import METADATA_FIELDS, changed_fields, once
from crmflow.operators.ordered import (
    MAX_ROWS_PER_TASK, HotKeys, find_hot_keys, with_latest, with_neighbour,
)
from crmflow.session import reliable

BOUNDARY = ("id", "valid_from", "event_id", "change_type", "changed_fields", "record_data")


def has_both_sides(kind: Column, before: Column, after: Column) -> Column:
    """INSERT needs after, DELETE before, UPDATE both; anything else is rejected."""
    return (
        ((kind == "INSERT") & after.isNotNull())
        | ((kind == "DELETE") & before.isNotNull())
        | ((kind == "UPDATE") & after.isNotNull() & before.isNotNull())
    )


def _at_rest(df: DataFrame, name: str) -> Column:
    return F.to_json(F.col(name)) if isinstance(df.schema[name].dataType, T.VariantType) else F.col(name)


def boundaries(
    events: DataFrame,
    tracked_fields: Iterable[str] | None = None,
    skip: Iterable[str] = METADATA_FIELDS,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Changes that move history: INSERT, DELETE and UPDATE with a real difference.

    Events need ``event_id, record_id, event_type, event_timestamp, before, after``; the states
    are structs, or VARIANT. No shuffle: the decision looks at one event. ``keep`` names further
    columns to carry along.
    """
    kind = F.col("event_type")
    usable = events.where(
        F.col("record_id").isNotNull() & F.col("event_timestamp").isNotNull()
        & kind.isin("INSERT", "UPDATE", "DELETE")
    )
    changed = changed_fields(events, "before", "after", tracked_fields, skip)
    listed = {"changed_fields": F.when(kind == "UPDATE", changed).otherwise(F.array().cast("array<string>"))}
    typed = isinstance(events.schema["before"].dataType, T.StructType)
    return (
        (usable.withColumns(listed) if typed else once(usable, listed))
        .where((kind != "UPDATE") | (F.size("changed_fields") > 0))
        .select(
            F.col("record_id").alias("id"),
            F.col("event_timestamp").alias("valid_from"),
            F.col("event_id"),
            kind.alias("change_type"),
            F.col("changed_fields"),
            F.when(kind == "DELETE", _at_rest(events, "before")).otherwise(_at_rest(events, "after")).alias("record_data"),
            *keep,
        )
    )


def collapse(rows: DataFrame) -> DataFrame:
    """The last boundary per (id, valid_from); copies of an event fold into one.

    A maximum over the whole row: combined before the shuffle, so neither a hot record nor a
    large group of copies reaches one task, and the same row wins in every evaluation.
    """
    rest = [c for c in BOUNDARY if c not in ("id", "valid_from")]
    return (
        rows.groupBy("id", "valid_from")
        .agg(F.max(F.struct(*rest)).alias("last"))
        .select("id", "valid_from", *[F.col("last")[c].alias(c) for c in rest])
    )


def one_per_event(rows: DataFrame) -> DataFrame:
    """One boundary per event id: the earliest of what was sent under it, so a resent event with
    another time adds no version. Rows without an event id are told apart by their content only.

    A minimum over the whole row, combined before the shuffle.
    """
    rest = [c for c in BOUNDARY if c not in ("valid_from", "event_id")]
    known = (
        rows.where(F.col("event_id").isNotNull()).groupBy("event_id")
        .agg(F.min(F.struct("valid_from", *rest)).alias("first"))
        .select("event_id", *[F.col("first")[c].alias(c) for c in ("valid_from", *rest)])
    )
    return rows.where(F.col("event_id").isNull()).select(*BOUNDARY).unionByName(known)


def chain(rows: DataFrame, hot: HotKeys | None) -> DataFrame:
    """Boundaries with ``valid_to``, the start of the next boundary of the record.

    Of several boundaries at one instant the largest row counts, compared column by column in the
    order of ``BOUNDARY`` (null event ids first), in both forms.
    """
    if hot is None:
        # Rows of one instant sort by all columns; all but the last meet their own start as the next.
        order = [c for c in BOUNDARY if c != "id"]
        nxt = with_neighbour(rows, ["id"], order,
                             {"valid_to": F.col("valid_from")}, "next", None)
        return nxt.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    return with_neighbour(reliable(collapse(rows)), ["id"], ["valid_from"],
                          {"valid_to": F.col("valid_from")}, "next", hot)


def as_history(chained: DataFrame, emit_tombstones: bool = False) -> DataFrame:
    """History rows; a DELETE only closes, unless tombstones are asked for."""
    rows = chained if emit_tombstones else chained.where(F.col("change_type") != "DELETE")
    return rows.select(
        "id", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"),
        "change_type", "changed_fields", "record_data", "event_id",
    )


def hot_records(events: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> HotKeys | None:
    """Records with more events than one task should order; scans the id column only."""
    ids = events.where(F.col("record_id").isNotNull()).select(F.col("record_id").alias("id"))
    return find_hot_keys(ids, ["id"], max_rows)


def apply_scd2(
    events: DataFrame,
    hot: HotKeys | None,
    tracked_fields: Iterable[str] | None = None,
    emit_tombstones: bool = False,
    repeated_ids: bool = False,
) -> DataFrame:
    """Full rebuild: the history of a change log. One exchange when no record is hot.

    ``hot`` comes from ``hot_records`` on the events, or on a cheaper frame with the same ids.
    Exact copies never count twice. ``repeated_ids`` also folds different events with one event id
    (``one_per_event``), at the price of a second exchange.
    """
    moves = boundaries(events, tracked_fields)
    return as_history(chain(one_per_event(moves) if repeated_ids else moves, hot), emit_tombstones)


def merge_versions(
    store: DataFrame, new: DataFrame, hot: HotKeys | None, since=None
) -> tuple[DataFrame, DataFrame]:
    """Effect of new boundaries on stored versions, as (replaced, rebuilt).

    ``store`` holds versions with tombstones. Only versions that overlap the time span of a
    record's new boundaries can change; they are ``replaced``. ``since``, a Column no later than
    any new boundary, lets the scan skip every version closed before it. Applying the same
    boundaries again changes nothing.
    """
    if since is not None:
        store = store.where(F.col("valid_to").isNull() | (F.col("valid_to") >= since))
    span = new.groupBy("id").agg(
        F.min("valid_from").alias("first_new"), F.max("valid_from").alias("last_new")
    )
    near = store.join(span, "id")
    overlap = (F.col("valid_from") <= F.col("last_new")) & (
        F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("first_new"))
    )
    replaced = near.where(overlap).drop("first_new", "last_new")
    horizon = near.where(F.col("valid_from") > F.col("last_new")).groupBy("id").agg(
        F.min("valid_from").alias("horizon")
    )
    rows = replaced.select(*BOUNDARY).unionByName(new.select(*BOUNDARY))
    rebuilt = (
        chain(rows, hot)
        .join(horizon, "id", "left")
        .withColumn("valid_to", F.coalesce("valid_to", "horizon"))
        .drop("horizon")
    )
    return replaced, as_history(rebuilt, emit_tombstones=True)


def merged_store(store: DataFrame, new: DataFrame, hot: HotKeys | None, since=None) -> DataFrame:
    """The whole versions set after a merge (tombstones included)."""
    replaced, rebuilt = merge_versions(store, new, hot, since)
    kept = store.join(replaced.select("id", "valid_from"), ["id", "valid_from"], "left_anti")
    return kept.unionByName(rebuilt)


def without_tombstones(store: DataFrame) -> DataFrame:
    return store.where(F.col("change_type") != "DELETE")


def scd2_stats(events: DataFrame, tracked_fields: Iterable[str] | None = None) -> DataFrame:
    """Batch statistics before same-instant changes collapse; errors are rejected events."""
    kind = F.col("event_type")
    usable = F.col("record_id").isNotNull() & (F.col("record_id") != "")
    complete = F.coalesce(has_both_sides(kind, F.col("before"), F.col("after")), F.lit(False))
    changed = F.size(changed_fields(events, "before", "after", tracked_fields)) > 0
    marked = events.select(
        F.when(usable, F.col("record_id")).alias("record_id"),
        (usable & complete & (kind == "INSERT")).alias("inserted"),
        (usable & complete & (kind == "UPDATE") & changed).alias("updated"),
        (usable & ~complete).alias("rejected"),
    )
    per_record = marked.groupBy("record_id").agg(
        F.count("*").alias("n"), F.count_if("inserted").alias("i"),
        F.count_if("updated").alias("u"), F.count_if("rejected").alias("e"),
    )
    return per_record.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
        F.count("record_id").alias("records_processed"),
        F.coalesce(F.sum("i"), F.lit(0)).alias("records_inserted"),
        F.coalesce(F.sum("u"), F.lit(0)).alias("records_updated"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("errors"),
    )


def history_record(events: DataFrame, as_of: Column) -> DataFrame:
    """One open history row per change event, before any interval is closed."""
    kind = F.col("event_type")
    return events.where(kind.isin("INSERT", "UPDATE", "DELETE")).select(
        F.col("record_id").alias("id"),
        F.col("event_timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        kind.alias("change_type"),
        F.to_json(F.coalesce(F.col("changed_fields"), F.array().cast("array<string>"))).alias("changed_fields"),
        F.to_json(F.when(kind == "DELETE", F.col("before")).otherwise(F.col("after")),
                  {"ignoreNullFields": "false"}).alias("record_data"),
        as_of.alias("ingestion_timestamp"),
    )


def current_view(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current"))


def current_state(events: DataFrame) -> DataFrame:
    """Latest state per record under a change feed; a deleted record has none.

    ``max_by`` combines map-side, so a hot record costs one row per map task. Events of one instant
    and event id are told apart by their type and state, so every evaluation gives the same row.
    """
    last = F.max_by(
        F.struct("event_type", "event_timestamp", "after"),
        F.struct("event_timestamp", "event_id", "event_type", _at_rest(events, "after")),
    )
    return (
        events.where(F.col("record_id").isNotNull())
        .groupBy("record_id")
        .agg(last.alias("last"))
        .where(F.col("last.event_type") != "DELETE")
        .select("record_id", "last.event_type", "last.event_timestamp", "last.after")
    )


def snapshot_diff(
    before: DataFrame, after: DataFrame, key: str, tracked_fields: Iterable[str] | None = None
) -> DataFrame:
    """Change events between two snapshots: record_id, event_type, changed_fields, before, after.

    Repeated keys inside a snapshot fold to one row first, which also keeps the join one to one.
    Snapshots must have orderable columns. A column of one snapshot only counts as null in the other.
    """

    def states(df: DataFrame, alias: str) -> DataFrame:
        names = [c for c in df.columns if c != key]
        return df.groupBy(key).agg(F.max(F.struct(key, *names)).alias(alias))

    both = states(before, "before").join(states(after, "after"), key, "full_outer")
    changed = changed_fields(both, "before", "after", tracked_fields)
    kind = (
        F.when(F.col("before").isNull(), "INSERT")
        .when(F.col("after").isNull(), "DELETE")
        .when(F.size("changed") > 0, "UPDATE")
    )
    return (
        both.withColumn("changed", changed)
        .withColumn("event_type", kind)
        .where(F.col("event_type").isNotNull())
        .select(
            F.col(key).alias("record_id"), "event_type",
            F.when(F.col("event_type") == "UPDATE", F.col("changed"))
            .otherwise(F.array().cast("array<string>")).alias("changed_fields"),
            "before", "after",
        )
    )


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    payload: Iterable[str],
    unique: Iterable[str],
    hot: HotKeys | None,
) -> DataFrame:
    """Facts with the version valid at ``ts`` (start inclusive, end exclusive).

    Both sides are stacked and each fact takes the last version at or before it, so the work is
    one sort per key instead of facts x versions. ``history`` has ``id, valid_from, valid_to``;
    facts without a valid version are dropped. ``unique`` columns make facts distinct in order;
    ``hot`` are record ids with very many facts or versions.
    """
    payload, unique = list(payload), list(unique)
    version = F.struct("valid_from", "valid_to", *payload)
    left = facts.select(
        F.col(key).alias("__key"), F.col(ts).alias("__ts"), F.lit(1).alias("__kind"),
        F.xxhash64(*unique).alias("__tie"), F.struct(*facts.columns).alias("__fact"),
    )
    right = history.select(
        F.col("id").alias("__key"), F.col("valid_from").alias("__ts"), F.lit(0).alias("__kind"),
        F.lit(0).cast("long").alias("__tie"), version.alias("__version"),
    )
    left, right = left.where(F.col("__key").isNotNull()), right.where(F.col("__key").isNotNull())
    stacked = left.unionByName(right, allowMissingColumns=True)
    if hot is not None:
        stacked = reliable(stacked)
    found = with_latest(stacked, ["__key"], ["__ts", "__kind", "__tie"], "__found",
                        F.col("__version"), hot and hot.renamed("__key"))
    valid = F.col("__found").isNotNull() & (
        F.col("__found.valid_to").isNull() | (F.col("__ts") < F.col("__found.valid_to"))
    )
    return found.where((F.col("__kind") == 1) & valid).select(
        "__fact.*", *[F.col("__found")[c].alias(c) for c in ["valid_from", "valid_to", *payload]]
    )

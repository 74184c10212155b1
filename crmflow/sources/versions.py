"""The stored versions of a history table, merged batch by batch without MERGE INTO.

A merge adds the batch's boundaries as a delta and records its batch id: its cost follows the batch.
Readers see compacted versions with the pending deltas folded in, the same rows a compaction would
write. A compaction rewrites the places in which a row changes, ``period=<open | closing day>/
bucket=<n>``, into a folder of its own generation; other places keep their files. What the table
consists of is one manifest (``Generations``), so no file that a reader may use is ever replaced: a
reader never sees half a merge, and a merge or compaction that dies leaves the generation before.

A batch in time order changes open versions and adds to recent days; a late event rewrites just the
days it falls into. Rows are written in ranges of (period, bucket, id, valid_from), so a record with
very many versions is spread over days, tasks and files. The append-only boundary log of a job is the
truth: ``rebuild`` makes the table from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmflow.operators.history import BOUNDARY, as_history, chain, merge_versions, without_tombstones
from crmflow.operators.ordered import MAX_BROADCAST, MAX_ROWS_PER_TASK, find_hot_keys
from crmflow.session import reliable
from crmflow.sources.generations import Generations, has_batch, with_batch

OPEN = "open"
PLACE = ["period", "bucket"]
EMPTY = {"places": {}, "deltas": [], "batches": {}}


class VersionsTable:
    def __init__(self, spark: SparkSession, path: str, record_type: T.DataType | None = None,
                 buckets: int = 64, event_id_type: T.DataType | None = None, compact_after: int = 8):
        """``buckets`` x days is the number of places; ``compact_after`` deltas are folded together."""
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            raise ValueError("closing days are UTC days: set spark.sql.session.timeZone to UTC")
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets, self.compact_after = buckets, compact_after
        self.generations = Generations(spark, path)
        boundary = [
            T.StructField("id", T.StringType()),
            T.StructField("valid_from", T.TimestampType()),
            T.StructField("event_id", event_id_type or T.StringType()),
            T.StructField("change_type", T.StringType()),
            T.StructField("changed_fields", T.ArrayType(T.StringType())),
            T.StructField("record_data", record_type or T.StringType()),
        ]
        types = {f.name: f for f in boundary}
        self.delta_schema = T.StructType(boundary)
        self.schema = T.StructType([
            types["id"], types["valid_from"],
            T.StructField("valid_to", T.TimestampType()),
            T.StructField("is_current", T.BooleanType()),
            types["change_type"], types["changed_fields"], types["record_data"], types["event_id"],
            T.StructField("period", T.StringType()),
            T.StructField("bucket", T.IntegerType()),
        ])

    # Reading

    def _state(self) -> dict:
        return self.generations.current()[1] or EMPTY

    def _stored(self, state: dict, since_day: str | None = None, before: bool = False) -> DataFrame:
        """Compacted versions with their place; with ``since_day`` those open or closed from then on (or ``before`` it)."""
        paths = []
        for place, folder in sorted(state["places"].items()):
            period, bucket = place.split("/")
            recent = since_day is None or period == OPEN or period >= since_day
            if recent != before:
                paths.append(f"{self.path}/versions/gen={folder}/period={period}/bucket={bucket}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/versions")
        return reader.parquet(*paths).select(*self.schema.fieldNames())

    def _pending(self, deltas: list[dict]) -> DataFrame:
        if not deltas:
            return self.spark.createDataFrame([], self.delta_schema)
        return self.spark.read.schema(self.delta_schema).parquet(*[f"{self.path}/deltas/{d['name']}" for d in deltas])

    def _touched(self, new: DataFrame, rows: int) -> DataFrame:
        """Ids of some deltas, marked for broadcast where their recorded rows are few."""
        ids = new.select("id").distinct()
        return F.broadcast(ids) if rows <= MAX_BROADCAST else ids

    def rows(self, since_day: str | None = None, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
        """All versions with tombstones and their place, pending deltas folded in.

        Versions of records no delta touches go through without a shuffle. ``since_day`` leaves out
        compacted versions of such records that closed before it.
        """
        state = self._state()
        deltas = state["deltas"]
        if not deltas:
            return self._stored(state, since_day)
        new, count = self._pending(deltas), sum(d["rows"] for d in deltas)
        touched = self._touched(new, count)
        still = self._stored(state, since_day).join(touched, "id", "left_anti")
        first = min(d["first"] for d in deltas)
        first_day = min(d["first_day"] for d in deltas)
        near = self._stored(state, first_day).join(touched, "id", "left_semi")
        far = self._stored(state, first_day, before=True).join(touched, "id", "left_semi")
        hot = find_hot_keys(near.select("id").unionByName(new.select("id")), ["id"], max_rows)
        since = F.timestamp_micros(F.lit(first))
        near = near.drop(*PLACE)
        replaced, rebuilt = merge_versions(near, new, hot, since)
        kept = near.join(replaced.select("id", "valid_from"), ["id", "valid_from"], "left_anti")
        folded = self._placed(kept.unionByName(rebuilt)).select(*self.schema.fieldNames())
        return still.unionByName(far).unionByName(folded)

    def history(self) -> DataFrame:
        return without_tombstones(self.rows()).drop(*PLACE)

    def as_of(self, instant) -> DataFrame:
        """Versions valid at one instant; days closed before it are not read for records at rest."""
        at = F.lit(instant).cast("timestamp")
        day = self.spark.range(1).select(F.date_format(at, "yyyy-MM-dd")).first()[0]
        return (
            without_tombstones(self.rows(since_day=day))
            .where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
            .drop(*PLACE)
        )

    def current(self) -> DataFrame:
        """Open versions; with no pending delta only the open places are read."""
        return self.history().where("is_current") if self._state()["deltas"] else (
            without_tombstones(self._stored(self._state(), "9999-99-99")).drop(*PLACE))

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            "period": F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit(OPEN)),
            "bucket": F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int"),
        })

    # Writing

    def append(self, new: DataFrame, batch_id: int | None = None, source: str = "") -> bool:
        """Store boundaries as a delta; False if ``batch_id`` is recorded already or there is nothing.

        Nothing stored is read. Under two writers with one batch id only the first is recorded. ``source``
        names the stream that numbers the batches.
        """
        if batch_id is not None and has_batch(self._state()["batches"].get(source, []), batch_id):
            return False
        name = f"{'x' if batch_id is None else batch_id}-{uuid.uuid4().hex}"
        path = f"{self.path}/deltas/{name}"
        new.select(*[F.col(c).cast(self.delta_schema[c].dataType) for c in BOUNDARY]).write.parquet(path)
        stored = self.spark.read.schema(self.delta_schema).parquet(path)
        rows, first, day = stored.agg(
            F.count("*"), F.unix_micros(F.min("valid_from")), F.date_format(F.min("valid_from"), "yyyy-MM-dd")).first()
        entry = {"name": name, "rows": rows, "first": first, "first_day": day}

        def added(content):
            content = content or EMPTY
            own = content["batches"].get(source, [])
            if batch_id is not None and has_batch(own, batch_id):
                return None
            batches = content["batches"] if batch_id is None else {**content["batches"], source: with_batch(own, batch_id)}
            if not rows and batches == content["batches"]:
                return None
            return {**content, "deltas": content["deltas"] + ([entry] if rows else []), "batches": batches}

        published = self.generations.update(added)
        return bool(rows) and any(d["name"] == name for d in published["deltas"])

    def merge(self, new: DataFrame, max_rows: int = MAX_ROWS_PER_TASK, batch_id: int | None = None,
              source: str = "") -> None:
        """Fold boundaries into the table. Repeating a batch leaves the table as it is."""
        self.append(new, batch_id, source)
        if len(self._state()["deltas"]) >= self.compact_after:
            self.compact(max_rows)

    def compact(self, max_rows: int = MAX_ROWS_PER_TASK) -> bool:
        """Fold the pending deltas into the places in which rows change; False if there is nothing to do.

        Deltas that arrive meanwhile stay pending. Of two compactions the second leaves things as they are.
        """
        state = self._state()
        deltas = state["deltas"]
        if not deltas:
            return False
        new, count = self._pending(deltas), sum(d["rows"] for d in deltas)
        since = F.timestamp_micros(F.lit(min(d["first"] for d in deltas)))
        near = self._stored(state, min(d["first_day"] for d in deltas))
        touched = near.join(self._touched(new, count), "id", "left_semi")
        hot = find_hot_keys(touched.select("id").unionByName(new.select("id")), ["id"], max_rows)
        replaced, rebuilt = merge_versions(touched.drop(*PLACE), new, hot, since)
        replaced, rebuilt = reliable(self._placed(replaced)), reliable(self._placed(rebuilt))
        places = replaced.select(*PLACE).unionByName(rebuilt.select(*PLACE)).distinct()
        changed = {f"{r['period']}/{r['bucket']}" for r in places.collect()}  # at most buckets x days
        inside = {**state, "places": {p: g for p, g in state["places"].items() if p in changed}}
        kept = self._stored(inside).join(replaced.select("id", "valid_from"), ["id", "valid_from"], "left_anti")
        folder, filled = self._write(kept.unionByName(rebuilt.select(*self.schema.fieldNames())))
        done = {d["name"] for d in deltas}

        def swapped(content):
            if not done <= {d["name"] for d in content["deltas"]}:
                return None
            places = {p: g for p, g in content["places"].items() if p not in changed} | {p: folder for p in filled}
            return {**content, "places": places, "deltas": [d for d in content["deltas"] if d["name"] not in done]}

        return folder in self.generations.update(swapped)["places"].values()

    def rebuild(self, log: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> None:
        """Write the table anew from all boundaries; recorded batches stay recorded."""
        hot = find_hot_keys(log.select("id"), ["id"], max_rows)
        rows = self._placed(as_history(chain(log, hot), emit_tombstones=True))
        folder, filled = self._write(rows)
        self.generations.update(lambda content: {
            "places": {p: folder for p in filled}, "deltas": [], "batches": content["batches"] if content else {}})

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Rows in a folder of their own; the folder's name and the places it has."""
        folder, ordered = uuid.uuid4().hex, [*PLACE, "id", "valid_from"]
        root = f"versions/gen={folder}"
        (
            rows.select(*self.schema.fieldNames()).repartitionByRange(*ordered).sortWithinPartitions(*ordered)
            .write.partitionBy(*PLACE).parquet(f"{self.path}/{root}")
        )
        filled = [
            f"{period.split('=', 1)[1]}/{bucket.split('=', 1)[1]}"
            for period in self.generations.names(root) if period.startswith("period=")
            for bucket in self.generations.names(root, period) if bucket.startswith("bucket=")
        ]
        return folder, filled

    def clean(self, keep: int = 2) -> int:
        """Delete folders that none of the last ``keep`` generations uses."""
        dropped = self.generations.clean(lambda c: {f"gen={g}" for g in c["places"].values()}, "versions", keep)
        return dropped + self.generations.clean(lambda c: [d["name"] for d in c["deltas"]], "deltas", keep)

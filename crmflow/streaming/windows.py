"""Counts per event-time window inside a job: closed windows once, what came too late aside.

The watermark of a batch is the greatest event time of the batches before it, less the allowed lateness. A
row is late if its window ended by then; a window closes with the batch after which the watermark reaches
its end. Open windows are partial counts, one row per window and group, in a folder per batch; a manifest
names the last batch, its folder and the greatest event time, so a batch that is processed again, or whose
driver died, gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmflow.sources.generations import Generations


@dataclass
class WindowJob:
    """Windows closed by batch, late rows and open counts below ``base``."""

    spark: SparkSession
    base: str
    width: str
    lateness: str
    by: tuple[str, ...] = ("object_type",)
    ts: str = "event_timestamp"

    def __post_init__(self):
        self._state = Generations(self.spark, f"{self.base}/open")
        self.schema = T.StructType([
            T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
            *(T.StructField(c, T.StringType()) for c in self.by), T.StructField("n", T.LongType()),
        ])

    def state(self, source: str = "") -> dict:
        """Last batch, greatest event time in microseconds and late rows so far."""
        content = self._state.current()[1] or {}
        return content.get(source, {"batch": -1, "until": None, "folder": None, "late": 0})

    def _watermark(self, until: int | None):
        return F.timestamp_micros(F.lit(until)) - F.expr(f"interval {self.lateness}")

    def _stored(self, folder: str | None) -> DataFrame:
        if folder is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.base}/open/{folder}")

    def batch(self, events: DataFrame, batch_id: int, source: str = "") -> bool:
        """Count one micro-batch; False if it was counted before. Rows without an event time are left out."""
        held = self.state(source)
        if batch_id <= held["batch"]:
            return False
        span = F.window(self.ts, self.width)
        rows = events.where(F.col(self.ts).isNotNull()).withColumn("__window", span)
        late = F.lit(False) if held["until"] is None else F.col("__window.end") <= self._watermark(held["until"])
        rows = rows.withColumn("__late", late).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            dropped = rows.where("__late").drop("__late")
            dropped.select(
                F.col("__window.start").alias("window_start"), *[c for c in dropped.columns if c != "__window"],
            ).write.mode("overwrite").parquet(f"{self.base}/late/batch_id={batch_id}")
            now = rows.where("NOT __late").groupBy(
                F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end"),
                *[F.col(c).cast("string").alias(c) for c in self.by],
            ).agg(F.count("*").alias("n"))
            latest, n_late = rows.agg(F.unix_micros(F.max(self.ts)), F.count_if("__late")).first()
            until = max((x for x in (latest, held["until"]) if x is not None), default=None)
            counts = self._stored(held["folder"]).unionByName(now).groupBy("window_start", "window_end", *self.by).agg(F.sum("n").alias("n"))
            closed = F.lit(False) if until is None else F.col("window_end") <= self._watermark(until)
            # One row per open window and group: kept for both outputs.
            counts = counts.withColumn("__closed", closed).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                counts.where("__closed").drop("__closed").write.mode("overwrite").parquet(f"{self.base}/closed/batch_id={batch_id}")
                folder = f"{source or 'batch'}-{batch_id}"
                counts.where("NOT __closed").drop("__closed").write.mode("overwrite").parquet(f"{self.base}/open/{folder}")
            finally:
                counts.unpersist()
        finally:
            rows.unpersist()

        def counted(content):
            entry = {"batch": batch_id, "until": until, "folder": folder, "late": held["late"] + n_late}
            return {**(content or {}), source: entry}

        self._state.update(counted)
        self._state.clean(lambda c: ["_generations", *(e["folder"] for e in c.values())], "")
        return True

    def closed(self) -> DataFrame:
        """Windows that closed, with the batch in which they did."""
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(f"{self.base}/closed")

    def open(self, source: str = "") -> DataFrame:
        return self._stored(self.state(source)["folder"])

"""Which messages came before: ids and contents that outlive a micro-batch.

The ledger holds one narrow row per content: its key, a digest and the batch it first came in. A batch
is judged against the entries of earlier batches only, so judging it again gives the same answer. Each
batch adds a small sorted run; runs of one size are folded into a larger one, so an entry is rewritten a
number of times that grows with the logarithm of the batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmflow.sources.generations import Generations

FIRST, REPEATED, CONFLICT = "first", "repeated", "conflict"
_ENTRY = "key string, content binary, won boolean, source string, batch long"


def digest(value: Column) -> Column:
    """32 bytes that tell contents apart; an absent value is a content of its own."""
    return F.unhex(F.coalesce(F.sha2(value.cast("binary"), 256), F.lit("")))


def ledger_key(event_id: Column, content: Column) -> Column:
    """The event id; a message without one (null or empty) goes by its content."""
    name = F.nullif(event_id.cast("string"), F.lit(""))
    return F.coalesce(F.concat(F.lit("id:"), name), F.concat(F.lit("content:"), F.hex(content)))


class SeenIds:
    def __init__(self, spark: SparkSession, path: str, fold_every: int = 16, source: str = ""):
        """``fold_every`` runs of a size are folded into one. ``source`` tells streams apart that number
        their batches alike, as a stream with a new checkpoint does."""
        self.spark, self.path, self.fold_every, self.source = spark, path.rstrip("/"), fold_every, source
        self.generations = Generations(spark, path)

    def _read(self, runs: list[dict]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).parquet(*[f"{self.path}/runs/{r['name']}" for r in runs])

    def entries(self) -> DataFrame:
        _, content = self.generations.current()
        return self._read(content["runs"] if content else [])

    def judge(self, messages: DataFrame, batch_id: int, event_id: Column, value: Column) -> DataFrame:
        """Add ``arrival``: 'first', 'repeated' (this content came in an earlier batch) or 'conflict'
        (another content has the id: that of an earlier batch, or the smallest of this batch), and the
        ledger's ``__key`` and ``__content``.

        Needs distinct messages. Rows are joined with the odd keys only, those that repeat in the batch or
        are in the ledger, one row each; the ledger is reduced to the batch's keys before anything else.
        """
        content = digest(value)
        named = messages.withColumns({"__content": content, "__key": ledger_key(event_id, content)})
        ours = named.groupBy("__key").agg(
            F.count("*").alias("__n"), F.min_by("__content", value.cast("binary")).alias("__least"))
        earlier = (F.col("source") != self.source) | (F.col("batch") < batch_id)
        near = self.entries().where(earlier).join(
            ours.select(F.col("__key").alias("key")), "key", "left_semi")
        winners = near.where("won").select(F.col("key").alias("__key"), F.col("content").alias("__stored"))
        losers = near.where("NOT won").select(
            F.col("key").alias("__key"), F.col("content").alias("__content"), F.lit(True).alias("__lost"))
        odd = (
            ours.join(winners, "__key", "left").where("__n > 1 OR __stored IS NOT NULL")
            .select("__key", F.coalesce("__stored", "__least").alias("__won"), F.col("__stored").isNotNull().alias("__known"))
        )
        judged = named.join(odd, "__key", "left").join(losers, ["__key", "__content"], "left")
        other = F.col("__content") != F.col("__won")
        arrival = (
            F.when(F.col("__won").isNull(), FIRST)
            .when(F.col("__lost") | (~other & F.col("__known")), REPEATED)
            .when(other, CONFLICT).otherwise(FIRST)
        )
        return judged.select(*messages.columns, "__key", "__content", arrival.alias("arrival"))

    def record(self, judged: DataFrame, batch_id: int) -> None:
        """Add what the batch brought. Recording a batch again replaces its own run with the same rows."""
        name = f"batch-{self.source}-{batch_id}"
        new = judged.where(F.col("arrival") != REPEATED).select(
            F.col("__key").alias("key"), F.col("__content").alias("content"),
            (F.col("arrival") == FIRST).alias("won"), F.lit(self.source).alias("source"), F.lit(batch_id).cast("long").alias("batch"))
        self._write(new, name)

        def added(content):
            runs = content["runs"] if content else []
            if any(name in r["batches"] for r in runs):
                return None
            return {"runs": [*runs, {"name": name, "level": 0, "batches": [name]}]}

        self.generations.update(added)

    def _write(self, entries: DataFrame, name: str) -> None:
        ordered = entries.repartitionByRange("key", "content").sortWithinPartitions("key", "content")
        ordered.write.mode("overwrite").parquet(f"{self.path}/runs/{name}")

    def fold(self) -> bool:
        """Fold full levels; replaced runs stay for readers until the next ``clean``."""
        _, content = self.generations.current()
        runs, level, folded = (content["runs"] if content else []), 0, []
        while len(group := [r for r in runs if r["level"] == level]) >= self.fold_every:
            name = f"level-{level + 1}-{uuid.uuid4().hex}"
            self._write(self._read(group), name)
            folded += [r["name"] for r in group]
            runs = [r for r in runs if r["level"] != level] + [{
                "name": name, "level": level + 1, "batches": [b for r in group for b in r["batches"]][-self.fold_every:]}]
            level += 1
        if not folded:
            return False

        def replaced(newest):
            known = {r["name"] for r in content["runs"]}
            return {"runs": runs + [r for r in newest["runs"] if r["name"] not in known]}

        self.generations.update(replaced)
        return True

    def clean(self) -> int:
        return self.generations.clean(lambda c: [r["name"] for r in c["runs"]], "runs")

"""Rows written once to a hidden folder, looked at there, then published or dropped.

``<path>/_staging/<key>/data`` is written by one Spark job. Checks read it, not the source again.
Publishing begins with one marker file: from then on the write counts, and ``recover`` finishes it
wherever it stopped, as moving a file that is gone already changes nothing. Without the marker the
write never happened. A published key can be recorded; a write under a recorded key does nothing.
Plain readers of ``path`` see files as they are moved in, never staged ones. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmflow.sources.generations import Generations, has_batch, with_batch

_STAGING, _READY = "_staging", "_ready"


class Files:
    """Renames and listings through the file system a path lives on."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._root = self._hadoop.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self._hadoop.Path("/".join((self.path, *parts)))

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self.at(*parts))

    def names(self, *parts: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.at(*parts))) if self.exists(*parts) else []

    def delete(self, *parts: str) -> None:
        self._fs.delete(self.at(*parts), True)

    def leaves(self, *parts: str) -> dict[str, int]:
        """Data files below a folder, relative to it, with their sizes; hidden ones are left out."""
        if not self.exists(*parts):
            return {}
        base, found = self.at(*parts), {}
        prefix = self._fs.makeQualified(base).toUri().getPath().rstrip("/") + "/"
        files = self._fs.listFiles(base, True)
        while files.hasNext():
            status = files.next()
            name = status.getPath().toUri().getPath().removeprefix(prefix)
            if not any(x.startswith(("_", ".")) for x in name.split("/")):
                found[name] = status.getLen()
        return found

    def move(self, source: Sequence[str], target: Sequence[str]) -> bool:
        """Rename; False if the source is gone or the target is there."""
        if not self.exists(*source) or self.exists(*target):
            return False
        self._fs.mkdirs(self.at(*target).getParent())
        if not self._fs.rename(self.at(*source), self.at(*target)):
            raise OSError(f"cannot move {'/'.join(source)} below {self.path}")
        return True

    def write(self, text: str, *parts: str) -> None:
        """A small file, visible only when it is whole."""
        draft = parts[:-1] + ("." + parts[-1],)
        out = self._fs.create(self.at(*draft))
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.delete(*parts)
        self.move(draft, parts)

    def read(self, *parts: str) -> str:
        stream = self._fs.open(self.at(*parts))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


class Stage:
    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.key, self.files = spark, key, Files(spark, path)
        self._here = (_STAGING, key)

    def write(self, df: DataFrame, partition_by: Sequence[str] = (), codec: str = "snappy") -> DataFrame:
        """Write the rows, in place of an unpublished earlier try, and return them as stored."""
        self.files.delete(*self._here)
        data = str(self.files.at(*self._here, "data"))
        df.write.option("compression", codec).partitionBy(*partition_by).parquet(data)
        fields = [f for f in df.schema.fields if f.name not in partition_by] + [f for f in df.schema.fields if f.name in partition_by]
        return self.spark.read.schema(type(df.schema)(fields)).parquet(data)

    def drop(self) -> None:
        self.files.delete(*self._here)

    def publish(self, below: str = "", replace: bool = False, batch: tuple[str, int] | None = None) -> None:
        """Move the files (``below`` a sub-folder of the data) into the table; ``replace`` first deletes what it holds.

        ``batch``, a source and an id, is recorded with it.
        """
        self.files.write(json.dumps({"below": below, "replace": replace, "batch": batch}), *self._here, _READY)
        self.finish()

    def finish(self) -> None:
        """Carry out a publication that was decided; nothing if none was."""
        if not self.files.exists(*self._here, _READY):
            return
        plan = json.loads(self.files.read(*self._here, _READY))
        if "swap" in plan:
            self._swap(plan["swap"])
            return
        data = (*self._here, "data", *([plan["below"]] if plan["below"] else []))
        names = self.files.leaves(*data)
        if plan["replace"]:
            new = {n.rsplit("/", 1)[-1] for n in names}
            for old in self.files.leaves():
                if old.rsplit("/", 1)[-1] not in new:
                    self.files.delete(*old.split("/"))
            # The rest only adds; what was moved already must stay if this is done again.
            self.files.write(json.dumps({**plan, "replace": False}), *self._here, _READY)
        for name in names:
            self.files.move((*data, *name.split("/")), name.split("/"))
        if plan["batch"]:
            record_batch(self.spark, self.files.path, *plan["batch"])
        self.drop()

    def swap(self, folder: str, held: dict[str, int]) -> bool:
        """Put the staged ``folder`` in place of the table's; False, and nothing is done, if that holds other files than ``held``."""
        if self.files.leaves(folder) != held:
            self.drop()
            return False
        self.files.write(json.dumps({"swap": folder}), *self._here, _READY)
        self.finish()
        return True

    def _swap(self, folder: str) -> None:
        new, old = (*self._here, "data", folder), (*self._here, "old")
        if self.files.exists(*new):
            self.files.move((folder,), old)
            self.files.move(new, (folder,))
        self.drop()


def recover(spark: SparkSession, path: str) -> int:
    """Finish publications that were decided, drop staged rest; returns how many were finished."""
    files, done = Files(spark, path), 0
    for key in files.names(_STAGING):
        stage = Stage(spark, path, key)
        done += files.exists(_STAGING, key, _READY)
        stage.finish()
        stage.drop()
    return done


def recorded(spark: SparkSession, path: str, source: str, batch_id: int) -> bool:
    _, content = Generations(spark, path).current()
    return has_batch((content or {}).get("batches", {}).get(source, []), batch_id)


def record_batch(spark: SparkSession, path: str, source: str, batch_id: int) -> None:
    def added(content):
        batches = (content or {}).get("batches", {})
        return {"batches": {**batches, source: with_batch(batches.get(source, []), batch_id)}}

    generations = Generations(spark, path)
    generations.update(added)
    generations.clean(lambda _: (), "_none")


def write_once(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str], source: str = "") -> bool:
    """Append a micro-batch exactly once: False if it is published already. Rebalancing avoids many small
    files and splits a partition that holds most rows."""
    spark = df.sparkSession
    recover(spark, path)
    if recorded(spark, path, source, batch_id):
        return False
    stage = Stage(spark, path, f"batch-{batch_id}")
    stage.write(df.hint("rebalance", *partition_by), partition_by)
    stage.publish(batch=(source, batch_id))
    return True


def fold_day(spark: SparkSession, path: str, day: str, cluster_by: Sequence[str], inner: Sequence[str] = (),
             column: str = "ingest_date") -> bool:
    """Rewrite a day's files as few sorted ones with disjoint ranges of the clustering columns.

    ``inner`` are partition columns below the day. False if the day is empty or got new files meanwhile.
    """
    recover(spark, path)
    folder, files = f"{column}={day}", Files(spark, path)
    held = files.leaves(folder)
    if not held:
        return False
    stage = Stage(spark, path, f"fold-{day}")
    rows = spark.read.option("basePath", path).parquet(f"{path}/{folder}")
    order = [*inner, *cluster_by]
    stage.write(rows.withColumn(column, F.lit(day)).repartitionByRange(*order).sortWithinPartitions(*order), [column, *inner])
    return stage.swap(folder, held)


def days(spark: SparkSession, path: str, column: str = "ingest_date") -> list[str]:
    return [n.split("=", 1)[1] for n in Files(spark, path).names() if n.startswith(f"{column}=")]

"""Writers: typed append, lake layout, dead letters, retention."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmflow.operators.parse import conform, missing_required
from crmflow.sources.staged import Files, Stage, recover

# Write dispositions of the configuration and their save modes.
DISPOSITIONS = {"WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite", "WRITE_EMPTY": "errorifexists"}
CODECS = ("snappy", "gzip", "lz4", "zstd")
FAILURE_POLICIES = ("dlq", "continue", "fail")
# Fixed value: the largest message, the batch size of the publisher.
MAX_MESSAGE_BYTES = 1 << 20


class BadRows(RuntimeError):
    """Rows do not fit the sink schema."""


def split_conforming(df: DataFrame, schema: T.StructType, skip_invalid: bool = False,
                     ignore_unknown: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows for a sink schema; bad rows name what failed in ``problems``.

    With ``skip_invalid`` a value that does not fit only nulls its column, and a row is bad
    only when a required column is null. Undeclared columns are refused unless ignored.
    """
    checked = with_problems(df, schema, skip_invalid, ignore_unknown)
    good = checked.where(F.size("problems") == 0).drop("problems", "__original")
    return good, checked.where(F.size("problems") > 0)


def with_problems(df: DataFrame, schema: T.StructType, skip_invalid: bool = False,
                  ignore_unknown: bool = False) -> DataFrame:
    """All rows in the sink schema with ``problems`` (empty where a row is good) and the row as it came in ``__original``."""
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if unknown and not ignore_unknown:
        raise BadRows(f"columns not in the sink schema: {unknown}")
    # The untouched row goes along, so that a dead letter holds the value that did not fit.
    original = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    kept = df.withColumn("__original", original).drop(*unknown)
    carried = T.StructType([*schema.fields, T.StructField("__original", T.StringType())])
    checked = missing_required(conform(kept, carried), carried)
    failed = F.col("missing") if skip_invalid else F.concat("cast_errors", "missing")
    return checked.withColumn("problems", F.array_distinct(failed)).drop("cast_errors", "missing")


def lay_out(df: DataFrame, date_column: str, cluster_by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in ranges of (day, clustering columns), sorted inside files.

    Range partitioning splits a day or a clustering value that is too large for one task, and
    file statistics then skip row groups on the clustering columns.
    """
    day = F.to_date(date_column)
    keyed = df.withColumn("ingest_date", day)
    columns = ["ingest_date", *cluster_by]
    ranged = keyed.repartitionByRange(partitions, *columns) if partitions else keyed.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def write_table(df: DataFrame, path: str, disposition: str = "WRITE_APPEND", codec: str = "snappy",
                partition_by: Sequence[str] = ("ingest_date",)) -> None:
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec}")
    df.write.mode(DISPOSITIONS[disposition]).option("compression", codec).partitionBy(*partition_by).parquet(path)


def append_raw(df: DataFrame, path: str, schema: T.StructType, cluster_by: Sequence[str],
               disposition: str = "WRITE_APPEND", on_bad: str = "dlq", skip_invalid: bool = False,
               ignore_unknown: bool = False, codec: str = "snappy",
               audit: Callable[[DataFrame], None] | None = None) -> None:
    """Write rows of a declared schema in one pass over ``df``. Bad rows go to ``<path>_dead_letters``, are
    dropped ('continue') or stop the write ('fail').

    All rows are staged with their route; the audit (which raises to stop the write), the letters and the rows to
    publish come from there. A write that is stopped leaves nothing visible. Files are sorted by the
    clustering columns; ``staged.fold_day`` later makes ranges of them.
    """
    if on_bad not in FAILURE_POLICIES:
        raise ValueError(f"unknown policy {on_bad}")
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec}")
    spark = df.sparkSession
    recover(spark, path)
    if disposition == "WRITE_EMPTY" and Files(spark, path).leaves():
        raise FileExistsError(f"{path} holds rows")
    good = F.size("problems") == 0
    checked = with_problems(df, schema, skip_invalid, ignore_unknown)
    routed = checked.withColumns({
        "__route": F.when(good, "good").otherwise("bad"),
        "__original": F.when(~good, F.col("__original")),
        "ingest_date": F.to_date("ingestion_timestamp"),
    })
    stage = Stage(spark, path, uuid.uuid4().hex)
    try:
        laid_out = routed.hint("rebalance", "__route", "ingest_date").sortWithinPartitions("__route", "ingest_date", *cluster_by)
        rows = stage.write(laid_out.select(*[c for c in routed.columns if c != "problems"], F.concat_ws(",", "problems").alias("__problems")),
                           ("__route", "ingest_date"), codec)
        if audit is not None:
            audit(rows)
        bad = rows.where("__route = 'bad'")
        if on_bad == "fail" and not bad.isEmpty():
            raise BadRows(f"rows do not fit {path}")
        if on_bad == "dlq":
            letters = bad.select(
                F.col("__original").alias("original_message"), F.col("__problems").alias("error"), "ingestion_timestamp")
            letters.write.mode("append").parquet(f"{path.rstrip('/')}_dead_letters")
    except BaseException:
        stage.drop()
        raise
    stage.publish("__route=good", replace=disposition == "WRITE_TRUNCATE")


def write_json_lines(df: DataFrame, path: str, disposition: str = "WRITE_TRUNCATE") -> None:
    df.write.mode(DISPOSITIONS[disposition]).option("ignoreNullFields", "false").json(path)


def publish(messages: DataFrame, servers: str, topic: str, fmt: str = "kafka", max_bytes: int = MAX_MESSAGE_BYTES,
            **options: str) -> dict[str, int]:
    """Send ``value`` rows (messages, alerts) to a topic; returns how many were sent and how many cannot be.

    A row without a value, or with one above ``max_bytes``, is not sent and counted as failed. A write that fails raises. Both
    counts come from the write itself. Kafka needs its connector; another ``fmt`` takes its own options.
    """
    fits = F.col("value").isNotNull() & (F.octet_length("value") <= max_bytes)
    seen = Observation()
    # Counted before the filter, in the same pass; a count per task attempt that succeeds.
    counted = messages.select("value", fits.alias("__fits")).observe(
        seen, F.count_if("__fits").alias("sent"), F.count_if(~F.col("__fits")).alias("failed"))
    if fmt == "kafka":
        options = {"kafka.bootstrap.servers": servers, "topic": topic, **options}
    counted.where("__fits").select("value").write.format(fmt).options(**options).save()
    return {name: seen.get[name] or 0 for name in ("sent", "failed")}


def drop_expired(spark: SparkSession, path: str, as_of: dt.date, days: int = 30, column: str = "ingest_date") -> int:
    """Delete day directories older than the retention period; returns how many.

    Lists directory names only (one per day), through the file system the path lives on.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    oldest = as_of - dt.timedelta(days=days)
    dropped = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{column}="):
            try:
                day = dt.date.fromisoformat(name.split("=", 1)[1])
            except ValueError:
                continue
            if day < oldest:
                fs.delete(status.getPath(), True)
                dropped += 1
    return dropped

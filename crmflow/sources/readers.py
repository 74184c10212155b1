"""Readers: extract envelopes, message streams, lake files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmflow.registry import OBJECTS, SOURCE_BATCH

MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("message_id", T.StringType()),
    T.StructField("publish_time", T.TimestampType()),
])


def text_schema(object_name: str) -> T.StructType:
    """The object's columns as text: what arrives before validation; nested values as VARIANT."""
    return T.StructType([
        T.StructField(f.name, T.VariantType() if f.type == "JSON" else T.StringType())
        for f in OBJECTS[object_name].fields
    ])


def stamp(records: DataFrame, object_type: str, at: Column, source: str = SOURCE_BATCH) -> DataFrame:
    """Add the ingestion metadata every extracted record carries."""
    return records.withColumns({
        "ingestion_timestamp": at, "source": F.lit(source), "object_type": F.lit(object_type),
    })


def unwrap(envelopes: DataFrame) -> DataFrame:
    """Records of ``{"records": [...]}`` envelopes, one row each."""
    return envelopes.select(F.explode("records").alias("r")).select("r.*")


def read_envelopes(spark: SparkSession, path: str, object_name: str, at: Column,
                   record_schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """Extract responses of one object. A malformed file fails the read, as a failed call would.

    A multi-line file is read by one task: have extracts write many files, or one envelope per
    line with ``multi_line=False``.
    """
    schema = T.StructType([
        T.StructField("records", T.ArrayType(record_schema or text_schema(object_name)))
    ])
    raw = spark.read.schema(schema).options(multiLine=multi_line, mode="FAILFAST").json(path)
    return stamp(unwrap(raw), object_name, at)


def extract_envelopes(texts: DataFrame, column: str, object_name: str, at: Column,
                      record_schema: T.StructType) -> DataFrame:
    """The same for envelopes held in a text column."""
    schema = T.StructType([T.StructField("records", T.ArrayType(record_schema))])
    parsed = texts.select(F.from_json(column, schema, {"mode": "FAILFAST"}).alias("e")).select("e.records")
    return stamp(unwrap(parsed), object_name, at)


def extract_all(tables: dict[str, DataFrame], at: Column, enabled: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """One lazy extract plan per enabled object."""
    names = list(tables) if enabled is None else [n for n in tables if n in set(enabled)]
    return {n: stamp(tables[n], n, at) for n in names}


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file that is one JSON array of records."""
    return spark.read.schema(schema).options(multiLine=True).json(path)


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet", include: str | None = None,
              schema: T.StructType | None = None) -> DataFrame:
    """All files of a format below ``path``; names starting with ``_`` are never read."""
    reader = spark.read.format(fmt).options(recursiveFileLookup=True, pathGlobFilter=include or f"*.{fmt}")
    return (reader.schema(schema) if schema else reader).load(path)


# What a lake zone takes in and leaves out.
INCLUDE, EXCLUDE = ("**/*.parquet", "**/*.json"), ("_temp/**", "_tmp/**")


def glob_pattern(globs: Iterable[str]) -> str:
    """A regular expression for paths below a root (with a leading ``/``) that one of the globs matches, at any depth.

    ``**`` stands for any folders, ``*`` and ``?`` stay inside one name.
    """
    special = {"**/": "(?:[^/]+/)*", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    each = ["".join(special.get(x, re.escape(x)) for x in re.split(r"(\*\*/|\*\*|\*|\?)", g.lstrip("/"))) for g in globs]
    return f"/(?:{'|'.join(each)})$"


def _wanted(spark: SparkSession, root: str, path: Column, include: Sequence[str], exclude: Sequence[str]) -> Column:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    whole = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(jpath).toUri().getPath()
    path = F.regexp_replace(path, "^[A-Za-z0-9+.-]+:(?://[^/]*)?" + re.escape(whole.rstrip("/")), "")
    found = path.rlike(glob_pattern(include)) if include else F.lit(True)
    return found & ~path.rlike(glob_pattern(exclude)) if exclude else found


def discover(spark: SparkSession, path: str, include: Sequence[str] = INCLUDE, exclude: Sequence[str] = EXCLUDE) -> DataFrame:
    """Files below ``path`` that one glob includes and none excludes: path, length, modified. No file is opened.

    Names beginning with ``_`` or ``.`` are never listed, at any depth.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified")).where(_wanted(spark, path, F.col("path"), include, exclude))


def read_new_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                   include: Sequence[str] = (), exclude: Sequence[str] = EXCLUDE, max_files: int = 1000) -> DataFrame:
    """A stream over the files of one format; the query's checkpoint is the ledger of those that were read.

    A run that takes what is there and stops (``availableNow``) therefore reads new files only. The globs work on
    the file's path, so rows of a file that is left out are never decoded.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(
        recursiveFileLookup=True, pathGlobFilter=f"*.{fmt}", maxFilesPerTrigger=max_files)
    return reader.load(path).where(_wanted(spark, path, F.col("_metadata.file_path"), include, exclude))


# Most rows of a task that parses and checks messages: some seconds of work, whatever the input.
TASK_ROWS = 100_000


def spread(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows over all cores, and over tasks of about ``task_rows`` rows, unless the input's splits are that small and even.

    For CPU-heavy work: a compact file has few splits by its bytes, and a row group lies whole in one split while others
    stay empty, so the longest task would grow with the table. Rows are counted by split; of a plain table that reads the
    footers only.
    """
    splits = df.select(F.spark_partition_id().alias("split")).groupBy("split").agg(F.count("*").alias("n"))
    rows, largest = splits.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // task_rows))
    uneven = largest * tasks > 2 * rows
    return df.repartition(tasks) if uneven or df.rdd.getNumPartitions() < tasks else df


def read_messages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """A message stream from files of the message schema (parquet)."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A message stream from a Kafka topic (needs the Kafka connector on the classpath)."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("includeHeaders", "true").options(**options).load()
    )
    # A topic may repeat a header key; the last one counts.
    entries = F.reverse(F.transform(F.coalesce("headers", F.array()), lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value"))))
    keys = F.array_distinct(F.transform(entries, lambda h: h["key"]))
    headers = F.map_from_arrays(keys, F.transform(keys, lambda k: F.filter(entries, lambda h: h["key"] == k)[0]["value"]))
    position = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return raw.select("value", headers.alias("attributes"), position.alias("message_id"),
                      F.col("timestamp").alias("publish_time"))


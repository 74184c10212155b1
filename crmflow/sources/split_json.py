"""One large JSON envelope read by many tasks.

``{"records": [{...}, ...], ...}`` has no line structure to split at, so it is read in chunks that end with a closing
brace: Spark cuts the file into byte ranges, and each range's chunks begin after its first brace. Whether a brace stands
in a string, and how deep it is, follows from all text before it. A range is therefore summed up for both cases, begun
outside and inside of a string; the sums, one row a range, give each range its true beginning; and a chunk that closes
one object of one array of the root ends a record. Only the pieces of records that cross ranges are exchanged again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANGE = ["__file", "__block"]


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _outside(text: Column) -> Column:
    """What of a text that begins outside of a string, free of escapes, is outside of strings."""
    return F.regexp_replace(text, '"[^"]*("|$)', "")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks with their place, the quotes that count, and the change of both depths, begun outside (0) or inside (1)."""
    read = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
        F.col("_metadata.file_size").alias("__size"), F.monotonically_increasing_id().alias("__at"))
    plain = read.withColumn("__plain", F.regexp_replace("value", r"\\.", ""))
    quotes = plain.withColumn("__quotes", _count(F.col("__plain"), '"') % 2)
    inside = F.regexp_replace("__plain", '^[^"]*("|$)', "")
    cut = quotes.withColumns({"__o0": _outside(F.col("__plain")), "__o1": _outside(inside)})
    closes = {0: F.col("__quotes") == 0, 1: F.col("__quotes") == 1}
    depths = {}
    for s in (0, 1):
        text = F.col(f"__o{s}")
        depths[f"__braces{s}"] = _count(text, "{") - closes[s].cast("int")
        depths[f"__brackets{s}"] = _count(text, "[") - _count(text, "]")
    return cut.withColumns(depths).select("value", *_RANGE, "__size", "__at", "__quotes", *depths)


def _chosen(name: str, state: Column) -> Column:
    return F.when(state == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))


def record_texts(spark: SparkSession, path: str, key: str = "records") -> DataFrame:
    """``file`` and ``record``, the JSON text of each object in the array ``key`` of the envelopes in ``path``.

    The array must be the only array of objects directly in the root, as in an extract response; another one, or a
    file that ends early, fails the read.
    """
    in_range = Window.partitionBy(*_RANGE).orderBy("__at")
    so_far, before = in_range.rowsBetween(Window.unboundedPreceding, 0), in_range.rowsBetween(Window.unboundedPreceding, -1)
    chunks = _chunks(spark, path).withColumn("__since", F.coalesce(F.sum("__quotes").over(before), F.lit(0)) % 2)

    # One row a range: its quotes, and its change of depth for both beginnings.
    sums = [F.sum("__quotes").alias("__quotes"), F.count("*").alias("__n"), F.sum(F.octet_length("value")).alias("__bytes"), F.max("__size").alias("__size")]
    for begun in (0, 1):
        for name in ("__braces", "__brackets"):
            sums.append(F.sum(_chosen(name, (F.col("__since") + begun) % 2)).alias(f"{name}{begun}"))
    ranges = chunks.groupBy(*_RANGE).agg(*sums)
    in_file = Window.partitionBy("__file").orderBy("__block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    begun = ranges.withColumn("__begun", F.coalesce(F.sum("__quotes").over(earlier), F.lit(0)) % 2)
    for name in ("__braces", "__brackets"):
        begun = begun.withColumn(name, _chosen(name, F.col("__begun")))
        begun = begun.withColumn(f"{name}_at", F.coalesce(F.sum(name).over(earlier), F.lit(0)))

    placed = chunks.join(begun.select(*_RANGE, "__begun", "__braces_at", "__brackets_at"), _RANGE)
    state = (F.col("__since") + F.col("__begun")) % 2
    placed = placed.withColumn("__state", state)
    deep = placed.withColumns({
        "__b": F.col("__braces_at") + F.sum(_chosen("__braces", F.col("__state"))).over(so_far),
        "__k": F.col("__brackets_at") + F.sum(_chosen("__brackets", F.col("__state"))).over(so_far),
    })
    closes = (F.col("__state") + F.col("__quotes")) % 2 == 0
    ends = deep.withColumn("__end", (closes & (F.col("__b") == 1) & (F.col("__k") == 1)).cast("int"))
    numbered = ends.select(
        "value", *_RANGE, "__at", "__end", F.coalesce(F.sum("__end").over(before), F.lit(0)).alias("__seq"),
        F.sum("__end").over(Window.partitionBy(*_RANGE)).alias("__ends"))

    # Pieces after a range's last end go on in the next range that has one.
    homes = ends.groupBy(*_RANGE).agg(F.max("__end").alias("__has"), F.max_by("__b", "__at").alias("__b"), F.max_by("__k", "__at").alias("__k"))
    own = F.when(F.col("__has") == 1, F.col("__block"))
    later = in_file.rowsBetween(1, Window.unboundedFollowing)
    homes = homes.withColumn("__next", F.first(own, ignorenulls=True).over(later)).select(*_RANGE, "__next")
    piece = F.concat("value", F.lit("}"))
    inner = numbered.where("__seq > 0 AND __seq < __ends").groupBy(*_RANGE, "__seq").agg(_joined(piece))
    border = numbered.where("__seq = 0 OR __seq = __ends").join(homes, _RANGE)
    home = F.when(F.col("__seq") < F.col("__ends"), F.col("__block")).otherwise(F.col("__next"))
    crossing = border.withColumn("__home", home).where("__home IS NOT NULL").groupBy("__file", "__home").agg(_joined(piece, "__block"))
    first = crossing.groupBy("__file").agg(F.min("__home").alias("__first"))
    # A file's first record, and one that follows, in the ways they may begin.
    opening, following = rf'(?s)^\s*\{{.*?"{re.escape(key)}"\s*:\s*\[\s*(\{{.*)$', r"(?s)^\s*,\s*(\{.*)$"
    crossing = crossing.join(first, "__file").withColumn(
        "record", F.when(F.col("__home") == F.col("__first"), F.regexp_extract("__text", opening, 1))
        .otherwise(F.regexp_extract("__text", following, 1)))
    inner = inner.withColumn("record", F.regexp_extract("__text", following, 1))
    found = crossing.select("__file", "record").unionByName(inner.select("__file", "record"))
    failed = F.raise_error(F.concat(F.lit(f"not one array '{key}' of objects: "), "__file")).cast("string")
    checked = found.select(F.col("__file").alias("file"), F.when(F.col("record") == "", failed).otherwise(F.col("record")).alias("record"))
    return checked.unionByName(_unfinished(begun))


def _joined(piece: Column, *order: str) -> Column:
    pieces = F.array_sort(F.collect_list(F.struct(*order, "__at", piece.alias("text"))))
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("__text")


def _unfinished(ranges: DataFrame) -> DataFrame:
    """No rows; raises for a file in which a string, an object or an array is open at the end."""
    whole = ranges.groupBy("__file").agg(
        F.sum("__braces").alias("b"), F.sum("__brackets").alias("k"), (F.sum("__quotes") % 2).alias("q"),
        (F.sum("__n") + F.sum("__bytes") - F.max("__size")).alias("extra"))
    # The last chunk has no brace of its own where text follows the last one.
    bad = (F.col("b") + F.col("extra") != 0) | (F.col("k") != 0) | (F.col("q") != 0)
    failed = F.raise_error(F.concat(F.lit("the file ends early: "), "__file")).cast("string")
    return whole.select(F.col("__file").alias("file"), F.when(bad, failed).alias("record")).where("record IS NOT NULL")


def read_large_envelopes(spark: SparkSession, path: str, record_schema: T.StructType, key: str = "records") -> DataFrame:
    """Records of large envelopes, the same rows as one task a file gives."""
    parsed = record_texts(spark, path, key).select(F.from_json("record", record_schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")

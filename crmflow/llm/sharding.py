"""Sharding by longest-processing-time scheduling (law ``bytes``).

Equal texts make a group that stays together. Groups, largest first, go to the least-loaded shard, found on a heap. The
schedule needs only how many groups there are of each size: groups of one size are alike, so the heap runs over size
classes (distinct sizes; k of them need k * (k - 1) / 2 bytes of text at least, so their number is at most the root of twice
the corpus' bytes), and a class of many groups is dealt in bulk: all shards are raised to one level, the rest one by one.
Each class then has, for each shard, a range of ranks, and a group's rank within its class gives its shard. Ranks and slots
are numbered without bringing a class or a shard into one task: rows are dealt into salted parts of at most about
``PART_ROWS``, numbered there, and shifted by the counts of the parts before.

Groups of many rows (at least one in a thousand of all) are under a thousand; their shards are broadcast. All other
groups are joined by shuffle.

Nulls: a null text is an empty one, of 16 bytes. Null doc_id: numbered first, kept. Repeated rows each count and each have a slot; ties of equal
size: by fingerprint. No rows: no result. Other columns are ignored.
"""
import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crmflow.llm.common import saved, texts

SHARDS, OVERHEAD, PART_ROWS = 40, 16, 1_000_000


def schedule(sizes, counts, shards: int = SHARDS) -> np.ndarray:
    """How many groups of each size (largest first) go to each shard: a matrix, sizes x shards."""
    heap = [(0, k) for k in range(shards)]
    out = np.zeros((len(sizes), shards), np.int64)
    for row, (size, left) in enumerate(zip(sizes.tolist(), counts.tolist())):
        if left > 4 * shards and size:
            load = np.zeros(shards, np.int64)
            for x, k in heap:
                load[k] = x
            # The level that takes nearly all of the class: one by one, shards below it would be chosen first.
            low, high = int(load.min()), int(load.max()) + size * left
            while low < high:
                level = (low + high + 1) // 2
                if np.maximum(0, (level - load + size - 1) // size).sum() <= left:
                    low = level
                else:
                    high = level - 1
            take = np.maximum(0, (low - load + size - 1) // size)
            out[row] += take
            left -= int(take.sum())
            heap = [(int(x), k) for k, x in enumerate(load + take * size)]
            heapq.heapify(heap)
        for _ in range(left):
            x, k = heapq.heappop(heap)
            out[row, k] += 1
            heapq.heappush(heap, (x + size, k))
    return out


def numbered(df: DataFrame, by: str, order: list, name: str, parts: int) -> DataFrame:
    """``df`` with gapless numbers from 0 within each value of ``by``, in salted parts."""
    df = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = df.groupBy(by, "_part").count().withColumn("_shift", F.coalesce(F.sum("count").over(before), F.lit(0))).select(F.col(by).alias("_by"), F.col("_part").alias("_p"), "_shift")
    own = Window.partitionBy(by, "_part").orderBy(*order)
    df = df.withColumn("_row", F.row_number().over(own) - 1)
    df = df.join(shift, (F.col(by) == F.col("_by")) & (F.col("_part") == F.col("_p")))
    return df.withColumn(name, (F.col("_row") + F.col("_shift")).cast("long")).drop("_part", "_by", "_p", "_shift", "_row")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``."""
    spark = docs.sparkSession
    rows = saved(texts(docs).select("doc_id", (F.octet_length("text") + OVERHEAD).cast("long").alias("size"), F.crc32(F.col("text")).alias("text_crc32"), F.md5(F.col("text")).alias("print")), "rows")
    total = rows.count()
    groups = saved(rows.groupBy("print").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    classes = groups.groupBy("bytes").count().orderBy(F.desc("bytes")).toPandas()
    dealt = schedule(classes["bytes"].to_numpy(np.int64), classes["count"].to_numpy(np.int64), shards)
    bounds = pd.DataFrame({"class": classes["bytes"], "bounds": [x.tobytes() for x in np.cumsum(dealt, axis=1).astype(">i8")]})
    table = spark.createDataFrame(bounds, "class long, bounds binary")
    groups = numbered(groups, "bytes", ["print"], "rank", max(1, -(-int(classes["count"].sum()) // PART_ROWS)))
    groups = groups.join(F.broadcast(table) if len(bounds) <= 50_000 else table, F.col("bytes") == F.col("class"))
    bound = F.expr(f"filter(sequence(0, {shards - 1}), k -> conv(hex(substring(bounds, k * 8 + 1, 8)), 16, 10) <= rank)")
    groups = saved(groups.select("print", "n", F.size(bound).alias("shard")), "dealt")
    many = max(2, total // 1000)
    hot = groups.where(F.col("n") >= many).select("print", "shard")
    rest = groups.where(F.col("n") < many).select("print", "shard")
    rows = rows.join(F.broadcast(hot.withColumnRenamed("shard", "hot_shard")), "print", "left")
    found = rows.where("hot_shard is not null").withColumnRenamed("hot_shard", "shard").unionByName(rows.where("hot_shard is null").drop("hot_shard").join(rest, "print"))
    out = numbered(found, "shard", ["doc_id", "print"], "slot", max(1, -(-total // (shards * PART_ROWS))))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard"))

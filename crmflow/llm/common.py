"""Helpers that the operators of this subpackage share."""
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


#: Settings of the Python workers' allocators: arrays of over 1 MB go back to the system when they are freed, so that a
#: worker that serves many stages keeps no memory of the largest.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def workers_see_package(spark: SparkSession) -> None:
    """Python workers find this package also when the driver was started in another folder, and give memory back."""
    env = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset a local session sets one of its own, a cluster raises."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them see")
        conf = Path(tempfile.mkdtemp(prefix="llm-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for a table of this session, removed when the session ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Removes the files of a ``saved`` table that nothing reads any more."""
    for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        jpath = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jpath, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_see_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (long), text (null: empty) and the columns named."""
    workers_see_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


#: Rows of an Arrow batch: whole texts, some MB of them. Buffers of JVM and workers stay small over all stages.
BATCH_ROWS = 1000


def bounded(spark: SparkSession) -> None:
    """Batches between JVM and Python workers hold at most ``BATCH_ROWS`` rows, or fewer where the session says so."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def spread(df: DataFrame) -> int:
    """Partitions for a shuffle: those of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Most rows of a narrow table (a few numbers a row) that are sent to every executor: some tens of MB.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are few; else as it is, for a shuffled join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


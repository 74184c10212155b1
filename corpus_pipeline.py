"""The documents, stage by stage, to training files: STAGES in order, each on all that the one before kept."""
from pyspark.sql import DataFrame, SparkSession

from crmflow.llm import common, decontaminate, mixing, ngram_join, token_files, toxicity
from crmflow.llm.common import bounded

#: The mix repeats documents and drops none: rates from 1 on, towards a quarter more tokens.
LEAST_RATE, GROWTH = 1.0, 1.25


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity chain rejects go. Null and empty texts stay as judged; without labels none goes."""
    bounded(spark)
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more stays; empty texts all stay."""
    bounded(spark)
    return ngram_join.one_of_each(docs, 5, 80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item go; without items none goes."""
    bounded(spark)
    return decontaminate.without_benchmark(docs, _table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their rates; none goes. Without labelled documents all stay as they are."""
    bounded(spark)
    labelled = mixing.labelled_domains(docs, _table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labelled, floor=LEAST_RATE, growth=GROWTH)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and per document what is read back; no documents, no rows."""
    bounded(spark)
    return token_files.encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing", mix_domains),
    ("token_files", write_tokens),
]
# Trained models, random projections and a binary file format: SQL can't express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the table between two stages is written and read again."""
    docs = common.documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            kept = common.saved(kept, name)
            if k:
                common.dropped(docs)
        docs = kept
    return docs

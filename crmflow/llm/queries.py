"""The registered queries of this subpackage and their SQL."""
from pyspark.sql import DataFrame, SparkSession

from crmflow.llm import byte_bpe, common, decontaminate, fill_in_middle, hpy_model, line_labels, mixing, ngram_join, periodic_runs, pii, quality_model, sharding, token_files, toxicity


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(common.documents(spark, sf_dir))


def op1_mixing_to_target_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return mixing.rated(docs, mixing.labelled_domains(docs, _labels(spark, sf_dir)))


def op2_token_id_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encoded(common.documents(spark, sf_dir))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(common.documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_labels.judged(common.documents(spark, sf_dir), _labels(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(common.documents(spark, sf_dir))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(common.documents(spark, sf_dir), _labels(spark, sf_dir))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(common.documents(spark, sf_dir), _benchmark(spark, sf_dir))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpy_model.seventh_scores(common.documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(common.documents(spark, sf_dir), _labels(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(common.documents(spark, sf_dir))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(common.documents(spark, sf_dir))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(common.documents(spark, sf_dir))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


QUERIES = {x.__name__: x for x in (
    op1_mixing_to_target_weights, op2_token_id_binary_output, op3_personal_data, op4_quality_rules, op5_sharding, op6_quality_classifier, op7_ngram_jaccard_join, op8_benchmark_decontamination, op9_language_model, op10_toxicity,
    op11_periodic_runs, op12_byte_bpe, op13_fill_in_middle,
)}
SQL: dict = {"op13_fill_in_middle": fill_in_middle.SQL}

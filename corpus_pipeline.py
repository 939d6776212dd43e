"""Training-data pipeline over ``documents``: quality rules, near-dedup, decontamination,
mixing, token output. Each stage reads the Parquet its predecessor wrote.

All stages but the last return the columns of ``documents``; the last returns, per document
of the mix, what the token files hold (doc_id, start, n_tokens, ids_crc32, shard, place).

Results for odd input: null and empty texts fail the quality rules; a row with a null id
stays unless its text is rejected; repeated rows of an id share its fate; an empty table
runs through as an empty table; extra columns are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.llm import decontaminate, minhash_dedup, quality_rules, source_mix, token_output
from folio.llm.common import scratch_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the base rules or the pipeline's policy reject go."""
    return quality_rules.keep_good(docs, quality_rules.PIPELINE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the smallest document of each group of near duplicates stays."""
    return minhash_dedup.dedupe(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a benchmark item, also re-parameterised, go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: each document as often as its source's target takes it."""
    return source_mix.take_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: writes the shard files and reads them back."""
    return token_output.round_trip(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("tokens", tokens)]

#: Token encoding, knapsack choices and shingle links are beyond SQL; the tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs

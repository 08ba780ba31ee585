"""A training corpus from raw documents, in five stages.

quality rules -> SimHash near-dedup -> surrogates for personal data -> mixing
to target weights -> SentencePiece ids.  Each stage gets what its predecessor
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from runvault.llm import mixing, pii, quality, sentencepiece_bpe, simhash
from runvault.session import scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: SentencePiece encoding, iterated components and keyed draws have no SQL form
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a risk-controlled threshold rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.one_of_each(docs).select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates."""
    rows = pii.pseudonymise(docs)
    n = F.when(F.col("n_mentions") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return rows.withColumn("n_chars", n).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned to equal shares of the text; copies are rows."""
    return mixing.mix(docs).select(COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return sentencepiece_bpe.digests(docs)


STAGES = [("quality", quality_rules), ("simhash", near_dedup), ("surrogates", personal_data),
          ("mixing", mix_sources), ("sentencepiece", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

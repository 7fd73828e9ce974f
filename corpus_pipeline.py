"""The corpus pipeline: quality classifier, exact dedup, SimHash near-dedup, mixing sources, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs.
The stages handle nulls, empty texts, repeated rows, empty tables and further columns as the operators that they call say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterweave.llm import bpe, exact_dedup, quality_classifier, simhash, source_mix
from rosterweave.llm.common import shared_dir, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects go."""
    return quality_classifier.selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one stays."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate takes it."""
    return source_mix.emitted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, as counts and digests."""
    return bpe.encoded(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("simhash near-dedup", near), ("source mix", mix), ("bpe", encode)]

#: SQL can express neither the classifier nor the encoder; tests compare each stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, docs = shared_dir(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, f"stage{number}")
    return docs

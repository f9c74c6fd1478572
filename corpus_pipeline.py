"""Documents to training sequences: toxic ones go, one of each group of near copies stays, personal data is masked, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet and gives it to the next. All
stages but the last return the columns of ``documents``. Learning uses the labels of all documents that the stage gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swayline.llm import packing, pii, simhash, toxicity
from swayline.llm.common import keep


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose fingerprints link at two bits or fewer: that with the smallest id."""
    return simhash.one_per_group(docs, words=3, max_bits=2)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind; ``n_chars`` follows the new text."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per piece of every document: its place in a sequence of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies), ("personal_data", mask_personal_data),
          ("best_fit_packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs

"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

Quality rules, toxicity, near duplicates, personal data, packing. All but the last return the columns of documents.
Toxicity is learnt from the labels beside the documents. Defined results for nulls, empty tables and repeated rows are
those of the operators; a repeated row has one verdict and either all or none of its copies go on, until near
duplicates keep one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import minhash, packing, pii, quality, toxicity
from storelens.llm.scratch import Scratch

TOXIC_AT = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the label model or the base rules find bad."""
    return quality.filtered(docs)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts whose toxicity score reaches the threshold."""
    model, curve = toxicity.fit(docs, toxicity.learnable(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return toxicity.kept_below(docs, model, curve, TOXIC_AT)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return minhash.deduplicated(docs, width=5, percent=80)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    return pii.redacted(docs, pii.fit(docs.select("doc_id", "text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.pack_with_public_vocabulary(docs)


STAGES = [("quality", keep_good), ("toxicity", keep_civil), ("near_duplicates", keep_one_of_each),
          ("personal_data", redact), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stored = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for _, stage in STAGES:
        docs = stored.keep(stage(spark, docs, sf_dir))
        stored.forget(stored.count - 1)  # what the stage read is not needed again
    return docs

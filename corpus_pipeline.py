"""From raw documents to packed training sequences.

Five stages, each a function of (spark, docs, sf_dir) that works on all rows its predecessor kept:

    quality    texts that fail the quality rules go
    near_dup   of each group of near-duplicates the document of the smallest id stays
    decontam   texts that contain a benchmark item go
    secrets    secrets in the texts are replaced by a mark
    packing    the texts are cut and packed into sequences of 1024 tokens

All but the last return the columns of documents. Their results are written and read again
between stages, so a lost executor costs at most its stage. Python workers get the texts in Arrow batches
bounded in bytes, which stays set in the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm import decontam, near_dup, packing, quality, secret_scan
from cargolens.llm.common import bounded_batches, table
from cargolens.sources.workspace import stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return near_dup.keep_one(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    hidden = docs.withColumn("text", secret_scan.redacted(F.col("text")))
    if "n_chars" not in docs.columns:
        return hidden
    kind = docs.schema["n_chars"].dataType
    return hidden.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.char_length("text")).cast(kind))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return packing.packed_documents(docs)


STAGES = [("quality", keep_good), ("near_dup", keep_one), ("decontam", keep_clean),
          ("secrets", hide_secrets), ("packing", pack)]

# SQL knows neither the trained model nor signatures nor token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

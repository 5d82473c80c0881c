"""Helpers the text operators share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.sources.workspace import fresh_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# The white space that separates words: space and code points 9 to 13.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; Python workers started from now on can import this package."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, ROOT]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get texts in Arrow batches of some `BATCH_BYTES`, unless the session says otherwise.

    By default a batch has up to 10,000 rows and 64 MB. Executor and worker each hold it several times over
    (a vector that doubles as it grows, what came in, strings, results), once for every task that runs. No row is
    left out: a row that is longer makes a batch of its own.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def stored_small(df: DataFrame, name: str) -> DataFrame:
    """Like `stored`, but compressed harder, for intermediate tables of the input's size."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def fold(key: str, folds: int) -> Column:
    """crc32 of the key's text modulo `folds`: the split into training and held-out rows."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def stored_in_buckets(df: DataFrame, key: str, name: str, *sort: str) -> DataFrame:
    """Like `stored`, in as many buckets by a hash of `key` as a shuffle has partitions.

    Joins and groupings by the key then read it as it lies. `df` should be partitioned by the key, as a grouping by it
    leaves it, so that a task writes whole buckets.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    table = f"{name}_{path.rpartition('-')[2]}"
    writer = (df.write.option("path", path)
              .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key))
    (writer.sortBy(*sort) if sort else writer).saveAsTable(table)
    return spark.table(table)

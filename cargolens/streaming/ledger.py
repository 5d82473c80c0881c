"""What earlier batches filed under an id, without reading it all.

A ledger holds (id, value) rows per batch, dealt to folders by a hash of the id. Every `FAN` batches are merged into one
range, every `FAN` such ranges into a longer one, and so on, each id once with its latest value. So the history before batch n is
at most FAN - 1 ranges of each length, about FAN log(n) folders whatever its size, and a lookup opens of these only the
hash folders of its own ids. Which ranges there are follows from the batch number alone: nothing has to be
listed, and a batch that runs again writes the same ranges again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN = 8
BUCKETS = 64
BUCKET = "bucket"


def ranges(batches: int) -> list[tuple[int, int]]:
    """The ranges [from, to) that cover the batches before number `batches`."""
    found, at = [], 0
    while at < batches:
        size = 1
        while at % (size * FAN) == 0 and at + size * FAN <= batches:
            size *= FAN
        found.append((at, at + size))
        at += size
    return found


class Ledger:
    """(key, value) rows by batch, below `path`. Batches are numbered from 0 without gaps, as a stream does."""

    def __init__(self, spark: SparkSession, path: str, key: T.StructField, value: T.StructField):
        self.spark, self.path, self.key, self.value = spark, path, key.name, value.name
        self.schema = T.StructType([key, value, T.StructField("filed", T.LongType()),
                                    T.StructField(BUCKET, T.IntegerType())])

    def _folder(self, begin: int, end: int) -> str:
        return f"{self.path}/from={begin}/to={end}"

    def _read(self, begin: int, end: int) -> DataFrame:
        # The schema is given, so that a range without rows can be read too.
        return self.spark.read.schema(self.schema).parquet(self._folder(begin, end))

    def _write(self, rows: DataFrame, begin: int, end: int) -> None:
        (rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
         .parquet(self._folder(begin, end)))

    def _latest(self, rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(self.value), "filed")
        return rows.groupBy(self.key, BUCKET).agg(newest.alias("v"), F.max("filed").alias("filed")).select(
            self.key, F.col("v")[self.value].alias(self.value), "filed", BUCKET)

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(BUCKETS)).cast("int")

    def add(self, batch_id: int, rows: DataFrame) -> None:
        """File the (key, value) rows of a batch, a key once; then merge the ranges that end with it."""
        filed = rows.select(self.key, self.value, F.lit(batch_id).cast("bigint").alias("filed"),
                            self._bucket().alias(BUCKET))
        end, size = batch_id + 1, FAN
        self._write(filed, batch_id, end)
        while end % size == 0:
            parts = [self._read(k, k + size // FAN) for k in range(end - size, end, size // FAN)]
            self._write(self._latest(reduce(DataFrame.unionByName, parts)), end - size, end)
            size *= FAN

    def before(self, batch_id: int, keys: DataFrame) -> DataFrame:
        """The latest (key, value) that batches before this one filed for `keys`, a column of distinct keys."""
        if not batch_id:
            return self.spark.createDataFrame([], self.schema).select(self.key, self.value)
        # At most `BUCKETS` numbers.
        open_to = [r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()]
        parts = [self._read(*r).where(F.col(BUCKET).isin(open_to)) for r in ranges(batch_id)]
        found = reduce(DataFrame.unionByName, parts).join(keys, self.key, "left_semi")
        return self._latest(found).select(self.key, self.value)

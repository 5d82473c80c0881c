"""Type 2 history that takes change batches, in whatever order they come.

The history lies in folders by a hash of the key. A batch reads and rewrites only the folders of its keys, and only the
intervals of its own keys are derived anew. A version that repeats the state of the one before (compared by a hash of the
row) opens no interval; it is kept aside, because a late version may come between the two and make it a change after all. A
late version thus splits the interval it falls into, and the result does not depend on the order of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.operators.cells import CELL, in_cells, versioned
from cargolens.operators.joins import spreader
from cargolens.operators.latest import latest_per_key
from cargolens.sources.conform import assert_columns
from cargolens.sources.workspace import stored

BUCKETS = 64
BUCKET = "bucket"
CHANGE = "is_change"
INTERVAL = ("valid_from", "valid_to", "is_current")


def with_changes(versions: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Adds whether a version differs from the one before it, for keys of any size."""
    rest, state, border = "__rest", "__state", "__border"
    payload = [c for c in versions.columns if c not in (key, ts, tie)]
    hashed = versions.withColumns({rest: spreader(versions.columns), state: F.xxhash64(*payload)})
    merged = in_cells(hashed, key, [ts, tie, rest]).drop(rest)
    # What a cell begins with is the state in which the key's cell before it ends.
    carried = (merged.groupBy(key, CELL).agg(F.max_by(state, F.struct(ts, tie)).alias(state))
               .withColumn(state, F.lag(state).over(W.partitionBy(key).orderBy(CELL)))
               .where(F.col(state).isNotNull()).withColumn(border, F.lit(0)))
    rows = merged.withColumn(border, F.lit(1)).unionByName(carried, allowMissingColumns=True)
    before = F.lag(state).over(W.partitionBy(key, CELL).orderBy(border, ts, tie))
    changed = rows.withColumn(CHANGE, before.isNull() | (before != F.col(state))).where(F.col(border) == 1)
    return changed.select(*versions.columns, CHANGE)


def merge_versions(spark: SparkSession, path: str, batch_id: int, batch: DataFrame, key: str, ts: str,
                   tie: str) -> None:
    """Take a batch of versions into the history at `path`.

    Versions are told apart by key, time and `tie`; one that comes again replaces the earlier. Every version needs a
    key. Batches are numbered from 0; one that runs again changes nothing.
    """
    assert_columns(batch, [key, ts, tie])
    columns = batch.columns
    payload = [c for c in columns if c not in (key, ts, tie)]
    new = stored(latest_per_key(batch, [key, ts, tie], payload), "versions")
    if not new.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"versions without {key}")
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias(BUCKET)
    everything, others = new, None
    if batch_id:
        # At most `BUCKETS` numbers.
        touched = [r[0] for r in new.select(bucket).distinct().collect()]
        # The schema is given, so that no other folder is opened to find it out.
        at, flag = batch.schema[ts].dataType, T.BooleanType()
        kinds = zip((*INTERVAL, CHANGE, BUCKET), (at, at, flag, flag, T.IntegerType()), strict=True)
        filed = T.StructType([*batch.schema.fields, *(T.StructField(*k) for k in kinds)])
        standing = spark.read.schema(filed).parquet(path).where(F.col(BUCKET).isin(touched))
        keys = new.select(key).distinct()
        others = standing.join(keys, key, "left_anti").drop(BUCKET)
        again = new.select(F.col(key).alias("__key"), F.col(ts).alias("__ts"), F.col(tie).alias("__tie"))
        same = (F.col(key).eqNullSafe(F.col("__key")) & F.col(ts).eqNullSafe(F.col("__ts"))
                & F.col(tie).eqNullSafe(F.col("__tie")))
        kept = standing.select(*columns).join(keys, key, "left_semi").join(again, same, "left_anti")
        everything = kept.unionByName(new)
    flagged = stored(with_changes(everything, key, ts, tie), "flagged")
    intervals = versioned(flagged.where(CHANGE).drop(CHANGE), key, ts, tie).withColumn(CHANGE, F.lit(True))
    silent = flagged.where(~F.col(CHANGE))
    result = intervals.unionByName(silent, allowMissingColumns=True)
    if others is not None:
        result = result.unionByName(others)
    # Written first, since the folders that are replaced are read for it.
    whole = stored(result.select(*columns, *INTERVAL, CHANGE), "history")
    (whole.select("*", bucket).hint("rebalance", BUCKET).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The versions that changed something, with their intervals."""
    return spark.read.parquet(path).where(CHANGE).drop(CHANGE, BUCKET)

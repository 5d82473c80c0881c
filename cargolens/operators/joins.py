"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.sources.workspace import stored

SALT = "__salt"
PARTS = "__parts"


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spreader(columns) -> Column:
    """A number that differs between rows and, for equal rows, between input partitions.

    It is the same when a lost task runs again, so rows keep their place.
    """
    return F.xxhash64(*columns, F.spark_partition_id())


def fits_broadcast(df: DataFrame) -> bool:
    """True when the planner's size estimate is within its broadcast threshold."""
    # Public PySpark does not expose the estimate that decides on a broadcast.
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= limit


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys with more than a fair partition's rows, and into how many parts to split each.

    The keys are counted exactly: counts are combined on the map side, so one small row per key and
    task is shuffled, however the rows are spread, and the total is added up from the counts. There are
    fewer such keys than shuffle partitions, whatever the data size, and all parts
    together are at most five times as many.
    """
    width = shuffle_width(df)
    counts = stored(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")),
                    "key_counts")
    total = counts.agg(F.sum("__n")).first()[0] or 1
    shares = F.col("__n") * width / F.lit(total)
    return (counts.where(shares > 1)
            .select(key, F.ceil(4 * shares).cast("int").alias(PARTS)))


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner",
                spread=None, profile: DataFrame | None = None,
                small: bool | None = None) -> DataFrame:
    """Join a large, possibly skewed `left` with the table `right` on `key`.

    A right side within the broadcast threshold is left to the planner, which
    then broadcasts it. Beyond that the join shuffles, and rows of hot keys (and
    of the null key, which never matches) are spread over the partitions by a salt,
    with one copy of the few hot right rows per salt. Which keys count as hot only
    affects balance, never the result.

    `spread` names the left columns whose hash picks the salt, together with the input
    partition, so that copies of one row part as well. `profile` is a
    cheaper frame with the same keys to look for hot ones in, for example the base
    table when `left` is itself a join. `small` states whether the right side is small; without it the
    planner's estimate decides.
    """
    if left.isStreaming or (fits_broadcast(right) if small is None else small):
        return left.join(right, key, how)

    width = shuffle_width(left)
    # Written, so that the counts are not made twice. The list has fewer rows than there are
    # partitions, which bounds the broadcast.
    hot = F.broadcast(stored(hot_keys(left if profile is None else profile, key), "hot_keys"))
    parts = F.when(F.col(key).isNull(), F.lit(width)).otherwise(F.coalesce(PARTS, F.lit(1)))
    salted = (left.join(hot, key, "left")
              .withColumn(SALT, F.pmod(spreader(spread or left.columns), parts).cast("int"))
              .drop(PARTS))
    copies = (right.join(hot, key, "left")
              .withColumn(SALT, F.explode(F.sequence(F.lit(0),
                                                     F.coalesce(PARTS, F.lit(1)) - 1)))
              .drop(PARTS))
    return salted.join(copies, [key, SALT], how).drop(SALT)


ROW = "__row_number"
LEFT_PARTS, RIGHT_PARTS = "__left_parts", "__right_parts"


def hot_pairs(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys with more than a fair partition's share of the join's rows, and a grid to split each by.

    Both sides are counted per key first, so a key that is repeated on both is seen for what its join will make. There are
    fewer such keys than shuffle partitions, and the grids have at most five times as many cells altogether.
    """
    width = shuffle_width(left)
    known = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__l"))
    others = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__r"))
    pairs = stored(known.join(others, key, "left").withColumn(
        "__pairs", F.col("__l") * F.coalesce("__r", F.lit(1))), "pair_counts")
    total = pairs.agg(F.sum(F.col("__pairs").cast("double"))).first()[0] or 1
    shares = F.col("__pairs") * width / F.lit(total)
    cells = F.ceil(4 * shares)
    # As long as wide: each cell gets about as many rows of one side as of the other.
    long = F.least(cells, F.greatest(F.lit(1), F.ceil(F.sqrt(cells * F.col("__l") / F.col("__r")))))
    return (pairs.where((shares > 1) & F.col("__r").isNotNull())
            .select(key, long.cast("int").alias(LEFT_PARTS), cells.alias("__cells"))
            .select(key, LEFT_PARTS, F.ceil(F.col("__cells") / F.col(LEFT_PARTS)).cast("int")
                    .alias(RIGHT_PARTS)))


def _left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in which keys that are hot together are spread over a grid of tasks.

    A hot key's rows are numbered on both sides when they are written, so that copies of one row part as well; a left
    row goes to one line of the grid, a right row to one column, and each pair meets in one cell. These
    keys have rows on both sides, so theirs is an inner join.
    """
    width = shuffle_width(left)
    salt = F.pmod(spreader(left.columns), F.lit(width)).cast("int")
    hot = stored(hot_pairs(left, right, key), "hot_pairs")

    def plain(some: DataFrame, others: DataFrame) -> DataFrame:
        salted = some.withColumn(SALT, F.when(F.col(key).isNull(), salt).otherwise(F.lit(0)))
        return salted.join(others.withColumn(SALT, F.lit(0)), [key, SALT], "left").drop(SALT)

    if hot.isEmpty():
        return plain(left, right)
    few = F.broadcast(hot)  # fewer keys than partitions
    names = F.broadcast(hot.select(key))
    rest = plain(left.join(names, key, "left_anti"), right.join(names, key, "left_anti"))

    def placed(side: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        numbered = stored(side.join(few, key).withColumn(ROW, F.monotonically_increasing_id()), "hot_rows")
        at = F.pmod(F.xxhash64(ROW), F.col(own)).cast("int")
        # Dealt with a number of partitions, which stays: merged by their few bytes, the cells would meet again.
        return (numbered.withColumn(mine, at)
                .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .drop(ROW, own, other).repartition(width, key, "__line", "__column"))

    lines = placed(left, LEFT_PARTS, RIGHT_PARTS, "__line", "__column")
    columns = placed(right, RIGHT_PARTS, LEFT_PARTS, "__column", "__line")
    met = lines.join(columns, [key, "__line", "__column"]).drop("__line", "__column")
    return rest.unionByName(met)


def left_join_all(left: DataFrame, rights, key: str) -> DataFrame:
    """Left join several large tables on one key, which may repeat on any side.

    Null keys of the left side match nothing; they are spread by row hash so that
    they do not meet in one task. Keys that make a large share of a join's rows are split on both sides.
    """
    joined = left
    for right in rights:
        joined = _left_join(joined, right, key)
    return joined

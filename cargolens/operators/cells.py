"""Ordered work inside keys of any size.

A window partitioned by key alone sorts a whole key in one task. Here the rows are
range-partitioned by (key, order) first, which also cuts a large key into several
pieces ("cells"); windows then run per (key, cell), and what has to cross a cell border
travels through a summary of one row per (key, cell).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cargolens.operators.joins import shuffle_width, spreader
from cargolens.sources.workspace import stored

CELL = "__cell"


def in_cells(df: DataFrame, key: str, order) -> DataFrame:
    """Add the cell number; cells of one key are numbered in `order`.

    The result is written out, since the sampled borders must not move between
    the passes that use them.
    """
    ranged = df.repartitionByRange(shuffle_width(df), key, *order)
    return stored(ranged.withColumn(CELL, F.spark_partition_id()), "cells")


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              payload, tie: str) -> DataFrame:
    """Each left row with the newest right row of its key at or before its time.

    Keeps every left row; `payload` columns are null where nothing is old enough.
    Among right rows of equal time the greatest `tie` wins, and the chosen row is
    kept whole, so null measurements survive.
    """
    row, seen, at, side, tied, rest = "__row", "__seen", "__at", "__side", "__tie", "__rest"
    tie_type = right.schema[tie].dataType
    queries = left.select(
        key, F.col(left_ts).alias(at), F.lit(1).alias(side), F.lit(None).cast(tie_type).alias(tied),
        spreader(left.columns).alias(rest), F.struct(*left.columns).alias(row),
        F.lit(None).cast(right.select(F.struct(*payload)).schema[0].dataType).alias(seen))
    known = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).select(
        key, F.col(right_ts).alias(at), F.lit(0).alias(side), F.col(tie).alias(tied),
        F.lit(0).cast("bigint").alias(rest),
        F.lit(None).cast(queries.schema[row].dataType).alias(row),
        F.struct(*payload).alias(seen))
    merged = in_cells(queries.unionByName(known), key, [at, side, tied, rest])

    newest = F.max_by(seen, F.when(F.col(side) == 0, F.struct(at, tied)))
    before = W.partitionBy(key).orderBy(CELL).rowsBetween(W.unboundedPreceding, -1)
    carried = (merged.groupBy(key, CELL).agg(newest.alias(seen))
               .withColumn(seen, F.last(seen, ignorenulls=True).over(before))
               .where(F.col(seen).isNotNull()).withColumn(side, F.lit(-1)))

    upto = (W.partitionBy(key, CELL).orderBy((F.col(side) == -1).desc(), at, side, tied)
            .rowsBetween(W.unboundedPreceding, 0))
    matched = (merged.drop(rest).unionByName(carried, allowMissingColumns=True)
               .withColumn(seen, F.last(seen, ignorenulls=True).over(upto))
               .where(F.col(side) == 1))
    return matched.select(f"{row}.*", *[F.col(f"{seen}.{c}").alias(c) for c in payload])


def versioned(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Validity interval of each version of a key (type 2 history).

    Adds `valid_from`, `valid_to` (start of the next version, null for the last) and
    `is_current`. Versions of equal time are ordered by `tie`.
    """
    start, border, rest = "__start", "__border", "__rest"
    merged = in_cells(df.withColumn(rest, spreader(df.columns)), key, [ts, tie, rest]).drop(rest)
    next_cell = W.partitionBy(key).orderBy(CELL)
    borders = (merged.groupBy(key, CELL).agg(F.min(F.struct(ts, tie)).alias(start))
               .withColumn(start, F.lead(start).over(next_cell))
               .where(F.col(start).isNotNull()).withColumn(border, F.lit(1)))
    rows = merged.withColumns({start: F.struct(ts, tie), border: F.lit(0)})
    within = W.partitionBy(key, CELL).orderBy(border, start)
    following = F.lead(start).over(within)
    dated = (rows.unionByName(borders, allowMissingColumns=True)
             .withColumn("__next", following).where(F.col(border) == 0))
    return dated.select(*df.columns, F.col(ts).alias("valid_from"),
                        F.col(f"__next.{ts}").alias("valid_to"),
                        F.col("__next").isNull().alias("is_current"))

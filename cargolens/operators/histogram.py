"""Equal-width histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per bin (0-based) between the smallest and the largest value.

    Nulls and NaN are left out, empty bins too; a constant column is bin 0. The value range is
    one struct from a scalar subquery, so there is no join.
    """
    number = F.col(column)
    values = df.where(number.isNotNull() & ~F.isnan(number.cast("double"))).select(column)
    span = values.agg(F.struct(F.min(column).cast("double").alias("lo"),
                               F.max(column).cast("double").alias("hi")).alias("span"))
    placed = values.withColumn("__span", span.scalar())
    lo, hi = F.col("__span.lo"), F.col("__span.hi")
    width = F.nullif((hi - lo) / F.lit(float(bins)), F.lit(0.0))
    index = F.coalesce(F.floor((F.col(column) - lo) / width).cast("int"), F.lit(0))
    return (placed.groupBy(F.least(index, F.lit(bins - 1)).alias("bin"))
            .agg(F.count("*").alias("n")).orderBy("bin"))

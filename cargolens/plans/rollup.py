"""Key figures from a rollup: additive figures per day, and exact distinct customers as bitmaps.

Distinct counts do not add up, so a report over a filter has to look at the shipments again, or at sets that can be
united. Customers get dense numbers; a set of them is one bit per customer in words of 64, of which only those with a
customer are kept, and a union is a bitwise or. So a set takes no more rows than it has members, however many combinations
there are, and a row is narrow enough to be grouped by hashing. Both tables have rows per combination of what can be
filtered by, and the figures one per day as well, so a day that changes is one folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.operators.filters import apply_filters
from cargolens.operators.joins import lookup_join
from cargolens.sources.workspace import stored

CHOICES = ["warehouse_id", "status", "priority", "risk_category"]
MEASURES = {"distance": "distance_km", "hours": "estimated_delivery_hours", "risk": "risk_score",
            "weight": "package_weight_kg"}
DAY = "day"
KEYS = "warehouse_id string, status string, priority string, risk_category string"
FIGURES = (f"{KEYS}, shipments bigint, orders bigint, distance_sum double, distance_n bigint, "
           "hours_sum double, hours_n bigint, risk_sum bigint, risk_n bigint, weight_sum double, "
           "weight_n bigint, high_risk bigint, day date")
WORDS = f"{KEYS}, word bigint, customers bigint"
PLACES = 33  # bits that `monotonically_increasing_id` leaves for the row


def dense_numbers(keys: DataFrame, key: str) -> DataFrame:
    """(key, number) with numbers from 1 on without gaps, for distinct non-null keys.

    Rows are numbered in their partitions and shifted by the rows of the partitions before: what is summed up in
    one place is one count per partition.
    """
    rows = stored(keys.where(F.col(key).isNotNull()).select(key).distinct()
                  .withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", PLACES)
    sizes = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    placed = rows.withColumn("__part", part).join(F.broadcast(shifts), "__part")
    within = F.col("__at").bitwiseAND(F.lit((1 << PLACES) - 1))
    return placed.select(key, (F.col("__shift") + within + 1).alias("number"))


def build(spark: SparkSession, root: str, dp: DataFrame) -> None:
    """Write the rollup of a mart below `root`."""
    sums = [c for name, column in MEASURES.items() for c in (
        F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n"))]
    figures = dp.groupBy(F.to_date("order_date").alias(DAY), *CHOICES).agg(
        F.count("*").alias("shipments"), F.count("order_id").alias("orders"), *sums,
        F.count_if(F.col("risk_category").isin(S.HIGH_RISK)).alias("high_risk"))
    figures.write.mode("overwrite").partitionBy(DAY).parquet(f"{root}/figures")
    numbers = stored(dense_numbers(dp, "customer_id"), "customer_numbers")
    found = dp.where(F.col("customer_id").isNotNull()).select("customer_id", *CHOICES).distinct()
    numbered = lookup_join(found, numbers, "customer_id")
    words = numbered.groupBy(*CHOICES, F.shiftright("number", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(number & 63 as int))")).alias("customers"))
    words.write.mode("overwrite").parquet(f"{root}/customers")


def _mean(name: str):
    return F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0))


def _customers(spark: SparkSession, root: str, filters, warehouses) -> DataFrame:
    words = apply_filters(spark.read.schema(WORDS).parquet(f"{root}/customers"), filters, warehouses)
    united = words.groupBy("word").agg(F.bit_or("customers").alias("customers"))
    return united.agg(F.coalesce(F.sum(F.bit_count("customers")), F.lit(0)).alias("customers"))


def _one_row(*parts: DataFrame) -> DataFrame:
    """One row of all columns of frames that have one row each."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def overview_metrics(spark: SparkSession, root: str, filters=None, warehouses=None) -> DataFrame:
    """As `analytics.overview_metrics`, from the rollup alone."""
    rows = apply_filters(spark.read.schema(FIGURES).parquet(f"{root}/figures"), filters, warehouses)
    depots = rows.select("warehouse_id").distinct().agg(F.count("warehouse_id").alias("warehouses"))
    figures = rows.agg(
        F.coalesce(F.sum("shipments"), F.lit(0)).alias("shipments"),
        _mean("distance").alias("avg_distance"), _mean("hours").alias("avg_delivery"),
        _mean("risk").alias("avg_risk"), _mean("weight").alias("avg_weight"),
        F.coalesce(F.sum("high_risk"), F.lit(0)).alias("high_risk_shipments"))
    return _one_row(figures, _customers(spark, root, filters, warehouses), depots).select(
        "shipments", "customers", "warehouses", "avg_distance", "avg_delivery", "avg_risk", "avg_weight",
        "high_risk_shipments")


def customer_metrics(spark: SparkSession, root: str, filters=None, warehouses=None) -> DataFrame:
    """As `analytics.customer_metrics`, from the rollup alone."""
    rows = apply_filters(spark.read.schema(FIGURES).parquet(f"{root}/figures"), filters, warehouses)
    figures = rows.agg(F.coalesce(F.sum("orders"), F.lit(0)).alias("shipments"),
                       _mean("weight").alias("avg_weight"))
    return _one_row(figures, _customers(spark, root, filters, warehouses)).select(
        "customers", "shipments", "avg_weight")

"""Streamed orders scored with the weather at their time, also when weather comes late.

Every observation holds until the next one of its warehouse. These intervals are kept cut at days, so that an order
finds its interval by an equality of warehouse and day and a test of the range: no history is sorted or shuffled for
a batch of orders. An interval that is still open is not cut; there is one per warehouse. Weather that comes late
changes the intervals of its own warehouses, and of the scored orders only the days and warehouses of new intervals are
scored anew (others of these days get the scores they have).

Observations and intervals lie in folders by a hash of the warehouse, scores in folders by day and batch. Batches of
either kind are numbered from 0; one that runs again replaces what it has filed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens import schemas as S
from cargolens.operators.cells import versioned
from cargolens.operators.joins import lookup_join
from cargolens.operators.latest import latest_per_key
from cargolens.plans import transforms
from cargolens.sources.conform import assert_columns
from cargolens.sources.workspace import stored
from cargolens.streaming.batches import BATCH, is_day, run

BUCKETS = 64
BUCKET = "bucket"
DAY = "day"
SINCE, NOW = "__since", "__now"
MEASURED = ("temperature", "wind_speed")
SCORED = [*S.DELIVERY_RISK.fieldNames(), "created_at"]
SCORES = T.StructType([*S.DELIVERY_RISK.fields, S.ORDERS["created_at"], T.StructField(DAY, T.DateType()),
                       T.StructField(BATCH, T.IntegerType())])
INTERVALS = T.StructType([*(S.WEATHER[c] for c in ("warehouse_id", *MEASURED)),
                          *(T.StructField(c, T.TimestampNTZType()) for c in ("valid_from", "valid_to")),
                          T.StructField(DAY, T.DateType()), T.StructField(BUCKET, T.IntegerType())])


def _bucket() -> Column:
    return F.pmod(F.xxhash64("warehouse_id"), F.lit(BUCKETS)).cast("int")


def _order_day() -> Column:
    """Day of an order; those without a time, which no weather fits, are filed under the first day there is."""
    return F.coalesce(F.to_date("created_at"), F.lit("0001-01-01").cast("date"))


def cut_at_days(intervals: DataFrame) -> DataFrame:
    """A row per interval and day it touches; an open interval stays one row, without a day."""
    days = F.when(F.col("valid_to").isNotNull(),
                  F.sequence(F.to_date("valid_from"), F.to_date("valid_to")))
    return intervals.withColumn(DAY, F.explode_outer(days))


def open_intervals(intervals: DataFrame) -> DataFrame:
    """(warehouse, start, measured values) of the intervals that have no end yet, one per warehouse."""
    return intervals.where(F.col(DAY).isNull()).select(
        "warehouse_id", F.col("valid_from").alias(SINCE), F.struct(*MEASURED).alias(NOW))


def weather_at(orders: DataFrame, intervals: DataFrame, otherwise: str | None = None) -> DataFrame:
    """Orders with the measured values that held when they were created; null where nothing was known.

    Orders of warehouses without any interval take the values in the struct column `otherwise`, if it is named. Orders
    that carry the columns of `open_intervals` already are not joined with them again.
    """
    closed = intervals.where(F.col(DAY).isNotNull()).select(
        F.col("warehouse_id").alias("__w"), F.col(DAY).alias("__d"), F.col("valid_from").alias("__from"),
        F.col("valid_to").alias("__to"), F.struct(*MEASURED).alias("__then"))
    held = ((F.col("warehouse_id") == F.col("__w")) & (F.to_date("created_at") == F.col("__d"))
            & (F.col("created_at") >= F.col("__from")) & (F.col("created_at") < F.col("__to")))
    found = orders.join(closed, held, "left").drop("__w", "__d", "__from", "__to")
    both = found if SINCE in orders.columns else lookup_join(
        found, open_intervals(intervals), "warehouse_id", "left", spread=["order_id"], profile=orders)
    seen = F.when(F.col("created_at") >= F.col(SINCE), F.col(NOW)).otherwise(F.col("__then"))
    if otherwise:  # every warehouse with intervals has an open one
        seen = F.when(F.col(SINCE).isNull(), F.col(otherwise)).otherwise(seen)
    kept = [c for c in orders.columns if c not in (otherwise, SINCE, NOW)]
    return (both.withColumn("__seen", seen)
            .select(*kept, *[F.col("__seen")[c].alias(c) for c in MEASURED]))


class RiskAsOf:
    """The tables of one such job, below `root`. `tie` decides between observations of one time."""

    def __init__(self, spark: SparkSession, root: str, tie: str, null_points: int = 0):
        self.spark, self.root, self.tie, self.null_points = spark, root, tie, null_points
        # Empty folders, so that either side can be read before its first batch.
        for table, schema in (("scores", SCORES), ("intervals", INTERVALS)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{root}/{table}")

    def _write(self, rows: DataFrame, table: str, *parts: str) -> None:
        (rows.hint("rebalance", *parts).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(f"{self.root}/{table}"))

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}")

    def add_weather(self, batch_id: int, weather: DataFrame) -> None:
        """Take observations, and score the orders anew for which they hold."""
        assert_columns(weather, [*S.WEATHER.fieldNames(), self.tie])
        new = stored(weather.where(F.col("warehouse_id").isNotNull() & F.col("timestamp").isNotNull())
                     .select("warehouse_id", "timestamp", self.tie, *MEASURED), "weather")
        known = new
        if batch_id:
            # At most `BUCKETS` numbers.
            touched = [r[0] for r in new.select(_bucket()).distinct().collect()]
            known = self._read("observations").where(F.col(BUCKET).isin(touched)).drop(BUCKET).unionByName(new)
        rest = [self.tie, *MEASURED]
        known = stored(latest_per_key(known, ["warehouse_id", "timestamp"], rest), "observations")
        held = stored(versioned(known, "warehouse_id", "timestamp", self.tie).select(
            "warehouse_id", *MEASURED, "valid_from", "valid_to"), "intervals")
        self._write(known.withColumn(BUCKET, _bucket()), "observations", BUCKET)
        self._write(cut_at_days(held).withColumn(BUCKET, _bucket()), "intervals", BUCKET)
        mine = new.select("warehouse_id", F.col("timestamp").alias("valid_from")).distinct()
        self._score_again(held, held.join(mine, ["warehouse_id", "valid_from"], "left_semi"))

    def _score_again(self, held: DataFrame, changed: DataFrame) -> None:
        """Score the orders of the days of `changed` intervals anew, for their warehouses; `held` are all of these."""
        # From the listing alone: files of other days are not to be opened.
        if not any(f"/{DAY}=" in file for file in self._scores().inputFiles()):
            return
        cut = stored(cut_at_days(changed).select("warehouse_id", "valid_from", DAY), "changed")
        # Days are few whatever the data size: all of the calendar's are 3.7 million dates.
        days = [r[0] for r in cut.where(F.col(DAY).isNotNull()).select(DAY).distinct().collect()]
        within = is_day(DAY, days)
        since = cut.where(F.col(DAY).isNull()).agg(F.to_date(F.min("valid_from"))).first()[0]
        if since is not None:  # an open interval reaches all later days
            within |= F.col(DAY) >= F.lit(since.isoformat()).cast("date")
        standing = self._scores().where(within)
        if standing.isEmpty():
            return
        # One pass: a warehouse that `held` does not know keeps its scores, one whose intervals stay gets the same again.
        orders = standing.withColumnRenamed(DAY, "__day").withColumn("__was", F.struct(*MEASURED)).drop(
            *MEASURED, "risk_score", "risk_level")
        intervals = cut_at_days(held).where(F.col(DAY).isNull() | within)
        seen = weather_at(orders, intervals, otherwise="__was")
        again = transforms.with_risk(seen, self.null_points)
        rows = again.withColumnRenamed("__day", DAY).select(*standing.columns)
        # Written first, since the folders that are replaced are read for it.
        self._write(stored(rows, "scores"), "scores", DAY, BATCH)

    def add_orders(self, batch_id: int, orders: DataFrame, customers: DataFrame,
                   warehouses: DataFrame) -> None:
        """Route a batch of orders and score it with the weather that is known by now."""
        assert_columns(orders, S.STG_ORDERS)
        intervals = self.spark.read.schema(INTERVALS).parquet(f"{self.root}/intervals")
        # The open intervals come in with the warehouses, so that the orders are not moved for them once more.
        stations = stored(warehouses.select("warehouse_id", "latitude", "longitude").join(
            open_intervals(intervals), "warehouse_id", "left"), "stations")
        routes = transforms.build_routes(orders, customers, stations, carry=["created_at"], keep=[SINCE, NOW])
        observed = weather_at(routes, intervals)
        scored = transforms.with_risk(observed, self.null_points).select(*SCORED)
        self._write(scored.withColumns({DAY: _order_day(), BATCH: F.lit(batch_id)}), "scores", DAY, BATCH)

    def run_orders(self, orders: DataFrame, checkpoint: str, customers: DataFrame,
                   warehouses: DataFrame) -> None:
        """`add_orders` for every batch of a stream."""
        run(orders, checkpoint, lambda batch, number: self.add_orders(number, batch, customers, warehouses))

    def run_weather(self, weather: DataFrame, checkpoint: str) -> None:
        """`add_weather` for every batch of a stream."""
        run(weather, checkpoint, lambda batch, number: self.add_weather(number, batch))

    def _scores(self) -> DataFrame:
        return self.spark.read.schema(SCORES).parquet(f"{self.root}/scores")

    def read(self) -> DataFrame:
        return self._scores().select(*S.DELIVERY_RISK.fieldNames())

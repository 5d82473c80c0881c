"""Streaming jobs: daily counts, duplicate removal, risk scoring, mart refresh.

Every job reads what is available and stops (`availableNow`), so it can be scheduled
or run continuously by changing the trigger. Results go to Parquet folders named
by batch, which a repeated batch overwrites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens import schemas as S
from cargolens.operators.latest import first_per_key, latest_per_key
from cargolens.plans import marts, transforms
from cargolens.sources.conform import assert_columns
from cargolens.sources.workspace import stored
from cargolens.streaming.batches import BATCH, batch_folder, is_day, readable, run
from cargolens.streaming.ledger import Ledger

DAY = "order_day"
GONE = "moved_away"

COUNTS = "date date, shipments bigint"


def run_timeline(orders: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Count the shipments of a stream per day below `path` and read the counts back.

    Counts are additive, so each batch writes its own and reading adds them up: no state, no
    watermark, and orders that are late or have no day (a null day) count like all others.
    """
    assert_columns(orders, ["created_at"])

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = (batch.groupBy(F.to_date("created_at").alias("date"))
                  .agg(F.count("*").alias("shipments")))
        counts.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    run(orders, checkpoint, write)
    return read_timeline(orders.sparkSession, path)


def read_timeline(spark, path: str) -> DataFrame:
    return (readable(spark, path, COUNTS).groupBy("date")
            .agg(F.sum("shipments").alias("shipments")))


ORDER_ID = S.ORDERS["order_id"]


def run_dedupe(orders: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Write each order of a stream once, when it first arrives, and read all back.

    Of several orders with one id in a batch the first in time stays, of these the least by its other columns, and ids that
    earlier batches filed are dropped. These are looked up in a ledger next to the results, of which only the
    hash folders of the batch's own ids are opened. However late a repeat comes, it is recognised. Orders without id
    cannot be repeats and stay.
    """
    spark = orders.sparkSession
    assert_columns(orders, S.STG_ORDERS)
    readable(spark, path, orders.schema)
    # Readers of the results pass over names that begin with an underscore.
    ids = Ledger(spark, f"{path}/_ids", ORDER_ID, T.StructField("known", T.BooleanType()))

    def write(batch: DataFrame, batch_id: int) -> None:
        taken = stored(batch, "batch")
        named = first_per_key(taken.where(F.col("order_id").isNotNull()), "order_id", "created_at")
        earlier = ids.before(batch_id, taken.where(F.col("order_id").isNotNull())
                             .select("order_id").distinct())
        new = named.join(earlier, "order_id", "left_anti")
        kept = new.unionByName(taken.where(F.col("order_id").isNull())).select(*orders.columns)
        folder = batch_folder(path, batch_id)
        kept.write.mode("overwrite").parquet(folder)
        filed = spark.read.schema(orders.schema).parquet(folder).where(F.col("order_id").isNotNull())
        ids.add(batch_id, filed.select("order_id", F.lit(True).alias("known")))

    run(orders, checkpoint, write)
    return spark.read.schema(orders.schema).parquet(path).select(*orders.columns)


def run_risk(orders: DataFrame, customers: DataFrame, warehouses: DataFrame, latest: DataFrame,
             path: str, checkpoint: str, null_points: int = 0) -> DataFrame:
    """Route and score a stream of orders batch by batch, with the batch operators."""
    assert_columns(orders, S.STG_ORDERS)

    def score(batch: DataFrame, batch_id: int) -> None:
        routes = transforms.build_routes(batch, customers, warehouses)
        risk = transforms.build_delivery_risk(routes, latest, null_points, profile=batch)
        risk.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    run(orders, checkpoint, score)
    return readable(orders.sparkSession, path, S.DELIVERY_RISK).drop(BATCH)


def _day(column: str) -> Column:
    """Day of a time stamp; orders without one are filed under the first day there is."""
    return F.coalesce(F.to_date(column), F.lit("0001-01-01").cast("date"))


def refresh_mart(batch: DataFrame, batch_id: int, root: str, customers: DataFrame,
                 warehouses: DataFrame, latest: DataFrame) -> None:
    """Take a batch of orders into the mart; only the days it touches are read and rewritten.

    Of several versions of an order in the batch the latest in time counts, and it replaces the one filed before;
    orders without an id are all kept. The orders of a day are one folder, without earlier versions. A ledger
    names the day under which an id was filed, so an order that moves is taken out of its old day: the batch costs the
    days of its orders, before and now, and the ledger's folders of its ids. Batches are numbered from 0 without gaps. One
    that runs again replaces what it has filed.
    """
    spark = batch.sparkSession
    assert_columns(batch, S.STG_ORDERS)
    filed, mart = f"{root}/orders_by_day", f"{root}/mart"
    days = Ledger(spark, f"{root}/_days", ORDER_ID, T.StructField(DAY, T.DateType()))
    rest = [c for c in batch.columns if c not in ("order_id", "created_at")]
    named = latest_per_key(batch.where(F.col("order_id").isNotNull()), "order_id",
                           ["created_at", *rest])
    new = stored(named.unionByName(batch.where(F.col("order_id").isNull())).withColumns(
        {GONE: F.lit(False), BATCH: F.lit(batch_id), DAY: _day("created_at")}), "batch")
    ids = new.where(F.col("order_id").isNotNull()).select("order_id")
    before = days.before(batch_id, ids)
    # Days are few whatever the data size: all of the calendar's are 3.7 million dates.
    touched = [r[0] for r in before.select(DAY).union(new.select(DAY)).distinct().collect()]

    def rewrite(rows: DataFrame, path: str) -> None:
        (rows.hint("rebalance", DAY).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path))

    # An empty folder makes the path readable before the first batch.
    if not batch_id:
        rewrite(new.where("false"), filed)
    standing = (spark.read.schema(new.schema).parquet(filed)
                .where(is_day(DAY, touched) & ~F.col(GONE) & (F.col(BATCH) != batch_id))
                .join(ids, "order_id", "left_anti"))
    current = stored(standing.select(*new.columns).unionByName(new), "current")
    # A day that all its orders left keeps one marked row, which readers drop: nothing else would
    # overwrite what stands there.
    left = spark.createDataFrame([(d,) for d in touched], T.StructType([new.schema[DAY]])).join(
        current.select(DAY).distinct(), DAY, "left_anti")
    marks = left.withColumns({GONE: F.lit(True), BATCH: F.lit(batch_id)})
    orders = current.select(*batch.columns)
    if marts.keys_are_sound((customers, "customer_id"), (warehouses, "warehouse_id")):
        wide = marts.performance_from_keys(orders, customers, warehouses, latest)
    else:
        wide = marts.build_performance(orders, customers, warehouses, latest)
    rows = wide.withColumns({DAY: _day("order_date"), GONE: F.lit(False)})
    rewrite(rows.unionByName(marks.drop(BATCH), allowMissingColumns=True), mart)
    rewrite(current.unionByName(marks, allowMissingColumns=True), filed)
    days.add(batch_id, new.where(F.col("order_id").isNotNull()).select("order_id", DAY))


def read_mart(spark, root: str) -> DataFrame:
    """The refreshed mart."""
    mart = spark.read.parquet(f"{root}/mart")
    return mart.where(~F.col(GONE)).select(*marts.PERFORMANCE)


def run_mart(orders: DataFrame, root: str, checkpoint: str, customers: DataFrame,
             warehouses: DataFrame, latest: DataFrame) -> DataFrame:
    """Refresh the mart from a stream of orders and read it back."""
    def take(batch: DataFrame, batch_id: int) -> None:
        refresh_mart(batch, batch_id, root, customers, warehouses, latest)

    run(orders, checkpoint, take)
    return read_mart(orders.sparkSession, root)

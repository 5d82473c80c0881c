"""Full rebuild of the lake and the marts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.operators.latest import latest_per_key
from cargolens.plans import marts, transforms
from cargolens.sources import lake
from cargolens.sources.conform import assert_columns
from cargolens.sources.workspace import stored
from cargolens.streaming import ingest

MARTS = ("dim_customers", "fact_shipments", "delivery_performance")


def mart_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/marts/{name}"


def newest_orders(orders: DataFrame) -> DataFrame:
    """One row per order id, the one of the latest time; orders without id stay as they are.

    Ids are counted first. Only orders whose id repeats are reduced, so clean input is not shuffled but for its ids.
    """
    repeated = stored(orders.where(F.col("order_id").isNotNull()).groupBy("order_id")
                      .agg(F.count("*").alias("n")).where(F.col("n") > 1).select("order_id"),
                      "repeated_ids")
    if repeated.isEmpty():
        return orders
    order = ["created_at", *(c for c in orders.columns if c not in ("order_id", "created_at"))]
    newest = latest_per_key(orders.join(repeated, "order_id", "left_semi"), "order_id", order)
    return orders.join(repeated, "order_id", "left_anti").unionByName(newest)


def build_all(spark: SparkSession, root: str, sources: dict[str, DataFrame],
              null_points: int = 0, weather_tie: str | None = None) -> DataFrame:
    """Write silver, gold and mart tables below `root`, replacing what is there.

    `sources` holds typed customers, warehouses, weather and orders; `weather_tie` is a
    weather column that decides between equal time stamps. Tables of the lake are written in the columns
    and types that `lake.TABLES` declares, and of orders with one id only the newest is kept, orders
    without id all. Every stage reads the files of the stage before, so a lost executor never
    reaches further back, and a run that is repeated leaves the same tables. Returns the row audit.

    With sound keys the wide mart is computed once and routes, risk and fact are
    projections of it; otherwise each table is built by its own joins.
    """
    for name, needed in S.REQUIRED.items():
        assert_columns(sources[name], needed)
    steps = []

    def together(tasks: dict) -> dict:
        """Independent tables at the same time, so that one's last tasks leave no core idle."""
        with ThreadPoolExecutor(len(tasks)) as pool:
            running = {name: pool.submit(inheritable_thread_target(spark)(write), name, *task)
                       for name, task in tasks.items()}
            return {name: job.result() for name, job in running.items()}

    def write(name: str, layer: str, df: DataFrame) -> DataFrame:
        path = mart_path(root, name) if layer == "mart" else lake.table_path(root, name)
        df = df if layer == "mart" else lake.declared(df, name)
        rows = lake.save(df, path)
        steps.append((name, layer, path, rows))
        return spark.read.schema(df.schema).parquet(path)

    sources = sources | {"orders": newest_orders(sources["orders"])}
    silver = together({name: ("silver", sources[name])
                       for name, (layer, _) in lake.TABLES.items() if layer == "silver"})
    latest_path = f"{root.rstrip('/')}/gold/latest_weather"
    # The tie column is no column of the table, so this looks at the source itself.
    latest = transforms.latest_weather(sources["weather"], weather_tie)
    lake.save(latest, latest_path)
    latest = spark.read.schema(latest.schema).parquet(latest_path)

    orders, customers, warehouses = (silver[n] for n in ("orders", "customers", "warehouses"))
    dimension = {"dim_customers": ("mart", marts.dim_customers(customers))}
    # After `newest_orders` an order id can only be missing.
    if marts.keys_are_sound((customers, "customer_id"), (warehouses, "warehouse_id"),
                            unique=[(orders, "order_id")]):
        wide = write("delivery_performance", "mart", marts.performance_from_keys(
            orders, customers, warehouses, latest, null_points))
        together({"routes": ("gold", marts.routes_of(wide)),
                  "delivery_risk": ("gold", marts.risk_of(wide)),
                  "fact_shipments": ("mart", wide.select(*marts.FACT)), **dimension})
    else:
        built = together({
            "routes": ("gold", transforms.build_routes(orders, customers, warehouses)),
            "fact_shipments": ("mart", marts.fact_shipments(orders, customers)), **dimension})
        routes, fact = built["routes"], built["fact_shipments"]
        risk = write("delivery_risk", "gold",
                     transforms.build_delivery_risk(routes, latest, null_points))
        write("delivery_performance", "mart", marts.delivery_performance(fact, routes, risk))
    return lake.audit(spark, sorted(steps))


def build_from_bronze(spark: SparkSession, root: str, landing: str, warehouses: DataFrame,
                      orders: DataFrame, multi_line: bool = False, on_error: str = "fail",
                      null_points: int = 0) -> DataFrame:
    """Take newly landed customers and weather into silver and rebuild everything from there.

    What was taken, what was rejected and the log of files are kept below `root`, so the next run opens only files
    that have landed since. Returns the row audit.
    """
    store = f"{root.rstrip('/')}/bronze"
    for feed in (ingest.CUSTOMERS, ingest.WEATHER):
        ingest.ingest(spark, feed, landing, store, f"{store}/_log_{feed.name}", multi_line, on_error)
    sources = {"customers": ingest.silver_customers(spark, store), "warehouses": warehouses,
               "weather": ingest.silver_weather(spark, store), "orders": orders}
    return build_all(spark, root, sources, null_points)


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    if name not in MARTS:
        raise KeyError(f"Unknown mart: {name!r}")
    return spark.read.parquet(mart_path(root, name))


def load_catalog(spark: SparkSession, root: str, database: str | None = None) -> DataFrame:
    """Load every lake table into the catalog, replacing earlier loads; returns the audit."""
    steps = []
    for name, (layer, _) in lake.TABLES.items():
        path = lake.table_path(root, name)
        steps.append((name, layer, path, lake.load_table(spark, name, path, database)))
    return lake.audit(spark, steps)

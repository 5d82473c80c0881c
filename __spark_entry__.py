"""Entry points of the driver: the registered queries and their SQL counterparts."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import entry_sql
from cargolens import schemas as S
from cargolens import testbed
from cargolens.functions import text
from cargolens.operators import cells, filters, latest
from cargolens.plans import analytics, build, marts, quality, rollup, transforms
from cargolens.plans.quality_state import CheckState
from cargolens.operators.joins import lookup_join
from cargolens.sources import bronze, conform, lake, reference
from cargolens.sources.workspace import fresh_path, stored
from cargolens.streaming import asof, history, ingest, shipments

try:
    import corpus_pipeline
    from cargolens.llm import entry as text_entry
except ModuleNotFoundError as missing:  # the text operators may be left out
    if missing.name not in ("corpus_pipeline", "cargolens.llm"):
        raise
    corpus_pipeline = text_entry = None

SMOKE_DIR = "/root/testdata/sf0.001"


# (application, data folder, state of its files, table) -> the written table
_WRITTEN: dict[tuple, DataFrame] = {}
_ROLLUPS: dict[tuple, str] = {}


class Tables:
    """The shipment tables of one data folder.

    Orders, weather and everything derived in a query are lazy views. Dimensions,
    the latest weather and the wide mart are tables: the first query that needs one
    writes it, later ones read it until the data files change.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def files_state(self) -> tuple:
        """Number and checksum of the data files, from the file listing alone."""
        listing = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                   .load([f"{self.sf_dir}/{t}.parquet" for t in testbed.BASE]))
        checksum = F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))
        return tuple(listing.agg(F.count("*"), checksum).first())

    def written(self, name: str, table: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.conf.get("spark.app.id"), self.sf_dir, self.files_state, name)
        if key not in _WRITTEN:
            _WRITTEN[key] = stored(table(), name)
        return _WRITTEN[key]

    def view(self, name: str, **replaced: DataFrame) -> DataFrame:
        return testbed.view(self.spark, self.sf_dir, name, **replaced)

    @property
    def orders(self) -> DataFrame:
        return self.view("ship_orders")

    @property
    def weather(self) -> DataFrame:
        return self.view("weather")

    @property
    def customers(self) -> DataFrame:
        return self.written("customers", lambda: self.view("customers"))

    @property
    def warehouses(self) -> DataFrame:
        return self.written("warehouses", lambda: self.view("warehouses"))

    @property
    def latest(self) -> DataFrame:
        return self.written("latest_weather", lambda: transforms.latest_weather(
            self.weather, tie="event_id"))

    @property
    def performance(self) -> DataFrame:
        return self.written("delivery_performance", lambda: marts.build_performance(
            self.orders, self.customers, self.warehouses, self.latest))

    @property
    def routes(self) -> DataFrame:
        return transforms.build_routes(self.orders, self.customers, self.warehouses)

    def risk(self, null_points: int = 0) -> DataFrame:
        return transforms.build_delivery_risk(self.routes, self.latest, null_points,
                                              profile=self.orders)

    @property
    def rollup(self) -> str:
        """Folder of the mart's rollup, built by the first query that needs it."""
        key = (self.spark.conf.get("spark.app.id"), self.sf_dir, self.files_state, "rollup")
        if key not in _ROLLUPS:
            path = fresh_path(self.spark, "rollup")
            rollup.build(self.spark, path, self.performance)
            _ROLLUPS[key] = path
        return _ROLLUPS[key]

    def stream(self, view: str) -> DataFrame:
        """A view over the orders files read as a stream.

        The path is a glob because a plain one would have to be a folder.
        """
        base = testbed.base_table(self.spark, self.sf_dir, "orders")
        files = f"{self.sf_dir}/orders.parque[t]"
        source = self.spark.readStream.schema(base.schema).parquet(files)
        return self.view(view, orders=source)


# Measured or already rounded values: equal in both engines as they are.
EXACT = {"latitude", "longitude", "package_weight_kg", "temperature", "wind_speed", "distance_km",
         "estimated_hours", "estimated_delivery_hours", "min_km", "max_km", "min_hours",
         "max_hours"}


def _comparable(df: DataFrame) -> DataFrame:
    """Averages and ratios to 4 decimals, exact ties upwards (see `entry_sql`)."""
    computed = {f.name for f in df.schema if f.dataType == T.DoubleType()} - EXACT
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 4) for c in computed}) if computed else df


# --- queries that need more than one call --------------------------------


def _customer_labels(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", text.full_name("first_name", "last_name").alias("full_name"),
        text.email_address(F.col("first_name"), F.col("last_name")).alias("email"),
        text.country_prefix(F.col("country")).alias("nationality"),
        text.coordinate(F.col("latitude")).alias("latitude"),
        text.coordinate(F.col("longitude")).alias("longitude"))


def _conformed(t: Tables) -> tuple[DataFrame, DataFrame]:
    return conform.split_rejects(t.view("raw_customers"), S.CUSTOMERS)


def _conform_rejects(t: Tables) -> DataFrame:
    return _conformed(t)[1].select("customer_id", F.array_join("reject_reason", ",")
                                   .alias("reject_reason"))


def _bronze_replay(t: Tables) -> DataFrame:
    landing = fresh_path(t.spark, "bronze")
    path = bronze.land_customers(t.view("raw_customers"), landing, "20260102_030405_000006")
    replayed = bronze.replay_customers(t.spark, path)
    return conform.split_rejects(replayed, S.CUSTOMERS)[0]


def _bronze_rejects(t: Tables) -> DataFrame:
    """Landed documents of which some are cut off and some have no results."""
    landing = f"{fresh_path(t.spark, 'bronze')}/customers_20260102_030405_000006"
    number = F.col("c_custkey") % 13
    document = F.concat(F.lit('{"results": [{"customer_id": "CUST-'), F.col("c_custkey"), F.lit('"}]'))
    text = (F.when(number == 0, document)
            .when(number == 1, F.concat(F.lit('{"info": {"seed": "CUST-'), F.col("c_custkey"), F.lit('"}}')))
            .otherwise(F.concat(document, F.lit("}"))))
    testbed.base_table(t.spark, t.sf_dir, "customer").select(text.alias("value")).write.text(landing)
    rejects = bronze.customer_rejects(t.spark, landing)
    found = F.regexp_extract(F.coalesce("record", "document"), "CUST-[0-9]+", 0)
    return rejects.select("reason", found.alias("customer_id"))


def _distance_histogram_nan(t: Tables) -> DataFrame:
    """Distances of low risk turned into NaN are left out like nulls."""
    low = F.coalesce(F.col("risk_category") == "LOW", F.lit(True))
    spoilt = t.performance.withColumn("distance_km", F.when(low, F.lit(float("nan")))
                                      .otherwise(F.col("distance_km")))
    return analytics.distance_histogram(spoilt, None, t.warehouses)


def _bronze_weather(t: Tables) -> DataFrame:
    landing = fresh_path(t.spark, "bronze")
    records = t.weather.select(*S.WEATHER.fieldNames())
    path = bronze.land_weather(records, landing, "20260102_030405")
    return bronze.replay_weather(t.spark, path)


def _weather_history(t: Tables) -> DataFrame:
    """Two landings, where the second corrects the wind speed of part of the records."""
    landing = fresh_path(t.spark, "bronze")
    records = t.weather.select(*S.WEATHER.fieldNames())
    corrected = records.where("temperature > 20").withColumn("wind_speed", F.lit(0.0))
    paths = [bronze.land_weather(records, landing, "20260102_030405"),
             bronze.land_weather(corrected, landing, "20260103_030405_000001")]
    return bronze.weather_history(bronze.replay_weather(t.spark, paths))


def _number(column: str) -> str:
    """SQL for the number in ids such as CUST-17."""
    return f"cast(substring_index({column}, '-', -1) as bigint)"


def _bronze_to_mart(t: Tables) -> DataFrame:
    """Two landings, each read once: all customers and weather, then corrected and moved customers."""
    landing, root = fresh_path(t.spark, "landing"), fresh_path(t.spark, "lake")
    raw, number = t.view("raw_customers"), F.expr(_number("customer_id"))
    bronze.land_customers(raw, landing, "20260102_030405_000006")
    bronze.land_weather(t.weather.select(*S.WEATHER.fieldNames()), landing, "20260102_030405")
    for feed in (ingest.CUSTOMERS, ingest.WEATHER):
        ingest.ingest(t.spark, feed, landing, f"{root}/bronze", f"{root}/bronze/_log_{feed.name}",
                      on_error="skip")
    again = raw.where((number % 97 == 0) | (number % 5 == 0)).withColumns({
        "latitude": F.when(number % 97 == 0, "10.5").otherwise(F.col("latitude")),
        "city": F.when(number % 5 == 0, "CITY_NEW").otherwise(F.col("city"))})
    bronze.land_customers(again, landing, "20260103_000000")
    build.build_from_bronze(t.spark, root, landing, t.warehouses, t.orders, on_error="skip")
    return build.read_mart(t.spark, root, "delivery_performance")


def _conform_types(t: Tables) -> DataFrame:
    """Records whose fields hold values of other JSON types: typed where they fit, with reasons where not."""
    judged = conform.judged_records(t.view("typed_records").select(
        F.parse_json("document").alias("record")), S.CUSTOMERS)
    return judged.select("typed.customer_id", "typed.first_name", "typed.street_number",
                         "typed.latitude", F.array_join("reject_reason", ",").alias("reject_reason"))


def _reference_routes(t: Tables) -> DataFrame:
    """Orders from the four reference warehouses to customers in the reference cities."""
    number = F.expr(_number("customer_id"))
    names = F.array(*[F.lit(row[0]) for row in reference.CITIES])
    towns = reference.cities(t.spark).select("city", "latitude", "longitude")
    people = lookup_join(t.customers.select("customer_id", F.element_at(
        names, (number % len(reference.CITIES) + 1).cast("int")).alias("city")), towns, "city")
    depots = reference.reference_warehouses(t.spark)
    depot = F.concat(F.lit("WH-00"), F.expr(_number("order_id")) % len(reference.WAREHOUSES) + 1)
    return transforms.build_routes(t.orders.withColumn("warehouse_id", depot), people, depots)


def _flatten_weather(t: Tables) -> DataFrame:
    answer = F.struct("temperature", F.col("wind_speed").alias("windspeed")).alias("current_weather")
    return bronze.flatten_weather(t.weather.select(
        "warehouse_id", F.col("timestamp").cast("string").alias("timestamp"), answer))


def _catalog_load(t: Tables) -> DataFrame:
    """The catalog table after a second load has replaced the first."""
    path, database = fresh_path(t.spark, "customers"), "cargolens_loads"
    lake.save(lake.declared(t.customers, "customers"), path)
    t.spark.sql(f"create database if not exists {database} location '{fresh_path(t.spark, 'catalog')}'")
    loaded = 0
    for _ in range(2):
        loaded = lake.load_table(t.spark, "customers", path, database)
    return t.spark.table(f"{database}.customers").select(
        "customer_id", "city", "latitude", F.lit(loaded).cast("bigint").alias("loaded"))


def _dirty_tables(t: Tables) -> dict[str, DataFrame]:
    orders = t.view("orders_dirty")
    fact = stored(marts.fact_shipments(orders, t.customers), "dirty_fact")
    dp = marts.build_performance(orders, t.customers, t.warehouses, t.latest)
    return {"customers": t.customers, "warehouses": t.warehouses, "orders": orders,
            "fact_shipments": fact,
            "dim_customers": marts.dim_customers(t.customers),
            "delivery_performance": stored(dp, "dirty_performance")}


def _clean_tables(t: Tables) -> dict[str, DataFrame]:
    return {"customers": t.customers, "warehouses": t.warehouses, "orders": t.orders,
            "dim_customers": marts.dim_customers(t.customers),
            "fact_shipments": t.written("fact_shipments", lambda: marts.fact_shipments(
                t.orders, t.customers)),
            "delivery_performance": t.performance}


def _joined_performance(t: Tables) -> DataFrame:
    routes = stored(t.routes, "routes")
    return marts.delivery_performance(marts.fact_shipments(t.orders, t.customers), routes,
                                      transforms.build_delivery_risk(routes, t.latest))


def _dq_incremental(t: Tables, tables: dict[str, DataFrame]) -> DataFrame:
    """The marts in three batches, shipments before most of their customers."""
    state = CheckState(t.spark, fresh_path(t.spark, "checks"), quality.mart_checks(),
                       {"fact_shipments": "order_date", "delivery_performance": "order_date"})
    keys = {"delivery_performance": "order_id", "fact_shipments": "order_id", "dim_customers": "customer_id"}
    for number in range(3):
        state.add(number, {name: tables[name].where(
            (F.coalesce(F.crc32(F.col(key).cast("binary")), F.lit(0)) + shift) % 3 == number)
            for shift, (name, key) in enumerate(keys.items())})
    return state.results()


def _dq_orphans(t: Tables) -> DataFrame:
    check = quality.Check("orders", "customer_id", "relationships",
                          parent=("customers", "customer_id"))
    return quality.failing_rows({"orders": t.view("orders_orphaned"), "customers": t.customers},
                                check)


def _dq_failing_status(t: Tables) -> DataFrame:
    check = quality.Check("orders", "status", "accepted_values", values=tuple(S.STATUSES))
    return quality.failing_rows({"orders": t.view("orders_dirty")}, check)


def _build(t: Tables, root: str, orders: str = "ship_orders") -> DataFrame:
    sources = {"customers": t.customers, "warehouses": t.warehouses,
               "weather": t.weather, "orders": t.view(orders)}
    return build.build_all(t.spark, root, sources, weather_tie="event_id")


def _load_audit(t: Tables) -> DataFrame:
    return _build(t, fresh_path(t.spark, "lake")).select("table_name", "layer", "rows")


def _rebuild(t: Tables, orders: str = "ship_orders") -> DataFrame:
    """The mart as the full rebuild writes it."""
    root = fresh_path(t.spark, "lake")
    _build(t, root, orders)
    return build.read_mart(t.spark, root, "delivery_performance")


def _asof(t: Tables) -> DataFrame:
    orders = t.orders.select("order_id", "warehouse_id", "created_at")
    return cells.asof_join(orders, t.weather, "warehouse_id", "created_at", "timestamp",
                           ["temperature", "wind_speed"], tie="event_id")


def _risk_asof(t: Tables, orders: str) -> DataFrame:
    routes = transforms.build_routes(t.view(orders), t.customers, t.warehouses,
                                     carry=["created_at"])
    return transforms.build_delivery_risk_asof(routes, t.weather, tie="event_id")


def _customer_scd(t: Tables) -> DataFrame:
    history = cells.versioned(t.view("customer_versions"), "customer_id", "changed_at",
                              "version_id")
    return history.drop("changed_at")


def _customer_scd_merge(t: Tables) -> DataFrame:
    """The versions of customers in three batches that interleave in time, the middle ones last."""
    path, versions = fresh_path(t.spark, "history"), t.view("customer_versions")
    for number, part in enumerate((2, 0, 1)):
        history.merge_versions(t.spark, path, number, versions.where(F.col("version_id") % 3 == part),
                               "customer_id", "changed_at", "version_id")
    return history.read_history(t.spark, path).drop("changed_at")


def _stream_risk_asof(t: Tables) -> DataFrame:
    """Part of the weather, all orders as a stream, then the weather that comes late."""
    root, checkpoint = _stream_paths(t, "risk_asof")
    job = asof.RiskAsOf(t.spark, root, tie="event_id")
    late = F.col("event_id") % 3 == 0
    job.add_weather(0, t.weather.where(~late))
    job.run_orders(t.stream("ship_orders"), checkpoint, t.customers, t.warehouses)
    job.add_weather(1, t.weather.where(late))
    return job.read()


def _stream_paths(t: Tables, name: str) -> tuple[str, str]:
    return fresh_path(t.spark, name), fresh_path(t.spark, f"{name}-checkpoint")


def _stream_timeline(t: Tables, orders: str = "ship_orders") -> DataFrame:
    return shipments.run_timeline(t.stream(orders), *_stream_paths(t, "timeline"))


def _stream_dedupe(t: Tables, orders: str = "orders_repeated") -> DataFrame:
    return shipments.run_dedupe(t.stream(orders), *_stream_paths(t, "dedupe"))


def _stream_risk(t: Tables) -> DataFrame:
    path, checkpoint = _stream_paths(t, "risk")
    return shipments.run_risk(t.stream("ship_orders"), t.customers, t.warehouses, t.latest,
                              path, checkpoint)


def _incremental_mart(t: Tables) -> DataFrame:
    root, checkpoint = _stream_paths(t, "mart")
    return shipments.run_mart(t.stream("ship_orders"), root, checkpoint, t.customers,
                              t.warehouses, t.latest)


def _incremental_mart_moved(t: Tables) -> DataFrame:
    """All orders in a first batch; in a second every 5th moves by three days and is delivered."""
    root = fresh_path(t.spark, "mart")
    moved = (t.orders.where("cast(substring(order_id, 5) as bigint) % 5 = 0")
             .withColumns({"created_at": F.expr("created_at + interval 3 days"),
                           "status": F.lit("delivered")}))
    for number, batch in enumerate((t.orders, moved)):
        shipments.refresh_mart(batch, number, root, t.customers, t.warehouses, t.latest)
    return shipments.read_mart(t.spark, root)


def _incremental_mart_day(t: Tables) -> DataFrame:
    """All orders in a first batch; in a second those of the fourth day are delivered."""
    root = fresh_path(t.spark, "mart")
    day = t.orders.agg(F.date_add(F.to_date(F.min("created_at")), 3)).first()[0]
    delivered = t.orders.where(F.to_date("created_at") == F.lit(day)).withColumn(
        "status", F.lit("delivered"))
    for number, batch in enumerate((t.orders, delivered)):
        shipments.refresh_mart(batch, number, root, t.customers, t.warehouses, t.latest)
    return shipments.read_mart(t.spark, root)


SOME = entry_sql.SOME_FILTERS
NOTHING = entry_sql.NO_MATCH


def _on_mart(report: Callable) -> Callable[[Tables, dict | None], DataFrame]:
    return lambda t, chosen: report(t.performance, chosen, t.warehouses)


def _with_warehouses(report: Callable) -> Callable[[Tables, dict | None], DataFrame]:
    return lambda t, chosen: report(t.performance, t.warehouses, chosen)


def _with_customers(report: Callable) -> Callable[[Tables, dict | None], DataFrame]:
    return lambda t, chosen: report(t.performance, marts.dim_customers(t.customers), chosen,
                                    t.warehouses)


# Reports that take the row filter; each is registered plain and as `<name>_filtered`.
REPORTS: dict[str, Callable[[Tables, dict | None], DataFrame]] = {
    "overview_metrics": _on_mart(analytics.overview_metrics),
    "shipment_status": _on_mart(analytics.shipment_status),
    "priority_distribution": _on_mart(analytics.priority_distribution),
    "shipment_timeline": _on_mart(analytics.shipment_timeline),
    "risk_summary": _on_mart(analytics.risk_summary),
    "package_sizes": _on_mart(analytics.package_sizes),
    "warehouse_performance": _with_warehouses(analytics.warehouse_performance),
    "warehouse_metrics": _on_mart(analytics.warehouse_metrics),
    "capacity_index": _with_warehouses(analytics.capacity_index),
    "top_customers": _with_customers(analytics.top_customers),
    "customer_metrics": _on_mart(analytics.customer_metrics),
    "shipments_by_country": _on_mart(analytics.shipments_by_country),
    "package_behaviour": _on_mart(analytics.package_behaviour),
    "customer_locations": _with_customers(analytics.customer_locations),
    "risk_metrics": _on_mart(analytics.risk_metrics),
    "risk_by_warehouse": _with_warehouses(analytics.risk_by_warehouse),
    "highest_risk": _on_mart(analytics.highest_risk),
    "weather_impact": _on_mart(analytics.weather_impact),
    "risk_histogram": _on_mart(analytics.risk_histogram),
    "route_metrics": _on_mart(analytics.route_metrics),
    "route_performance": _on_mart(analytics.route_performance),
    "route_points": _on_mart(analytics.route_points),
    "longest_routes": _on_mart(analytics.longest_routes),
    "routes_by_warehouse": _with_warehouses(analytics.routes_by_warehouse),
    "distance_histogram": _on_mart(analytics.distance_histogram),
}

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # derived tables
    "routes": lambda t: t.routes,
    "routes_shuffled": lambda t: transforms.build_routes(t.orders, t.customers, t.warehouses,
                                                         small=False),
    "route_profile": lambda t: transforms.route_profile(t.routes),
    "mode_profile": lambda t: transforms.mode_profile(t.routes),
    "latest_weather": lambda t: transforms.latest_weather(t.weather, tie="event_id"),
    "latest_weather_tied": lambda t: transforms.latest_weather(
        t.view("weather_tied"), tie="event_id"),
    "delivery_risk": lambda t: t.risk(),
    "delivery_risk_missing_penalty": lambda t: t.risk(S.MISSING_WEATHER_POINTS),
    "risk_profile": lambda t: transforms.risk_profile(t.risk()),
    "score_range": lambda t: transforms.score_range(t.risk()),
    "customer_labels": lambda t: _customer_labels(t.view("customers")),
    "order_stamps": lambda t: t.orders.select(
        "order_id", text.iso_text(F.col("created_at")).alias("iso"),
        text.file_stamp(F.col("created_at")).alias("stamp")),
    "stg_customers": lambda t: marts.stg_customers(t.view("customers")),
    "stg_orders": lambda t: marts.stg_orders(t.orders),
    "dim_customers": lambda t: marts.dim_customers(t.view("customers")),
    "fact_shipments": lambda t: marts.fact_shipments(t.orders, t.customers),
    "fact_shipments_shuffled": lambda t: marts.fact_shipments(t.orders, t.customers, small=False),
    "fact_shipments_orphaned": lambda t: marts.fact_shipments(
        t.view("orders_orphaned"), t.customers),
    "delivery_performance": lambda t: t.performance,
    "delivery_performance_joined": _joined_performance,
    "delivery_performance_dirty": lambda t: marts.build_performance(
        t.view("orders_dirty"), t.customers, t.warehouses, t.latest),
    "delivery_performance_orphaned": lambda t: marts.build_performance(
        t.view("orders_orphaned"), t.customers, t.warehouses, t.latest),
    "rebuild": _rebuild,
    "rebuild_dirty": lambda t: _rebuild(t, "orders_dirty"),
    # reports without or with a fixed filter
    "overview_metrics_rollup": lambda t: rollup.overview_metrics(t.spark, t.rollup),
    "overview_metrics_rollup_filtered": lambda t: rollup.overview_metrics(
        t.spark, t.rollup, SOME, t.warehouses),
    "overview_metrics_rollup_empty": lambda t: rollup.overview_metrics(
        t.spark, t.rollup, NOTHING, t.warehouses),
    "customer_metrics_rollup_filtered": lambda t: rollup.customer_metrics(
        t.spark, t.rollup, SOME, t.warehouses),
    "overview_metrics_empty": lambda t: REPORTS["overview_metrics"](t, NOTHING),
    "warehouse_performance_idle": lambda t: analytics.warehouse_performance(
        t.performance.where("warehouse_id <> 'WH-001'"), t.warehouses),
    "capacity_index_empty": lambda t: analytics.capacity_index(
        t.performance.where("warehouse_id = 'none'"), t.warehouses),
    "warehouse_network": lambda t: analytics.warehouse_network(t.performance, t.warehouses),
    "warehouse_locations": lambda t: analytics.warehouse_locations(t.view("warehouses")),
    "route_points_sample": lambda t: analytics.route_points_sample(t.performance),
    "weather_impact_sample": lambda t: analytics.weather_impact_sample(t.performance),
    "distance_histogram_nan": lambda t: _distance_histogram_nan(t),
    "filter_options": lambda t: filters.filter_options(t.performance, t.warehouses),
    # data quality
    "dq_marts": lambda t: quality.run_checks(_clean_tables(t), quality.mart_checks()),
    "dq_marts_dirty": lambda t: quality.run_checks(_dirty_tables(t), quality.mart_checks()),
    "dq_ranges": lambda t: quality.run_checks(_clean_tables(t), quality.range_checks()),
    "dq_incremental": lambda t: _dq_incremental(t, _clean_tables(t)),
    "dq_incremental_dirty": lambda t: _dq_incremental(t, _dirty_tables(t)),
    "dq_orphans": _dq_orphans,
    "dq_failing_status": _dq_failing_status,
    # ingest and load
    "conform_customers": lambda t: _conformed(t)[0],
    "conform_rejects": _conform_rejects,
    "dedupe_latest": lambda t: latest.latest_per_key(
        t.view("customer_versions"), "customer_id", ["changed_at", "version_id"]),
    "bronze_replay": _bronze_replay,
    "bronze_rejects": _bronze_rejects,
    "bronze_weather": _bronze_weather,
    "weather_history": _weather_history,
    "load_audit": _load_audit,
    "bronze_to_mart": _bronze_to_mart,
    "conform_types": _conform_types,
    "flatten_weather": _flatten_weather,
    "reference_routes": _reference_routes,
    "catalog_load": _catalog_load,
    "padded_ids": lambda t: testbed.base_table(t.spark, t.sf_dir, "supplier").select(
        "s_suppkey", text.padded_id("WH", F.col("s_suppkey")).alias("warehouse_id")),
    # extensions
    "asof_weather": _asof,
    "delivery_risk_asof": lambda t: _risk_asof(t, "ship_orders"),
    "delivery_risk_asof_dirty": lambda t: _risk_asof(t, "orders_dirty"),
    "customer_scd": _customer_scd,
    "customer_scd_merge": _customer_scd_merge,
    "stream_timeline": _stream_timeline,
    "stream_timeline_undated": lambda t: _stream_timeline(t, "orders_undated"),
    "stream_dedupe": _stream_dedupe,
    "stream_dedupe_versions": lambda t: _stream_dedupe(t, "orders_versions"),
    "stream_dedupe_unnamed": lambda t: _stream_dedupe(t, "orders_unnamed"),
    "stream_risk": _stream_risk,
    "stream_risk_asof": _stream_risk_asof,
    "incremental_mart": _incremental_mart,
    "incremental_mart_moved": _incremental_mart_moved,
    "incremental_mart_day": _incremental_mart_day,
}


for _name, _report in REPORTS.items():
    QUERIES[_name] = partial(_report, chosen=None)
    QUERIES[f"{_name}_filtered"] = partial(_report, chosen=SOME)


def _registered(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _comparable(query(Tables(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Volume, averages and effective speed per transport mode."""
    return queries()["route_performance"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: _registered(query) for name, query in QUERIES.items()}
    if text_entry is None:
        return own
    return own | text_entry.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    own = entry_sql.oracles()
    if text_entry is None:
        return own
    sql = corpus_pipeline.ORACLE_SQL
    return own | text_entry.ORACLES | ({"pipeline": sql} if sql else {})

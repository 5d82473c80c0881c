"""Staging projections, dimension, fact and the wide shipment mart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.operators.joins import left_join_all, lookup_join
from cargolens.plans import transforms
from cargolens.sources.workspace import stored


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(*S.STG_CUSTOMERS)


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(*S.STG_ORDERS)


def dim_customers(customers: DataFrame) -> DataFrame:
    return stg_customers(customers)


FACT = ["order_id", "customer_id", "warehouse_id", "order_date", "package_weight_kg",
        "package_size", "priority", "status", "customer_city", "customer_country"]


def _customer_place(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", F.col("city").alias("customer_city"),
                            F.col("country").alias("customer_country"))


def fact_shipments(orders: DataFrame, customers: DataFrame,
                   small: bool | None = None) -> DataFrame:
    """Every order, with its customer's city and country where the customer is known."""
    dated = stg_orders(orders).withColumnRenamed("created_at", "order_date")
    placed = lookup_join(dated, _customer_place(customers), "customer_id", "left",
                         spread=["order_id"], small=small)
    return placed.select(*FACT)


PERFORMANCE = ["order_id", "customer_id", "warehouse_id", "order_date", "status",
               "package_weight_kg", "package_size", "priority", "customer_city",
               "customer_country", "route_id", "distance_km", "estimated_delivery_hours",
               "transport_mode", "temperature", "wind_speed", "risk_score", "risk_category"]


def delivery_performance(fact: DataFrame, routes: DataFrame, risk: DataFrame) -> DataFrame:
    """Fact rows with route and risk attributes, joined on order_id.

    Holds for any input, repeated and null order ids included. All three sides are
    partitioned by order_id, so each is shuffled once.
    """
    route = routes.select("order_id", "route_id", "distance_km",
                          F.col("estimated_hours").alias("estimated_delivery_hours"),
                          "transport_mode")
    scored = risk.select("order_id", "temperature", "wind_speed", "risk_score",
                         F.col("risk_level").alias("risk_category"))
    return left_join_all(fact, [route, scored], "order_id").select(*PERFORMANCE)


def keys_are_sound(*tables, unique=()) -> bool:
    """True when no (frame, key) pair has a repeated or null key; of pairs in `unique` only nulls are looked for."""
    faults = [df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n"))
              .where((F.col("n") > 1) | F.col("key").isNull()).select("n").limit(1)
              for df, key in tables]
    faults += [df.where(F.col(key).isNull()).select(F.lit(1).cast("bigint").alias("n")).limit(1)
               for df, key in unique]
    return reduce(DataFrame.unionByName, faults).isEmpty()


def _stations(warehouses: DataFrame, latest: DataFrame) -> DataFrame:
    """Position and latest weather, one row per warehouse.

    Written out, so that the lookup of the orders knows its size and happens once.
    """
    places = transforms.warehouse_points(warehouses).withColumn("__warehouse", F.lit(True))
    observed = latest.select("warehouse_id", "temperature", "wind_speed")
    return stored(lookup_join(places, observed, "warehouse_id", "left"), "stations")


def performance_from_keys(orders: DataFrame, customers: DataFrame, warehouses: DataFrame,
                          latest: DataFrame, null_points: int = 0) -> DataFrame:
    """`delivery_performance` in one pass over the orders, for sound keys only.

    With unique, non-null order, customer and warehouse ids a route is a function of its
    order row, so the joins on order_id (three wide shuffles) fall away: the
    order looks up customer, warehouse and weather, and attributes of orders without a
    route are null. So are those of orders without an id, which no join would match.
    """
    dated = stg_orders(orders).withColumnRenamed("created_at", "order_date")
    people = customers.select(
        "customer_id", F.col("city").alias("customer_city"),
        F.col("country").alias("customer_country"), F.col("latitude").alias("customer_latitude"),
        F.col("longitude").alias("customer_longitude"), F.lit(True).alias("__customer"))
    stations = _stations(warehouses, latest)
    wide = lookup_join(dated, people, "customer_id", "left", spread=["order_id"])
    wide = lookup_join(wide, stations, "warehouse_id", "left", spread=["order_id"], profile=dated)
    scored = transforms.with_risk(transforms.with_route(wide), null_points)
    named = scored.withColumnsRenamed({"estimated_hours": "estimated_delivery_hours",
                                       "risk_level": "risk_category"})
    routed = (F.col("__customer").isNotNull() & F.col("__warehouse").isNotNull()
              & F.col("order_id").isNotNull())
    return named.select(*PERFORMANCE[:10],
                        *[F.when(routed, F.col(c)).alias(c) for c in PERFORMANCE[10:]])


def routes_of(performance: DataFrame) -> DataFrame:
    """The routes table back from a mart with sound keys."""
    return performance.where(F.col("route_id").isNotNull()).select(
        F.col("route_id"), "order_id", "customer_id", "warehouse_id", "distance_km",
        F.col("estimated_delivery_hours").alias("estimated_hours"), "transport_mode")


def risk_of(performance: DataFrame) -> DataFrame:
    """The delivery risk table back from a mart with sound keys."""
    return performance.where(F.col("route_id").isNotNull()).select(
        "route_id", "order_id", "warehouse_id", "distance_km",
        F.col("estimated_delivery_hours").alias("estimated_hours"), "temperature", "wind_speed",
        "risk_score", F.col("risk_category").alias("risk_level"))


def build_performance(orders: DataFrame, customers: DataFrame, warehouses: DataFrame,
                      latest: DataFrame, null_points: int = 0) -> DataFrame:
    """The wide mart by the cheapest plan that is exact for these keys."""
    if keys_are_sound((orders, "order_id"), (customers, "customer_id"),
                      (warehouses, "warehouse_id")):
        return performance_from_keys(orders, customers, warehouses, latest, null_points)
    routes = stored(transforms.build_routes(orders, customers, warehouses), "routes")
    risk = transforms.build_delivery_risk(routes, latest, null_points)
    return delivery_performance(fact_shipments(orders, customers), routes, risk)

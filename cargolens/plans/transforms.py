"""Routes and delivery risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.functions import routing, scoring
from cargolens.operators.cells import asof_join
from cargolens.operators.joins import lookup_join
from cargolens.operators.latest import latest_per_key


def customer_points(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", F.col("latitude").alias("customer_latitude"),
                            F.col("longitude").alias("customer_longitude"))


def warehouse_points(warehouses: DataFrame, keep=()) -> DataFrame:
    return warehouses.select("warehouse_id", F.col("latitude").alias("warehouse_latitude"),
                             F.col("longitude").alias("warehouse_longitude"), *keep)


def with_route(df: DataFrame) -> DataFrame:
    """Add route_id, distance_km, transport_mode and estimated_hours.

    The mode follows from the unrounded distance; distance and hours are then rounded.
    """
    return (df
            .withColumn("distance_km", routing.haversine_km(
                "warehouse_latitude", "warehouse_longitude",
                "customer_latitude", "customer_longitude"))
            .withColumn("transport_mode", routing.transport_mode(F.col("distance_km")))
            .withColumn("estimated_hours",
                        routing.travel_hours(F.col("distance_km"), F.col("transport_mode")))
            .withColumns({"route_id": routing.route_id("order_id"),
                          "distance_km": routing.round2(F.col("distance_km")),
                          "estimated_hours": routing.round2(F.col("estimated_hours"))}))


def with_risk(df: DataFrame, null_points: int = 0) -> DataFrame:
    """Add risk_score and risk_level from distance, hours, temperature and wind speed."""
    score = scoring.risk_score(F.col("distance_km"), F.col("estimated_hours"),
                               F.col("temperature"), F.col("wind_speed"), null_points)
    return (df.withColumn("risk_score", score)
            .withColumn("risk_level", scoring.risk_level(F.col("risk_score"))))


def build_routes(orders: DataFrame, customers: DataFrame, warehouses: DataFrame,
                 carry=(), small: bool | None = None, keep=()) -> DataFrame:
    """One route per order whose customer and warehouse are known.

    `carry` names further order columns that the routes keep, `keep` such columns of the warehouses; `small` is as in
    `lookup_join`.
    """
    keys = orders.select("order_id", "customer_id", "warehouse_id", *carry)
    located = lookup_join(keys, customer_points(customers), "customer_id", "inner",
                          spread=["order_id"], small=small)
    located = lookup_join(located, warehouse_points(warehouses, keep), "warehouse_id", "inner",
                          spread=["order_id"], profile=keys, small=small)
    return with_route(located).select(*S.ROUTES.fieldNames(), *carry, *keep)


def latest_weather(weather: DataFrame, tie: str | None = None) -> DataFrame:
    """The newest observation of each warehouse, nulls included.

    `tie` names a unique column that decides between equal time stamps; without it the
    measured values do.
    """
    order = ["timestamp", *([tie] if tie else ["temperature", "wind_speed"])]
    return (latest_per_key(weather, "warehouse_id", order)
            .select("warehouse_id", "temperature", "wind_speed"))


def build_delivery_risk(routes: DataFrame, latest: DataFrame, null_points: int = 0,
                        profile: DataFrame | None = None) -> DataFrame:
    """Score every route against the latest weather of its warehouse.

    `null_points` is what each missing weather value scores: 0 by default,
    `schemas.MISSING_WEATHER_POINTS` to count missing weather as raised risk. `profile`
    is where to look for warehouses with very many rows, best the orders when
    `routes` is not a written table.
    """
    observed = lookup_join(routes, latest.select("warehouse_id", "temperature", "wind_speed"),
                           "warehouse_id", "left", spread=["order_id"], profile=profile)
    return with_risk(observed, null_points).select(*S.DELIVERY_RISK.fieldNames())


def build_delivery_risk_asof(routes: DataFrame, weather: DataFrame, tie: str,
                             null_points: int = 0) -> DataFrame:
    """Score every route against the weather of its warehouse at the time of the order.

    The routes have to carry `created_at` (`build_routes(..., carry=["created_at"])`). Each is matched on
    its own, so orders with a repeated or missing id are scored like all others.
    """
    observed = asof_join(routes, weather, "warehouse_id", "created_at", "timestamp",
                         ["temperature", "wind_speed"], tie)
    return with_risk(observed, null_points).select(*S.DELIVERY_RISK.fieldNames())


def route_profile(routes: DataFrame) -> DataFrame:
    """Count and range of distance and hours, and the number of routes per mode."""
    modes = {f"{label}_routes": F.count_if(F.col("transport_mode") == label)
             for _, label in S.MODE_TIERS}
    return routes.agg(
        F.count("*").alias("routes"),
        F.min("distance_km").alias("min_km"), F.max("distance_km").alias("max_km"),
        F.avg("distance_km").alias("mean_km"),
        F.min("estimated_hours").alias("min_hours"), F.max("estimated_hours").alias("max_hours"),
        F.avg("estimated_hours").alias("mean_hours"),
        *[n.alias(name) for name, n in modes.items()])


def mode_profile(routes: DataFrame) -> DataFrame:
    return routes.groupBy("transport_mode").agg(F.count("*").alias("routes")).orderBy(
        "transport_mode")


def risk_profile(risk: DataFrame) -> DataFrame:
    """Routes and score range per risk level."""
    return (risk.groupBy("risk_level")
            .agg(F.count("*").alias("routes"), F.min("risk_score").alias("min_score"),
                 F.max("risk_score").alias("max_score"))
            .orderBy("risk_level"))


def score_range(risk: DataFrame) -> DataFrame:
    return risk.agg(F.min("risk_score").alias("min_score"), F.max("risk_score").alias("max_score"))

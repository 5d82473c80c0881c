"""Reports over the shipment mart.

`dp` is the delivery_performance table. Every report takes the optional filter of
`operators.filters.apply_filters`; a report that joins warehouses or customers first
reduces the mart to one row per key, so the join never moves shipment rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.functions.scoring import severity
from cargolens.functions.text import full_name
from cargolens.operators import histogram as hist
from cargolens.operators.filters import apply_filters, is_active


def _shipments() -> Column:
    return F.count("*").alias("shipments")


def _high_risk() -> Column:
    return F.count_if(F.col("risk_category").isin(S.HIGH_RISK))


def _speed() -> Column:
    return F.sum("distance_km") / F.nullif(F.sum("estimated_delivery_hours"), F.lit(0.0))


# --- key figures: one row, also when nothing matches ---------------------


AVERAGED = {"avg_distance": "distance_km", "avg_delivery": "estimated_delivery_hours",
            "avg_weight": "package_weight_kg", "avg_risk": "risk_score"}


def overview_metrics(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    """Sums per warehouse, which are few rows, for the figures; customers, which are many, are only told apart."""
    chosen = apply_filters(dp, filters, warehouses)
    depots = chosen.groupBy("warehouse_id").agg(
        _shipments(), _high_risk().alias("high"),
        *[F.sum(c).alias(f"sum_{name}") for name, c in AVERAGED.items()],
        *[F.count(c).alias(f"n_{name}") for name, c in AVERAGED.items()])
    none = F.lit(0).cast("bigint")
    figures = depots.agg(
        F.coalesce(F.sum("shipments"), none).alias("shipments"),
        F.count("warehouse_id").alias("warehouses"),
        *[(F.sum(f"sum_{name}") / F.nullif(F.sum(f"n_{name}"), none)).alias(name)
          for name in AVERAGED],
        F.coalesce(F.sum("high"), none).alias("high_risk_shipments"))
    people = chosen.select("customer_id").distinct().agg(F.count("customer_id").alias("customers"))
    # One row each.
    both = figures.unionByName(people, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in (
        "shipments", "customers", "warehouses", *AVERAGED, "high_risk_shipments")])


def customer_metrics(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return apply_filters(dp, filters, warehouses).agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count("order_id").alias("shipments"), F.avg("package_weight_kg").alias("avg_weight"))


def risk_metrics(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return apply_filters(dp, filters, warehouses).agg(
        _shipments(), F.avg("risk_score").alias("avg_risk"), F.max("risk_score").alias("max_risk"),
        _high_risk().alias("high_risk_count"))


def route_metrics(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return apply_filters(dp, filters, warehouses).agg(
        F.count("*").alias("routes"), F.avg("distance_km").alias("avg_distance"),
        F.avg("estimated_delivery_hours").alias("avg_hours"), _speed().alias("avg_speed"))


def warehouse_metrics(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return apply_filters(dp, filters, warehouses).agg(
        F.count_distinct("warehouse_id").alias("warehouses"),
        F.count("order_id").alias("shipments"), F.avg("distance_km").alias("avg_distance"),
        F.avg("risk_score").alias("avg_risk"))


# --- distributions -------------------------------------------------------


def _shipments_by(dp: DataFrame, column: str, filters, warehouses) -> DataFrame:
    return (apply_filters(dp, filters, warehouses).groupBy(column).agg(_shipments())
            .orderBy(F.desc("shipments"), F.asc_nulls_last(column)))


def shipment_status(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return _shipments_by(dp, "status", filters, warehouses)


def priority_distribution(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return _shipments_by(dp, "priority", filters, warehouses)


def package_sizes(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return _shipments_by(dp, "package_size", filters, warehouses)


def shipments_by_country(dp: DataFrame, filters=None, warehouses=None, top: int = 15) -> DataFrame:
    return _shipments_by(dp, "customer_country", filters, warehouses).limit(top)


def shipment_timeline(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return (apply_filters(dp, filters, warehouses)
            .groupBy(F.to_date("order_date").alias("date")).agg(_shipments())
            .orderBy(F.asc_nulls_last("date")))


def risk_summary(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    """Shipments per risk category, in order of severity."""
    return (apply_filters(dp, filters, warehouses).groupBy("risk_category").agg(_shipments())
            .orderBy(severity(F.col("risk_category")).asc_nulls_last(), "risk_category"))


def package_behaviour(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return (apply_filters(dp, filters, warehouses).groupBy("package_size")
            .agg(_shipments(), F.avg("package_weight_kg").alias("avg_weight"))
            .orderBy(F.desc("shipments"), "package_size"))


def route_performance(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    """Volume, averages and effective speed per transport mode."""
    return (apply_filters(dp, filters, warehouses).groupBy("transport_mode")
            .agg(_shipments(), F.avg("distance_km").alias("distance"),
                 F.avg("estimated_delivery_hours").alias("hours"), _speed().alias("speed"))
            .orderBy(F.desc_nulls_last("speed"), "transport_mode"))


# --- by warehouse --------------------------------------------------------

# partial of a warehouse -> (aggregate, column)
_PARTS = {
    "rows": (F.count, "*"),
    "orders": (F.count, "order_id"),
    "routes": (F.count, "route_id"),
    "km": (F.sum, "distance_km"),
    "km_n": (F.count, "distance_km"),
    "h": (F.sum, "estimated_delivery_hours"),
    "h_n": (F.count, "estimated_delivery_hours"),
    "risk": (F.sum, "risk_score"),
    "risk_n": (F.count, "risk_score"),
}


def _per_warehouse(df: DataFrame, *parts: str) -> DataFrame:
    """One row of partials per warehouse, so that no shipment row enters a join."""
    return df.groupBy("warehouse_id").agg(
        *[agg(column).alias(f"__{p}") for p in parts for agg, column in [_PARTS[p]]])


def _total(part: str) -> Column:
    return F.coalesce(F.sum(f"__{part}"), F.lit(0)).cast("bigint")


def _mean(part: str) -> Column:
    return F.sum(f"__{part}").cast("double") / F.nullif(F.sum(f"__{part}_n"), F.lit(0))


def warehouse_performance(dp: DataFrame, warehouses: DataFrame, filters=None) -> DataFrame:
    """Volume and averages per warehouse, busiest first.

    Idle warehouses are listed with 0 shipments, but only while no filter is active: a
    filter restricts shipments and so removes warehouses without any.
    """
    parts = _per_warehouse(apply_filters(dp, filters, warehouses),
                           "orders", "km", "km_n", "h", "h_n", "risk", "risk_n")
    joined = warehouses.join(parts, "warehouse_id", "inner" if is_active(filters) else "left")
    return (joined.groupBy("name", "city", "country", "capacity")
            .agg(_total("orders").alias("shipments"), _mean("km").alias("avg_distance"),
                 _mean("h").alias("avg_delivery_hours"), _mean("risk").alias("avg_risk"))
            .orderBy(F.desc("shipments"), "name", "city", "country", "capacity"))


def capacity_index(dp: DataFrame, warehouses: DataFrame, filters=None) -> DataFrame:
    """Warehouse volume relative to the busiest one (= 100; all 0 without shipments)."""
    volume = (warehouse_performance(dp, warehouses, filters)
              .select("name", "city", "country", "capacity", "shipments"))
    busiest = volume.agg(F.max("shipments").alias("busiest"))
    return (volume.withColumn("__busiest", busiest.scalar())
            .withColumn("utilisation_idx",
                        F.when(F.col("__busiest") == 0, F.lit(0.0))
                        .otherwise(F.col("shipments") / F.col("__busiest") * 100))
            .drop("__busiest"))


def risk_by_warehouse(dp: DataFrame, warehouses: DataFrame, filters=None) -> DataFrame:
    parts = _per_warehouse(apply_filters(dp, filters, warehouses), "orders", "risk", "risk_n")
    return (warehouses.select("warehouse_id", "name").join(parts, "warehouse_id")
            .groupBy("warehouse_id", "name")
            .agg(_total("orders").alias("shipments"), _mean("risk").alias("avg_risk"))
            .orderBy(F.desc_nulls_last("avg_risk"), "warehouse_id"))


def routes_by_warehouse(dp: DataFrame, warehouses: DataFrame, filters=None) -> DataFrame:
    parts = _per_warehouse(apply_filters(dp, filters, warehouses), "rows", "km", "km_n")
    return (warehouses.select("warehouse_id", "name").join(parts, "warehouse_id")
            .groupBy("name").agg(_total("rows").alias("routes"), _mean("km").alias("avg_distance"))
            .orderBy(F.desc("routes"), "name"))


def warehouse_network(dp: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Position and number of routes of every warehouse, idle ones included."""
    place = ["name", "city", "country", "latitude", "longitude"]
    return (warehouses.select("warehouse_id", *place)
            .join(_per_warehouse(dp, "routes"), "warehouse_id", "left")
            .groupBy(*place).agg(_total("routes").alias("routes")))


def warehouse_locations(warehouses: DataFrame) -> DataFrame:
    return warehouses.select("name", "city", "country", "latitude", "longitude")


# --- by customer ---------------------------------------------------------


def top_customers(dp: DataFrame, customers: DataFrame, filters=None, warehouses=None,
                  top: int = 20) -> DataFrame:
    """Customers with the most shipments; orders of unknown customers do not count."""
    parts = (apply_filters(dp, filters, warehouses).groupBy("customer_id")
             .agg(F.count("order_id").alias("__n"), F.sum("package_weight_kg").alias("__kg"),
                  F.count("package_weight_kg").alias("__kg_n")))
    people = customers.select("customer_id", full_name("first_name", "last_name").alias("customer"),
                              "country")
    return (parts.join(people, "customer_id")
            .groupBy("customer_id", "customer", "country")
            .agg(F.sum("__n").alias("shipments"),
                 (F.sum("__kg") / F.nullif(F.sum("__kg_n"), F.lit(0))).alias("avg_weight"))
            .orderBy(F.desc("shipments"), "customer_id", "customer", "country").limit(top))


def customer_locations(dp: DataFrame, customers: DataFrame, filters=None,
                       warehouses=None) -> DataFrame:
    """Distinct customers with at least one matching shipment, and where they are."""
    active = apply_filters(dp, filters, warehouses).select("customer_id").distinct()
    return (customers.select("customer_id", "first_name", "last_name", "city", "country",
                             "latitude", "longitude")
            .join(active, "customer_id", "left_semi").distinct())


# --- shipment lists and point sets ---------------------------------------


def highest_risk(dp: DataFrame, filters=None, warehouses=None, top: int = 50) -> DataFrame:
    return (apply_filters(dp, filters, warehouses)
            .select("route_id", "order_id", "warehouse_id", "transport_mode", "distance_km",
                    "estimated_delivery_hours", "temperature", "wind_speed", "risk_score",
                    "risk_category")
            .orderBy(F.desc_nulls_last("risk_score"), "order_id").limit(top))


def longest_routes(dp: DataFrame, filters=None, warehouses=None, top: int = 20) -> DataFrame:
    return (apply_filters(dp, filters, warehouses)
            .select("route_id", "order_id", "warehouse_id", "transport_mode", "distance_km",
                    "estimated_delivery_hours")
            .orderBy(F.desc_nulls_last("distance_km"), "order_id").limit(top))


def route_points(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return apply_filters(dp, filters, warehouses).select(
        "distance_km", "estimated_delivery_hours", "transport_mode")


def weather_impact(dp: DataFrame, filters=None, warehouses=None) -> DataFrame:
    return apply_filters(dp, filters, warehouses).select(
        "temperature", "wind_speed", "risk_score")


SAMPLE = 1000  # points per group


def _least_hashes(points: DataFrame, group: str, size: int, columns) -> DataFrame:
    """The `size` rows of each group whose order id has the least hash; the columns decide between equal ones.

    Which rows are chosen does not depend on how the table is partitioned or was written, and the least of several
    parts are among the least of each part, so a task passes on at most `size` rows per group.
    """
    hashed = F.md5(F.coalesce("order_id", F.lit("")))
    order = Window.partitionBy(group).orderBy(hashed, *[F.asc_nulls_first(c) for c in columns])
    return (points.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= size)
            .select(*columns))


def route_points_sample(dp: DataFrame, filters=None, warehouses=None, size: int = SAMPLE) -> DataFrame:
    """A bounded, stable choice of `route_points`: at most `size` per transport mode."""
    return _least_hashes(apply_filters(dp, filters, warehouses), "transport_mode", size,
                         ["distance_km", "estimated_delivery_hours", "transport_mode"])


def weather_impact_sample(dp: DataFrame, filters=None, warehouses=None, size: int = SAMPLE) -> DataFrame:
    """A bounded, stable choice of `weather_impact`: at most `size` per risk level."""
    return _least_hashes(apply_filters(dp, filters, warehouses), "risk_category", size,
                         ["temperature", "wind_speed", "risk_score"])


def distance_histogram(dp: DataFrame, filters=None, warehouses=None, bins: int = 30) -> DataFrame:
    return hist.histogram(apply_filters(dp, filters, warehouses), "distance_km", bins)


def risk_histogram(dp: DataFrame, filters=None, warehouses=None, bins: int = 20) -> DataFrame:
    return hist.histogram(apply_filters(dp, filters, warehouses), "risk_score", bins)

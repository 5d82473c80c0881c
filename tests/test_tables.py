"""Routes, risk and marts on small frames."""
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.plans import marts, transforms
from conftest import rows

NOON = datetime(2026, 1, 1, 12)


def orders_of(spark, *ids, customer="C1", warehouse="WH-001"):
    data = [(i, customer, warehouse, 1.5, "small", "express", "shipped", NOON) for i in ids]
    return spark.createDataFrame(data, S.ORDERS)


def customers_of(spark, *points):
    return spark.createDataFrame(
        [(c, "Ann", "Lee", "a@x", "Town", "St", "Land", lat, lon) for c, lat, lon in points],
        "customer_id string, first_name string, last_name string, email string, city string, "
        "state string, country string, latitude double, longitude double")


def warehouses_of(spark, *points):
    return spark.createDataFrame([(w, w.lower(), "City", "Land", lat, lon, 10)
                                  for w, lat, lon in points], S.WAREHOUSES)


def weather_of(spark, *records):
    return spark.createDataFrame(list(records), S.WEATHER)


def route_at(spark, distance):
    lon = 5.0 + distance / (111.32 * math.cos(math.radians(50.0)))
    return transforms.build_routes(
        orders_of(spark, "O1"), customers_of(spark, ("C1", 50.0, lon)),
        warehouses_of(spark, ("WH-001", 50.0, 5.0))).first()


def test_route_columns_and_identifiers(spark):
    routes = transforms.build_routes(
        orders_of(spark, "abc-1"), customers_of(spark, ("C1", 52.3676, 4.9041)),
        warehouses_of(spark, ("WH-001", 52.52, 13.405)))
    assert routes.dtypes == [(f.name, f.dataType.simpleString()) for f in S.ROUTES]
    r = routes.first()
    assert (r.route_id, r.order_id, r.customer_id, r.warehouse_id) == \
        ("RT-abc-1", "abc-1", "C1", "WH-001")
    assert 565 <= r.distance_km <= 590 and r.estimated_hours > 0


@pytest.mark.parametrize("distance, mode", [(300, "van"), (1500, "truck"), (8000, "air")])
def test_mode_and_hours_follow_distance(spark, distance, mode):
    r = route_at(spark, distance)
    speed, handling = S.MODE_PACE[mode]
    assert r.transport_mode == mode
    assert r.estimated_hours == pytest.approx(r.distance_km / speed + handling, abs=0.02)


@pytest.mark.parametrize("shuffled", [False, True])
def test_orders_without_customer_or_warehouse_have_no_route(spark, shuffled, request):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    orders = (orders_of(spark, "O1").unionByName(orders_of(spark, "O2", customer="none"))
              .unionByName(orders_of(spark, "O3", warehouse="none"))
              .unionByName(orders_of(spark, "O4", customer=None)))
    routes = transforms.build_routes(orders, customers_of(spark, ("C1", 50.0, 5.0)),
                                     warehouses_of(spark, ("WH-001", 50.0, 5.0)))
    assert rows(routes, "order_id", "distance_km") == [("O1", 0.0)]


def risk_of(spark, distance, hours, *weather, null_points=0):
    routes = spark.createDataFrame([("RT-1", "O1", "C1", "WH-001", distance, hours, "van")],
                                   S.ROUTES)
    latest = transforms.latest_weather(weather_of(spark, *weather))
    return transforms.build_delivery_risk(routes, latest, null_points)


def test_risk_columns(spark):
    risk = risk_of(spark, 100.0, 3.0, ("WH-001", NOON, 20.0, 5.0))
    assert risk.dtypes == [(f.name, f.dataType.simpleString()) for f in S.DELIVERY_RISK]
    assert (risk.first().risk_score, risk.first().risk_level) == (0, "LOW")


@pytest.mark.parametrize("distance, hours, temp, wind, score, level", [
    (300.0, 5.0, 18.0, 3.0, 0, "LOW"),
    (12000.0, 40.0, 28.0, 18.0, 95, "CRITICAL"),
    (25000.0, 200.0, 45.0, 80.0, 95, "CRITICAL"),
    (5000.0, 24.0, 22.0, 8.0, 35, "MEDIUM"),
    (10000.0, 48.0, 22.0, 8.0, 65, "CRITICAL")])
def test_risk_score(spark, distance, hours, temp, wind, score, level):
    r = risk_of(spark, distance, hours, ("WH-001", NOON, temp, wind)).first()
    assert (r.risk_score, r.risk_level) == (score, level)


def test_missing_weather(spark):
    other = ("WH-999", NOON, 30.0, 30.0)
    assert risk_of(spark, 1000.0, 3.0, other).first().risk_score == 0
    assert risk_of(spark, 1000.0, 3.0, other, null_points=15).first().risk_score == 30


def test_latest_weather_keeps_null_measurements(spark):
    weather = weather_of(spark, ("A", datetime(2026, 1, 1), 10.0, 1.0),
                         ("A", datetime(2026, 1, 2), None, 2.0), ("A", None, 99.0, 99.0),
                         ("B", None, 7.0, None))
    assert rows(transforms.latest_weather(weather)) == [("A", None, 2.0), ("B", 7.0, None)]


def test_latest_weather_takes_text_time_stamps(spark):
    weather = spark.createDataFrame(
        [("A", "2026-01-01T00:00:00", 1.0, 1.0), ("A", "2026-01-02T00:00:00", 2.0, 2.0)],
        "warehouse_id string, timestamp string, temperature double, wind_speed double")
    assert rows(transforms.latest_weather(weather)) == [("A", 2.0, 2.0)]


def test_profiles(spark):
    routes = spark.createDataFrame(
        [("R1", "O1", "C", "W", 100.0, 2.0, "van"), ("R2", "O2", "C", "W", 300.0, 4.0, "van"),
         ("R3", "O3", "C", "W", 4000.0, 17.0, "air")], S.ROUTES)
    p = transforms.route_profile(routes).first()
    assert (p.routes, p.min_km, p.max_km, p.van_routes, p.truck_routes, p.air_routes) == \
        (3, 100.0, 4000.0, 2, 0, 1)
    assert rows(transforms.mode_profile(routes)) == [("air", 1), ("van", 2)]


def star(spark, orders):
    customers = customers_of(spark, ("C1", 50.0, 5.0), ("C2", 40.0, 0.0))
    warehouses = warehouses_of(spark, ("WH-001", 50.0, 15.0), ("WH-002", 45.0, 3.0))
    latest = transforms.latest_weather(weather_of(spark, ("WH-001", NOON, 26.0, 11.0)))
    return orders, customers, warehouses, latest


def joined(orders, customers, warehouses, latest):
    routes = transforms.build_routes(orders, customers, warehouses)
    return marts.delivery_performance(marts.fact_shipments(orders, customers), routes,
                                      transforms.build_delivery_risk(routes, latest))


@pytest.mark.parametrize("shuffled", [False, True])
def test_one_pass_mart_equals_joined_mart(spark, shuffled, request):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    orders = (orders_of(spark, "O1", "O2")
              .unionByName(orders_of(spark, "O3", customer="C2", warehouse="WH-002"))
              .unionByName(orders_of(spark, "O4", customer="none"))
              .unionByName(orders_of(spark, "O5", warehouse="none"))
              .unionByName(orders_of(spark, "O6", customer=None, warehouse=None)))
    tables = star(spark, orders)
    fast = marts.performance_from_keys(*tables)
    assert fast.columns == marts.PERFORMANCE
    assert rows(fast) == rows(joined(*tables))
    assert rows(marts.routes_of(fast)) == rows(transforms.build_routes(*tables[:3]))
    assert rows(fast.select(*marts.FACT)) == rows(marts.fact_shipments(*tables[:2]))


def test_unsound_keys_take_the_joins(spark):
    repeated = orders_of(spark, "O1", "O1", "O2")
    unnamed = orders_of(spark, "O1").unionByName(orders_of(spark, None, None))
    for orders in (repeated, unnamed):
        tables = star(spark, orders)
        assert not marts.keys_are_sound((orders, "order_id"))
        assert rows(marts.build_performance(*tables)) == rows(joined(*tables))
    assert marts.build_performance(*star(spark, repeated)).count() == 9
    assert marts.keys_are_sound((orders_of(spark, "O1", "O2"), "order_id"))


def test_repeated_customers_multiply_fact_rows(spark):
    customers = customers_of(spark, ("C1", 50.0, 5.0), ("C1", 51.0, 5.0))
    assert marts.fact_shipments(orders_of(spark, "O1"), customers).count() == 2


def test_staging(spark):
    orders, customers, _, _ = star(spark, orders_of(spark, "O1").withColumn("extra", F.lit(1)))
    assert marts.stg_orders(orders).columns == S.STG_ORDERS
    assert marts.stg_customers(customers).columns == S.STG_CUSTOMERS
    assert marts.dim_customers(customers).count() == 2

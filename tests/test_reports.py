"""Reports over a small mart, idle warehouses and empty selections included."""
from datetime import datetime

import pytest

from cargolens.operators import filters
from cargolens.plans import analytics as a
from cargolens.plans import marts, rollup
from conftest import rows

DAY1, DAY2 = datetime(2026, 1, 1, 23), datetime(2026, 1, 2, 1)


@pytest.fixture(scope="module")
def dp(spark):
    schema = ("order_id string, customer_id string, warehouse_id string, order_date timestamp_ntz,"
              " status string, package_weight_kg double, package_size string, priority string,"
              " customer_city string, customer_country string, route_id string, distance_km double,"
              " estimated_delivery_hours double, transport_mode string, temperature double,"
              " wind_speed double, risk_score int, risk_category string")
    data = [
        ("O1", "C1", "W1", DAY1, "shipped", 1.0, "small", "express", "x", "SE", "R1", 100.0, 2.0,
         "van", 1.0, 1.0, 0, "LOW"),
        ("O2", "C1", "W1", DAY2, "shipped", 3.0, "large", "express", "x", "SE", "R2", 300.0, 6.0,
         "van", 1.0, 1.0, 70, "CRITICAL"),
        ("O3", "C2", "W2", DAY2, "created", 5.0, "small", "standard", "y", "NO", "R3", 4000.0, 17.0,
         "air", None, None, 50, "HIGH"),
        ("O4", "CX", "W9", DAY2, "created", 7.0, "small", "standard", None, None, None, None, None,
         None, None, None, None, None)]
    frame = spark.createDataFrame(data, schema)
    assert frame.columns == marts.PERFORMANCE
    return frame


@pytest.fixture(scope="module")
def depots(spark):
    return spark.createDataFrame(
        [("W1", "North", "a", "SE", 1.0, 2.0, 10), ("W2", "South", "b", "NO", 3.0, 4.0, 20),
         ("W3", "Idle", "c", "FI", 5.0, 6.0, 30)],
        "warehouse_id string, name string, city string, country string, latitude double,"
        " longitude double, capacity bigint")


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("C1", "Ann", "Lee", "x", "SE", 1.0, 2.0), ("C2", "Bo", "Ek", "y", "NO", 3.0, 4.0),
         ("C3", "No", "One", "z", "FI", 5.0, 6.0)],
        "customer_id string, first_name string, last_name string, city string, country string,"
        " latitude double, longitude double")


NONE = {"statuses": ["nothing"]}


def test_overview(dp):
    m = a.overview_metrics(dp).first()
    assert (m.shipments, m.customers, m.warehouses, m.high_risk_shipments) == (4, 3, 3, 2)
    assert (m.avg_weight, m.avg_risk) == (4.0, 40.0)


def test_key_figures_of_an_empty_selection(dp):
    for report in (a.overview_metrics, a.customer_metrics, a.risk_metrics, a.route_metrics,
                   a.warehouse_metrics):
        got = report(dp, NONE).collect()
        assert len(got) == 1
        assert all(v in (0, None) for v in got[0])
    assert a.shipment_status(dp, NONE).count() == 0


def test_distributions(dp):
    assert [tuple(r) for r in a.shipment_status(dp).collect()] == [("created", 2), ("shipped", 2)]
    assert rows(a.priority_distribution(dp)) == [("express", 2), ("standard", 2)]
    assert [tuple(r) for r in a.package_sizes(dp).collect()] == [("small", 3), ("large", 1)]
    assert [r.shipments for r in a.shipment_timeline(dp).collect()] == [1, 3]
    assert [r.risk_category for r in a.risk_summary(dp).collect()] == \
        ["LOW", "HIGH", "CRITICAL", None]
    assert [tuple(r) for r in a.shipments_by_country(dp, top=2).collect()] == [("SE", 2), ("NO", 1)]
    assert [tuple(r) for r in a.package_behaviour(dp).collect()] == \
        [("small", 3, 13 / 3), ("large", 1, 3.0)]


def test_route_performance(dp):
    got = [tuple(r) for r in a.route_performance(dp).collect()]
    assert got == [("air", 1, 4000.0, 17.0, 4000 / 17), ("van", 2, 200.0, 4.0, 50.0),
                   (None, 1, None, None, None)]


def test_speed_without_hours(dp):
    still = dp.withColumn("estimated_delivery_hours", dp.estimated_delivery_hours * 0)
    assert a.route_metrics(still).first().avg_speed is None


def test_idle_warehouse_shows_only_without_filter(dp, depots):
    got = [tuple(r) for r in a.warehouse_performance(dp, depots).collect()]
    assert got == [("North", "a", "SE", 10, 2, 200.0, 4.0, 35.0),
                   ("South", "b", "NO", 20, 1, 4000.0, 17.0, 50.0),
                   ("Idle", "c", "FI", 30, 0, None, None, None)]
    kept = a.warehouse_performance(dp, depots, {"statuses": ["shipped", "created"]})
    assert [r.name for r in kept.collect()] == ["North", "South"]
    assert a.warehouse_performance(dp, depots, {"warehouses": ["Idle"]}).count() == 0


def test_warehouses_of_equal_name_are_one_row(dp, spark):
    twins = spark.createDataFrame([("W1", "Hub", "a", "SE", 10), ("W2", "Hub", "a", "SE", 10)],
                                  "warehouse_id string, name string, city string, country string,"
                                  " capacity bigint")
    got = a.warehouse_performance(dp, twins).collect()
    assert [tuple(r)[4:6] for r in got] == [(3, 4400 / 3)]


def test_capacity_index(dp, depots):
    got = {r.name: r.utilisation_idx for r in a.capacity_index(dp, depots).collect()}
    assert got == {"North": 100.0, "South": 50.0, "Idle": 0.0}
    empty = a.capacity_index(dp.where("false"), depots).collect()
    assert [r.utilisation_idx for r in empty] == [0.0, 0.0, 0.0]


def test_other_warehouse_reports(dp, depots):
    assert [tuple(r) for r in a.risk_by_warehouse(dp, depots).collect()] == \
        [("W2", "South", 1, 50.0), ("W1", "North", 2, 35.0)]
    assert [tuple(r) for r in a.routes_by_warehouse(dp, depots).collect()] == \
        [("North", 2, 200.0), ("South", 1, 4000.0)]
    assert rows(a.warehouse_network(dp, depots), "name", "routes") == \
        [("Idle", 0), ("North", 2), ("South", 1)]
    assert a.warehouse_locations(depots).columns == ["name", "city", "country", "latitude",
                                                     "longitude"]


def test_top_customers_leave_out_unknown_ones(dp, people):
    got = [tuple(r) for r in a.top_customers(dp, people).collect()]
    assert got == [("C1", "Ann Lee", "SE", 2, 2.0), ("C2", "Bo Ek", "NO", 1, 5.0)]
    assert a.top_customers(dp, people, top=1).count() == 1


def test_customer_locations(dp, people):
    assert rows(a.customer_locations(dp, people), "customer_id") == [("C1",), ("C2",)]
    shipped = a.customer_locations(dp, people, {"statuses": ["shipped"]})
    assert rows(shipped, "customer_id") == [("C1",)]


def test_lists(dp):
    assert [r.order_id for r in a.highest_risk(dp).collect()] == ["O2", "O3", "O1", "O4"]
    assert [r.order_id for r in a.longest_routes(dp, top=2).collect()] == ["O3", "O2"]
    assert a.route_points(dp, {"risk": ["LOW"]}).count() == 1
    assert a.weather_impact(dp).columns == ["temperature", "wind_speed", "risk_score"]


def test_histograms(dp):
    assert rows(a.distance_histogram(dp)) == [(0, 1), (1, 1), (29, 1)]
    assert rows(a.risk_histogram(dp)) == [(0, 1), (14, 1), (19, 1)]


def shipments_of(spark, n):
    return spark.range(n).selectExpr(
        "concat('O', id) order_id", "concat('C', id % 70000) customer_id", "concat('W', id % 2) warehouse_id",
        "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(cast(id % 3 as int)) order_date",
        "if(id % 2 = 0, 'shipped', 'created') status", "cast(id % 9 as double) package_weight_kg",
        "'small' package_size", "if(id % 5 = 0, 'express', 'standard') priority", "'x' customer_city",
        "'SE' customer_country", "concat('R', id) route_id", "if(id % 7 = 0, null, cast(id as double)) distance_km",
        "cast(id % 11 as double) estimated_delivery_hours", "if(id % 4 = 0, 'air', 'van') transport_mode",
        "1.5D temperature", "2.5D wind_speed", "cast(id % 80 as int) risk_score",
        "if(id % 80 > 64, 'CRITICAL', 'LOW') risk_category")


def test_rollup_gives_the_same_figures(spark, dp, depots, tmp_path):
    """Also with customers over several pages of bits, and over no rows at all."""
    filters = [None, {"statuses": ["shipped"]}, {"priorities": ["express"], "risk": ["CRITICAL"]},
               {"warehouses": ["North"]}, {"statuses": ["nothing"]}]
    large = shipments_of(spark, 75_000).withColumn("warehouse_id", a.F.expr("translate(warehouse_id, '0', '2')"))
    for number, mart in enumerate((dp, large, dp.where("false"))):
        root = f"{tmp_path}/{number}"
        rollup.build(spark, root, mart)
        for chosen in filters:
            for mine, whole in ((rollup.overview_metrics, a.overview_metrics),
                                (rollup.customer_metrics, a.customer_metrics)):
                got = mine(spark, root, chosen, depots)
                assert rows(got)[0] == pytest.approx(rows(whole(mart, chosen, depots), *got.columns)[0])


def test_rollup_of_many_combinations_takes_room_by_its_shipments(spark, tmp_path):
    """Where every shipment is a combination of its own, a set of one customer is a narrow row and not a page of bits."""
    mart = shipments_of(spark, 2000).withColumn("warehouse_id", a.F.expr("translate(order_id, 'O', 'W')"))
    rollup.build(spark, str(tmp_path), mart)
    sets = spark.read.parquet(f"{tmp_path}/customers")
    room = sets.agg(a.F.count("*"), a.F.max(a.F.octet_length(a.F.col("customers").cast("string")))).first()
    assert room[0] == 2000 and room[1] <= 20


def test_few_chosen_warehouses_of_many_are_broadcast(spark, dp, tmp_path):
    """The list of the chosen ones is small, though the table that it comes from is not."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    many = spark.range(20_000).selectExpr("concat('W', id) warehouse_id", "concat('N', id) name")
    many.write.parquet(f"{tmp_path}/many")
    spark.conf.set(key, "20k")
    try:
        kept = filters.apply_filters(dp, {"warehouses": ["N1", "N9"]}, spark.read.parquet(f"{tmp_path}/many"))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert rows(kept, "order_id") == [("O1",), ("O2",), ("O4",)]
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_dense_numbers(spark):
    keys = spark.range(5000).selectExpr("if(id % 10 = 9, null, concat('k', id % 800)) as k").repartition(7)
    numbers = [r["number"] for r in rollup.dense_numbers(keys, "k").collect()]
    assert sorted(numbers) == list(range(1, 721))


def test_samples_are_bounded_and_stable(spark):
    mart = shipments_of(spark, 5000)
    for sample, group in ((a.route_points_sample, "transport_mode"), (a.weather_impact_sample, None)):
        chosen = rows(sample(mart, size=50))
        assert len(chosen) == 100
        assert chosen == rows(sample(mart.repartition(13, "status"), size=50))
        assert chosen == rows(sample(mart.coalesce(1).orderBy("distance_km"), size=50))
    # The least of the parts hold the least of the whole.
    halves = [a.route_points_sample(mart.where(f"length(order_id) % 2 = {k}"), size=50) for k in (0, 1)]
    assert set(rows(a.route_points_sample(mart, size=50))) <= {r for h in halves for r in rows(h)}
    assert a.route_points_sample(mart, {"statuses": ["none"]}).collect() == []

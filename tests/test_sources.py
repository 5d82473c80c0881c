"""Landing, replay, typed projection, lake and rebuild."""
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.plans import build, marts, transforms
from cargolens.sources import bronze, conform, lake, reference
from cargolens.sources.workspace import stored, workspace
from conftest import rows

RECORD = {
    "customer_id": "c-1", "title": "Ms", "first_name": "Wilma", "last_name": "Okafor",
    "gender": "female", "email": "w.okafor@example.eu", "phone": "+48-12-555-0199",
    "street_number": 7, "street_name": "Harbour Lane", "city": "Gdansk",
    "state": "Pomerania", "country": "Poland", "postcode": "80-001",
    "latitude": 54.352, "longitude": 18.6466, "registered_date": "2021-05-06T00:00:00",
    "nationality": "PO"}


def payload(path, name, *records):
    body = {"results": list(records), "info": {"seed": "s", "results": len(records)}}
    (path / name).write_text(json.dumps(body, indent=2), encoding="utf-8")


def replay(spark, path):
    return bronze.replay_customers(spark, str(path), multi_line=True)


def test_indented_payload_is_typed(spark, tmp_path):
    payload(tmp_path, "customers_20260102_030405_000006.json", {**RECORD, "unexpected": "x"},
            {**RECORD, "customer_id": "c-2", "latitude": " 52.5 ", "street_number": "7"})
    raw = replay(spark, tmp_path)
    typed = conform.conform(raw, S.CUSTOMERS)
    assert typed.dtypes == [(f.name, f.dataType.simpleString()) for f in S.CUSTOMERS]
    assert rows(typed, "customer_id", "latitude", "street_number") == \
        [("c-1", 54.352, 7), ("c-2", 52.5, 7)]
    assert raw.first().ingested_at == datetime(2026, 1, 2, 3, 4, 5, 6)


@pytest.mark.parametrize("field", list(RECORD))
def test_missing_field_is_rejected(spark, tmp_path, field):
    payload(tmp_path, "customers_20260102_030405.json", RECORD,
            {k: v for k, v in RECORD.items() if k != field})
    valid, rejects = conform.split_rejects(replay(spark, tmp_path), S.CUSTOMERS)
    assert valid.count() == 1
    assert [r.reject_reason for r in rejects.collect()] == [[f"{field}:missing"]]


def test_wrong_type_is_rejected(spark, tmp_path):
    payload(tmp_path, "customers_1.json", {**RECORD, "latitude": "abc", "street_number": "4x"})
    raw = replay(spark, tmp_path)
    _, rejects = conform.split_rejects(raw, S.CUSTOMERS)
    assert rejects.first().reject_reason == ["street_number:invalid", "latitude:invalid"]
    assert rejects.first().latitude == "abc"
    with pytest.raises(conform.RejectedRecords, match="1 records"):
        conform.conform(raw, S.CUSTOMERS)


def test_column_the_input_lacks(spark):
    df = spark.createDataFrame([("a",)], "customer_id string")
    valid, rejects = conform.split_rejects(df, S.CUSTOMERS)
    assert (valid.count(), rejects.count()) == (0, 1)
    with pytest.raises(ValueError, match="missing columns: city, email"):
        conform.assert_columns(df, ["customer_id", "email", "city"])


def test_landed_customers_replay(spark, tmp_path):
    customers = spark.createDataFrame([{**RECORD, "customer_id": f"c-{i}"} for i in range(20)],
                                      S.CUSTOMERS)
    for stamp in ("20260102_030405_000006", "20260103_030405"):
        bronze.land_customers(customers, str(tmp_path), stamp)
    raw = bronze.replay_customers(spark, f"{tmp_path}/*")
    assert raw.count() == 40
    assert raw.select("ingested_at").distinct().count() == 2
    assert rows(conform.conform(raw, S.CUSTOMERS).distinct()) == rows(customers)


def test_indented_weather_array(spark, tmp_path):
    records = [{"warehouse_id": "WH-001", "timestamp": "2026-01-01 10:00:00.123456",
                "temperature": 20.5, "wind_speed": 10},
               {"warehouse_id": "WH-002", "timestamp": "2026-01-01", "temperature": None,
                "wind_speed": 1.5}]
    (tmp_path / "weather_20260101_100000.json").write_text(json.dumps(records, indent=2))
    got = bronze.replay_weather(spark, str(tmp_path), multi_line=True)
    assert rows(got.drop("ingested_at")) == [
        ("WH-001", datetime(2026, 1, 1, 10, 0, 0, 123456), 20.5, 10.0),
        ("WH-002", datetime(2026, 1, 1), None, 1.5)]


def test_weather_history_takes_the_last_landing(spark, tmp_path):
    at = datetime(2026, 1, 1, 10, 0, 0, 5)
    first = spark.createDataFrame([("A", at, 1.0, 1.0), ("B", at, 2.0, 2.0)], S.WEATHER)
    second = spark.createDataFrame([("A", at, None, 9.0)], S.WEATHER)
    bronze.land_weather(second, str(tmp_path), "20260102_000000")
    bronze.land_weather(first, str(tmp_path), "20260101_000000")
    history = bronze.weather_history(bronze.replay_weather(spark, f"{tmp_path}/*"))
    assert rows(history) == [("A", at, None, 9.0), ("B", at, 2.0, 2.0)]


def test_nested_weather_is_flattened(spark):
    api = spark.createDataFrame([("WH-001", "2026-01-01T00:00:00", (18.5, 6.2))],
                                bronze.API_WEATHER)
    flat = bronze.flatten_weather(api)
    assert flat.dtypes == [(f.name, f.dataType.simpleString()) for f in S.WEATHER]
    assert flat.first()[2:] == (18.5, 6.2)


def test_reference_tables(spark):
    depots = reference.reference_warehouses(spark)
    assert depots.dtypes == [(f.name, f.dataType.simpleString()) for f in S.WAREHOUSES]
    assert [r[0] for r in rows(depots, "warehouse_id")] == [f"WH-00{n}" for n in range(1, 5)]
    assert reference.reference_warehouses(spark, 2).count() == 2
    with pytest.raises(ValueError, match="the table has 4"):
        reference.reference_warehouses(spark, 5)
    towns = reference.cities(spark)
    assert towns.count() == towns.select("city").distinct().count() == 30


def test_registry():
    assert lake.table_path("/root", "routes") == "/root/gold/routes"
    assert lake.table_path("/root/", "orders") == "/root/silver/orders"
    with pytest.raises(KeyError):
        lake.table_path("/root", "nothing")


def test_save_round_trip_and_replace(spark, tmp_path):
    df = spark.createDataFrame([("WH-001", datetime(2026, 1, 1), 25.0, 5.0)], S.WEATHER)
    path = str(tmp_path / "does" / "not" / "exist")
    assert lake.save(df.unionByName(df), path) == 2
    assert lake.save(df, path) == 1
    back = spark.read.schema(S.WEATHER).parquet(path)
    assert back.dtypes == df.dtypes and rows(back) == rows(df)


def test_load_table(spark, tmp_path):
    for n in (3, 2):
        path = str(tmp_path / f"v{n}")
        spark.range(n).write.parquet(path)
        assert lake.load_table(spark, "weather", path) == n
        assert spark.table("weather").count() == n
    with pytest.raises(ValueError, match="unregistered table"):
        lake.load_table(spark, "not_registered", path)


def sources(spark):
    at = datetime(2026, 1, 1)
    towns = reference.cities(spark)
    customers = spark.createDataFrame(
        [{**RECORD, "customer_id": f"c-{i}", "latitude": r.latitude, "longitude": r.longitude}
         for i, r in enumerate(towns.collect())], S.CUSTOMERS)
    orders = spark.createDataFrame(
        [(f"o-{i}", f"c-{i % 30}", f"WH-00{1 + i % 4}", 1.0 + i, "small", "express", "shipped", at)
         for i in range(60)], S.ORDERS)
    weather = spark.createDataFrame([(f"WH-00{n}", at, 10.0 * n, 4.0 * n) for n in range(1, 4)],
                                    S.WEATHER)
    return {"customers": customers, "warehouses": reference.reference_warehouses(spark),
            "weather": weather, "orders": orders}


@pytest.mark.parametrize("repeated", [False, True])
def test_rebuild_is_repeatable_and_right(spark, tmp_path, repeated):
    tables = sources(spark)
    if repeated:
        tables["orders"] = tables["orders"].unionByName(tables["orders"].limit(1))
    root = str(tmp_path / "lake")
    first = rows(build.build_all(spark, root, tables))
    assert rows(build.build_all(spark, root, tables)) == first
    orders, n = tables["orders"].distinct(), 60
    found = {r[0]: r[3] for r in first}
    assert found["customers"] == 30 and found["warehouses"] == 4 and found["weather"] == 3
    assert found["orders"] == found["routes"] == found["delivery_risk"] == n
    assert found["delivery_performance"] == n
    for name, (_, schema) in lake.TABLES.items():
        written = spark.read.parquet(lake.table_path(root, name)).schema
        assert [(f.name, f.dataType) for f in written] == [(f.name, f.dataType) for f in schema]

    routes = transforms.build_routes(orders, tables["customers"], tables["warehouses"])
    risk = transforms.build_delivery_risk(routes, transforms.latest_weather(tables["weather"]))
    fact = marts.fact_shipments(orders, tables["customers"])
    assert rows(lake.read(spark, root, "routes")) == rows(routes)
    assert rows(lake.read(spark, root, "delivery_risk")) == rows(risk)
    assert rows(build.read_mart(spark, root, "fact_shipments")) == rows(fact)
    assert rows(build.read_mart(spark, root, "delivery_performance")) == \
        rows(marts.delivery_performance(fact, routes, risk))
    with pytest.raises(KeyError):
        build.read_mart(spark, root, "nothing")


def test_newest_orders(spark):
    at = datetime(2026, 1, 1)
    def order(name, status, when):
        return (name, "c", "w", 1.0, "small", "express", status, when)
    data = [order("a", "created", at), order("a", "shipped", at.replace(day=2)), order("b", "x", None),
            order("b", "y", at), order(None, "z", at), order(None, "z", at)]
    got = build.newest_orders(spark.createDataFrame(data, S.ORDERS))
    assert sorted((r.order_id or "", r.status) for r in got.collect()) == [
        ("", "z"), ("", "z"), ("a", "shipped"), ("b", "y")]


def test_catalog_load(spark, tmp_path):
    root = str(tmp_path / "lake")
    build.build_all(spark, root, sources(spark))
    spark.sql("create database if not exists loaded")
    audit = build.load_catalog(spark, root, "loaded")
    assert {r.table_name: r.rows for r in audit.collect()} == {
        "customers": 30, "warehouses": 4, "weather": 3, "orders": 60, "routes": 60,
        "delivery_risk": 60}
    assert spark.table("loaded.routes").count() == 60


def test_stored_tables_lie_in_the_shared_folder(spark):
    df = stored(spark.range(5).withColumn("x", F.lit(1.5)), "numbers")
    assert df.count() == 5
    assert all(f.startswith(workspace(spark)) for f in df.inputFiles())
    assert workspace(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_documents_that_cannot_be_replayed(spark, tmp_path):
    path = str(tmp_path / "customers_20260102_030405_000006")
    good = '{"results": [{"customer_id": "c-1", "first_name": "A"}]}'
    texts = [good, good[:-9], '{"info": {"seed": "x"}}', good]
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(path)
    with pytest.raises(conform.RejectedRecords):
        bronze.replay_customers(spark, path)
    assert bronze.replay_customers(spark, path, on_error="skip").count() == 2
    reasons = {r["reason"]: r for r in bronze.customer_rejects(spark, path).collect()}
    assert set(reasons) == {"unreadable", "no results"}
    assert reasons["unreadable"]["record"] == texts[1]


def test_weather_that_cannot_be_replayed(spark, tmp_path):
    path = str(tmp_path / "weather_20260102_030405")
    texts = ['{"warehouse_id": "W", "timestamp": "2026-01-01T00:00:00", "temperature": 1, "wind_speed": 2}',
             '{"warehouse_id": "W", "temperature": "warm"}', '{"warehouse_id": ']
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(path)
    with pytest.raises(conform.RejectedRecords):
        bronze.replay_weather(spark, path)
    assert bronze.replay_weather(spark, path, on_error="skip").count() == 2
    assert sorted(r["reason"] for r in bronze.weather_rejects(spark, path).collect()) == [
        "temperature invalid", "unreadable"]

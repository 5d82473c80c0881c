"""Typed judging of JSON records and the way from landed files to the mart."""
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.plans import build
from cargolens.sources import bronze, conform, reference
from cargolens.streaming import ingest
from conftest import rows
from test_sources import RECORD, payload


def judged(spark, *records, **options):
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "text string")
    return conform.split_records(lines.select(F.parse_json("text").alias("record")), S.CUSTOMERS, **options)


def verdicts(spark, field, *values):
    """What each value becomes in the typed row, or the reason against it."""
    records = [{**RECORD, "customer_id": f"{k:02d}", field: v} for k, v in enumerate(values)]
    valid, rejects = judged(spark, *records)
    found = {r["customer_id"]: r[field] for r in valid.collect()}
    found |= {json.loads(r["record"])["customer_id"]: tuple(r["reject_reason"]) for r in rejects.collect()}
    return [found[f"{k:02d}"] for k in range(len(values))]


def test_text_has_to_be_a_string(spark):
    bad = ("first_name:invalid",)
    assert verdicts(spark, "first_name", "Ann", "", "5", 5, 5.0, True, [1], ["x"], {"a": 1}, None) == \
        ["Ann", "", "5", bad, bad, bad, bad, bad, bad, ("first_name:missing",)]


def test_whole_numbers(spark):
    bad = ("street_number:invalid",)
    values = [42, -7, 42.0, 42.5, "42", " 42\n", "42.0", "+3", "4x", "", "4 2", True, False, 2 ** 63, -2 ** 63,
              1e3, 1e30, "9" * 30, [42], {"n": 42}, None]
    assert verdicts(spark, "street_number", *values) == [
        42, -7, 42, bad, 42, 42, 42, 3, bad, bad, bad, 1, 0, bad, -2 ** 63, 1000, bad, bad, bad, bad,
        ("street_number:missing",)]


def test_numbers(spark):
    bad = ("latitude:invalid",)
    values = [1, 52.5, 1.25e2, "52.3676", " 52.5 ", "-.5", "1e2", "inf", "1d", "1f", "0x10", "abc", "", True, [1.0], None]
    assert verdicts(spark, "latitude", *values) == [
        1.0, 52.5, 125.0, 52.3676, 52.5, -0.5, 100.0, float("inf"), bad, bad, bad, bad, bad, 1.0, bad,
        ("latitude:missing",)]
    assert str(verdicts(spark, "latitude", "nan")[0]) == "nan"


def test_several_faults_and_extra_fields(spark):
    broken = {k: v for k, v in RECORD.items() if k != "email"} | {"city": 7, "extra": {"deep": [1]}}
    valid, rejects = judged(spark, RECORD | {"unexpected": "x"}, broken, {}, 5)
    assert rows(valid) == [tuple(RECORD[c] for c in S.CUSTOMERS.fieldNames())]
    found = {r["record"]: r["reject_reason"] for r in rejects.collect()}
    assert len(found) == 3 and found[json.dumps(broken, sort_keys=True, separators=(",", ":"))] == \
        ["email:missing", "city:invalid"]
    assert found["{}"] == found["5"] == [f"{c}:missing" for c in S.CUSTOMERS.fieldNames()]


def test_records_need_their_column(spark):
    with pytest.raises(ValueError, match="missing columns: record"):
        conform.judged_records(spark.range(1), S.CUSTOMERS)


@pytest.mark.parametrize("text,reason", [("{", "unreadable"), ('{"a": 1}', "no results"),
                                         ('{"results": 5}', "no results"), ("[]", "no results")])
def test_documents_that_are_no_payload(spark, text, reason):
    lines = spark.createDataFrame([("f", text), ("f", " "), ("f", '{"results": []}')], "file string, value string")
    assert rows(bronze.customer_documents(lines)) == [("f", text, reason, None)]


class Store:
    def __init__(self, spark, path):
        self.spark, self.landing, self.store = spark, f"{path}/landing", f"{path}/store"
        os.makedirs(self.landing)

    def run(self, feed=ingest.CUSTOMERS, **options):
        options = {"multi_line": True} | options
        query = ingest.ingest(self.spark, feed, self.landing, self.store, f"{self.store}/log", **options)
        return sum(p["numInputRows"] for p in query.recentProgress)

    def customers(self):
        return rows(ingest.silver_customers(self.spark, self.store), "customer_id", "city")


def test_each_file_is_opened_once(spark, tmp_path):
    it = Store(spark, tmp_path)
    landing = tmp_path / "landing"
    payload(landing, "customers_20260101_000000.json", RECORD, {**RECORD, "customer_id": "c-2"})
    assert it.run() == 1
    assert it.customers() == [("c-1", "Gdansk"), ("c-2", "Gdansk")]
    # The first file would be rejected if it were opened again.
    (landing / "customers_20260101_000000.json").write_text("{cut off")
    payload(landing, "customers_20260102_000000.json", {**RECORD, "city": "Oslo"})
    payload(landing, "other_20260102_000000.json", {**RECORD, "city": "Bergen"})
    assert it.run() == 1
    assert it.customers() == [("c-1", "Oslo"), ("c-2", "Gdansk")]
    assert it.run() == 0
    assert it.customers() == [("c-1", "Oslo"), ("c-2", "Gdansk")]


def test_an_older_landing_that_comes_late_does_not_win(spark, tmp_path):
    it = Store(spark, tmp_path)
    payload(tmp_path / "landing", "customers_20260105_000000.json", {**RECORD, "city": "New"})
    it.run()
    payload(tmp_path / "landing", "customers_20260101_000000.json", {**RECORD, "city": "Old"})
    it.run()
    assert it.customers() == [("c-1", "New")]


def test_a_bad_record_fails_the_run_and_is_read_again(spark, tmp_path):
    it = Store(spark, tmp_path)
    bad = tmp_path / "landing" / "customers_20260101_000000.json"
    payload(tmp_path / "landing", bad.name, RECORD, {**RECORD, "first_name": 5})
    with pytest.raises(conform.RejectedRecords, match="1 landed customers"):
        it.run()
    assert it.customers() == []
    assert it.run(on_error="skip") == 1
    assert it.customers() == [("c-1", "Gdansk")]
    found = ingest.rejects(spark, ingest.CUSTOMERS, it.store).collect()
    assert [(r["reason"], r["reject_reason"], json.loads(r["record"])["first_name"]) for r in found] == \
        [(None, ["first_name:invalid"], 5)]
    with pytest.raises(ValueError, match="on_error"):
        it.run(on_error="ignore")


def test_broken_documents_are_kept_as_text(spark, tmp_path):
    it = Store(spark, tmp_path)
    folder = tmp_path / "landing" / "customers_20260101_000000"
    folder.mkdir()
    (folder / "part-0.json").write_text('{"results": [1\n\n{"info": 1}\n' + json.dumps({"results": [RECORD]}) + "\n")
    it.run(multi_line=False, on_error="skip")
    assert it.customers() == [("c-1", "Gdansk")]
    assert rows(ingest.rejects(spark, ingest.CUSTOMERS, it.store), "reason", "record") == [
        ("no results", '{"info": 1}'), ("unreadable", '{"results": [1')]


def test_weather_as_list_line_and_nested_answer(spark, tmp_path):
    it = Store(spark, tmp_path)
    at = "2026-01-01 10:00:00.123456"
    flat = {"warehouse_id": "WH-001", "timestamp": at, "temperature": 20.5, "wind_speed": 10}
    nested = {"warehouse_id": "WH-002", "timestamp": "2026-01-01T00:00:00",
              "current_weather": {"temperature": 18, "windspeed": 6.25, "time": "x"}}
    empty = {"warehouse_id": "WH-003", "timestamp": at, "temperature": None, "wind_speed": None}
    bad = {**flat, "warehouse_id": "WH-004", "temperature": "warm"}
    (tmp_path / "landing" / "weather_20260101_100000.json").write_text(json.dumps([flat, nested, empty, bad], indent=1))
    (tmp_path / "landing" / "weather_20260102_100000.json").write_text(json.dumps({**flat, "wind_speed": 11}))
    it.run(ingest.WEATHER, on_error="skip")
    noted = datetime(2026, 1, 1, 10, 0, 0, 123456)
    assert rows(ingest.silver_weather(spark, it.store)) == [
        ("WH-001", noted, 20.5, 11.0), ("WH-002", datetime(2026, 1, 1), 18.0, 6.25),
        ("WH-003", noted, None, None)]
    assert rows(ingest.rejects(spark, ingest.WEATHER, it.store).select("reject_reason")) == [(["temperature:invalid"],)]


def test_bronze_to_mart(spark, tmp_path):
    landing, root = tmp_path / "landing", f"{tmp_path}/lake"
    landing.mkdir()
    depots = reference.reference_warehouses(spark)
    at = datetime(2026, 1, 1, 12)
    orders = spark.createDataFrame([(f"o-{k}", f"c-{k}", "WH-001", 1.0, "small", "express", "created", at)
                                    for k in range(3)], S.ORDERS)
    payload(landing, "customers_20260101_000000.json", *({**RECORD, "customer_id": f"c-{k}"} for k in range(2)))
    (landing / "weather_20260101_000000.json").write_text(json.dumps(
        {"warehouse_id": "WH-001", "timestamp": str(at), "temperature": 30, "wind_speed": 1}))

    def built():
        audit = build.build_from_bronze(spark, root, str(landing), depots, orders, multi_line=True)
        mart = build.read_mart(spark, root, "delivery_performance")
        return {r["table_name"]: r["rows"] for r in audit.collect()}, \
            rows(mart, "order_id", "customer_city", "temperature", F.col("route_id").isNotNull())

    counts, mart = built()
    assert (counts["customers"], counts["weather"], counts["routes"]) == (2, 1, 2)
    assert mart == [("o-0", "Gdansk", 30.0, True), ("o-1", "Gdansk", 30.0, True), ("o-2", None, None, False)]
    for old in os.listdir(landing):
        (landing / old).write_text("[not read again")
    payload(landing, "customers_20260103_000000.json", {**RECORD, "customer_id": "c-2"},
            {**RECORD, "customer_id": "c-0", "city": "Turku"})
    counts, mart = built()
    assert (counts["customers"], counts["weather"], counts["routes"]) == (3, 1, 3)
    assert mart == [("o-0", "Turku", 30.0, True), ("o-1", "Gdansk", 30.0, True), ("o-2", "Gdansk", 30.0, True)]


def test_jobs_check_their_columns(spark, tmp_path):
    depots = reference.reference_warehouses(spark)
    frames = {"customers": spark.createDataFrame([], S.CUSTOMERS), "warehouses": depots,
              "weather": spark.createDataFrame([], S.WEATHER), "orders": spark.createDataFrame([], S.ORDERS)}
    for name, needed in S.REQUIRED.items():
        with pytest.raises(ValueError, match=f"missing columns: {needed[0]}"):
            build.build_all(spark, str(tmp_path), frames | {name: frames[name].drop(needed[0])})

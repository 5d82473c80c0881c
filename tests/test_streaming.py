"""Streams over several files and runs give what a batch over all of them gives."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens import schemas as S
from cargolens.plans import marts, transforms
from cargolens.sources import reference
from cargolens.streaming import ledger, shipments
from conftest import rows

START = datetime(2026, 1, 1)


def orders_of(spark, first, last):
    data = [(f"o-{i}", f"c-{i % 30}", f"WH-00{1 + i % 4}", 1.0 + i, "small", "express", "shipped",
             START + timedelta(hours=i)) for i in range(first, last)]
    return spark.createDataFrame(data, S.ORDERS)


@pytest.fixture
def world(spark):
    towns = reference.cities(spark).withColumn("n", F.row_number().over(
        Window.orderBy("city")))
    customers = towns.select(
        F.concat(F.lit("c-"), F.col("n") - 1).alias("customer_id"), F.lit("A").alias("first_name"),
        F.lit("B").alias("last_name"), F.lit("e").alias("email"), "city", "state", "country",
        "latitude", "longitude")
    weather = spark.createDataFrame([("WH-001", START, 30.0, 12.0)], S.WEATHER)
    return customers, reference.reference_warehouses(spark), transforms.latest_weather(weather)


class Feed:
    """A folder that receives orders, and the stream over it."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path = spark, str(tmp_path / "feed")
        self.out, self.checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def add(self, df):
        df.write.mode("append").parquet(self.path)

    @property
    def stream(self):
        return (self.spark.readStream.schema(S.ORDERS).option("maxFilesPerTrigger", 1)
                .parquet(self.path))

    @property
    def all(self):
        return self.spark.read.schema(S.ORDERS).parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_timeline_over_two_runs(spark, feed):
    expected = None
    for part in (orders_of(spark, 0, 30), orders_of(spark, 20, 80)):
        feed.add(part.coalesce(2))
        got = shipments.run_timeline(feed.stream, feed.out, feed.checkpoint)
        expected = feed.all.groupBy(F.to_date("created_at").alias("date")).count()
        assert rows(got) == rows(expected)
    assert expected.count() == 4


def test_dedupe_across_files_and_runs(spark, feed):
    hot = orders_of(spark, 5, 6)
    feed.add(orders_of(spark, 0, 30).unionByName(hot).unionByName(hot).repartition(3))
    shipments.run_dedupe(feed.stream, feed.out, feed.checkpoint)
    feed.add(orders_of(spark, 10, 50).coalesce(1))
    got = shipments.run_dedupe(feed.stream, feed.out, feed.checkpoint)
    assert rows(got) == rows(orders_of(spark, 0, 50))


def test_streamed_risk_equals_batch(spark, feed, world):
    customers, warehouses, latest = world
    feed.add(orders_of(spark, 0, 60).repartition(3))
    got = shipments.run_risk(feed.stream, *world, feed.out, feed.checkpoint)
    routes = transforms.build_routes(feed.all, customers, warehouses)
    assert got.columns == S.DELIVERY_RISK.fieldNames()
    assert rows(got) == rows(transforms.build_delivery_risk(routes, latest))


def test_mart_refresh_rewrites_touched_days_only(spark, feed, world):
    feed.add(orders_of(spark, 0, 60).coalesce(1))
    shipments.run_mart(feed.stream, feed.out, feed.checkpoint, *world)
    before = {f for f in spark.read.parquet(f"{feed.out}/mart").inputFiles()}
    late = orders_of(spark, 50, 60).withColumn("status", F.lit("delivered"))
    feed.add(late.coalesce(1))
    got = shipments.run_mart(feed.stream, feed.out, feed.checkpoint, *world)
    after = {f for f in spark.read.parquet(f"{feed.out}/mart").inputFiles()}
    assert any("order_day=2026-01-01" in f for f in before & after)
    assert not any("order_day=2026-01-03" in f for f in before & after)
    current = orders_of(spark, 0, 50).unionByName(late)
    assert rows(got) == rows(marts.build_performance(current, *world))


def test_repeated_batch_changes_nothing(spark, feed, world):
    batch = orders_of(spark, 0, 30)
    for _ in range(2):
        shipments.refresh_mart(batch, 0, feed.out, *world)
    assert spark.read.parquet(f"{feed.out}/mart").count() == 30


def test_refresh_keeps_orders_without_day_or_id(spark, feed, world):
    undated = orders_of(spark, 0, 3).withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    unnamed = orders_of(spark, 3, 5).withColumn("order_id", F.lit(None).cast("string"))
    batch = orders_of(spark, 10, 20).unionByName(undated).unionByName(unnamed)
    shipments.refresh_mart(batch, 0, feed.out, *world)
    got = spark.read.parquet(f"{feed.out}/mart").select(*marts.PERFORMANCE)
    assert rows(got) == rows(marts.build_performance(batch, *world))
    assert got.count() == 15


def test_a_moved_order_stands_under_its_new_day_only(spark, feed, world):
    at = [START + timedelta(days=n) for n in range(3)]
    def version(name, day, status):
        return (name, "c-1", "WH-001", 1.0, "small", "express", status, day)
    batches = [[version("a", at[0], "created"), version("b", at[0], "created")],
               [version("a", at[1], "shipped")],
               [version("a", at[2], "late"), version("a", at[1], "early"), version("b", at[0], "shipped")],
               [version("b", at[2], "delivered")]]
    for number, data in enumerate(batches):
        for _ in range(2):  # a repeated batch changes nothing
            shipments.refresh_mart(spark.createDataFrame(data, S.ORDERS), number, feed.out, *world)
    got = shipments.read_mart(spark, feed.out)
    assert rows(got, "order_id", "status", "order_date") == [
        ("a", "late", at[2]), ("b", "delivered", at[2])]


def backwards(spark, feed, parts):
    """Files in an order in which most orders are late."""
    for part in parts:
        feed.add(part.coalesce(1))


def test_late_and_undated_orders_count(spark, feed):
    undated = orders_of(spark, 900, 902).withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    backwards(spark, feed, [orders_of(spark, 600, 610), orders_of(spark, 0, 5), undated,
                            orders_of(spark, 300, 303)])
    got = shipments.run_timeline(feed.stream, feed.out, feed.checkpoint)
    expected = feed.all.groupBy(F.to_date("created_at").alias("date")).count()
    assert rows(got) == rows(expected)
    assert sum(r.shipments for r in got.collect()) == 20


def test_late_repeats_are_recognised_and_unnamed_orders_stay(spark, feed):
    unnamed = orders_of(spark, 900, 903).withColumn("order_id", F.lit(None).cast("string"))
    backwards(spark, feed, [orders_of(spark, 600, 610), orders_of(spark, 0, 5).unionByName(unnamed),
                            orders_of(spark, 0, 610), unnamed])
    got = shipments.run_dedupe(feed.stream, feed.out, feed.checkpoint)
    assert rows(got) == rows(orders_of(spark, 0, 610).unionByName(unnamed).unionByName(unnamed))


def test_streams_over_nothing(spark, feed, world):
    feed.add(orders_of(spark, 0, 1).where("false"))
    assert shipments.run_timeline(feed.stream, feed.out, feed.checkpoint).collect() == []
    assert shipments.run_dedupe(feed.stream, feed.out + "2", feed.checkpoint + "2").collect() == []
    assert shipments.run_risk(feed.stream, *world, feed.out + "3",
                              feed.checkpoint + "3").collect() == []


def parquet_files(path):
    return sorted(str(f) for f in path.rglob("part-*.parquet"))


def spoil(files):
    """Files that nobody can read any more."""
    for f in files:
        with open(f, "wb") as out:
            out.write(b"not parquet")


def test_refresh_opens_the_days_of_its_batch_only(spark, feed, world, tmp_path):
    shipments.refresh_mart(orders_of(spark, 0, 120), 0, feed.out, *world)
    for kind in ("orders_by_day", "mart"):
        spoil(f for f in parquet_files(tmp_path / "out" / kind) if "order_day=2026-01-02" not in f)
    late = orders_of(spark, 30, 36).withColumn("status", F.lit("delivered"))
    shipments.refresh_mart(late, 1, feed.out, *world)
    day = spark.read.parquet(f"{feed.out}/mart/order_day=2026-01-02").select(*marts.PERFORMANCE)
    current = orders_of(spark, 24, 30).unionByName(late).unionByName(orders_of(spark, 36, 48))
    assert rows(day) == rows(marts.build_performance(current, *world))


def test_days_hold_no_earlier_versions(spark, feed, world):
    for number in range(4):
        batch = orders_of(spark, 0, 24).withColumn("status", F.lit(f"s{number}"))
        shipments.refresh_mart(batch, number, feed.out, *world)
    assert spark.read.parquet(f"{feed.out}/orders_by_day").count() == 24
    assert rows(shipments.read_mart(spark, feed.out).select("status").distinct()) == [("s3",)]


def test_first_version_in_time_stays(spark, feed):
    first = orders_of(spark, 0, 20)
    later = first.withColumns({"created_at": F.expr("created_at + interval 1 hour"), "status": F.lit("later")})
    heavier = first.withColumn("package_weight_kg", F.col("package_weight_kg") + 1)
    undated = first.withColumns({"created_at": F.lit(None).cast("timestamp_ntz"), "status": F.lit("undated")})
    feed.add(later.unionByName(heavier).unionByName(undated).unionByName(first).coalesce(1))
    feed.add(undated.unionByName(orders_of(spark, 20, 22)).coalesce(1))
    got = shipments.run_dedupe(feed.stream, feed.out, feed.checkpoint)
    assert rows(got) == rows(orders_of(spark, 0, 22))


def test_ranges_of_a_ledger():
    for n in range(700):
        found = ledger.ranges(n)
        assert [k for a, b in found for k in range(a, b)] == list(range(n))
        assert all(a % (b - a) == 0 for a, b in found)
        assert len(found) <= 7 * 4


def test_ledger(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "FAN", 3)
    it = ledger.Ledger(spark, str(tmp_path), T.StructField("id", T.StringType()), T.StructField("day", T.LongType()))
    known = {}
    for number in range(11):
        new = {f"i{(number * 5 + k) % 23}": number for k in range(4)}
        asked = spark.createDataFrame([(f"i{k}",) for k in range(0, 23, 2)], "id string")
        for _ in range(2):  # a batch that runs again
            want = sorted((k, v) for k, v in known.items() if int(k[1:]) % 2 == 0)
            assert rows(it.before(number, asked)) == want
            it.add(number, spark.createDataFrame(list(new.items()), "id string, day bigint"))
        known |= new


def test_a_lookup_opens_few_files(spark, tmp_path):
    """One id is looked up: the files opened are those of its hash folder in a few ranges."""
    it = ledger.Ledger(spark, str(tmp_path), T.StructField("id", T.StringType()), T.StructField("day", T.LongType()))
    for number in range(ledger.FAN + 2):
        it.add(number, spark.range(200).selectExpr(f"concat('i', id + {200 * number}) as id", "id as day"))
    asked = spark.createDataFrame([("i77",)], "id string")
    bucket = asked.select(F.pmod(F.xxhash64("id"), F.lit(ledger.BUCKETS))).first()[0]
    spoil(f for f in parquet_files(tmp_path) if f"bucket={bucket}/" not in f or "/to=8/" in f and "from=0" not in f)
    assert rows(it.before(ledger.FAN + 2, asked)) == [("i77", 77)]

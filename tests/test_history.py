"""Type 2 history and as-of scores that grow by batches, against what one batch over everything gives."""
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.plans import transforms
from cargolens.sources import reference
from cargolens.streaming import asof, history
from conftest import rows

VERSION = "k string, at date, tie bigint, city string, n int"


def brute(versions):
    """(k, at, tie, city, n, valid_from, valid_to, is_current) of the versions that change something."""
    out = []
    for key in {v[0] for v in versions}:
        own = sorted((v for v in versions if v[0] == key), key=lambda v: (v[1] is not None, v[1] or date.min, v[2]))
        kept = [v for i, v in enumerate(own) if not i or own[i - 1][3:] != v[3:]]
        for v, following in zip(kept, [*kept[1:], None], strict=True):
            out.append((*v, v[1], following and following[1], following is None))
    return sorted(out, key=repr)


def versions(count, seed):
    pick = random.Random(seed)
    start = date(2026, 1, 1)
    return [(f"k{pick.randrange(6)}", start + timedelta(days=pick.randrange(12)), tie,
             pick.choice(["A", "B", None]), pick.choice([1, None])) for tie in range(count)]


def merged(spark, path, batches):
    for number, batch in enumerate(batches):
        history.merge_versions(spark, path, number, spark.createDataFrame(batch, VERSION), "k", "at", "tie")
    return history.read_history(spark, path)


@pytest.mark.parametrize("seed", range(3))
def test_batches_in_any_order(spark, tmp_path, seed):
    every = versions(60, seed)
    random.Random(seed).shuffle(every)
    got = merged(spark, str(tmp_path), [every[:10], every[10:45], every[45:]])
    assert got.columns == ["k", "at", "tie", "city", "n", "valid_from", "valid_to", "is_current"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(every)


def test_a_late_version_splits_and_unhides(spark, tmp_path):
    """A, A is one interval; a late B between the two makes three."""
    day = [date(2026, 1, d) for d in (1, 2, 3)]
    first = [("k", day[0], 1, "A", 1), ("k", day[2], 3, "A", 1), ("other", day[0], 9, "C", 1)]
    got = merged(spark, str(tmp_path), [first])
    assert rows(got.where("k = 'k'"), "valid_from", "valid_to", "is_current") == [(day[0], None, True)]
    got = merged(spark, str(tmp_path), [first, [("k", day[1], 2, "B", 1)]])
    assert rows(got.where("k = 'k'"), "city", "valid_from", "valid_to") == [
        ("A", day[0], day[1]), ("A", day[2], None), ("B", day[1], day[2])]


def test_repeated_versions_and_batches(spark, tmp_path):
    every = versions(20, 7)
    corrected = [(*v[:3], "Z", 5) for v in every[:4]]
    for _ in range(2):
        got = merged(spark, str(tmp_path), [every, corrected + corrected])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(every[4:] + corrected)


def test_odd_versions(spark, tmp_path):
    undated = [("k", None, 1, "A", 1), ("k", date(2026, 1, 1), 2, "B", 1)]
    got = merged(spark, str(tmp_path / "a"), [undated[1:], undated, []])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(undated)
    with pytest.raises(ValueError, match="versions without k"):
        merged(spark, str(tmp_path / "b"), [[(None, date(2026, 1, 1), 2, "B", 1)]])


def test_other_folders_are_not_opened(spark, tmp_path):
    merged(spark, str(tmp_path), [versions(60, 1)])
    one = spark.createDataFrame([("k3",)], "k string").select(F.pmod(F.xxhash64("k"), F.lit(history.BUCKETS))).first()[0]
    spoiled = [f for f in tmp_path.rglob("part-*.parquet") if f"bucket={one}/" not in str(f)]
    assert spoiled
    for f in spoiled:
        f.write_bytes(b"not parquet")
    history.merge_versions(spark, str(tmp_path), 1, spark.createDataFrame(
        [("k3", date(2026, 2, 1), 99, "New", 1)], VERSION), "k", "at", "tie")
    got = spark.read.parquet(f"{tmp_path}/bucket={one}").where("k = 'k3' and is_current")
    assert rows(got, "city") == [("New",)]


START = datetime(2026, 1, 1)


def orders_of(spark, hours):
    return spark.createDataFrame(
        [(f"o-{k}", "c-1", f"WH-00{1 + k % 3}", 1.0, "small", "express", "created",
          None if h is None else START + timedelta(hours=h)) for k, h in enumerate(hours)], S.ORDERS)


def weather_of(spark, *rows_):
    return spark.createDataFrame([(w, START + timedelta(hours=h), t, v, tie) for w, h, t, v, tie in rows_],
                                 "warehouse_id string, timestamp timestamp_ntz, temperature double, "
                                 "wind_speed double, tie bigint")


@pytest.fixture
def places(spark):
    customers = spark.createDataFrame([("c-1", 50.0, 5.0)], "customer_id string, latitude double, longitude double")
    return customers, reference.reference_warehouses(spark)


@pytest.mark.parametrize("shuffled", [False, True])
def test_late_weather(spark, tmp_path, places, shuffled, request):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    pick = random.Random(3)
    orders = orders_of(spark, [pick.randrange(24 * 9) for _ in range(80)] + [None, 0, 24, 48])
    weather = [(f"WH-00{1 + k % 3}", 6 * pick.randrange(4 * 8), pick.choice([None, 15.0, 22.0, 30.0]),
                pick.choice([None, 3.0, 7.0, 12.0]), k) for k in range(40)]
    weather += [("WH-001", 24, 30.0, 12.0, 100), ("WH-001", 24, None, None, 101), ("WH-009", 0, 1.0, 1.0, 102)]
    job = asof.RiskAsOf(spark, str(tmp_path), "tie")
    assert job.read().collect() == []
    half = orders.where("substring(order_id, 3) % 2 = 0")
    job.add_orders(0, half, *places)
    batches = [weather[30:], weather[:11], weather[11:30]]
    job.add_weather(0, weather_of(spark, *batches[0]))
    job.add_weather(1, weather_of(spark, *batches[1]))
    job.add_orders(1, orders.join(half, "order_id", "left_anti").select(*orders.columns), *places)
    for _ in range(2):  # a batch that runs again changes nothing
        job.add_weather(2, weather_of(spark, *batches[2]))
    routes = transforms.build_routes(orders, *places, carry=["created_at"])
    want = transforms.build_delivery_risk_asof(routes, weather_of(spark, *weather), "tie")
    assert rows(job.read()) == rows(want)


def test_late_weather_opens_its_days_only(spark, tmp_path, places):
    job = asof.RiskAsOf(spark, str(tmp_path), "tie")
    job.add_weather(0, weather_of(spark, ("WH-001", 0, 10.0, 1.0, 1), ("WH-001", 72, 10.0, 1.0, 2)))
    job.add_orders(0, orders_of(spark, list(range(0, 120, 3))), *places)
    for f in (tmp_path / "scores").rglob("part-*.parquet"):
        if "day=" in str(f) and "day=2026-01-02" not in str(f) and "day=2026-01-03" not in str(f) \
                and "day=2026-01-04" not in str(f):
            f.write_bytes(b"not parquet")
    job.add_weather(1, weather_of(spark, ("WH-001", 30, 30.0, 12.0, 3)))
    day = spark.read.parquet(f"{tmp_path}/scores/day=2026-01-02").where("warehouse_id = 'WH-001'")
    got = {r["created_at"].hour: r["temperature"] for r in day.collect()}
    assert got and all(t == (30.0 if h >= 6 else 10.0) for h, t in got.items())


def test_late_weather_of_one_warehouse_moves_the_orders_once(spark, tmp_path, places, no_broadcast, monkeypatch):
    """The orders of the days are not split into those of touched warehouses and others, and the others keep their scores."""
    plans, write = [], asof.stored
    monkeypatch.setattr(asof, "stored", lambda df, name: plans.append(
        (name, df._jdf.queryExecution().optimizedPlan().toString())) or write(df, name))
    job = asof.RiskAsOf(spark, str(tmp_path), "tie")
    first = [("WH-001", 0, 10.0, 1.0, 1), ("WH-002", 0, 12.0, 2.0, 2)]
    job.add_weather(0, weather_of(spark, *first))
    orders = orders_of(spark, list(range(0, 120, 3)))
    job.add_orders(0, orders, *places)
    late = ("WH-001", 30, 30.0, 12.0, 3)
    job.add_weather(1, weather_of(spark, late))
    routes = transforms.build_routes(orders, *places, carry=["created_at"])
    assert rows(job.read()) == rows(transforms.build_delivery_risk_asof(routes, weather_of(spark, *first, late), "tie"))
    names = [name for name, _ in plans]
    assert "routes" not in names and names.count("scores") == 1
    plan = dict(plans)["scores"]
    assert "LeftSemi" not in plan and "LeftAnti" not in plan and "Union" not in plan

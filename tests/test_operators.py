"""Joins, latest row, as-of, history, histogram and filters."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cargolens.operators import cells, filters, joins
from cargolens.operators.histogram import histogram
from cargolens.operators.latest import latest_per_key
from conftest import rows

START = datetime(2026, 1, 1)


def skewed(spark, n=6000):
    """A third of the rows has key 'hot', another sixth no key."""
    key = (F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, None)
           .otherwise((F.col("id") % 997).cast("string")))
    return spark.range(n).withColumn("key", key)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, no_broadcast, how):
    left = skewed(spark)
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 3), ("nobody", 4), (None, 5)],
                                  "key string, v int")
    plain = left.join(right, "key", how)
    salted = joins.lookup_join(left, right, "key", how, spread=["id"])
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_hot_keys_are_found(spark):
    found = rows(joins.hot_keys(skewed(spark), "key"))
    assert [k for k, _ in found] == ["hot"]
    assert 4 * 8 * 0.3 < found[0][1] <= 4 * 8 * 0.5
    even = spark.range(1000).withColumn("key", F.col("id").cast("string"))
    assert rows(joins.hot_keys(even, "key")) == []
    assert rows(joins.hot_keys(even.where("false"), "key")) == []


def test_few_equal_keys_are_not_copied_everywhere(spark):
    few = spark.range(6000).withColumn("key", (F.col("id") % 6).cast("string"))
    found = rows(joins.hot_keys(few, "key"))
    assert len(found) == 6
    assert sum(parts for _, parts in found) <= 5 * 8


def test_hot_rows_are_spread(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = spark.createDataFrame([("hot", 1)], "key string, v int")
        joined = joins.lookup_join(skewed(spark), right, "key", "left", spread=["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 6000
    assert max(sizes) < 6000 / 3


def test_copies_of_one_row_are_spread(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        copies = spark.range(0, 4000, 1, 16).select(F.lit("hot").alias("key"), F.lit(1).alias("id"))
        right = spark.createDataFrame([("hot", 1)], "key string, v int")
        joined = joins.lookup_join(copies, right, "key", "left", spread=["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000
    assert max(sizes) <= 4000 / 2


def test_size_check(spark, no_broadcast):
    assert not joins.fits_broadcast(spark.range(10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    assert joins.fits_broadcast(spark.range(10))
    assert not joins.fits_broadcast(spark.range(1000))


def test_left_join_all_keeps_null_keys(spark):
    left = skewed(spark, 600)
    a = spark.createDataFrame([("hot", 1), ("5", 2), (None, 3)], "key string, a int")
    b = spark.createDataFrame([("hot", 7)], "key string, b int")
    plain = left.join(a, "key", "left").join(b, "key", "left")
    assert rows(joins.left_join_all(left, [a, b], "key")) == rows(plain)


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "old"), ("a", 2, 1, "tie"), ("a", 2, 2, None), ("b", None, 1, "only")],
        "k string, ts int, id int, v string")
    assert rows(latest_per_key(df, "k", ["ts", "id"])) == [("a", 2, 2, None),
                                                           ("b", None, 1, "only")]


def observations(seed, n, keys):
    rng = random.Random(seed)
    return [(rng.choice(keys), START + timedelta(minutes=rng.randrange(300)), i,
             rng.choice([None, float(i)])) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_join_against_brute_force(spark, seed):
    keys = ["hot"] * 10 + ["a", "b", "c", None]
    asked = [(k, t, i) for k, t, i, _ in observations(seed, 400, [*keys, "unseen"])]
    asked += [("hot", None, 1000), (None, None, 1001)]
    seen = observations(seed + 100, 300, keys) + [("hot", None, 5000, 9.0)]
    left = spark.createDataFrame(asked, "k string, at timestamp_ntz, q int")
    right = spark.createDataFrame(seen, "k string, ts timestamp_ntz, o int, v double")
    got = cells.asof_join(left, right, "k", "at", "ts", ["o", "v"], tie="o")
    assert got.columns == ["k", "at", "q", "o", "v"]

    def expected(k, at):
        fit = [(t, o, v) for kk, t, o, v in seen
               if k is not None and at is not None and kk == k and t is not None and t <= at]
        return max(fit, key=lambda x: x[:2])[1:] if fit else (None, None)

    assert rows(got) == sorted(((k, at, q, *expected(k, at)) for k, at, q in asked), key=repr)


def test_asof_join_splits_a_key_into_cells(spark):
    seen = [("hot", START + timedelta(minutes=i), i) for i in range(2000)]
    df = spark.createDataFrame(seen, "k string, ts timestamp_ntz, o int")
    placed = cells.in_cells(df, "k", ["ts", "o"])
    assert placed.select(cells.CELL).distinct().count() >= 4


def test_versions_against_brute_force(spark):
    data = [(k, t, i, f"v{i}") for k, t, i, _ in observations(7, 500, ["hot"] * 9 + ["a", "b"])]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id int, v string")
    got = cells.versioned(df, "k", "ts", "id")
    expected = []
    for key in {d[0] for d in data}:
        mine = sorted((d for d in data if d[0] == key), key=lambda d: (d[1], d[2]))
        for row, following in zip(mine, [*mine[1:], None]):
            expected.append((*row, row[1], following[1] if following else None, not following))
    assert rows(got) == sorted(expected, key=repr)
    assert got.where("is_current").count() == len({d[0] for d in data})


def test_copies_in_ordered_work(spark):
    copies = spark.range(3000).select(F.lit("hot").alias("k"), F.lit(START).cast("timestamp_ntz")
                                      .alias("ts"), F.lit(1).alias("id"))
    placed = cells.in_cells(copies.withColumn("r", joins.spreader(copies.columns)), "k", ["ts", "r"])
    assert placed.select(cells.CELL).distinct().count() > 1
    history = cells.versioned(copies, "k", "ts", "id")
    assert (history.count(), history.where("is_current").count()) == (3000, 1)
    seen = spark.createDataFrame([("hot", START, 7)], "k string, at timestamp_ntz, o int")
    got = cells.asof_join(copies, seen, "k", "ts", "at", ["o"], tie="o")
    assert got.where("o = 7").count() == 3000


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 9, 10, 10)] + [(None,)], "x double")
    assert rows(histogram(df, "x", 10)) == [(0, 1), (1, 1), (9, 3)]
    assert rows(histogram(df.where("x = 10"), "x", 5)) == [(0, 2)]
    assert rows(histogram(df.where("x is null"), "x", 5)) == []


def mart(spark):
    return spark.createDataFrame(
        [("O1", "W1", "shipped", "express", "LOW"), ("O2", "W2", "created", "express", "HIGH"),
         ("O3", "W3", "shipped", "standard", None), ("O4", None, "it's", "standard", "LOW")],
        "order_id string, warehouse_id string, status string, priority string, "
        "risk_category string")


def depots(spark):
    return spark.createDataFrame([("W1", "North"), ("W2", "O'Brien's"), ("W3", "North")],
                                 "warehouse_id string, name string")


@pytest.mark.parametrize("chosen, kept", [
    (None, "1234"), ({}, "1234"), ({"statuses": []}, "1234"), ({"statuses": ["shipped"]}, "13"),
    ({"priorities": ["standard", "express"]}, "1234"), ({"risk": ["LOW", "HIGH"]}, "124"),
    ({"warehouses": ["North"]}, "13"), ({"warehouses": ["O'Brien's"]}, "2"),
    ({"statuses": ["it's"]}, "4"), ({"statuses": ["shipped"], "risk": ["LOW"]}, "1"),
    ({"warehouses": ["North"], "statuses": ["shipped"], "priorities": ["standard"]}, "3"),
    ({"statuses": ["nothing"]}, "")])
@pytest.mark.parametrize("shuffled", [False, True])
def test_filters(spark, chosen, kept, shuffled, request):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    got = filters.apply_filters(mart(spark), chosen, depots(spark))
    assert [r[0] for r in rows(got, "order_id")] == [f"O{n}" for n in kept]


def test_warehouse_filter_needs_the_table(spark):
    with pytest.raises(ValueError):
        filters.apply_filters(mart(spark), {"warehouses": ["North"]})


def test_filter_options(spark):
    got = [tuple(r) for r in filters.filter_options(mart(spark), depots(spark)).collect()]
    assert got == [("priorities", "express"), ("priorities", "standard"), ("risks", "HIGH"),
                   ("risks", "LOW"), ("risks", None), ("statuses", "created"),
                   ("statuses", "it's"), ("statuses", "shipped"), ("warehouses", "North"),
                   ("warehouses", "North"), ("warehouses", "O'Brien's")]


@pytest.mark.parametrize("copies", [(60, 60), (1, 3000), (3000, 1)])
def test_ids_repeated_on_both_sides_are_spread(spark, copies):
    """A key that is hot on both sides, or on one, is split over the partitions and the result stays."""
    mine, theirs = copies
    left = spark.createDataFrame([("hot", 7)] * mine + [(f"k{i}", i) for i in range(40)] + [(None, 1), ("only", 2)],
                                 "key string, a int").coalesce(1)
    right = spark.createDataFrame([("hot", 9)] * theirs + [(f"k{i}", i) for i in range(0, 40, 2)] + [(None, 3)],
                                  "key string, b int").coalesce(1)
    got = joins.left_join_all(left, [right], "key")
    assert rows(got.groupBy("key", "a", "b").count()) == rows(left.join(right, "key", "left").groupBy("key", "a", "b").count())
    grid = joins.hot_pairs(left, right, "key").collect()
    assert [r["key"] for r in grid] == ["hot"]
    cells = grid[0][joins.LEFT_PARTS] * grid[0][joins.RIGHT_PARTS]
    assert cells >= 8 and grid[0][joins.LEFT_PARTS] >= (mine > 1) * 2


def test_equal_rows_of_a_hot_key_part(spark):
    """1,000 copies of one row on each side meet in all tasks, not in one."""
    copies = spark.range(1000, numPartitions=1).selectExpr("'k' as key", "1 as a")
    joined = joins.left_join_all(copies, [copies.withColumnRenamed("a", "b")], "key")
    shares = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in shares) == 1_000_000
    assert max(r["count"] for r in shares) < 500_000


def test_latest_row_without_sorting_the_history(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 1, "y"), ("a", 2, 3, None), ("a", 2, 3, None), ("b", None, 1, "z"),
                                ("b", None, 2, "w"), (None, 1, 1, "n"), ("c", 4, None, "q")], "k string, ts int, id int, v string")
    got = latest_per_key(df, "k", ["ts", "id"])
    assert rows(got) == rows(spark.createDataFrame(
        [("a", 2, 3, None), ("b", None, 2, "w"), (None, 1, 1, "n"), ("c", 4, None, "q")], df.schema))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan.split("Exchange")[-1]


def test_latest_row_of_keys_that_do_not_repeat(spark, tmp_path, no_broadcast):
    """Where every key has one row there is nothing to decide, and only repeated keys are decided otherwise."""
    spark.range(1000).selectExpr("id k", "id % 7 ts", "id % 3 v").write.parquet(f"{tmp_path}/once")
    once = spark.read.parquet(f"{tmp_path}/once")
    got = latest_per_key(once, ["k"], ["ts", "v"])
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(once)
    more = once.union(once.where("k < 9").selectExpr("k", "ts + 1", "v")).union(once.where("k = 20"))
    want = once.selectExpr("k", "if(k < 9, ts + 1, ts) ts", "v")
    assert rows(latest_per_key(more, ["k"], ["ts", "v"])) == rows(want)

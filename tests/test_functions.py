import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.functions import routing, scoring, text


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def km(spark, lat1, lon1, lat2, lon2):
    return one(spark, routing.haversine_km(*[F.lit(v).cast("double")
                                             for v in (lat1, lon1, lat2, lon2)]))


def test_distance_between_known_cities(spark):
    assert 565 <= km(spark, 52.52, 13.405, 52.3676, 4.9041) <= 590


def test_distance_of_equal_points_is_zero(spark):
    assert km(spark, 52.0, 4.0, 52.0, 4.0) == 0.0


def test_distance_of_antipodes_is_half_the_circumference(spark):
    assert km(spark, 35.0, 20.0, -35.0, -160.0) == pytest.approx(math.pi * S.EARTH_RADIUS_KM)


def test_distance_needs_all_coordinates(spark):
    assert km(spark, 52.0, None, 52.0, 4.0) is None


def test_distance_of_nan_is_nan(spark):
    assert math.isnan(km(spark, float("nan"), 1.0, 2.0, 3.0))


def test_distance_matches_plain_formula_and_is_never_negative(spark):
    points = [(la1, lo1, la2, lo2) for la1 in (-60, 0, 35, 65) for lo1 in (-170, -9, 20)
              for la2 in (-35, 50) for lo2 in (5, 150)]
    df = spark.createDataFrame([tuple(map(float, p)) for p in points],
                               "a double, b double, c double, d double")
    got = df.withColumn("km", routing.haversine_km("a", "b", "c", "d")).collect()
    for r in got:
        p1, p2 = math.radians(r.a), math.radians(r.c)
        cos = (math.sin(p1) * math.sin(p2)
               + math.cos(p1) * math.cos(p2) * math.cos(math.radians(r.d - r.b)))
        assert r.km >= 0
        assert r.km == pytest.approx(S.EARTH_RADIUS_KM * math.acos(max(-1, min(1, cos))), abs=1e-3)


@pytest.mark.parametrize("distance, mode", [
    (0.0, "van"), (499.99, "van"), (500.0, "truck"), (500.01, "truck"), (2999.99, "truck"),
    (3000.0, "air"), (8000.0, "air"), (None, "van"), (float("nan"), "air"), (-1.0, "van")])
def test_transport_mode_bounds_are_inclusive(spark, distance, mode):
    assert one(spark, routing.transport_mode(F.lit(distance).cast("double"))) == mode


def test_tiers_may_come_in_any_order(spark):
    tiers = [(10.0, "b"), (0.0, "a"), (20.0, "c")]
    values = [one(spark, routing.tier_label(F.lit(v), tiers)) for v in (5.0, 15.0, 25.0)]
    assert values == ["a", "b", "c"]
    assert one(spark, routing.tier_label(F.lit(-5.0), tiers, default="none")) == "none"


@pytest.mark.parametrize("mode, hours", [("van", 2.0), ("truck", 70 / 55 + 2),
                                         ("air", 70 / 800 + 12), ("ship", 0.0)])
def test_travel_hours(spark, mode, hours):
    assert one(spark, routing.travel_hours(F.lit(70.0), F.lit(mode))) == pytest.approx(hours)


def test_travel_hours_without_distance(spark):
    assert one(spark, routing.travel_hours(F.lit(None).cast("double"), F.lit("van"))) is None


@pytest.mark.parametrize("value, rounded", [
    (0.0, 0.0), (0.125, 0.13), (1.005, 1.0), (2961.994999, 2961.99), (2961.995001, 2962.0),
    (None, None)])
def test_round2(spark, value, rounded):
    assert one(spark, routing.round2(F.lit(value).cast("double"))) == rounded


def test_round2_keeps_nan(spark):
    assert math.isnan(one(spark, routing.round2(F.lit(float("nan")))))


def test_constants():
    pace = S.MODE_PACE
    assert pace["air"][0] > pace["van"][0] > pace["truck"][0]
    assert all(handling >= 0 for _, handling in pace.values())
    assert 6300 <= S.EARTH_RADIUS_KM <= 6400
    assert 0 < S.MISSING_WEATHER_POINTS <= 25
    for tiers in (S.MODE_TIERS, S.DISTANCE_POINTS, S.DURATION_POINTS, S.TEMPERATURE_POINTS,
                  S.WIND_POINTS, S.RISK_LEVELS):
        assert [b for b, _ in tiers] == sorted(b for b, _ in tiers)


def plain_points(tiers, value):
    return max([p for bound, p in tiers if value > bound], default=0)


@pytest.mark.parametrize("tiers", [S.DISTANCE_POINTS, S.DURATION_POINTS, S.TEMPERATURE_POINTS,
                                   S.WIND_POINTS])
def test_points_around_every_bound(spark, tiers):
    values = [float(b) + d for b, _ in tiers for d in (-0.01, 0.0, 0.01)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", scoring.tier_points(F.col("v"), tiers).alias("p"))
    assert got.schema["p"].dataType.simpleString() == "int"
    assert {r.v: r.p for r in got.collect()} == {v: plain_points(tiers, v) for v in values}


def test_points_of_null_and_nan(spark):
    null = F.lit(None).cast("double")
    assert one(spark, scoring.tier_points(null, S.WIND_POINTS)) == 0
    assert one(spark, scoring.tier_points(null, S.WIND_POINTS, 15)) == 15
    assert one(spark, scoring.tier_points(F.lit(float("nan")), S.WIND_POINTS)) == 15


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(*[st.floats(-50, 30000)] * 4), min_size=1, max_size=20))
def test_score_is_the_capped_sum_of_points(spark, values):
    df = spark.createDataFrame(values, "d double, h double, t double, w double")
    got = df.withColumn("score", scoring.risk_score(*map(F.col, "dhtw"))).collect()
    for r in got:
        assert r.score == min(100, plain_points(S.DISTANCE_POINTS, r.d)
                              + plain_points(S.DURATION_POINTS, r.h)
                              + plain_points(S.TEMPERATURE_POINTS, r.t)
                              + plain_points(S.WIND_POINTS, r.w))


def test_score_cap(spark):
    assert one(spark, scoring.capped_sum([F.lit(80), F.lit(35)])) == 100


@pytest.mark.parametrize("score, level", [(0, "LOW"), (24, "LOW"), (25, "MEDIUM"), (49, "MEDIUM"),
                                          (50, "HIGH"), (64, "HIGH"), (65, "CRITICAL"),
                                          (95, "CRITICAL")])
def test_risk_level(spark, score, level):
    assert one(spark, scoring.risk_level(F.lit(score))) == level


def test_severity(spark):
    got = [one(spark, scoring.severity(F.lit(x))) for x in ("LOW", "CRITICAL", "none")]
    assert got == [1, 4, None]


def test_text(spark):
    assert one(spark, text.padded_id("WH", F.lit(7))) == "WH-007"
    assert one(spark, text.padded_id("WH", F.lit(1000))) == "WH-1000"
    assert one(spark, text.email_address(F.lit("Emma"), F.lit("de Vries"))) == \
        "emma.devries@example.eu"
    assert one(spark, text.country_prefix(F.lit("Sweden"))) == "SW"
    assert one(spark, text.full_name(F.lit("A"), F.lit("B"))) == "A B"
    assert one(spark, text.full_name(F.lit("A"), F.lit(None).cast("string"))) is None
    assert one(spark, routing.route_id(F.lit("abc-1"))) == "RT-abc-1"
    assert one(spark, text.coordinate(F.lit(1.23456))) == 1.2346


def test_time_stamps(spark):
    ts = F.lit("2026-01-02 03:04:05.000006").cast("timestamp")
    assert one(spark, text.iso_text(ts)) == "2026-01-02T03:04:05"
    assert one(spark, text.file_stamp(ts)) == "20260102_030405_000006"
    for name, micro in (("/x/customers_20260102_030405_000006.json", 6),
                        ("/x/weather_20260102_030405.json", 0),
                        ("/x/weather_20260102_030405/part-0.json", 0)):
        got = one(spark, text.stamp_of_file(F.lit(name)))
        assert (got.second, got.microsecond) == (5, micro)
    assert one(spark, text.stamp_of_file(F.lit("/x/other.json"))) is None

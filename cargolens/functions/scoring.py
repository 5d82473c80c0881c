"""Points, score and level of the delivery risk."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.functions.routing import tier_label


def tier_points(value: Column, tiers, null_points: int = 0) -> Column:
    """Points of the highest tier whose bound `value` exceeds (strict), else 0."""
    chain = F.when(value.isNull(), F.lit(null_points))
    for bound, points in sorted(tiers, reverse=True):
        chain = chain.when(value > F.lit(bound), F.lit(points))
    return chain.otherwise(F.lit(0)).cast("int")


def capped_sum(parts, cap: int = S.SCORE_CAP) -> Column:
    return F.least(reduce(add, parts), F.lit(cap))


def risk_score(distance_km: Column, hours: Column, temperature: Column, wind: Column,
               null_points: int = 0) -> Column:
    """Sum of the four factors, capped.

    `null_points` is what a missing temperature or wind speed scores, each.
    """
    return capped_sum([
        tier_points(distance_km, S.DISTANCE_POINTS),
        tier_points(hours, S.DURATION_POINTS),
        tier_points(temperature, S.TEMPERATURE_POINTS, null_points),
        tier_points(wind, S.WIND_POINTS, null_points),
    ])


def risk_level(score: Column) -> Column:
    return tier_label(score, S.RISK_LEVELS)


def rank_of(value: Column, ordered) -> Column:
    """1-based position of `value` in `ordered`, null for any other value."""
    chain = F
    for position, item in enumerate(ordered, start=1):
        chain = chain.when(value == item, F.lit(position))
    return chain


def severity(level: Column) -> Column:
    return rank_of(level, [label for _, label in S.RISK_LEVELS])

"""Distance, transport mode and duration of a route."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cargolens import schemas as S


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; null when any coordinate is null."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlam = (F.radians(lon2) - F.radians(lon1)) / 2
    a = F.sin(half_dphi) ** 2 + F.cos(phi1) * F.cos(phi2) * F.sin(half_dlam) ** 2
    # rounding can push `a` just above 1 at antipodes, hence the floor at 0
    return 2 * S.EARTH_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))


def tier_label(value: Column, tiers, default=None) -> Column:
    """Label of the highest tier whose lower bound `value` meets (inclusive).

    A null value gets the default, which is the label of the lowest tier
    unless another one is named.
    """
    ordered = sorted(tiers, reverse=True)
    chain = F
    for bound, label in ordered:
        chain = chain.when(value >= F.lit(bound), F.lit(label))
    return chain.otherwise(F.lit(ordered[-1][1] if default is None else default))


def transport_mode(distance_km: Column) -> Column:
    return tier_label(distance_km, S.MODE_TIERS)


def travel_hours(distance_km: Column, mode: Column, pace=None) -> Column:
    """Driving or flying time plus handling; 0 for a mode without a pace."""
    chain = F
    for name, (speed, handling) in (pace or S.MODE_PACE).items():
        chain = chain.when(mode == name, distance_km / speed + handling)
    return chain.otherwise(F.lit(0.0))


def route_id(order_id) -> Column:
    return F.concat(F.lit("RT-"), order_id)


def round2(value: Column) -> Column:
    """A non-negative number to 2 decimals, halves up, on the binary value.

    `round` would go through a decimal per row; this stays in plain arithmetic.
    """
    return F.when(F.isnan(value), value).otherwise(
        F.floor(value * 100 + F.lit(0.5)) / F.lit(100.0))

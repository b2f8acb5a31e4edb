"""Feature expressions: risk index, vulnerability, nearest centre, density band."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from kerbline import profile as fixed
from kerbline.columns import measured
from kerbline.functions.rules import clamp01, lookup


def risk_index(light: Column, weather: Column, surface: Column, speed: Column, road_type: Column) -> Column:
    """Weighted mean of five component risks, within [0, 1].

    Unknown and missing components count as neutral; all five missing gives
    the middle of the scale.
    """
    low, high = fixed.SPEED_RANGE
    value = speed.try_cast("double")
    scaled = F.when(value.isNotNull(), clamp01((value - low) / (high - low))).otherwise(F.lit(fixed.DEFAULT_RISK))
    parts = {
        "light": lookup(light, fixed.LIGHT_RISK, fixed.DEFAULT_RISK),
        "weather": lookup(weather, fixed.WEATHER_RISK, fixed.DEFAULT_RISK),
        "surface": lookup(surface, fixed.SURFACE_RISK, fixed.DEFAULT_RISK),
        "speed": scaled,
        "road_type": lookup(road_type, fixed.ROAD_TYPE_RISK, fixed.DEFAULT_RISK),
    }
    weighted = F.lit(0.0)
    for name, weight in fixed.RISK_WEIGHTS.items():
        weighted = weighted + F.lit(weight) * parts[name]
    score = clamp01(weighted / sum(fixed.RISK_WEIGHTS.values()))
    nothing = F.coalesce(light, weather, surface, speed.cast("string"), road_type).isNull()
    return F.when(nothing, F.lit(fixed.ALL_MISSING_RISK)).otherwise(score)


def vulnerable(detail_type: Column, engine: Column) -> Column:
    """Whether a vehicle gives little protection; never null."""
    cc = engine.try_cast("double")
    small_car = (detail_type == fixed.CAR_TYPE) & measured(cc) & (cc < fixed.SMALL_ENGINE_CC)
    return F.coalesce(detail_type.isin(*fixed.VULNERABLE_TYPES) | small_car, F.lit(False))


def nearest_centre(lat: Column, lon: Column, centres: Mapping[int, tuple[float, float]] | None = None) -> Column:
    """Id of the nearest centre by plain distance in degrees.

    The lowest id wins a tie; missing or unusable coordinates give -1.
    """
    centres = fixed.CLUSTER_CENTRES if centres is None else centres
    x, y = lat.try_cast("double"), lon.try_cast("double")
    ranked = [
        F.struct(F.sqrt(F.pow(x - la, F.lit(2.0)) + F.pow(y - lo, F.lit(2.0))).alias("gap"), F.lit(i).alias("id"))
        for i, (la, lo) in sorted(centres.items())
    ]
    nearest = F.array_min(F.array(*ranked)).getField("id")
    return F.when(measured(x) & measured(y), nearest).otherwise(F.lit(-1)).cast("int")


def density_band(cluster: Column, shares: Mapping[int, float] | None = None) -> Column:
    """urban / suburban / rural by the share of events in the cluster."""
    shares = fixed.CLUSTER_SHARES if shares is None else shares
    bands = {
        i: "urban" if share > fixed.URBAN_ABOVE else "suburban" if share > fixed.SUBURBAN_ABOVE else "rural"
        for i, share in shares.items()
    }
    known = lookup(cluster.cast("int"), bands, "rural")
    return F.when(cluster.isNull() | (cluster < 0), F.lit("unknown")).otherwise(known)


def haversine_term(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """The haversine of the angle between two points given in radians."""
    dlat, dlon = F.sin((lat2 - lat1) / 2), F.sin((lon2 - lon1) / 2)
    return dlat * dlat + F.cos(lat1) * F.cos(lat2) * dlon * dlon

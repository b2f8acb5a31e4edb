"""Nearest place, daily side data and detail rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from kerbline.columns import col, measured, numeric
from kerbline.functions.features import haversine_term
from kerbline.operators.cleaning import null_columns
from kerbline.profile import WEATHER_COLUMNS
from kerbline.scale import attach_by_key, settle, spread_left_join, within

# Places up to this number are compared with every point inside the tasks.
SCAN_PLACES = 4_096
# Grid of cubes around the unit sphere: edge 2 at level 0, a quarter per level.
GRID_LEVELS = 11
# On the first levels the whole sphere touches well under 100,000 cubes.
COARSE_LEVELS = 4
# Detail rows of one key that one task may join.
HEAVY_ROWS = 1_000_000
# Hash groups in which keys are counted before any key is.
KEY_GROUPS = 65_536


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    lat: str = "Latitude",
    lon: str = "Longitude",
    place_id: str = "id",
    place_lat: str = "latitude",
    place_lon: str = "longitude",
    output: str = "station_id",
    scan_places: int = SCAN_PLACES,
) -> DataFrame:
    """Append the id of the place with the smallest great-circle distance.

    The lowest id wins a tie; a point without finite coordinates gets null. Few places
    (counted) are sent to the tasks; more are found by a grid join.
    """
    tidy = places.select(
        col(place_id).cast("string").alias("id"),
        numeric(place_lat).alias("lat"),
        numeric(place_lon).alias("lon"),
    ).filter(F.col("id").isNotNull() & measured(F.col("lat")) & measured(F.col("lon")))
    tidy = tidy.filter(_finite(F.col("lat")) & _finite(F.col("lon")))
    if within(tidy, scan_places):
        # The output comes last on both paths.
        kept = [col(c) for c in points.columns if c != output]
        return points.select(*kept, _nearest_by_scan(tidy, numeric(lat), numeric(lon)).alias(output))
    return _nearest_by_grid(points, tidy, lat, lon, output)


def _finite(number: Column) -> Column:
    return F.abs(number) != F.lit(float("inf"))


def _nearest_by_scan(places: DataFrame, lat: Column, lon: Column) -> Column:
    # At most SCAN_PLACES rows, checked by the caller.
    table = places.orderBy("id").toPandas()
    ids = table["id"].tolist()
    lats, lons = table["lat"].tolist(), table["lon"].tolist()

    @F.pandas_udf("string")
    def nearest(lat_values: pd.Series, lon_values: pd.Series) -> pd.Series:
        import numpy as np
        import pandas as pd

        def unit(la, lo):
            return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=1)

        place_la, place_lo = np.radians(np.array(lats)), np.radians(np.array(lons))
        place_unit, names = unit(place_la, place_lo).T, np.array(ids, dtype=object)
        la_all = lat_values.to_numpy(dtype=float)
        lo_all = lon_values.to_numpy(dtype=float)
        out = np.full(len(la_all), None, dtype=object)
        usable = np.flatnonzero(np.isfinite(la_all) & np.isfinite(lo_all))
        step = max(1, 2_000_000 // max(1, len(ids)))
        for start in range(0, len(usable) if ids else 0, step):
            rows = usable[start : start + step]
            la, lo = np.radians(la_all[rows]), np.radians(lo_all[rows])
            # The dot product falls as the distance grows. It picks the places
            # that can be nearest; the haversine decides among near-equal ones.
            dot = unit(la, lo) @ place_unit
            close = dot >= dot.max(axis=1, keepdims=True) - 1e-12
            best = close.argmax(axis=1)
            for i in np.flatnonzero(close.sum(axis=1) > 1):
                some = np.flatnonzero(close[i])
                h = (
                    np.sin((place_la[some] - la[i]) / 2) ** 2
                    + np.cos(la[i]) * np.cos(place_la[some]) * np.sin((place_lo[some] - lo[i]) / 2) ** 2
                )
                best[i] = some[h.argmin()]
            out[rows] = names[best]
        return pd.Series(out, index=lat_values.index)

    return nearest(lat, lon)


def _cells(lat: str, lon: str, level: Column) -> list[Column]:
    """Cube coordinates of a point on the unit sphere at a grid level."""
    la, lo = F.radians(col(lat)), F.radians(col(lon))
    edge = F.lit(2.0) / F.pow(F.lit(4.0), level)
    axes = [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]
    return [F.floor(a / edge).cast("long") for a in axes]


def _nearest_by_grid(points: DataFrame, places: DataFrame, lat: str, lon: str, output: str) -> DataFrame:
    """Exact nearest place by equi-joins on grid cubes.

    For each distinct location take the finest level L at which the 27 cubes
    around it hold a place. The nearest place is then closer than 3.47 cube
    edges, which is less than one edge of level L-1, so it lies in the 27 cubes
    around the location at level L-1 (level 0 covers the whole sphere).
    Coarse cubes, which hold very many locations each, are looked up by
    broadcast; fine ones by a shuffle join. A location far from all places is
    compared with every place in its coarse cubes.
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(GRID_LEVELS - 1)))
    # Places sharing a location cannot all be nearest: the lowest id stands in.
    sites = places.groupBy("lat", "lon").agg(F.min("id").alias("id")).withColumn("level", levels)
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    x, y, z = _cells("lat", "lon", F.col("level"))
    sites = sites.withColumns({"x": x, "y": y, "z": z})
    occupied = sites.select("level", "x", "y", "z").distinct()
    for axis in ("x", "y", "z"):
        shifted = (F.col(axis) + F.col("d")).alias(axis)
        others = [c for c in ("level", "x", "y", "z") if c != axis]
        occupied = occupied.withColumn("d", around).select(*others, shifted)
    occupied = occupied.distinct()

    located = measured(numeric(lat)) & measured(numeric(lon)) & _finite(numeric(lat)) & _finite(numeric(lon))
    keyed = points.withColumns(
        {"__lat": F.when(located, numeric(lat)), "__lon": F.when(located, numeric(lon))}
    )
    spots = keyed.filter(F.col("__lat").isNotNull()).select("__lat", "__lon").distinct()
    px, py, pz = _cells("__lat", "__lon", F.col("level"))
    cubed = spots.withColumn("level", levels).withColumns({"x": px, "y": py, "z": pz})
    is_coarse = F.col("level") < COARSE_LEVELS
    cube = ["level", "x", "y", "z"]
    near = (
        cubed.filter(is_coarse)
        .join(F.broadcast(occupied.filter(is_coarse)), cube)
        .unionByName(cubed.filter(~is_coarse).join(occupied.filter(~is_coarse), cube))
    )
    finest = near.groupBy("__lat", "__lon").agg(F.greatest(F.max("level") - 1, F.lit(0)).alias("level"))
    search = finest.withColumns({"x": px, "y": py, "z": pz})
    for axis in ("x", "y", "z"):
        search = search.withColumn("d", around).withColumn(axis, F.col(axis) + F.col("d")).drop("d")
    h = haversine_term(F.radians("__lat"), F.radians("__lon"), F.radians("lat"), F.radians("lon"))
    winners = (
        search.join(sites, cube)
        .groupBy("__lat", "__lon")
        .agg(F.min(F.struct(h.alias("h"), F.col("id").alias("id"))).getField("id").alias("__nearest"))
    )
    joined = spread_left_join(keyed, winners, ["__lat", "__lon"])
    kept = [c for c in points.columns if c != output]
    return joined.select(*[col(c) for c in kept], F.col("__nearest").alias(output))


def join_daily(
    events: DataFrame,
    daily: DataFrame,
    on: dict[str, str],
) -> DataFrame:
    """Left-join side data by place and day (``on``: event column to side column).

    The side's key columns are not kept. Rows without a place get nulls.
    Repeated side rows multiply events.
    """
    side = daily.withColumnsRenamed({right: left for left, right in on.items()})
    joined = spread_left_join(events, side, list(on))
    extra = [c for c in side.columns if c not in on]
    return joined.select(*[col(c) for c in events.columns], *[col(c) for c in extra])


def join_daily_from(
    events: DataFrame,
    path: str,
    on: dict[str, str],
    columns: tuple[str, ...] = WEATHER_COLUMNS,
) -> DataFrame:
    """``join_daily`` with a stored side table.

    Without the table, or with one Spark cannot open, the columns are added as
    nulls. Only opening is guarded: damage found later, inside a task, still
    fails the job.
    """
    from pyspark.errors import AnalysisException

    try:
        daily = events.sparkSession.read.parquet(path)
    except AnalysisException:
        return null_columns(events, columns)
    return join_daily(events, daily, on)


def heavy_keys(details: DataFrame, key: str, most: int = HEAVY_ROWS) -> DataFrame:
    """(key, copies): keys with more than ``most`` rows, and over how many shares to deal them.

    A first pass counts hash groups of keys, which are few, so that the keys themselves are
    shuffled only where a group is large enough to hold a heavy one. Counts are partial before
    the shuffle; the result has at most one row for each ``most`` rows of the table.
    """
    keys = details.select(col(key)).filter(col(key).isNotNull())
    group = F.pmod(F.xxhash64(col(key)), F.lit(KEY_GROUPS))
    # Bounded: one row a group.
    large = [r["g"] for r in keys.groupBy(group.alias("g")).agg(F.count("*").alias("n")).filter(F.col("n") > most).collect()]
    suspects = keys.filter(group.isin(large)) if len(large) < KEY_GROUPS else keys
    counts = suspects.groupBy(col(key)).agg(F.count("*").alias("__n"))
    return counts.filter(F.col("__n") > most).select(col(key), F.ceil(F.col("__n") / most).cast("int").alias("__copies"))


def join_details(events: DataFrame, details: DataFrame, key: str, drop: tuple[str, ...] = ("Year",), most: int = HEAVY_ROWS) -> DataFrame:
    """Left-join 1:n detail rows; events without details are kept.

    ``drop`` names detail columns that repeat an event column. A left join can
    not split a hot right side at runtime, so keys with more than ``most``
    detail rows are dealt over shares of about that size, and their events are
    copied to each. Rows with a null key do not meet in one task.
    """
    details = details.drop(*[c for c in drop if c in details.columns])
    extra = [c for c in details.columns if c != key]
    heavy = settle(heavy_keys(details, key, most))
    if heavy.isEmpty():
        return spread_left_join(events, details, [key]).select(*[col(c) for c in events.columns], *[col(c) for c in extra])
    # The share follows from the row and its partition, so a retried task deals alike and equal rows are spread.
    share = F.pmod(F.xxhash64(*[col(c) for c in details.columns], F.spark_partition_id()), F.coalesce(F.col("__copies"), F.lit(1))).cast("int")
    # Bounded: one row for each ``most`` detail rows, counted by attach_by_key.
    dealt = attach_by_key(details, heavy, key, stored=True).withColumn("__share", share).drop("__copies").withColumn("__met", F.lit(True))
    copied = attach_by_key(events, heavy, key, stored=True)
    copied = copied.withColumn("__share", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__copies"), F.lit(1)) - 1)))
    joined = spread_left_join(copied, dealt, [key, "__share"])
    # A hot key has details, so its copies that met none stand for no row.
    joined = joined.filter(F.col("__copies").isNull() | F.col("__met"))
    return joined.select(*[col(c) for c in events.columns], *[col(c) for c in extra])

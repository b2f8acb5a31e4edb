"""From raw tables to the merged, year-partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbline.operators.cleaning import null_columns
from kerbline.operators.joins import join_daily, join_details, nearest_place
from kerbline.profile import ROAD, WEATHER_COLUMNS, Profile
from kerbline.sources.sinks import materialize, write_by
from kerbline.sources.weather import file_ledger, read_daily_weather


def merge(
    events: DataFrame,
    details: DataFrame,
    places: DataFrame,
    daily: DataFrame | None,
    profile: Profile = ROAD,
    located: DataFrame | None = None,
) -> DataFrame:
    """Nearest station, its weather on the day, then the detail rows.

    ``located`` is the event table with stations, if it is stored already.
    """
    p = profile
    if located is None:
        located = nearest_place(events, places, p.lat, p.lon, output=p.station)
    if daily is None:
        with_weather = null_columns(located, WEATHER_COLUMNS)
    else:
        with_weather = join_daily(located, daily, {p.station: "station_id", p.date: "time"})
    return join_details(with_weather, details, p.key, drop=(p.year,))


def ingest(
    spark: SparkSession,
    events: DataFrame,
    details: DataFrame,
    places: DataFrame,
    daily: DataFrame | None,
    work_dir: str,
    profile: Profile = ROAD,
) -> DataFrame:
    """Run the whole ingest; the located events and the merged table are stored.

    A finished step is not run again on a second call, unless its inputs or its plan have changed.
    """
    p = profile
    stations = materialize(spark, f"{work_dir}/stations.parquet", lambda: places)
    located = materialize(
        spark,
        f"{work_dir}/events_with_station.parquet",
        lambda: nearest_place(events, stations, p.lat, p.lon, output=p.station),
        also=(stations,),
    )
    merged = merge(events, details, stations, daily, p, located)
    write_by(merged, f"{work_dir}/merged.parquet", p.year)
    # An empty table has no files to take columns from.
    return spark.read.schema(merged.schema).parquet(f"{work_dir}/merged.parquet")


def ingest_weather(spark: SparkSession, path: str, work_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    """The daily table of all weather files below ``path``, and its file ledger; both are stored.

    The ledger goes to the quality report (``validate``), so that files read
    in part or not at all are told. ``options`` are those of ``read_daily_weather``.
    """
    daily = materialize(spark, f"{work_dir}/daily.parquet", lambda: read_daily_weather(spark, path, **options))
    ledger = materialize(spark, f"{work_dir}/weather_files.parquet", lambda: file_ledger(spark, path))
    return daily, ledger

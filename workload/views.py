"""Event, detail, place and daily views over the given tables.

The tables hold no nulls, so the views add the faults the operators look for,
by arithmetic on keys. One select list serves both Spark and the SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbline.profile import Profile

EVENTS = {
    "acc_id": "o_orderkey",
    "acc_date": "CAST(o_orderdate AS DATE)",
    "acc_year": "CAST(CASE WHEN o_orderkey % 500 = 7 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS INT)",
    "acc_time": """CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN 'bad'
        ELSE concat(lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':', lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')) END""",
    "severity": "CASE WHEN o_orderkey % 100 = 0 THEN 'Fatal' WHEN o_orderkey % 100 < 15 THEN 'Serious' ELSE 'Slight' END",
    "lat": """CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN CAST(9999 AS DOUBLE)
        ELSE CAST(49 AS DOUBLE) + CAST((o_orderkey * 37) % 1200 AS DOUBLE) / CAST(100 AS DOUBLE) END""",
    "lon": """CASE WHEN o_orderkey % 97 = 0 THEN NULL
        ELSE CAST(-8 AS DOUBLE) + CAST((o_orderkey * 53) % 1000 AS DOUBLE) / CAST(100 AS DOUBLE) END""",
    "speed": """CAST(CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderkey % 79 = 0 THEN 999 WHEN o_orderkey % 73 = 0 THEN 15
        WHEN o_orderkey % 71 = 0 THEN 25 ELSE 20 + 10 * (o_orderkey % 6) END AS DOUBLE)""",
    "light": """CASE o_orderkey % 7 WHEN 0 THEN 'Darkness - no lighting' WHEN 1 THEN 'Darkness - lights lit'
        WHEN 2 THEN 'Data missing or out of range' WHEN 3 THEN NULL ELSE 'Daylight' END""",
    "weather": """CASE o_orderkey % 9 WHEN 0 THEN 'Fog or mist' WHEN 1 THEN 'Raining no high winds' WHEN 2 THEN 'Unknown'
        WHEN 3 THEN 'Other' WHEN 4 THEN '' ELSE 'Fine no high winds' END""",
    "surface": "CASE o_orderkey % 5 WHEN 0 THEN 'Wet' WHEN 1 THEN 'Frost or ice' WHEN 2 THEN NULL ELSE 'Dry' END",
    "road_type": "CASE o_orderkey % 6 WHEN 0 THEN 'Motorway' WHEN 1 THEN 'Slip road' WHEN 2 THEN 'Unknown' ELSE 'Single carriageway' END",
    "n_vehicles": "CASE WHEN o_orderkey % 67 = 0 THEN CAST(0 AS BIGINT) ELSE 1 + o_orderkey % 4 END",
    "n_casualties": "1 + o_orderkey % 5",
    "day_name": """CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN 'Someday' ELSE
        CASE o_orderkey % 7 WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday'
        WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' ELSE 'Saturday' END END""",
}
DETAILS = {
    "acc_id": "CASE WHEN l_orderkey % 37 = 0 THEN l_orderkey + 1000000000 ELSE l_orderkey END",
    "veh_ref": "l_linenumber",
    "veh_year": "CAST(year(l_shipdate) AS INT)",
    "vehicle_type": """CASE l_partkey % 8 WHEN 0 THEN 'Motorcycle over 500cc' WHEN 1 THEN 'Pedal cycle'
        WHEN 2 THEN 'Van / Goods 3.5 tonnes mgw or under' WHEN 3 THEN '109' WHEN 4 THEN 'Data missing or out of range' ELSE 'Car' END""",
    "engine_cc": """CAST(CASE WHEN l_partkey % 9 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN 96000 WHEN l_partkey % 103 = 0 THEN -1
        ELSE 600 + (l_partkey * 13) % 3000 END AS DOUBLE)""",
    "age": "CASE WHEN l_partkey % 6 = 1 THEN NULL WHEN l_partkey % 107 = 0 THEN CAST(-1 AS DOUBLE) ELSE l_quantity END",
    "make": "CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE concat('make_', CAST(l_suppkey % 7 AS STRING)) END",
    "model": "CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE concat('model_', CAST(l_partkey % 13 AS STRING)) END",
    "sex": "CASE l_partkey % 5 WHEN 0 THEN ' female ' WHEN 1 THEN 'Not known' WHEN 2 THEN NULL ELSE 'Male' END",
}
PLACES = {
    "id": "CAST(s_suppkey AS STRING)",
    "latitude": "CAST(49 AS DOUBLE) + CAST((s_suppkey * 131) % 1200 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "longitude": "CAST(-8 AS DOUBLE) + CAST((s_suppkey * 71) % 1000 AS DOUBLE) / CAST(100 AS DOUBLE)",
}
DAILY_KEYS = {
    "station_id": "CAST(user_id % 10 AS STRING)",
    "time": "DATE '1995-01-01' + CAST(event_id % 2400 AS INT)",
}
DAILY_VALUES = {
    "tavg": "min(value) / CAST(10 AS DOUBLE) - CAST(10 AS DOUBLE)",
    "prcp": "max(value)",
}

# The views' columns in the roles the operators know.
VIEW = Profile(
    key="acc_id",
    detail_key="veh_ref",
    label="severity",
    date="acc_date",
    time="acc_time",
    year="acc_year",
    day_name="day_name",
    lat="lat",
    lon="lon",
    speed="speed",
    light="light",
    weather="weather",
    surface="surface",
    road_type="road_type",
    n_details="n_vehicles",
    n_casualties="n_casualties",
    detail_type="vehicle_type",
    engine="engine_cc",
    raw_engine="engine_cc",
    age="age",
    age_band="model",
    sex="sex",
    drop_columns=("n_casualties",),
    renames={},
    numeric=("speed", "n_vehicles", "lat", "lon", "age", "engine_cc"),
    null_negative=("age", "engine_cc"),
    legal_values={"speed": (20, 30, 40, 50, 60, 70)},
    bounds={
        "lat": (49.0, 61.0),
        "lon": (-8.0, 2.0),
        "engine_cc": (50.0, 8000.0),
        "age": (0.0, 100.0),
        "n_vehicles": (1.0, 100.0),
    },
    required=("severity", "lat", "lon"),
    median=("age", "engine_cc"),
    group_mode=(("model", "make"),),
    unknown_fill=("weather", "surface", "light", "road_type", "vehicle_type", "make"),
    one_hot=("day_name", "road_type", "weather", "light", "surface", "sex"),
    indexed=("vehicle_type", "make", "model"),
    scaled=("speed", "n_vehicles", "lat", "lon", "age", "engine_cc"),
    required_event=("acc_id", "severity", "acc_date", "lat", "lon", "acc_year", "speed", "road_type", "weather", "light", "surface"),
    required_detail=("acc_id", "vehicle_type", "sex"),
    outlier_event=("speed", "n_casualties", "n_vehicles"),
    outlier_detail=("age", "engine_cc"),
    described_event=("speed", "n_casualties", "n_vehicles", "lat", "lon"),
    described_detail=("age", "engine_cc"),
    related=("speed", "n_casualties", "n_vehicles", "lat", "lon"),
    category_event=("day_name", "light", "weather", "surface", "road_type"),
    category_detail=("sex", "vehicle_type"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return _select(rows, EVENTS)


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity", "l_suppkey")
    return _select(rows, DETAILS)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "supplier"), PLACES)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    keyed = table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in DAILY_KEYS.items()], "value")
    return keyed.groupBy(*DAILY_KEYS).agg(*[F.expr(e).alias(n) for n, e in DAILY_VALUES.items()])


# The station in the path of a file of ``ragged_files``.
STATION_FOLDER = r"station=([^/]*)_[^_/]*/[^/]*$"


def ragged_files(spark: SparkSession, sf_dir: str, base: str) -> None:
    """The daily data as weather files of three layouts, with bad numbers (day 13) and bad dates (day 17)."""
    from pyspark.sql import functions as F

    day = F.dayofmonth("time")
    wx = daily(spark, sf_dir).select(
        F.concat(F.col("station_id"), F.lit("_all")).alias("station"),
        (F.col("station_id").cast("int") % 3).alias("layout"),
        F.year("time").alias("year"),
        F.month("time").alias("month"),
        F.when(day == 17, F.lit(77)).otherwise(day).alias("day"),
        F.when(day == 13, F.lit("?")).otherwise(F.col("tavg").cast("string")).alias("temp"),
        "prcp",
        day.alias("snwd"),
        F.lit(0).alias("wpgt"),
    )
    layouts = (("year", "month", "day", "temp", "prcp"), ("year", "month", "day", "temp", "snwd", "prcp"), ("prcp", "wpgt", "day", "month", "year"))
    for i, names in enumerate(layouts):
        part = wx.filter(F.col("layout") == i).select("station", *names)
        part.write.partitionBy("station").option("header", True).option("compression", "gzip").csv(f"{base}/{i}")


def _sql(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in columns.items()) + f" FROM {source}"


SQL = {
    "acc": _sql(EVENTS, "orders"),
    "veh": _sql(DETAILS, "lineitem"),
    "stn": _sql(PLACES, "supplier"),
    "wx": _sql({**DAILY_KEYS, **DAILY_VALUES}, "events") + " GROUP BY 1, 2",
}


def with_views(body: str, *names: str, **more: str) -> str:
    """``body`` preceded by the named views and any further named queries."""
    parts = [f"{n} AS ({SQL[n]})" for n in names] + [f"{n} AS ({q})" for n, q in more.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body

"""Joins, key overlap, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.operators import joins, keys, sampling
from kerbline.plans.ingest import ingest, ingest_weather, merge
from kerbline.scale import scratch_path
from workload import views
from workload.registry import query
from workload.views import STATION_FOLDER, VIEW, ragged_files, with_views

HAVERSINE = """pow(sin((radians(latitude) - radians(lat)) / 2), 2)
 + cos(radians(lat)) * cos(radians(latitude)) * pow(sin((radians(longitude) - radians(lon)) / 2), 2)"""
RANKED = f"""SELECT acc_id, id FROM (SELECT acc_id, id, row_number() OVER (PARTITION BY acc_id ORDER BY {HAVERSINE}, id) AS rk
 FROM acc JOIN stn ON lat IS NOT NULL AND lon IS NOT NULL) WHERE rk = 1"""
NEAREST = with_views("SELECT acc.acc_id, id AS station_id FROM acc LEFT JOIN ranked ON acc.acc_id = ranked.acc_id", "acc", "stn", ranked=RANKED)


@query("nearest_point", NEAREST)
def nearest_point(spark, sf_dir):
    acc = views.events(spark, sf_dir).select("acc_id", "lat", "lon")
    return joins.nearest_place(acc, views.places(spark, sf_dir), "lat", "lon").select("acc_id", "station_id")


@query("nearest_point_grid", NEAREST)
def nearest_point_grid(spark, sf_dir):
    acc = views.events(spark, sf_dir).select("acc_id", "lat", "lon")
    found = joins.nearest_place(acc, views.places(spark, sf_dir), "lat", "lon", scan_places=0)
    return found.select("acc_id", "station_id")


STATIONED = "SELECT acc_id, acc_date, CASE WHEN acc_id % 97 = 0 THEN NULL ELSE CAST(acc_id % 10 AS STRING) END AS station_id FROM acc"


def stationed(spark, sf_dir):
    station = F.expr("CASE WHEN acc_id % 97 = 0 THEN NULL ELSE CAST(acc_id % 10 AS STRING) END")
    return views.events(spark, sf_dir).select("acc_id", "acc_date", station.alias("station_id"))


@query(
    "side_join_daily",
    with_views(
        """SELECT s.acc_id, s.acc_date, s.station_id, tavg, prcp FROM stationed s
 LEFT JOIN wx ON s.station_id = wx.station_id AND s.acc_date = wx.time""",
        "acc",
        "wx",
        stationed=STATIONED,
    ),
)
def side_join_daily(spark, sf_dir):
    return joins.join_daily(stationed(spark, sf_dir), views.daily(spark, sf_dir), {"station_id": "station_id", "acc_date": "time"})


@query(
    "missing_side_input",
    with_views(
        "SELECT acc_id, acc_date, station_id, CAST(NULL AS DOUBLE) AS tavg, CAST(NULL AS DOUBLE) AS prcp FROM stationed",
        "acc",
        stationed=STATIONED,
    ),
)
def missing_side_input(spark, sf_dir):
    absent = scratch_path(spark, "absent")
    on = {"station_id": "station_id", "acc_date": "time"}
    return joins.join_daily_from(stationed(spark, sf_dir), absent, on, ("tavg", "prcp"))


@query(
    "detail_left_join",
    with_views(
        """SELECT acc.acc_id, acc_year, severity, veh_ref, vehicle_type, age, make FROM acc LEFT JOIN veh ON acc.acc_id = veh.acc_id""",
        "acc",
        "veh",
    ),
)
def detail_left_join(spark, sf_dir):
    acc = views.events(spark, sf_dir).select("acc_id", "acc_year", "severity")
    veh = views.details(spark, sf_dir).select("acc_id", "veh_ref", F.col("veh_year").alias("acc_year"), "vehicle_type", "age", "make")
    return joins.join_details(acc, veh, "acc_id", drop=("acc_year",))


@query(
    "merge_all",
    with_views(
        """SELECT acc.acc_id, acc_year, severity, id AS station_id, tavg, prcp, veh_ref, vehicle_type FROM acc
 LEFT JOIN ranked ON acc.acc_id = ranked.acc_id LEFT JOIN wx ON ranked.id = wx.station_id AND acc.acc_date = wx.time
 LEFT JOIN veh ON acc.acc_id = veh.acc_id""",
        "acc",
        "veh",
        "stn",
        "wx",
        ranked=RANKED,
    ),
)
def merge_all(spark, sf_dir):
    veh = views.details(spark, sf_dir).withColumnRenamed("veh_year", "acc_year")
    out = merge(views.events(spark, sf_dir), veh, views.places(spark, sf_dir), views.daily(spark, sf_dir), VIEW)
    return out.select("acc_id", "acc_year", "severity", "station_id", "tavg", "prcp", "veh_ref", "vehicle_type")


@query(
    "ingest_all",
    with_views(
        """SELECT acc.acc_id, acc_year, severity, id AS station_id, CAST(CASE WHEN CAST(id AS INTEGER) % 3 = 2 OR day(acc_date) = 13 THEN NULL ELSE tavg END AS FLOAT) AS tavg,
 CAST(CASE WHEN day(acc_date) <> 17 THEN prcp END AS FLOAT) AS prcp, veh_ref, vehicle_type FROM acc
 LEFT JOIN ranked ON acc.acc_id = ranked.acc_id LEFT JOIN wx ON ranked.id = wx.station_id AND acc.acc_date = wx.time AND day(wx.time) <> 17
 LEFT JOIN veh ON acc.acc_id = veh.acc_id""",
        "acc",
        "veh",
        "stn",
        "wx",
        ranked=RANKED,
    ),
)
def ingest_all(spark, sf_dir):
    """From the weather files on: read, store, locate, join the day, join the details, store by year."""
    base = scratch_path(spark, "ingest")
    ragged_files(spark, sf_dir, f"{base}/raw")
    daily, _ = ingest_weather(spark, f"{base}/raw", base, first="1990-01-01", last="2030-12-31", station=STATION_FOLDER)
    veh = views.details(spark, sf_dir).withColumnRenamed("veh_year", "acc_year")
    out = ingest(spark, views.events(spark, sf_dir), veh, views.places(spark, sf_dir), daily, base, VIEW)
    return out.select("acc_id", "acc_year", "severity", "station_id", "tavg", "prcp", "veh_ref", "vehicle_type")


_KEYS = {
    "a": "SELECT DISTINCT acc_id FROM acc WHERE acc_id IS NOT NULL",
    "v": "SELECT DISTINCT acc_id FROM veh WHERE acc_id IS NOT NULL",
}


@query(
    "key_overlap",
    with_views(
        """SELECT l AS left_keys, r AS right_keys, m AS matched, l - m AS only_left, r - m AS only_right,
 round((l - m) / l * 100, 2) AS only_left_pct, round((r - m) / r * 100, 2) AS only_right_pct
 FROM (SELECT (SELECT count(*) FROM a) AS l, (SELECT count(*) FROM v) AS r, (SELECT count(*) FROM a JOIN v USING (acc_id)) AS m)""",
        "acc",
        "veh",
        **_KEYS,
    ),
)
def key_overlap(spark, sf_dir):
    return keys.key_overlap(views.events(spark, sf_dir), views.details(spark, sf_dir), "acc_id")


@query("keys_intersect", with_views("SELECT acc_id FROM acc INTERSECT SELECT acc_id FROM veh", "acc", "veh"))
def keys_intersect(spark, sf_dir):
    return keys.keys_in_both(views.events(spark, sf_dir), views.details(spark, sf_dir), "acc_id")


@query("keys_only_left", with_views("SELECT acc_id FROM acc EXCEPT SELECT acc_id FROM veh", "acc", "veh"))
def keys_only_left(spark, sf_dir):
    return keys.keys_only_left(views.events(spark, sf_dir), views.details(spark, sf_dir), "acc_id")


@query("keys_only_right", with_views("SELECT acc_id FROM veh EXCEPT SELECT acc_id FROM acc", "acc", "veh"))
def keys_only_right(spark, sf_dir):
    return keys.keys_only_right(views.events(spark, sf_dir), views.details(spark, sf_dir), "acc_id")


@query(
    "xtable_year_mismatch",
    with_views(
        """SELECT count(*) AS n_total, count(*) FILTER (acc_year != y OR acc_year IS NULL OR y IS NULL) AS n_bad
 FROM acc JOIN firsts USING (acc_id)""",
        "acc",
        "veh",
        firsts="SELECT acc_id, veh_year AS y FROM veh QUALIFY row_number() OVER (PARTITION BY acc_id ORDER BY veh_ref, veh_year) = 1",
    ),
)
def xtable_year_mismatch(spark, sf_dir):
    return keys.cross_table_mismatch(
        views.events(spark, sf_dir), views.details(spark, sf_dir), "acc_id", "veh_ref", "acc_year", "veh_year"
    )


def hash_sql(key: str, seed: int | None = 42) -> str:
    tail = "" if seed is None else f" || ':{seed}'"
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR){tail}), 1, 8) AS BIGINT)"


@query(
    "hash_split_counts",
    with_views(
        f"""SELECT severity, count(*) FILTER ({hash_sql('acc_id', None)} % 100 < 80) AS n_train,
 count(*) FILTER ({hash_sql('acc_id', None)} % 100 >= 80) AS n_test FROM acc GROUP BY 1""",
        "acc",
    ),
)
def hash_split_counts(spark, sf_dir):
    train, test = sampling.split_by_key(views.events(spark, sf_dir), "acc_id")
    both = train.select("severity", F.lit(1).alias("t")).unionByName(test.select("severity", F.lit(0).alias("t")))
    return both.groupBy("severity").agg(F.count_if(F.col("t") == 1).alias("n_train"), F.count_if(F.col("t") == 0).alias("n_test"))


@query("random_split_counts")
def random_split_counts(spark, sf_dir):
    train, test = sampling.random_split(views.events(spark, sf_dir))
    both = train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part")))
    return both.groupBy("part").agg(F.count("*").alias("n"))


_COUNTS = "SELECT severity, count(*) AS n FROM acc GROUP BY 1"
_FRACTIONS = "SELECT severity, n, least(1.0, floor(3.0 * (SELECT min(n) FROM counts)) / n) AS fraction FROM counts"


@query(
    "class_weights",
    with_views("SELECT severity, n, (SELECT sum(n) FROM counts) / ((SELECT count(*) FROM counts) * n) AS weight FROM counts", "acc", counts=_COUNTS),
)
def class_weights(spark, sf_dir):
    return sampling.class_weights(views.events(spark, sf_dir), "severity")


@query("class_counts", with_views("SELECT severity, n FROM counts", "acc", counts=_COUNTS))
def class_counts(spark, sf_dir):
    return sampling.class_counts(views.events(spark, sf_dir), "severity")


@query("undersample_fractions", with_views(_FRACTIONS, "acc", counts=_COUNTS))
def undersample_fractions(spark, sf_dir):
    return sampling.class_fractions(views.events(spark, sf_dir), "severity")


@query(
    "undersample",
    with_views(
        f"SELECT acc_id, acc.severity FROM acc JOIN fractions USING (severity) WHERE {hash_sql('acc_id')} / 4294967296.0 < fraction",
        "acc",
        counts=_COUNTS,
        fractions=_FRACTIONS,
    ),
)
def undersample(spark, sf_dir):
    return sampling.undersample(views.events(spark, sf_dir).select("acc_id", "severity"), "severity", "acc_id")


@query("sample_fraction", with_views(f"SELECT acc_id, severity FROM acc WHERE {hash_sql('acc_id')} / 4294967296.0 < 0.01", "acc"))
def sample_fraction(spark, sf_dir):
    return sampling.sample_fraction(views.events(spark, sf_dir).select("acc_id", "severity"), 0.01, "acc_id")


@query("sample_n", with_views(f"SELECT acc_id, severity FROM acc ORDER BY {hash_sql('acc_id')}, acc_id LIMIT 5000", "acc"))
def sample_n(spark, sf_dir):
    return sampling.sample_at_most(views.events(spark, sf_dir).select("acc_id", "severity"), 5000, "acc_id")

"""Grouped summaries, rankings and key figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.operators import encoding, summaries
from kerbline.profile import WEEK_ORDER
from workload import views
from workload.featuring import CLUSTERED
from workload.registry import query
from workload.views import VIEW, with_views

_MEANS = {"avg_casualties": "n_casualties", "avg_vehicles": "n_vehicles"}
_HOUR = "CASE WHEN regexp_full_match(acc_time, '[0-9]{1,2}:[0-9]{2}') THEN CAST(split_part(acc_time, ':', 1) AS INTEGER) END"
_BY_CLASS = """SELECT severity, count(*) AS count, round(avg(n_casualties), 2) AS avg_casualties, round(avg(n_vehicles), 2) AS avg_vehicles,
 round(count(*) / (SELECT count(*) FROM acc) * 100, 2) AS percentage FROM acc GROUP BY 1"""
_BY_CONDITION = """SELECT weather, count(*) AS count, round(avg(n_casualties), 2) AS avg_casualties,
 count(DISTINCT acc_id) AS total_events FROM acc GROUP BY 1"""


@query("summary_by_class", with_views(_BY_CLASS, "acc"))
def summary_by_class(spark, sf_dir):
    return summaries.by_class(views.events(spark, sf_dir), "severity", _MEANS)


@query(
    "summary_by_coded_class",
    with_views(
        """SELECT CASE c WHEN '1' THEN 'Fatal' WHEN '2' THEN 'Serious' WHEN '3' THEN 'Slight' ELSE c END AS severity, count(*) AS count,
 round(avg(n_casualties), 2) AS avg_casualties, round(count(*) / (SELECT count(*) FROM acc) * 100, 2) AS percentage
 FROM (SELECT CAST(1 + acc_id % 4 AS STRING) AS c, n_casualties FROM acc) GROUP BY 1""",
        "acc",
    ),
)
def summary_by_coded_class(spark, sf_dir):
    coded = views.events(spark, sf_dir).select((1 + F.col("acc_id") % 4).alias("severity"), "n_casualties")
    summary = summaries.by_class(coded, "severity", {"avg_casualties": "n_casualties"})
    return summaries.merge_coded_classes(summary, "severity")


@query("summary_by_condition", with_views(_BY_CONDITION, "acc"))
def summary_by_condition(spark, sf_dir):
    return _by_condition(spark, sf_dir)


def _by_condition(spark, sf_dir):
    return summaries.by_condition(views.events(spark, sf_dir), "weather", "n_casualties", "acc_id")


@query("hourly_counts", with_views(f"SELECT {_HOUR} AS hour, count(*) AS count FROM acc GROUP BY 1", "acc"))
def hourly_counts(spark, sf_dir):
    return summaries.by_hour(views.events(spark, sf_dir), "acc_time")


@query(
    "event_hour_counts",
    "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS count FROM events GROUP BY 1",
)
def event_hour_counts(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select(F.date_format("ts", "HH:mm").alias("time"))
    return summaries.by_hour(rows, "time")


@query("dow_counts", with_views("SELECT dayname(acc_date) AS day_name, count(*) AS count FROM acc GROUP BY 1", "acc"))
def dow_counts(spark, sf_dir):
    return summaries.by_day_of_week(views.events(spark, sf_dir), "acc_date")


@query("monthly_counts", with_views("SELECT CAST(month(acc_date) AS INTEGER) AS month, count(*) AS count FROM acc GROUP BY 1", "acc"))
def monthly_counts(spark, sf_dir):
    return summaries.by_month(views.events(spark, sf_dir), "acc_date")


@query(
    "yearly_dip",
    with_views(
        """SELECT year, count, change_pct, coalesce(count = 0 OR change_pct < -10, false) AS is_dip FROM (
 SELECT CAST(year AS INTEGER) AS year, count, CASE WHEN before > 0 THEN round((count - before) / before * 100, 2) END AS change_pct
 FROM (SELECT *, lag(count) OVER (ORDER BY year) AS before FROM (SELECT y.year, coalesce(n, 0) AS count
 FROM (SELECT unnest(range(min(year), max(year) + 1)) AS year FROM c) y LEFT JOIN c USING (year))))""",
        "acc",
        c="SELECT year(acc_date) AS year, count(*) AS n FROM acc GROUP BY 1",
    ),
)
def yearly_dip(spark, sf_dir):
    return summaries.yearly_coverage(views.events(spark, sf_dir), "acc_date")


def _placed(spark, sf_dir):
    acc = views.events(spark, sf_dir).select("lat", "lon", "n_casualties")
    return encoding.add_spatial_features(acc, "lat", "lon")


_BAND_SUMMARY = "SELECT band AS location_density, count(*) AS count, round(avg(n_casualties), 2) AS avg_casualties FROM banded GROUP BY 1"


@query("density_summary", with_views(_BAND_SUMMARY, "acc", **CLUSTERED))
def density_summary(spark, sf_dir):
    return summaries.by_place_group(_placed(spark, sf_dir), "location_density", "n_casualties")


@query(
    "density_chart",
    with_views(
        "SELECT upper(location_density[1]) || location_density[2:] AS location_density, count, avg_casualties FROM bands WHERE location_density != 'unknown'",
        "acc",
        **CLUSTERED,
        bands=_BAND_SUMMARY,
    ),
)
def density_chart(spark, sf_dir):
    bands = summaries.by_place_group(_placed(spark, sf_dir), "location_density", "n_casualties")
    return summaries.chartable_bands(bands)


@query(
    "cluster_summary",
    with_views(
        """SELECT 'Cluster_' || cluster AS cluster, count(*) AS count, round(avg(n_casualties), 2) AS avg_casualties
 FROM banded GROUP BY 1""",
        "acc",
        **CLUSTERED,
    ),
)
def cluster_summary(spark, sf_dir):
    name = "accident_hotspot_cluster"
    return summaries.cluster_names(summaries.by_place_group(_placed(spark, sf_dir), name, "n_casualties"), name)


@query(
    "kpis",
    with_views(
        f"""SELECT count(*) AS total, count(*) FILTER (severity = 'Fatal') AS fatal_count,
 round(count(*) FILTER (severity = 'Fatal') / count(*) * 100, 2) AS fatal_pct,
 round(count(*) FILTER (severity = 'Serious') / count(*) * 100, 2) AS serious_pct,
 (SELECT hour FROM (SELECT {_HOUR} AS hour, count(*) AS n FROM acc GROUP BY 1) WHERE hour IS NOT NULL ORDER BY n DESC, hour LIMIT 1) AS peak_hour,
 round((round(avg(n_casualties) FILTER (weather = 'Fog or mist'), 2)
 / round(avg(n_casualties) FILTER (weather = 'Fine no high winds'), 2) - 1) * 100, 2) AS uplift_pct FROM acc""",
        "acc",
    ),
)
def kpis(spark, sf_dir):
    return summaries.headline(views.events(spark, sf_dir), "severity", "acc_time", "weather", "n_casualties")


@query(
    "peak_hour",
    with_views(
        f"SELECT hour AS peak FROM (SELECT {_HOUR} AS hour, count(*) AS n FROM acc GROUP BY 1) WHERE hour IS NOT NULL ORDER BY n DESC, hour LIMIT 1",
        "acc",
    ),
)
def peak_hour(spark, sf_dir):
    return summaries.peak(summaries.by_hour(views.events(spark, sf_dir), "acc_time"), "hour")


@query(
    "ordered_categories",
    with_views(
        """SELECT CAST(position AS INTEGER) AS position, day_name[1:3] AS day_name, coalesce(count, 0) AS count
 FROM (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'), (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) o(position, day_name)
 LEFT JOIN (SELECT dayname(acc_date) AS day_name, count(*) AS count FROM acc GROUP BY 1) USING (day_name)""",
        "acc",
    ),
)
def ordered_categories(spark, sf_dir):
    counts = summaries.by_day_of_week(views.events(spark, sf_dir), "acc_date")
    laid_out = summaries.in_fixed_order(counts, "day_name", WEEK_ORDER, {"count": F.lit(0).cast("long")})
    return summaries.short_names(laid_out, "day_name")


@query(
    "ordered_classes",
    with_views(
        """SELECT CAST(position AS INTEGER) AS position, severity, count, avg_casualties, avg_vehicles, percentage FROM s
 JOIN (VALUES (1, 'Fatal'), (2, 'Serious'), (3, 'Slight')) o(position, severity) USING (severity)""",
        "acc",
        s=_BY_CLASS,
    ),
)
def ordered_classes(spark, sf_dir):
    summary = summaries.by_class(views.events(spark, sf_dir), "severity", _MEANS)
    return summaries.in_fixed_order(summary, "severity", ("Fatal", "Serious", "Slight"))


@query("top_conditions", with_views("SELECT * FROM c ORDER BY count DESC, weather LIMIT 5", "acc", c=_BY_CONDITION))
def top_conditions(spark, sf_dir):
    return summaries.top_by_count(_by_condition(spark, sf_dir), "weather", 5)


@query(
    "top_condition_means",
    with_views(
        """SELECT weather, count, avg_casualties, total_events, CASE WHEN hi > lo THEN (avg_casualties - lo) / (hi - lo) ELSE 0.0::DOUBLE END AS shade
 FROM (SELECT *, min(avg_casualties) OVER () AS lo, max(avg_casualties) OVER () AS hi FROM (SELECT * FROM c
 WHERE weather NOT IN ('None', 'nan', 'Unknown', 'Data missing or out of range') ORDER BY avg_casualties DESC, weather LIMIT 3))""",
        "acc",
        c=_BY_CONDITION,
    ),
)
def top_condition_means(spark, sf_dir):
    return summaries.top_by_mean(_by_condition(spark, sf_dir), "weather", 3)


@query(
    "class_layers",
    with_views(
        "SELECT severity AS layer, count(*) AS n FROM acc WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 1", "acc"
    ),
)
def class_layers(spark, sf_dir):
    located = views.events(spark, sf_dir).select("severity", "lat", "lon").dropna(subset=["lat", "lon"])
    layers = summaries.class_layers(located, VIEW.label)
    out = None
    for name, layer in layers.items():
        part = layer.select(F.lit(name).alias("layer"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("layer").agg(F.count("*").alias("n"))

"""Sources and sinks: each query writes, reads back and returns what it read."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.operators import encoding, quality
from kerbline.plans.explore import explore, summary_lines
from kerbline.scale import scratch_path
from kerbline.sources import sinks, tables, weather
from workload import views
from workload.featuring import CLUSTERED
from workload.joining import hash_sql
from workload.registry import query
from workload.views import VIEW, with_views

_CSV_SCHEMA = "acc_id BIGINT, acc_date STRING, severity STRING, lat DOUBLE, weather STRING, n_vehicles BIGINT"


# Spark's reader takes an empty field for a null.
@query("csv_scan", with_views("SELECT acc_id, acc_date, severity, lat, nullif(weather, '') AS weather, n_vehicles FROM acc", "acc"))
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    acc = views.events(spark, sf_dir).select("acc_id", "acc_date", "severity", "lat", "weather", "n_vehicles")
    acc.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return tables.read_csv(spark, path, _CSV_SCHEMA, "acc_date")


@query("csv_scan_inferred", with_views("SELECT CAST(acc_id AS INTEGER) AS acc_id, severity, lat, CAST(n_vehicles AS INTEGER) AS n_vehicles FROM acc", "acc"))
def csv_scan_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv")
    acc = views.events(spark, sf_dir).select("acc_id", "severity", "lat", "n_vehicles")
    acc.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return tables.read_csv(spark, path)


_RAGGED = """SELECT station_id, time, CAST(CASE WHEN CAST(station_id AS INTEGER) % 3 = 2 OR day(time) = 13 THEN NULL ELSE tavg END AS FLOAT) AS tavg,
 CAST(NULL AS FLOAT) AS tmin, CAST(NULL AS FLOAT) AS tmax, CAST(prcp AS FLOAT) AS prcp,
 CAST(CASE WHEN CAST(station_id AS INTEGER) % 3 = 1 THEN day(time) END AS FLOAT) AS snow, CAST(NULL AS FLOAT) AS wspd, CAST(NULL AS FLOAT) AS pres
 FROM wx WHERE day(time) != 17 AND time BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"""


@query("ragged_csv_union", with_views(_RAGGED, "wx"))
def ragged_csv_union(spark, sf_dir):
    """Three file layouts, some bad numbers (day 13) and bad dates (day 17)."""
    base = scratch_path(spark, "weather")
    views.ragged_files(spark, sf_dir, base)
    return weather.read_daily_weather(spark, base, "1996-01-01", "2000-12-31", station=views.STATION_FOLDER)


_FILES = """SELECT 'damaged_files' AS "check", 0::BIGINT AS n_bad, 'PASS' AS status
 UNION ALL SELECT 'files_without_header', 0, 'PASS'
 UNION ALL SELECT 'lines_without_date', count(*) FILTER (day(time) = 17), CASE WHEN count(*) FILTER (day(time) = 17) > 0 THEN 'ISSUE' ELSE 'PASS' END FROM wx"""


@query("weather_file_findings", with_views(_FILES, "wx"))
def weather_file_findings(spark, sf_dir):
    base = scratch_path(spark, "weather")
    views.ragged_files(spark, sf_dir, base)
    return quality.file_findings(weather.file_ledger(spark, base)).select("check", "n_bad", "status")


@query("place_reference", with_views("SELECT id, latitude, longitude FROM stn WHERE CAST(id AS BIGINT) % 25 != 0", "stn"))
def place_reference(spark, sf_dir):
    country = F.when(F.col("id").cast("long") % 25 == 0, F.lit("FR")).otherwise(F.lit("GB"))
    return tables.place_reference(views.places(spark, sf_dir).withColumn("country", country))


@query(
    "located_sample",
    with_views(
        f"SELECT lat, lon, severity FROM acc WHERE lat IS NOT NULL AND lon IS NOT NULL ORDER BY {hash_sql('acc_id')}, acc_id LIMIT 4000", "acc"
    ),
)
def located_sample(spark, sf_dir):
    return tables.located_sample(views.events(spark, sf_dir), "acc_id", 4000, VIEW)


_YEARS = "SELECT acc_id, acc_year, severity FROM acc WHERE acc_year IN (1996, 1997)"


@query("year_partitioned_roundtrip", with_views(_YEARS, "acc"))
def year_partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "years")
    sinks.write_by(views.events(spark, sf_dir).select("acc_id", "acc_year", "severity"), path, "acc_year")
    return tables.read_parquet(spark, path).filter(F.col("acc_year").isin(1996, 1997))


@query("clustered_roundtrip", with_views(_YEARS, "acc"))
def clustered_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    sinks.write_clustered(views.events(spark, sf_dir).select("acc_id", "acc_year", "severity"), path, "acc_year", 8)
    return tables.read_parquet(spark, path).filter(F.col("acc_year").isin(1996, 1997))


@query("materialize_once", with_views("SELECT acc_id, severity FROM acc", "acc"))
def materialize_once(spark, sf_dir):
    path = scratch_path(spark, "once")
    read = lambda: views.events(spark, sf_dir).select("acc_id", "severity")
    first = sinks.materialize(spark, path, read).inputFiles()
    # Parts have new names in each write.
    if set(sinks.materialize(spark, path, read).inputFiles()) != set(first):
        raise AssertionError("a finished table was written twice")
    return tables.read_parquet(spark, path)


@query(
    "json_report_roundtrip",
    with_views("SELECT severity, count(*) AS count, round(avg(n_casualties), 2) AS avg_casualties FROM acc GROUP BY 1", "acc"),
)
def json_report_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "report")
    summary = views.events(spark, sf_dir).groupBy("severity").agg(
        F.count("*").alias("count"), F.round(F.avg("n_casualties"), 2).alias("avg_casualties")
    )
    sinks.write_json(summary, path)
    return tables.read_findings(spark, path, "severity STRING, count BIGINT, avg_casualties DOUBLE")


@query(
    "nested_report",
    with_views(
        """SELECT count(*) FILTER (severity = 'Fatal') AS fatal, count(*) FILTER (severity = 'Serious') AS serious,
 count(*) FILTER (severity = 'Slight') AS slight FROM acc""",
        "acc",
    ),
)
def nested_report(spark, sf_dir):
    path = scratch_path(spark, "nested")
    counts = views.events(spark, sf_dir).groupBy("severity").agg(F.count("*").alias("count"))
    sinks.nested_report(counts, F.col("severity"), "count").select(F.col("report").alias("value")).write.text(path)
    read = tables.read_report(spark, path)
    return read.select(*[F.col(f"{c}.count").alias(c.lower()) for c in ("Fatal", "Serious", "Slight")])


_LINES = """SELECT 1000000 AS line_no, 'Size' AS line
 UNION ALL SELECT 1000001, format('{:,} rows of 17 columns', count(*)) FROM acc
 UNION ALL SELECT 2000000, 'Share of each severity'
 UNION ALL SELECT 2000000 + row_number() OVER (ORDER BY severity), format('  {}: {:,} ({:.2f}%), mean casualties {:.2f}', severity, count(*),
 round(count(*) / (SELECT count(*) FROM acc) * 100, 2), round(avg(n_casualties), 2)) FROM acc GROUP BY severity
 UNION ALL SELECT 3000000, 'Most frequent weather'
 UNION ALL SELECT 3000000 + row_number() OVER (ORDER BY n DESC, weather), format('  {}: {:,}, mean casualties {:.2f}', weather, n, m)
 FROM (SELECT weather, count(*) AS n, round(avg(n_casualties), 2) AS m FROM acc GROUP BY 1 ORDER BY n DESC, weather LIMIT 5)
 UNION ALL SELECT 4000000, 'Events by weekday'
 UNION ALL SELECT 4000000 + row_number() OVER (ORDER BY dayname(acc_date)), format('  {}: {:,}', dayname(acc_date), count(*)) FROM acc GROUP BY dayname(acc_date)
 UNION ALL SELECT 5000000, 'Events by density band'
 UNION ALL SELECT 5000000 + row_number() OVER (ORDER BY band), format('  {}: {:,} ({:.1f}%)', band, count(*), count(*) / (SELECT count(*) FROM acc) * 100)
 FROM banded GROUP BY band"""


def _spatial(spark, sf_dir):
    return encoding.add_spatial_features(views.events(spark, sf_dir), "lat", "lon")


@query("text_summary", with_views(f"SELECT line FROM ({_LINES})", "acc", **CLUSTERED))
def text_summary(spark, sf_dir):
    path = scratch_path(spark, "summary")
    sinks.write_lines(summary_lines(explore(_spatial(spark, sf_dir), VIEW), VIEW), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "eda_tables",
    with_views(
        """SELECT 'dataset_shape' AS "table", 1::BIGINT AS n_rows
 UNION ALL SELECT 'null_statistics', (SELECT count(*) FILTER (n > 0) FROM (SELECT unnest([count(*) - count(acc_time), count(*) - count(lat),
 count(*) - count(lon), count(*) - count(speed), count(*) - count(light), count(*) - count(surface), count(*) - count(day_name)]) AS n FROM acc))
 UNION ALL SELECT 'numeric_statistics', 8
 UNION ALL SELECT 'severity_distribution', (SELECT count(DISTINCT severity) FROM acc)
 UNION ALL SELECT 'weather_analysis', (SELECT count(DISTINCT weather) FROM acc)
 UNION ALL SELECT 'hourly', (SELECT count(DISTINCT acc_time[1:2]) FILTER (acc_time != 'bad') + 1 FROM acc)
 UNION ALL SELECT 'day_of_week', (SELECT count(DISTINCT dayname(acc_date)) FROM acc)
 UNION ALL SELECT 'monthly', (SELECT count(DISTINCT month(acc_date)) FROM acc)
 UNION ALL SELECT 'by_density', (SELECT count(DISTINCT band) FROM banded)
 UNION ALL SELECT 'by_cluster', (SELECT count(DISTINCT cluster) FROM banded)""",
        "acc",
        **CLUSTERED,
    ),
)
def eda_tables(spark, sf_dir):
    """Number of rows of every table of the exploratory report."""
    out = None
    for name, table in explore(_spatial(spark, sf_dir), VIEW).items():
        part = table.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out

"""The exploratory report: every summary table of the merged data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbline.columns import col
from kerbline.operators import profiling, summaries
from kerbline.profile import ROAD, Profile
from kerbline.sources.sinks import write_json


def explore(df: DataFrame, profile: Profile = ROAD) -> dict[str, DataFrame]:
    """The report tables by name.

    Expects merged rows with the spatial features and with the casualty count,
    which cleaning removes.
    """
    p = profile
    bands, cluster = "location_density", "accident_hotspot_cluster"
    means = {"avg_casualties": p.n_casualties, "avg_vehicles": p.n_details}
    return {
        "dataset_shape": profiling.dataset_shape(df),
        "null_statistics": profiling.null_profile(df),
        "numeric_statistics": profiling.numeric_profile(df),
        "severity_distribution": summaries.by_class(df, p.label, means),
        "weather_analysis": summaries.by_condition(df, p.weather, p.n_casualties, p.key),
        "hourly": summaries.by_hour(df, p.time),
        "day_of_week": summaries.by_day_of_week(df, p.date),
        "monthly": summaries.by_month(df, p.date),
        "by_density": summaries.by_place_group(df, bands, p.n_casualties),
        "by_cluster": summaries.cluster_names(summaries.by_place_group(df, cluster, p.n_casualties), cluster),
    }


def _numbered(df: DataFrame, section: int, line: Column, *order: Column) -> DataFrame:
    # Summary tables: one short row per group.
    position = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))
    return df.select((F.lit(section * 1_000_000) + position).cast("long").alias("line_no"), line.alias("line"))


def summary_lines(report: dict[str, DataFrame], profile: Profile = ROAD) -> DataFrame:
    """Rows (line_no, line) of the text summary, in reading order."""
    p = profile
    shape = report["dataset_shape"]
    spark = shape.sparkSession

    def heading(section: int, text: str) -> DataFrame:
        return spark.range(1).select(F.lit(section * 1_000_000).cast("long").alias("line_no"), F.lit(text).alias("line"))

    def name(c: str) -> Column:
        return F.coalesce(col(c).cast("string"), F.lit("None"))

    total = shape.select("total_rows").scalar()
    number = lambda c: F.format_number(F.col(c), 0)
    mean = F.format_string("%.2f", "avg_casualties")
    severity = F.format_string(
        "  %s: %s (%.2f%%), mean casualties %s", name(p.label), number("count"), "percentage", mean
    )
    weather = F.format_string("  %s: %s, mean casualties %s", name(p.weather), number("count"), mean)
    days = F.format_string("  %s: %s", name("day_name"), number("count"))
    share = F.col("count") / F.col("__total") * 100
    band = F.format_string("  %s: %s (%.1f%%)", name("location_density"), number("count"), share)
    overview = F.format_string("%s rows of %s columns", number("total_rows"), number("total_columns"))
    top = summaries.top_by_count(report["weather_analysis"], p.weather, 5)
    bands = report["by_density"].withColumn("__total", total)
    parts = [
        heading(1, "Size"),
        _numbered(shape, 1, overview, F.col("total_rows")),
        heading(2, "Share of each severity"),
        _numbered(report["severity_distribution"], 2, severity, col(p.label)),
        heading(3, "Most frequent weather"),
        _numbered(top, 3, weather, F.desc("count"), col(p.weather)),
        heading(4, "Events by weekday"),
        _numbered(report["day_of_week"], 4, days, F.col("day_name")),
        heading(5, "Events by density band"),
        _numbered(bands, 5, band, F.col("location_density")),
    ]
    return reduce(DataFrame.unionByName, parts)


def save_report(report: dict[str, DataFrame], out_dir: str) -> None:
    """Store each report table as JSON lines."""
    for name, table in report.items():
        write_json(table, f"{out_dir}/{name}.json")

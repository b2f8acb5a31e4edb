"""Grouped summaries by class, condition, time and place, and their rankings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbline import profile as fixed
from kerbline.columns import col
from kerbline.functions.rules import min_max, relabel
from kerbline.functions.temporal import hour_of, named_day

_SHARE = "percentage"


def with_share(counts: DataFrame, n: str = "count", digits: int = 2) -> DataFrame:
    """Add each group's percentage of the grand total."""
    # One row per group, so the window is small and the rows are read once.
    total = F.sum(n).over(Window.partitionBy(F.lit(1)))
    return counts.withColumn(_SHARE, F.round(F.col(n) / total * 100, digits))


def by_class(df: DataFrame, label: str, means: Mapping[str, str], digits: int = 2) -> DataFrame:
    """Rows, share of all rows and rounded means per class (``means``: output to column)."""
    rounded = [F.round(F.avg(col(c)), digits).alias(out) for out, c in means.items()]
    return with_share(df.groupBy(col(label)).agg(F.count("*").alias("count"), *rounded), digits=digits)


def by_condition(df: DataFrame, condition: str, casualties: str, key: str, digits: int = 2) -> DataFrame:
    """Rows, mean casualties and distinct events per condition, most frequent first."""
    return (
        df.groupBy(col(condition))
        .agg(
            F.count("*").alias("count"),
            F.round(F.avg(col(casualties)), digits).alias("avg_casualties"),
            F.count_distinct(col(key)).alias("total_events"),
        )
        .orderBy(F.desc("count"), col(condition))
    )


def by_hour(df: DataFrame, time: str) -> DataFrame:
    """Rows per hour of day; missing and unreadable times are one null group."""
    return df.groupBy(hour_of(col(time)).alias("hour")).agg(F.count("*").alias("count")).orderBy("hour")


def by_day_of_week(df: DataFrame, date: str) -> DataFrame:
    """Rows per named day of week; a missing date is a group without a name."""
    day = F.dayofweek(col(date))
    counts = df.groupBy(day.alias("d")).agg(F.count("*").alias("count"))
    return counts.select(named_day(F.col("d")).alias("day_name"), "count")


def by_month(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(F.month(col(date)).alias("month")).agg(F.count("*").alias("count")).orderBy("month")


def by_place_group(df: DataFrame, group: str, casualties: str, digits: int = 2) -> DataFrame:
    """Rows and mean casualties per density band or cluster."""
    mean = F.round(F.avg(col(casualties)), digits).alias("avg_casualties")
    return df.groupBy(col(group)).agg(F.count("*").alias("count"), mean).orderBy(col(group))


def cluster_names(summary: DataFrame, cluster: str) -> DataFrame:
    """Label clusters ``Cluster_<id>``."""
    label = F.concat(F.lit("Cluster_"), col(cluster).cast("string")).alias("cluster")
    return summary.select(label, *[col(c) for c in summary.columns if c != cluster])


def yearly_coverage(df: DataFrame, date: str, dip_below_pct: float = -10.0) -> DataFrame:
    """Rows per year from first to last year, change on the year before, dip flag.

    Years without rows are listed with zero.
    """
    counts = df.filter(col(date).isNotNull()).groupBy(F.year(col(date)).alias("year")).agg(F.count("*").alias("count"))
    span = counts.agg(F.min("year").alias("a"), F.max("year").alias("b")).filter(F.col("a").isNotNull())
    years = span.select(F.explode(F.sequence("a", "b")).alias("year"))
    # A year table is short, so one ordered task is enough.
    in_order = Window.partitionBy(F.lit(1)).orderBy("year")
    full = years.join(counts, "year", "left").withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
    before = F.lag("count").over(in_order)
    change = F.when(before > 0, F.round((F.col("count") - before) / before * 100, 2))
    return full.withColumn("change_pct", change).withColumn(
        "is_dip", F.coalesce((F.col("count") == 0) | (F.col("change_pct") < dip_below_pct), F.lit(False))
    )


def peak(counts: DataFrame, name: str, n: str = "count") -> DataFrame:
    """One row: the group with most rows; the lowest group wins a tie."""
    best = F.min(F.when(F.col(name).isNotNull(), F.struct((-F.col(n)).alias("neg"), F.col(name).alias("v"))))
    return counts.agg(best.getField("v").alias("peak"))


def headline(
    df: DataFrame,
    label: str,
    time: str,
    condition: str,
    casualties: str,
    first: str = fixed.FOG_LABEL,
    second: str = fixed.CLEAR_LABEL,
) -> DataFrame:
    """One row of key figures, from one pass grouped by hour.

    The uplift compares mean casualties, rounded first, under two conditions;
    it is 0 when the second has none.
    """
    under = lambda name: F.when(col(condition) == name, col(casualties))
    hours = df.groupBy(hour_of(col(time)).alias("hour")).agg(
        F.count("*").alias("n"),
        F.count_if(col(label) == "Fatal").alias("fatal"),
        F.count_if(col(label) == "Serious").alias("serious"),
        F.sum(under(first)).alias("sum_a"),
        F.count(under(first)).alias("n_a"),
        F.sum(under(second)).alias("sum_b"),
        F.count(under(second)).alias("n_b"),
    )
    busiest = F.min(F.when(F.col("hour").isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col("hour").alias("v"))))
    totals = hours.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "fatal", "serious", "n_a", "n_b")],
        F.sum("sum_a").alias("sum_a"),
        F.sum("sum_b").alias("sum_b"),
        busiest.getField("v").alias("peak_hour"),
    )
    share = lambda part: F.when(F.col("n") > 0, F.round(F.col(part) / F.col("n") * 100, 2)).otherwise(F.lit(0.0))
    mean = lambda s, n: F.round(F.try_divide(F.col(s).cast("double"), F.col(n)), 2)
    a = F.coalesce(mean("sum_a", "n_a"), F.lit(0.0))
    b = F.coalesce(mean("sum_b", "n_b"), F.lit(1.0))
    uplift = F.when(b != 0, F.round((a / b - 1) * 100, 2)).otherwise(F.lit(0.0))
    return totals.select(
        F.col("n").alias("total"),
        F.col("fatal").alias("fatal_count"),
        share("fatal").alias("fatal_pct"),
        share("serious").alias("serious_pct"),
        "peak_hour",
        uplift.alias("uplift_pct"),
    )


def merge_coded_classes(summary: DataFrame, label: str, codes: Mapping[str, str] = fixed.CLASS_CODES) -> DataFrame:
    """Replace class codes by names; names and anything else stay."""
    return summary.withColumn(label, relabel(col(label), codes))


def top_by_count(summary: DataFrame, name: str, k: int, n: str = "count") -> DataFrame:
    return summary.orderBy(F.desc(n), col(name)).limit(k)


def top_by_mean(
    summary: DataFrame,
    name: str,
    k: int = 8,
    mean: str = "avg_casualties",
    excluded: Iterable[str] = fixed.UNCHARTED_CONDITIONS,
) -> DataFrame:
    """The ``k`` named groups with the highest mean, lowest first, with a 0..1 shade."""
    kept = summary.filter(col(name).isNotNull() & ~col(name).isin(*excluded))
    best = kept.orderBy(F.desc(mean), col(name)).limit(k)
    # At most k rows.
    whole = Window.partitionBy(F.lit(1))
    low, high = F.min(mean).over(whole), F.max(mean).over(whole)
    return best.withColumn("shade", min_max(F.col(mean), low, high)).orderBy(mean, F.desc(col(name)))


def chartable_bands(summary: DataFrame, band: str = "location_density") -> DataFrame:
    """Known density bands with rows, title-cased, most frequent first."""
    # The test uses the count, so that it stays above the aggregation and the
    # band of every row is worked out once.
    kept = summary.filter(F.when(col(band) != "unknown", F.col("count")).otherwise(0) > 0)
    return kept.withColumn(band, F.initcap(col(band))).orderBy(F.desc("count"), col(band))


def in_fixed_order(summary: DataFrame, name: str, order: Iterable[str], fill: Mapping[str, Column] | None = None) -> DataFrame:
    """Lay a summary out in a fixed category order with a ``position`` column.

    Categories without rows are filled (``fill``: column to value) or, without
    ``fill``, left out.
    """
    wanted = list(order)
    pairs = [F.struct(F.lit(i + 1).alias("position"), F.lit(w).alias(name)) for i, w in enumerate(wanted)]
    table = summary.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    if fill is None:
        # Bounded: the listed categories.
        return summary.join(F.broadcast(table), name).orderBy("position")
    # Only listed categories are wanted, so the filtered summary is as short.
    short = summary.filter(col(name).isin(*wanted))
    joined = table.join(short, name, "left")
    filled = {c: F.coalesce(col(c), v) for c, v in fill.items()}
    return joined.withColumns(filled).orderBy("position")


def short_names(df: DataFrame, name: str, length: int = 3) -> DataFrame:
    return df.withColumn(name, F.substring(col(name), 1, length))


def class_layers(df: DataFrame, label: str, order: Iterable[str] = fixed.CLASS_ORDER) -> dict[str, DataFrame]:
    """One filtered frame per class, in drawing order."""
    return {name: df.filter(col(label) == name) for name in order}

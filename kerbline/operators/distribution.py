"""Quantiles, outliers, moments, histograms and the normality test."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from kerbline.columns import col, measured, numeric, present
from kerbline.functions.rules import bin_edge, bucket
from kerbline.operators.profiling import coalesced_extremes, melted
from kerbline.operators.quantiles import at_ranks, brackets, exact_quantiles, value_of
from kerbline.operators.sampling import sample_at_most
from kerbline.profile import NOT_NORMAL_P_BELOW
from kerbline.scale import cumulative_counts, long_values, settle, value_counts_long

APPROX_ACCURACY = 10_000
FEWEST_DESCRIBED = 10


def iqr_outliers(df: DataFrame, names: Iterable[str], exact: bool = True, digits: int = 2) -> DataFrame:
    """Per column the fences Q1 - 1.5 IQR and Q3 + 1.5 IQR, and the rows outside.

    Exact quartiles are counted between the values of a sketch; ``exact=False``
    takes the sketch's own quartiles. Each row is then compared with the fences.
    """
    found = present(df, names)
    if exact:
        both = exact_quantiles(df, found, [0.25, 0.75])
        pick = lambda p: F.max(F.when(F.col("p") == p, F.col("value")))
        quartiles = both.groupBy("column").agg(pick(0.25).alias("q1"), pick(0.75).alias("q3"))
    else:
        both = F.percentile_approx("value", [0.25, 0.75], APPROX_ACCURACY).alias("q")
        quartiles = long_values(df, found).groupBy("column").agg(both).select(
            "column", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")
        )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fences = quartiles.select("column", (F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))
    outside = (F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))
    # Bounded: one row per named column.
    return (
        long_values(df, found)
        .join(F.broadcast(fences), "column")
        .groupBy("column", "lo", "hi")
        .agg(F.count_if(outside).alias("n_outliers"))
        .select("column", "n_outliers", F.round("lo", digits).alias("lower_fence"), F.round("hi", digits).alias("upper_fence"))
    )


def zscore_outliers(df: DataFrame, names: Iterable[str], threshold: float = 3.0) -> DataFrame:
    """Per column the rows more than ``threshold`` sample deviations from the mean."""
    found = present(df, names)
    aggs = []
    for i, n in enumerate(found):
        c = F.when(measured(numeric(n)), numeric(n))
        aggs += [F.avg(c).alias(f"mean_{i}"), F.stddev(c).alias(f"sd_{i}")]
    stats = melted(df.agg(*aggs), found, {"mean": "mean", "sd": "sd"})
    far = F.abs(F.col("value") - F.col("mean")) > threshold * F.col("sd")
    # Bounded: one row per named column.
    return (
        long_values(df, found)
        .join(F.broadcast(stats), "column")
        .groupBy("column")
        .agg(F.count_if(far).alias("n_outliers"), F.count("*").alias("n_valid"))
    )


def describe_numeric(df: DataFrame, names: Iterable[str], digits: int = 3) -> DataFrame:
    """Range, mean, exact median, deviation, skew, excess kurtosis, cardinality, status.

    Skew and kurtosis are population moments, the deviation is the sample one.
    A column with fewer than ten values is SKIPPED: it keeps its row, with the
    number of values and of different ones, but no measures.
    """
    found = present(df, names)
    moments = []
    for i, n in enumerate(found):
        c = value_of(n)
        for name, f in (("mean", F.avg), ("std", F.stddev), ("skewness", F.skewness), ("kurtosis", F.kurtosis)):
            moments.append(f(c).alias(f"{name}{i}"))
    # One pass for the moments and the brackets of the medians, one for the values.
    brackets_, row = brackets(df, found, [0.5], moments)
    middle = at_ranks(df, value_counts_long(df, found), brackets_, grouped=True).select("column", F.col("value").alias("median"), "cardinality")
    names_ = ("min", "max", "mean", "std", "skewness", "kurtosis")
    rows = []
    for i, n in enumerate(found):
        measures = [row[f"__a{i}"], row[f"__z{i}"], *[row[f"{m}{i}"] for m in names_[2:]]]
        enough = row[f"__n{i}"] >= FEWEST_DESCRIBED
        rows.append((n, *(measures if enough else [None] * len(measures)), row[f"__n{i}"], "DONE" if enough else "SKIPPED"))
    schema = "column string, " + ", ".join(f"{m} double" for m in names_) + ", n_valid long, status string"
    # Bounded: one row per named column.
    table = df.sparkSession.createDataFrame(rows, schema).coalesce(1)
    full = table.join(F.broadcast(middle), "column", "left")
    rounded = [F.round(c, digits).alias(c) for c in ("min", "max", "mean")]
    median = F.round(F.when(F.col("status") == "DONE", F.col("median")), digits).alias("median")
    return full.select(
        "column", *rounded, median, *[F.round(c, digits).alias(c) for c in ("std", "skewness", "kurtosis")],
        "n_valid", F.coalesce("cardinality", F.lit(0).cast("long")).alias("cardinality"), "status",
    )


def histogram(df: DataFrame, names: Iterable[str], bins: int = 10, digits: int = 3) -> DataFrame:
    """Equal-width bins per column, empty bins included, the last bin closed."""
    found = present(df, names)
    ends = coalesced_extremes(df, found).filter(F.col("lo").isNotNull())
    # Bounded: one row per named column, times the bins.
    hits = (
        long_values(df, found)
        .join(F.broadcast(ends), "column")
        .groupBy("column", bucket(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    grid = ends.select("column", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    counted = grid.join(F.broadcast(hits), ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    total = hits.groupBy("column").agg(F.sum("n").alias("total"))
    edge = lambda k: F.round(bin_edge(F.col("lo"), F.col("hi"), bins, k), digits)
    return counted.join(F.broadcast(total), "column").select(
        "column",
        "bin",
        edge(F.col("bin") - 1).alias("bin_low"),
        edge(F.col("bin")).alias("bin_high"),
        "n",
        F.round(F.col("n") / F.col("total") * 100, 1).alias("pct"),
    )


def density_grid(df: DataFrame, x: str, y: str, bins: int = 40) -> DataFrame:
    """Filled cells (bx, by, n) of an equal-width grid over both columns.

    Rows missing either coordinate are left out.
    """
    points = df.select(numeric(x).alias("x"), numeric(y).alias("y")).filter(measured(F.col("x")) & measured(F.col("y")))
    ends = points.agg(
        F.struct(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    ).scalar()
    return (
        points.withColumn("e", ends)
        .groupBy(
            bucket(F.col("x"), F.col("e.x0"), F.col("e.x1"), bins).alias("bx"),
            bucket(F.col("y"), F.col("e.y0"), F.col("e.y1"), bins).alias("by"),
        )
        .agg(F.count("*").alias("n"))
    )


def ks_normal(df: DataFrame, name: str, key: str, n: int | None = None, seed: int = 42) -> DataFrame:
    """Kolmogorov-Smirnov test of a column against the normal fitted to it.

    Every measured value is tested, unless a sample of ``n`` is asked for. With
    fewer than two values, or a single distinct one, no normal can be fitted:
    statistic, p-value and verdict are null and the status is SKIPPED.
    """
    from pyspark.ml.stat import KolmogorovSmirnovTest

    values = df.select(col(key).alias("k"), numeric(name).alias("v")).filter(measured(F.col("v")))
    values = settle(values if n is None else sample_at_most(values, n, "k", seed))
    fit = values.agg(F.avg("v").alias("m"), F.stddev("v").alias("s"), F.count("*").alias("n")).first()
    if fit["n"] < 2 or not fit["s"]:
        return df.sparkSession.createDataFrame(
            [(name, None, None, None, "SKIPPED")], "column string, ks_statistic double, p_value double, not_normal boolean, status string"
        )
    result = KolmogorovSmirnovTest.test(values, "v", "norm", float(fit["m"]), float(fit["s"]))
    return result.select(
        F.lit(name).alias("column"),
        F.round("statistic", 4).alias("ks_statistic"),
        F.round("pValue", 6).alias("p_value"),
        (F.col("pValue") < NOT_NORMAL_P_BELOW).alias("not_normal"),
        F.lit("DONE").alias("status"),
    )


# The five-term approximation of erf by Abramowitz and Stegun (7.1.26), good to 1.5e-7.
ERF_TERMS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
ERF_SLOPE = 0.3275911
KOLMOGOROV_TERMS = 40


def normal_share(z: Column) -> Column:
    """Share of the standard normal below ``z``."""
    x = F.abs(z) / math.sqrt(2.0)
    t = 1 / (1 + ERF_SLOPE * x)
    poly = F.lit(0.0)
    for a in reversed(ERF_TERMS):
        poly = (poly + a) * t
    erf = 1 - poly * F.exp(-x * x)
    return F.when(z >= 0, (1 + erf) / 2).otherwise((1 - erf) / 2)


def ks_profile(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Kolmogorov-Smirnov test of every column against the normal fitted to it.

    All values count, but equal ones only once: the statistic is the largest
    distance at a distinct value. The p-value is the asymptotic one. A column
    without two different values has null results and the status SKIPPED.
    """
    found = present(df, names)
    aggs = []
    for i, n in enumerate(found):
        c = F.when(measured(numeric(n)), numeric(n))
        aggs += [F.avg(c).alias(f"mean_{i}"), F.stddev(c).alias(f"sd_{i}"), F.count(c).alias(f"n_{i}")]
    # Bounded: one row per named column.
    stats = melted(df.agg(*aggs), found, {"mean": "mean", "sd": "sd", "n_valid": "n"})
    ranked = cumulative_counts(value_counts_long(df, found)).join(F.broadcast(stats.filter("sd > 0")), "column")
    tested = ranked.groupBy("column").agg(F.max(normal_gap()).alias("d"))
    return ks_table(stats.join(tested, "column", "left"))


def normal_gap() -> Column:
    """Distance of the share of rows up to a ranked value from the normal of ``mean`` and ``sd``."""
    below = normal_share((F.col("value") - F.col("mean")) / F.col("sd"))
    return F.greatest((F.col("before") + F.col("n")) / F.col("total") - below, below - F.col("before") / F.col("total"))


def ks_table(tested: DataFrame) -> DataFrame:
    """Statistic, p-value and verdict from rows (column, n_valid, d)."""
    root = F.col("d") * F.sqrt(F.col("n_valid"))
    tail = sum(((-1) ** (k - 1) * 2 * F.exp(-2.0 * k * k * root * root) for k in range(1, KOLMOGOROV_TERMS + 1)), F.lit(0.0))
    p = F.when(root < 0.2, F.lit(1.0)).otherwise(F.greatest(F.least(tail, F.lit(1.0)), F.lit(0.0)))
    p = F.when(F.col("d").isNotNull(), p)
    return tested.select(
        "column",
        "n_valid",
        F.round("d", 4).alias("ks_statistic"),
        F.round(p, 6).alias("p_value"),
        (p < NOT_NORMAL_P_BELOW).alias("not_normal"),
        F.when(F.col("d").isNull(), F.lit("SKIPPED")).otherwise(F.lit("DONE")).alias("status"),
    )

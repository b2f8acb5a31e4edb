"""Pearson and Spearman correlation of numeric columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from kerbline.columns import measured, numeric, present
from kerbline.profile import HIGH_CORRELATION_ABOVE, NON_LINEAR_ABOVE
from kerbline.scale import cumulative_counts, value_counts_long


def _pairs(names: list[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]


def _complete(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns as c0, c1, ... for rows that have all of them."""
    rows = df.select(*[numeric(n).alias(f"c{i}") for i, n in enumerate(names)])
    for i in range(len(names)):
        rows = rows.filter(measured(F.col(f"c{i}")))
    return rows


def _melt_pairs(row: DataFrame, names: list[str], measure: str, digits: int) -> DataFrame:
    structs = [
        F.struct(
            F.lit(names[i]).alias("left_column"),
            F.lit(names[j]).alias("right_column"),
            # Null for a constant column.
            F.round(F.col(f"r_{i}_{j}"), digits).alias(measure),
        )
        for i, j in _pairs(names)
    ]
    return row.select(F.inline(F.array(*structs)))


def pearson_counts(names: list[str]) -> list[Column]:
    """Aggregates that ``pearson_from`` reads, over the rows that have all of the columns."""
    whole = F.lit(True)
    for n in names:
        whole = whole & measured(numeric(n))
    c = [F.when(whole, numeric(n)) for n in names]
    # corr() itself fails on a constant column under ANSI.
    return [
        F.try_divide(F.covar_pop(c[i], c[j]), F.stddev_pop(c[i]) * F.stddev_pop(c[j])).alias(f"r_{i}_{j}")
        for i, j in _pairs(names)
    ]


def pearson_from(row: DataFrame, names: list[str], digits: int = 3) -> DataFrame:
    return _melt_pairs(row, names, "pearson", digits)


def pearson_pairs(df: DataFrame, names: Iterable[str], digits: int = 3) -> DataFrame:
    """Pearson r of every pair of columns in one pass over the complete rows."""
    found = present(df, names)
    return pearson_from(df.agg(*pearson_counts(found)), found, digits)


def spearman_pairs(df: DataFrame, names: Iterable[str], digits: int = 3) -> DataFrame:
    """Spearman rho of every pair of columns: Pearson r of average ranks.

    Ranks are worked out on distinct values and joined back to the distinct
    combinations, which carry their number of rows as a weight.
    """
    found = present(df, names)
    rows = _complete(df, found)
    cols = [f"c{i}" for i in range(len(found))]
    ranked = cumulative_counts(value_counts_long(rows, cols))
    ranks = ranked.select("column", "value", (F.col("before") + (F.col("n") + 1) / 2).alias("rank"))
    weighted = rows.select(*[(F.col(c) + F.lit(0.0)).alias(c) for c in cols]).groupBy(*cols).agg(F.count("*").alias("w"))
    for c in cols:
        table = ranks.filter(F.col("column") == c).select(F.col("value").alias(c), F.col("rank").alias(f"{c}_rank"))
        weighted = weighted.join(table, c).drop(c).withColumnRenamed(f"{c}_rank", f"{c}_r")
    # Ranks are centred on their known mean, so the sums stay small.
    n = rows.agg(F.count("*")).scalar()
    weighted = weighted.withColumn("__mid", (n + 1) / 2)
    centred = {f"{c}_r": F.col(f"{c}_r") - F.col("__mid") for c in cols}
    weighted = weighted.withColumns(centred)
    w = F.col("w")
    aggs = []
    for i, j in _pairs(found):
        a, b = F.col(f"c{i}_r"), F.col(f"c{j}_r")
        spread = F.sqrt(F.sum(w * a * a) * F.sum(w * b * b))
        aggs.append(F.try_divide(F.sum(w * a * b), spread).alias(f"r_{i}_{j}"))
    return _melt_pairs(weighted.agg(*aggs), found, "spearman", digits)


def compare_correlations(pearson: DataFrame, spearman: DataFrame, digits: int = 3) -> DataFrame:
    """Both coefficients per pair, with the non-linear and high-correlation flags.

    The difference is taken between the rounded coefficients.
    """
    p, s = F.col("pearson"), F.col("spearman")
    gap = F.abs(p - s)
    # Bounded: one row per pair of named columns.
    return pearson.join(F.broadcast(spearman), ["left_column", "right_column"]).select(
        "left_column",
        "right_column",
        "pearson",
        "spearman",
        F.round(gap, digits).alias("diff"),
        F.coalesce(gap > NON_LINEAR_ABOVE, F.lit(False)).alias("non_linear"),
        F.coalesce((F.abs(p) > HIGH_CORRELATION_ABOVE) | (F.abs(s) > HIGH_CORRELATION_ABOVE), F.lit(False)).alias("high"),
    )

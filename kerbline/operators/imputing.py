"""Imputation by median and by mode within a group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from kerbline.columns import col, measured, present, replace_columns
from kerbline.operators.quantiles import exact_quantiles
from kerbline.scale import attach_by_key, settle

# Rank error allowed by default: one in this many rows.
MEDIAN_ACCURACY = 1_000


def medians(df: DataFrame, names: Iterable[str], exact: bool = False) -> DataFrame:
    """One row holding an observed median of each column (null and NaN ignored).

    The default is a mergeable sketch in one pass. ``exact`` counts
    between the sketch's values instead.
    """
    found = present(df, names)
    if exact:
        middle = exact_quantiles(df, found, [0.5])
        return middle.agg(*[F.max(F.when(F.col("column") == n, F.col("lower"))).alias(n) for n in found])
    usable = [F.when(measured(col(n).cast("double")), col(n).cast("double")) for n in found]
    return df.agg(*[F.percentile_approx(u, 0.5, MEDIAN_ACCURACY).alias(n) for n, u in zip(found, usable)])


def fill_median(df: DataFrame, names: Iterable[str], exact: bool = False, facts: DataFrame | None = None) -> DataFrame:
    """Replace null and NaN by the column's median (of ``facts``, by default the rows themselves)."""
    found = present(df, names)
    if not found:
        return df
    # Stored, one row: every later pass over the result would look for the medians again.
    middle = settle(medians(df if facts is None else facts, found, exact)).select(F.struct(*[col(n) for n in found]).alias("m")).scalar()
    filled = df.withColumn("__m", middle)
    new = {n: F.when(measured(col(n).cast("double")), col(n)).otherwise(F.col("__m").getField(n)) for n in found}
    return filled.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])


def mode_counts(df: DataFrame, target: str, group: str) -> DataFrame:
    """Rows (group, target, n) for the rows that have a target."""
    return df.filter(col(target).isNotNull()).groupBy(col(group), col(target)).agg(F.count("*").alias("n"))


def _best(target: str) -> Column:
    """Aggregate over ``mode_counts``: the most frequent target, lowest value first."""
    return F.min(F.struct((-F.col("n")).alias("neg"), col(target).alias("value"))).getField("value").alias("mode")


def _modes(df: DataFrame, target: str, group: str) -> DataFrame:
    """(group, whole, mode): the mode of each group, and in the ``whole`` row that of all rows.

    The counts are partial before the shuffle, so a hot group costs no more than
    its distinct values; both kinds of mode come from one pass over the rows.
    """
    levels = mode_counts(df, target, group).rollup(col(target), col(group)).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    return levels.filter("level < 2").groupBy(col(group), (F.col("level") == 1).alias("whole")).agg(_best(target))


def group_modes(df: DataFrame, target: str, group: str) -> DataFrame:
    """The most frequent target per group; the lowest value wins a tie."""
    return mode_counts(df, target, group).groupBy(col(group)).agg(_best(target))


def fill_group_mode(df: DataFrame, target: str, group: str, nothing: str = "Unknown", facts: DataFrame | None = None) -> DataFrame:
    """Fill null targets with the mode of the row's group, else the overall mode.

    With no target value at all, ``nothing`` is used. Unchanged when either
    column is absent. ``facts`` are the rows to count, by default those filled.
    """
    if len(present(df, [target, group])) < 2:
        return df
    found = settle(_modes(df if facts is None else facts, target, group))
    modes = found.filter(~F.col("whole") & col(group).isNotNull()).select(col(group), F.col("mode").alias("__mode"))
    joined = attach_by_key(df, modes, group, stored=True).withColumn("__all", found.filter("whole").select("mode").scalar())
    filled = F.coalesce(col(target), F.col("__mode"), F.col("__all"), F.lit(nothing))
    return joined.select(*[filled.alias(c) if c == target else col(c) for c in df.columns])

"""Cleaning rules. Each is one projection or filter and skips absent columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from kerbline.columns import col, numeric, present, replace_columns, string_columns
from kerbline.functions import rules
from kerbline.operators.imputing import fill_group_mode, fill_median
from kerbline.profile import ROAD, Profile
from kerbline.scale import settle


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*present(df, names))


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: renames[old] for old in present(df, renames)})


def cast_numeric(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """To double; text that is no number becomes null."""
    return replace_columns(df, {n: numeric(n) for n in present(df, names)})


def null_sentinels(df: DataFrame, sentinels: Iterable[str]) -> DataFrame:
    """Null for sentinel texts in every string column, key and label included."""
    values = list(sentinels)
    return replace_columns(df, {n: rules.null_if_in(col(n), values) for n in string_columns(df)})


def null_negative(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return replace_columns(df, {n: rules.null_if_negative(col(n)) for n in present(df, names)})


def snap_to_legal(df: DataFrame, legal: Mapping[str, Iterable[float]]) -> DataFrame:
    return replace_columns(df, {n: rules.snap(col(n), legal[n]) for n in present(df, legal)})


def null_out_of_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return replace_columns(df, {n: rules.null_if_outside(col(n), *bounds[n]) for n in present(df, bounds)})


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop rows where a required column is null."""
    for n in present(df, names):
        df = df.filter(col(n).isNotNull())
    return df


def fill_constant(df: DataFrame, names: Iterable[str], value: str) -> DataFrame:
    found = present(df, names)
    return replace_columns(df, {n: F.coalesce(col(n), F.lit(value)) for n in found})


def null_columns(df: DataFrame, names: Iterable[str], dtype: str = "double") -> DataFrame:
    """Append columns that hold nothing but null."""
    return df.withColumns({n: F.lit(None).cast(dtype) for n in names})


def apply_row_rules(df: DataFrame, profile: Profile = ROAD) -> DataFrame:
    """The rules that look at one row only (they run on streams unchanged)."""
    df = drop_columns(df, profile.drop_columns)
    df = rename_columns(df, profile.renames)
    df = cast_numeric(df, profile.numeric)
    df = null_sentinels(df, profile.sentinels)
    df = null_negative(df, profile.null_negative)
    df = snap_to_legal(df, profile.legal_values)
    df = null_out_of_bounds(df, profile.bounds)
    return require_columns(df, profile.required)


def impute(df: DataFrame, profile: Profile = ROAD, exact_median: bool = False, facts: DataFrame | None = None) -> DataFrame:
    """Fill what the row rules left empty; medians and modes are those of ``facts``, by default of the rows.

    The group mode runs before missing groups are filled, so a row without a
    group takes the overall mode.
    """
    if not counted_once(df, profile):
        facts = None
    df = fill_median(df, profile.median, exact=exact_median, facts=facts)
    for target, group in profile.group_mode:
        df = fill_group_mode(df, target, group, profile.fill_value, facts=facts)
    return fill_constant(df, profile.unknown_fill, profile.fill_value)


def imputing_columns(df: DataFrame, profile: Profile = ROAD) -> list[str]:
    """The columns that medians and modes are taken of."""
    return present(df, [*profile.median, *[c for pair in profile.group_mode for c in pair]])


def counted_once(df: DataFrame, profile: Profile = ROAD) -> bool:
    """Whether no column is in two imputing steps; one that is must be counted after the first has filled it."""
    used = imputing_columns(df, profile)
    return bool(used) and len(set(used)) == len(used)


def clean(df: DataFrame, profile: Profile = ROAD, exact_median: bool = False) -> DataFrame:
    """All cleaning rules in order.

    The few columns that medians and modes need are stored once, so the rows
    are evaluated for them and for the result only.
    """
    df = apply_row_rules(df, profile)
    facts = settle(df.select(*[col(c) for c in imputing_columns(df, profile)])) if counted_once(df, profile) else None
    return impute(df, profile, exact_median, facts)


def row_loss(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after a step, and how many were lost."""
    counted = before.agg(F.count("*").alias("n_before")).withColumn(
        "n_after", after.agg(F.count("*")).scalar()
    )
    lost = F.col("n_before") - F.col("n_after")
    share = F.when(F.col("n_before") > 0, F.round(lost / F.col("n_before") * 100, 2)).otherwise(F.lit(0.0))
    return counted.select("n_before", "n_after", lost.alias("n_lost"), share.alias("pct_lost"))

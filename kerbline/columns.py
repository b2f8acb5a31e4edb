"""Column names, presence guards and type selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# EDA profiles look at these four types only (not decimal, short or byte).
PROFILED_NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def quoted(name: str) -> str:
    """The name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` the frame has, in the order given."""
    have = set(df.columns)
    return [n for n in names if n in have]


def numeric(name: str) -> Column:
    """Safe coercion to double: text that is no number becomes null."""
    return col(name).try_cast("double")


def measured(c: Column) -> Column:
    """True where a double holds a real value (neither null nor NaN)."""
    return c.isNotNull() & ~F.isnan(c)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, PROFILED_NUMERIC)]


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Replace columns in place with one projection (order kept)."""
    return df.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])

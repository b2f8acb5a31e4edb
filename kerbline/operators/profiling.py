"""Profiles of whole tables: missing values, numbers, duplicates, categories."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from kerbline.columns import col, measured, numeric, numeric_columns, present
from kerbline.profile import MISSING_PCT_ABOVE


def melted(row: DataFrame, names: list[str], measures: dict[str, str]) -> DataFrame:
    """Turn one wide aggregate row into one row per column.

    ``measures`` maps an output name to the prefix of its aggregates, which are
    named ``<prefix>_<position>``.
    """
    structs = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"{p}_{i}").alias(m) for m, p in measures.items()])
        for i, n in enumerate(names)
    ]
    return row.select(F.inline(F.array(*structs)))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(0.0))


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows")).withColumn("total_columns", F.lit(len(df.columns)).cast("long"))


def null_counts(names: list[str]) -> list[Column]:
    """Aggregates that ``nulls_from`` reads: rows, and nulls of each column."""
    return [F.count("*").alias("total"), *[F.count_if(col(n).isNull()).alias(f"null_{i}") for i, n in enumerate(names)]]


def nulls_from(row: DataFrame, names: list[str]) -> DataFrame:
    """Rows (column, null_count, null_pct) of the columns with nulls, from one row of ``null_counts``."""
    structs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"null_{i}").alias("null_count")) for i, n in enumerate(names)])
    out = row.select(F.inline(structs), "total").select("column", "null_count", pct(F.col("null_count"), F.col("total")).alias("null_pct"))
    return out.filter("null_count > 0")


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage of the columns that have nulls, all columns in one pass."""
    names = df.columns
    if not names:
        return df.sparkSession.createDataFrame([], "`column` string, null_count long, null_pct double")
    return nulls_from(df.agg(*null_counts(names)), names)


def numeric_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    """Min, max, mean and sample deviation of int, long, float and double columns."""
    names = numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "`column` string, min double, max double, mean double, stddev double")
    aggs = []
    for i, n in enumerate(names):
        c = col(n).cast("double")
        aggs += [
            F.min(c).alias(f"lo_{i}"),
            F.max(c).alias(f"hi_{i}"),
            F.round(F.avg(c), digits).alias(f"mean_{i}"),
            F.round(F.stddev(c), digits).alias(f"sd_{i}"),
        ]
    return melted(df.agg(*aggs), names, {"min": "lo", "max": "hi", "mean": "mean", "stddev": "sd"})


def missing_profile(df: DataFrame, table: str, required: Iterable[str] = ()) -> DataFrame:
    """Columns with missing values, flagged if required or above the threshold.

    The percentage is rounded before it is compared.
    """
    must = list(required)
    return missing_from(null_profile(df), table, must)


def missing_from(nulls: DataFrame, table: str, must: list[str]) -> DataFrame:
    needed = F.col("column").isin(*must) if must else F.lit(False)
    return nulls.select(
        F.lit(table).alias("table"),
        "column",
        "null_count",
        "null_pct",
        needed.alias("is_required"),
        (F.col("null_pct") > MISSING_PCT_ABOVE).alias("is_high"),
    )


def top_missing(profile: DataFrame, k: int = 12) -> DataFrame:
    return profile.orderBy(F.desc("null_pct"), "column").limit(k)


def duplicate_rows(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """One row ``n_duplicates``: rows beyond the first of each equal group.

    Without ``names`` whole rows are compared. Nulls are equal to each other.
    """
    keys = list(names) if names is not None else df.columns
    groups = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def nested_duplicates(df: DataFrame, levels: list[list[str]]) -> DataFrame:
    """One row: duplicates of whole rows (``rows``) and of each key, from one pass.

    Every key in ``levels`` continues the one before it. Rows are grouped by the
    longest key and a 128-bit fingerprint of the row, those groups by the next
    shorter key, and so on, so whole rows are never moved. Two rows with one key
    and one fingerprint are taken as equal: for n rows some two would differ
    with a probability below n * n / 2**128.
    """
    kinds = dict(df.dtypes)
    whole = [col(c) for c in df.columns if "map<" not in kinds[c] and kinds[c] != "variant"]
    longest = levels[-1]
    keyed = df.select(*[col(k) for k in longest], F.xxhash64(F.lit(1), *_marked(whole)).alias("__f1"), F.xxhash64(F.lit(2), *_marked(whole)).alias("__f2"))
    groups = keyed.groupBy(*[col(k) for k in longest], "__f1", "__f2").agg(F.count("*").alias("__n"))
    extra = [(F.col("__n") - 1).alias("__d0")]
    groups = groups.select(*[col(k) for k in longest], "__n", *extra)
    for i, keys in enumerate(reversed(levels), 1):
        sums = [F.sum(f"__d{k}").alias(f"__d{k}") for k in range(i)]
        groups = groups.groupBy(*[col(k) for k in keys]).agg(F.sum("__n").alias("__n"), *sums).withColumn(f"__d{i}", F.col("__n") - 1)
    names = ["rows", *[",".join(k) for k in reversed(levels)]]
    return groups.agg(*[F.coalesce(F.sum(f"__d{i}"), F.lit(0)).cast("long").alias(n) for i, n in enumerate(names)])


def _marked(columns: list[Column]) -> list[Column]:
    """Each value with a mark of its null, which the hash itself would skip."""
    return [x for c in columns for x in (c.isNull(), c)]


def duplicate_profile(checks: list[tuple[str, DataFrame, list[list[str]]]]) -> DataFrame:
    """Rows (check, n_duplicates) of (prefix, table, keys from short to long): one pass a table."""
    parts = []
    for prefix, df, levels in checks:
        row = nested_duplicates(df, levels)
        told = [("rows", "rows"), *[(",".join(k), "key" if len(k) == 1 else "composite_key") for k in levels]]
        shown = [F.struct(F.lit(f"{prefix}_{name}").alias("check"), col(c).alias("n_duplicates")) for c, name in told]
        parts.append(row.select(F.inline(F.array(*shown))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def category_sample(df: DataFrame, name: str, k: int = 10) -> DataFrame:
    """One row: how many distinct values a column has, and the first ``k`` of them."""
    values = df.filter(col(name).isNotNull()).select(col(name).cast("string").alias("v")).distinct()
    first = values.orderBy("v").limit(k).agg(F.array_join(F.sort_array(F.collect_list("v")), "|").alias("s"))
    return values.agg(F.count("*").alias("n_distinct")).select(
        F.lit(name).alias("column"), "n_distinct", first.scalar().alias("sample")
    )


def value_counts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows (column, value, n) of the non-null values of categorical columns."""
    found = present(df, names)
    text = df.select(*[col(n).cast("string").alias(n) for n in found])
    long = text.unpivot([], [col(n) for n in found], "column", "value").filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def coalesced_extremes(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows (column, lo, hi) of the measured values, all columns in one pass."""
    found = list(names)
    aggs = []
    for i, n in enumerate(found):
        c = F.when(measured(numeric(n)), numeric(n))
        aggs += [F.min(c).alias(f"lo_{i}"), F.max(c).alias(f"hi_{i}")]
    return melted(df.agg(*aggs), found, {"lo": "lo", "hi": "hi"})

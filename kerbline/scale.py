"""Helpers that keep operators safe on large and skewed data.

* ``settle`` cuts lineage with a stored table, so a lost executor costs a
  re-read, not a recomputation.
* ``attach_by_key`` broadcasts a lookup table only after counting its rows and
  otherwise joins by shuffle.
* ``spread_left_join`` keeps rows with a null key out of a single task.
* ``cumulative_counts`` is a prefix sum over distinct values that never sorts
  a whole column in one task. Average ranks and the normality test build on it.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kerbline.columns import col, measured, numeric

# A lookup table at or under this many rows may be broadcast.
BROADCAST_ROWS = 20_000
# Tasks over which rows with a null join key are spread.
NULL_SPREAD = 256
# Usual size of one input split.
SPLIT_BYTES = 128 * 1024 * 1024
# The JVM compiles no method of more bytes; it stays interpreted.
COMPILED_BYTES = "8000"
# Up to this many distinct values are ranked without a range sort.
BUCKET_VALUES = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by the session.

    Only a session on one machine may fall back to a temporary folder; on a
    cluster each executor would write its own disk and later reads would miss
    the rows, so a missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors share (master is {master})")
    own = tempfile.mkdtemp(prefix="kerbline-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Store a frame in the shared folder and read it back.

    Computed once; later uses read files, so a lost executor costs a re-read.
    Neither row order nor partitioning is kept.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "settled")
    # Any column name is legal in a frame, but not in a file.
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    plain.write.parquet(path)
    return spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside split generated code that is too long for the JVM to compile.

    Wide chains of expressions otherwise end in one interpreted method, several times slower. The
    session's own setting is put back afterwards.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, COMPILED_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def within(df: DataFrame, max_rows: int) -> bool:
    """Whether a frame has at most ``max_rows`` rows (reads no more than that)."""
    return df.limit(max_rows + 1).count() <= max_rows


def likely_tasks(df: DataFrame) -> int:
    """Tasks a frame would be read in, by the optimizer's size estimate (runs no job)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, size // SPLIT_BYTES)


def spread_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left equi-join whose null-key rows do not meet in one task.

    Null keys never match, so those rows get a salt the right side does not
    have. Hot real keys stay on one salt and are split by the adaptive skew
    join, which may split the left side of a left join.
    """
    rest = [c for c in left.columns if c not in keys]
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | col(k).isNull()
    spread = F.lit(1) + F.pmod(F.xxhash64(*[col(c) for c in rest or keys]), F.lit(NULL_SPREAD))
    salted = left.withColumn("__salt", F.when(any_null, spread).otherwise(F.lit(0)).cast("long"))
    # Always zero, but computed from the key, so that it stays a join key and
    # is not folded into a constant condition.
    zero = F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(1)).cast("long")
    other = right.withColumn("__salt", zero)
    return salted.join(other, [*keys, "__salt"], "left").drop("__salt")


def attach_by_key(df: DataFrame, table: DataFrame, key: str, max_rows: int = BROADCAST_ROWS, stored: bool = False) -> DataFrame:
    """Left-join a lookup table with one row per key, by broadcast if it is small.

    A ``stored`` table is cheap to read twice and not stored again.
    """
    table = table if stored else settle(table)
    order = df.columns + [c for c in table.columns if c != key]
    if within(table, max_rows):
        joined = df.join(F.broadcast(table), key, "left")
    else:
        joined = spread_left_join(df, table, [key])
    return joined.select(*[col(c) for c in order])


def long_values(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows (column, value) of all measured values of the named columns."""
    wide = df.select(*[numeric(n).alias(n) for n in names])
    # Minus zero and zero are one value, as they are in comparisons.
    long = wide.unpivot([], [col(n) for n in names], "column", "value")
    return long.filter(measured(F.col("value"))).withColumn("value", F.col("value") + F.lit(0.0))


def value_counts_long(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows (column, value, n), counted before the shuffle so hot values are cheap."""
    return long_values(df, names).groupBy("column", "value").agg(F.count("*").alias("n"))


def cumulative_counts(counts: DataFrame, bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """Add ``before`` (rows with a smaller value) and ``total`` to value counts.

    Many distinct values are range-sorted and stored with the number of their
    partition first. Those partitions are consecutive value ranges of even
    size: their totals (at most columns + partitions rows) give each range its
    start, and a window inside each range the rest.
    """
    counts = settle(counts)
    if counts.count() > bucket_values:
        bucketed = settle(counts.orderBy("column", "value").withColumn("__bucket", F.spark_partition_id()))
    else:
        bucketed = counts.withColumn("__bucket", F.lit(0))
    ordered = Window.partitionBy("column").orderBy("__bucket")
    starts = (
        bucketed.groupBy("column", "__bucket")
        .agg(F.sum("n").alias("__in_bucket"))
        .withColumn("__start", F.sum("__in_bucket").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__in_bucket"))
        .withColumn("total", F.sum("__in_bucket").over(Window.partitionBy("column")))
        .drop("__in_bucket")
    )
    inside = Window.partitionBy("column", "__bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return (
        bucketed.withColumn("__run", F.sum("n").over(inside) - F.col("n"))
        # Bounded: columns + partitions rows.
        .join(F.broadcast(starts), ["column", "__bucket"])
        .select("column", "value", "n", (F.col("__start") + F.col("__run")).alias("before"), "total")
    )

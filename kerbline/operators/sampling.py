"""Splits, samples and class balance.

Every random choice is a hash of the row's key and a seed. It does not depend
on partitioning, and a retried task repeats it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbline.columns import col
from kerbline.scale import attach_by_key, likely_tasks

_HASH_RANGE = 2**32
# Rows a top-k merge may be sent by all tasks together.
MERGED_ROWS = 2_000_000


def hash_unit(key: Column, seed: int | None = None) -> Column:
    """A number in [0, 1) fixed by key and seed (first 32 bits of an MD5)."""
    return hash_int(key, seed) / F.lit(float(_HASH_RANGE))


def hash_int(key: Column, seed: int | None = None) -> Column:
    text = key.cast("string")
    if seed is not None:
        text = F.concat(text, F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def in_train_part(key: Column, train_pct: int = 80) -> Column:
    """Whether a row belongs to the training part; rows without a key do not."""
    return F.coalesce(hash_int(key) % 100 < train_pct, F.lit(False))


def split_by_key(df: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test part; rows without a key go to the test part."""
    in_train = in_train_part(col(key), train_pct)
    return df.filter(in_train), df.filter(~in_train)


def random_split(df: DataFrame, weights: tuple[float, float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Spark's own split; its outcome depends on the partitioning of ``df``."""
    return df.randomSplit(list(weights), seed)


def sample_fraction(df: DataFrame, fraction: float, key: str, seed: int = 42) -> DataFrame:
    return df.filter(hash_unit(col(key), seed) < fraction)


def sample_at_most(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """At most ``n`` rows without replacement: those with the lowest key hashes.

    A top-k per task and a merge, not a full sort. Where the tasks together
    would send much more than ``n`` rows to the merge, a count by hash range
    first finds the ranges that can hold the sample.
    """
    hashed = df.withColumn("__h", hash_int(col(key), seed))
    if likely_tasks(df) * n > MERGED_ROWS:
        hashed = _lowest_ranges(hashed, n)
    return hashed.orderBy("__h", col(key)).limit(n).drop("__h")


def _lowest_ranges(hashed: DataFrame, n: int) -> DataFrame:
    """Drop the hash ranges above the one in which the ``n``-th lowest row lies."""
    ranges = F.shiftright("__h", 16)
    # Bounded: 65,536 ranges and one for rows without a key.
    counts = hashed.groupBy(ranges.alias("r")).agg(F.count("*").alias("n")).orderBy("r").collect()
    seen = 0
    for row in counts:
        seen += row["n"]
        if seen >= n:
            last = -1 if row["r"] is None else row["r"]
            return hashed.filter(F.col("__h").isNull() | (ranges <= last))
    return hashed


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(col(label)).agg(F.count("*").alias("n"))


def class_fractions(df: DataFrame, label: str, ratio: float = 3.0) -> DataFrame:
    """Per class the share of rows to keep: no class above ``ratio`` x the smallest."""
    counts = class_counts(df, label)
    # One row per class.
    smallest = F.min("n").over(Window.partitionBy(F.lit(1)))
    cap = F.floor(smallest * F.lit(float(ratio)))
    return counts.select(col(label), "n", F.least(F.lit(1.0), cap / F.col("n")).alias("fraction"))


def undersample(df: DataFrame, label: str, key: str, ratio: float = 3.0, seed: int = 42) -> DataFrame:
    """Thin out the frequent classes; sizes are approximate, a null label is dropped."""
    shares = class_fractions(df, label, ratio).filter(col(label).isNotNull()).select(col(label), "fraction")
    joined = attach_by_key(df.filter(col(label).isNotNull()), shares, label)
    return joined.filter(hash_unit(col(key), seed) < F.col("fraction")).select(*[col(c) for c in df.columns])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes x rows of the class)."""
    counts = class_counts(df, label).filter(col(label).isNotNull())
    # One row per class.
    whole = Window.partitionBy(F.lit(1))
    weight = F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n"))
    return counts.select(col(label), "n", weight.alias("weight"))

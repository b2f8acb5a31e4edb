"""Key overlap of two tables, from one grouped pass over both key columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbline.columns import col, numeric


def key_presence(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per non-null key with flags ``in_left`` and ``in_right``.

    Keys are reduced to distinct ones before the shuffle, so a hot key is one
    row per task.
    """
    both = left.select(col(key).alias(key), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(col(key).alias(key), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return (
        both.filter(col(key).isNotNull())
        .groupBy(col(key))
        .agg((F.max("l") == 1).alias("in_left"), (F.max("r") == 1).alias("in_right"))
    )


def keys_in_both(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return key_presence(left, right, key).filter(F.col("in_left") & F.col("in_right")).select(col(key))


def keys_only_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return key_presence(left, right, key).filter(~F.col("in_right")).select(col(key))


def keys_only_right(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return key_presence(left, right, key).filter(~F.col("in_left")).select(col(key))


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys per side, matched, unmatched both ways, percentages."""
    l, r = F.col("in_left"), F.col("in_right")

    def share(part: str, whole: str):
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * 100)

    return (
        key_presence(left, right, key)
        .agg(
            F.count_if(l).alias("left_keys"),
            F.count_if(r).alias("right_keys"),
            F.count_if(l & r).alias("matched"),
            F.count_if(l & ~r).alias("only_left"),
            F.count_if(r & ~l).alias("only_right"),
        )
        .withColumns(
            {
                "only_left_pct": F.round(share("only_left", "left_keys"), 2),
                "only_right_pct": F.round(share("only_right", "right_keys"), 2),
            }
        )
    )


def first_detail(details: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Per key, the value on the row with the lowest ``order``."""
    first = F.min(F.struct(col(order).alias("o"), col(value).alias("v"))).getField("v")
    return details.groupBy(col(key)).agg(first.alias("first_value"))


def cross_table_mismatch(events: DataFrame, details: DataFrame, key: str, order: str, left: str, right: str) -> DataFrame:
    """One row: matched events and how many differ from their first detail row.

    A value missing or unreadable on either side counts as a difference.
    """
    first = first_detail(details.filter(col(key).isNotNull()), key, order, right)
    pairs = events.select(col(key), numeric(left).alias("__e")).join(first, key)
    differs = F.coalesce(F.col("__e") != F.col("first_value").try_cast("double"), F.lit(True))
    return pairs.agg(F.count("*").alias("n_total"), F.count_if(differs).alias("n_bad"))

"""Exact quantiles of many columns by rank brackets.

A mergeable sketch gives, for every asked rank, two values between which the rank lies for sure,
because the sketch's rank error is known. Counting the rows below the lower one and grouping the
few values in between then gives the exact value. Nothing is sorted or stored but those values;
where they would still be many, another sketch of the rows inside narrows the bracket first.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from kerbline.columns import measured, numeric
from kerbline.scale import long_values

# The sketch's rank error is one in this many rows.
ACCURACY = 1_000
# The bracket reaches this many times the error to each side.
MARGIN = 3
# Rows of one bracket that are grouped at once.
FEW = 100_000


@dataclass(frozen=True)
class Bracket:
    """Where the quantile ``p`` of a column of ``n`` values lies."""

    column: str
    p: float
    n: int
    low: float
    high: float
    inside: float

    @property
    def rank(self) -> float:
        return self.p * (self.n - 1)


def value_of(name: str) -> Column:
    """The column as a double, null where nothing was measured; minus zero is zero."""
    return F.when(measured(numeric(name)), numeric(name) + F.lit(0.0))


def _around(share: float) -> tuple[float, float]:
    reach = MARGIN / ACCURACY
    return max(0.0, share - reach), min(1.0, share + reach)


def brackets(df: DataFrame, names: list[str], probs: Iterable[float], also: Iterable[Column] = ()) -> tuple[list[Bracket], Row]:
    """Brackets of every column and quantile, and the row of further aggregates from the same pass."""
    probs = list(probs)
    asked = [s for p in probs for s in _around(p)]
    aggs = list(also)
    for i, name in enumerate(names):
        v = value_of(name)
        aggs += [F.count(v).alias(f"__n{i}"), F.min(v).alias(f"__a{i}"), F.max(v).alias(f"__z{i}"), F.percentile_approx(v, asked, ACCURACY).alias(f"__q{i}")]
    row = df.agg(*aggs).first()
    found = []
    for i, name in enumerate(names):
        n, q = row[f"__n{i}"], row[f"__q{i}"]
        for k, p in enumerate(probs if n else []):
            share_low, share_high = _around(p)
            # The ends are exact.
            low = q[2 * k] if share_low > 0 else row[f"__a{i}"]
            high = q[2 * k + 1] if share_high < 1 else row[f"__z{i}"]
            found.append(Bracket(name, p, n, low, high, 2 * (MARGIN + 1) * n / ACCURACY + 2))
    return _narrowed(df, found), row


def _narrowed(df: DataFrame, found: list[Bracket]) -> list[Bracket]:
    """Brackets that hold few rows, or rows of one value."""
    while wide := [b for b in found if b.inside > FEW and b.low < b.high]:
        aggs = []
        for i, b in enumerate(wide):
            v = value_of(b.column)
            aggs += [F.count_if(v < b.low).alias(f"b{i}"), F.count_if((v >= b.low) & (v <= b.high)).alias(f"n{i}")]
        counts = df.agg(*aggs).first()
        sketches = []
        for i, b in enumerate(wide):
            v, below, inside = value_of(b.column), counts[f"b{i}"], counts[f"n{i}"]
            asked = list(_around((b.rank - below) / max(1, inside - 1)))
            sketches.append(F.percentile_approx(F.when((v >= b.low) & (v <= b.high), v), asked, ACCURACY).alias(f"q{i}"))
        row = df.agg(*sketches).first()
        better = {}
        for i, b in enumerate(wide):
            inside = counts[f"n{i}"]
            if inside <= FEW:
                better[b] = Bracket(b.column, b.p, b.n, b.low, b.high, inside)
                continue
            share_low, share_high = _around((b.rank - counts[f"b{i}"]) / (inside - 1))
            low, high = row[f"q{i}"]
            low, high = low if share_low > 0 else b.low, high if share_high < 1 else b.high
            same = (low, high) == (b.low, b.high)
            # A value with most of the rows can not be cut away; it groups to one row.
            better[b] = Bracket(b.column, b.p, b.n, low, high, 0 if same else 2 * (MARGIN + 1) * inside / ACCURACY + 2)
        found = [better.get(b, b) for b in found]
    return found


def _slots(df: DataFrame, found: list[Bracket]) -> DataFrame:
    rows = [(i, b.column, float(b.p), b.n, float(b.low), float(b.high)) for i, b in enumerate(found)]
    return df.sparkSession.createDataFrame(rows, "slot int, column string, p double, total long, low double, high double")


def at_ranks(df: DataFrame, counts: DataFrame, found: list[Bracket], grouped: bool = False) -> DataFrame:
    """(column, p, total, lower, value) from rows (column, value, n).

    ``value`` is linearly interpolated, ``lower`` the observed value below. Where
    the rows are ``grouped``, with each value once, ``cardinality`` tells how many.
    """
    # Bounded: one row for each column and quantile.
    slots = F.broadcast(_slots(df, found))
    placed = counts.join(slots, "column")
    here = (F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high"))
    if not grouped:
        kept = placed.filter(F.col("value") <= F.col("high"))
        placed = kept.groupBy("slot", "low", "high", F.when(here, F.col("value")).alias("value")).agg(F.sum("n").alias("n"))
    held = placed.groupBy("slot").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull() | (F.col("value") < F.col("low")), F.col("n"))), F.lit(0)).alias("below"),
        F.array_sort(F.collect_list(F.when(here, F.struct("value", "n")))).alias("inside"),
        F.count("*").alias("cardinality"),
    )
    k = F.col("p") * (F.col("total") - 1)

    def at(rank: Column) -> Column:
        start = F.struct(F.col("below").alias("seen"), F.lit(None).cast("double").alias("v"))
        step = lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"), F.when(a["v"].isNull() & (rank < a["seen"] + x["n"]), x["value"]).otherwise(a["v"]).alias("v"))
        got = F.when(rank >= F.col("below"), F.aggregate("inside", start, step)["v"])
        return F.coalesce(got, F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))

    out = held.join(slots, "slot").select("*", (k - F.floor(k)).alias("part"), at(F.floor(k)).alias("lower"), at(F.ceil(k)).alias("upper"))
    value = F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("part")
    return out.select("column", "p", "total", "lower", value.alias("value"), *(["cardinality"] if grouped else []))


def exact_quantiles(df: DataFrame, names: list[str], probs: Iterable[float]) -> DataFrame:
    """(column, p, total, lower, value) of the measured values; a column without any has no row."""
    found, _ = brackets(df, names, probs)
    return at_ranks(df, long_values(df, names).withColumn("n", F.lit(1)), found)

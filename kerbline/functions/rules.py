"""Row rules: sentinels, legal values, bounds and safe text handling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F


def null_if_in(c: Column, values: Iterable[str]) -> Column:
    """Null for the listed values (exact, case-sensitive, untrimmed)."""
    return F.when(c.isin(*values), F.lit(None)).otherwise(c)


def null_if_negative(c: Column) -> Column:
    return F.when(c < 0, F.lit(None)).otherwise(c)


def null_if_outside(c: Column, low: float, high: float) -> Column:
    """Null outside the closed interval."""
    return F.when((c < low) | (c > high), F.lit(None)).otherwise(c)


def snap(c: Column, legal: Iterable[float]) -> Column:
    """The nearest legal value; a value on a midpoint goes down, null stays null."""
    steps = sorted(float(v) for v in legal)
    nearest = F.lit(steps[-1])
    for low, high in reversed(list(zip(steps, steps[1:]))):
        nearest = F.when(c <= (low + high) / 2, F.lit(low)).otherwise(nearest)
    return F.when(c.isNull() | c.isin(*steps), c).otherwise(nearest)


def lookup(c: Column, table: Mapping[str, object], default: object = None) -> Column:
    """Literal map lookup; an absent or null key gives ``default``."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.element_at(F.create_map(*pairs), c)
    return found if default is None else F.coalesce(found, F.lit(default))


def relabel(c: Column, codes: Mapping[str, str]) -> Column:
    """Replace codes by labels; anything unmapped passes through as text."""
    text = c.cast("string")
    return F.coalesce(lookup(text, codes), text)


def capitalised(c: Column) -> Column:
    """Trimmed, first letter upper case, the rest lower case."""
    t = F.trim(c)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substr(t, F.lit(2))))


def clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def min_max(c: Column, low: Column, high: Column) -> Column:
    """(c - low) / (high - low); unscaled (zero) where the range is empty."""
    return F.when(high > low, (c - low) / (high - low)).otherwise(c - low)


def bucket(c: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 1..bins over [low, high], the last bin closed.

    A constant column is widened by 0.5 to each side. The bin found by division
    is checked against the edges themselves, so rounding cannot move a value.
    """
    lo, hi = _widened(low, high)
    guess = F.greatest(F.lit(1), F.least(F.floor((c - lo) / ((hi - lo) / bins)) + 1, F.lit(bins)))
    return (
        F.when(c < bin_edge(low, high, bins, guess - 1), guess - 1)
        .when((c >= bin_edge(low, high, bins, guess)) & (guess < bins), guess + 1)
        .otherwise(guess)
        .cast("int")
    )


def bin_edge(low: Column, high: Column, bins: int, edge: Column) -> Column:
    """Edge number ``edge`` (0..bins) of the bins of ``bucket``."""
    lo, hi = _widened(low, high)
    return F.when(edge == bins, hi).otherwise(lo + (hi - lo) / bins * edge)


def _widened(low: Column, high: Column) -> tuple[Column, Column]:
    flat = low == high
    return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)

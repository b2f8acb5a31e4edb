"""Dates and times of day, parsed without ever failing a job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from kerbline.functions.rules import lookup
from kerbline.profile import DATE_PATTERN, TIME_PATTERN, VALID_DAYS


def parsed_date(c: Column) -> Column:
    """A date from a date or from ``yyyy-MM-dd`` text; null if it is neither."""
    return F.try_to_date(c.cast("string"), DATE_PATTERN)


def hour_of(c: Column) -> Column:
    """Hour of an ``H:mm`` time; null if the text is no time of day."""
    return F.hour(F.try_to_timestamp(c, F.lit("H:mm")))


def day_name(c: Column) -> Column:
    """Full English day name of a date."""
    return named_day(F.dayofweek(c))


def named_day(number: Column) -> Column:
    """Full English name of day 1 (Sunday) to 7; null for null.

    A map lookup: an array lookup at a null position is not null under ANSI.
    """
    return lookup(number, dict(enumerate(VALID_DAYS, start=1)))


def bad_time_format(c: Column) -> Column:
    """True for text that is not ``H:mm`` or ``HH:mm``; null for null."""
    return ~c.rlike(TIME_PATTERN)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """A date from three text parts; null when they name no real day."""
    parts = F.concat_ws("-", F.trim(year), F.lpad(F.trim(month), 2, "0"), F.lpad(F.trim(day), 2, "0"))
    return F.try_to_date(parts, DATE_PATTERN)

"""Daily weather from many CSV files with different headers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kerbline.functions.temporal import date_from_parts
from kerbline.profile import WEATHER_COLUMNS, WEATHER_DATES
from kerbline.scale import attach_by_key

# Source column of each output column; the others keep their name.
SOURCE_NAMES = {"tavg": "temp", "snow": "snwd"}
DATE_PARTS = ("year", "month", "day")
STATION_PATTERN = r"([^/]*)_[^_/]*$"
_COMMA_OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _fields(line: Column) -> Column:
    """The fields of a CSV line without blanks and quotes around them."""
    parts = F.when(F.contains(line, F.lit('"')), F.split(line, _COMMA_OUTSIDE_QUOTES, -1)).otherwise(F.split(line, ",", -1))
    return F.transform(parts, lambda x: F.trim(F.regexp_replace(F.trim(x), r'^"|"$', "")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), _fields(F.col("value")).alias("fields"))


def _is_header(fields: Column) -> Column:
    return reduce(lambda a, b: a & b, [F.array_contains(fields, d) for d in DATE_PARTS])


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, names): the header of each file, the line that names all date parts."""
    return _lines(spark, path).filter(_is_header(F.col("fields"))).groupBy("file").agg(F.min("fields").alias("names"))


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, reason) of files that ``read_daily_weather`` reads in part or not at all.

    A file is damaged if its compressed stream does not end well; others may
    have no header. Each file is looked at as a whole, as compressed files are
    read anyway.
    """

    def damaged(batches):
        import zlib

        for frame in batches:
            bad = []
            for name, content in zip(frame["path"], frame["content"], strict=True):
                stream, rest, fine = zlib.decompressobj(31), bytes(content), True
                try:
                    while name.endswith(".gz") and fine and rest:
                        stream.decompress(rest)
                        fine, rest = stream.eof, stream.unused_data
                        stream = zlib.decompressobj(31)
                except zlib.error:
                    fine = False
                bad.append(not fine)
            yield frame.loc[bad, ["path"]].rename(columns={"path": "file"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    broken = files.select("path", "content").mapInPandas(damaged, "file string")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    headed = file_headers(spark, path).select(plain("file").alias("file"))
    broken = broken.select(plain("file").alias("file"), F.lit("damaged").alias("reason"))
    missing = files.select(plain("path").alias("file")).join(headed, "file", "left_anti").join(broken, "file", "left_anti")
    return broken.unionByName(missing.withColumn("reason", F.lit("no header")))


def file_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(file, lines, dated, reason): every file with the lines read, those with a valid date, and what is wrong.

    ``reason`` is null for a file read in full. Lines exclude the header; of a
    damaged file they are those before the damage.
    """
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/").alias("file")
    headers = file_headers(spark, path)
    lines = attach_by_key(_lines(spark, path), headers, "file").filter(F.col("names").isNull() | ~_is_header(F.col("fields")))
    parts = [F.get("fields", (F.array_position("names", d) - 1).cast("int")) for d in DATE_PARTS]
    counts = lines.groupBy(plain("file")).agg(F.count("*").alias("lines"), F.count(date_from_parts(*parts)).alias("dated"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(plain("path"))
    told = files.join(counts, "file", "left").join(unreadable_files(spark, path), "file", "left")
    return told.select("file", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("lines", "dated")], "reason")


def read_daily_weather(
    spark: SparkSession,
    path: str,
    first: str = WEATHER_DATES[0],
    last: str = WEATHER_DATES[1],
    station: str = STATION_PATTERN,
) -> DataFrame:
    """All files as one table (station_id, time, seven measures as float).

    ``station`` finds the station in the file path: by default the file name
    before its last underscore. Absent columns and
    unreadable numbers are null; rows without a valid date, or outside the
    closed date range, are left out. Any number of headers and files is read with
    two scans; files read in part or not at all are told by ``unreadable_files``.
    """
    headers = file_headers(spark, path)
    if headers.isEmpty():
        raise ValueError(f"no weather file with year, month and day below {path}")
    rows = attach_by_key(_lines(spark, path), headers, "file").filter(F.col("names").isNotNull() & ~_is_header(F.col("fields")))

    # A name that a file lacks has position 0, and place -1 holds nothing.
    def value(name: str) -> Column:
        return F.get("fields", (F.array_position("names", name) - 1).cast("int"))

    measures = [value(SOURCE_NAMES.get(c, c)).try_cast("float").alias(c) for c in WEATHER_COLUMNS]
    time = date_from_parts(*[value(p) for p in DATE_PARTS])
    table = rows.select(F.regexp_extract("file", station, 1).alias("station_id"), time.alias("time"), *measures)
    return table.filter(F.col("time").between(F.lit(first).cast("date"), F.lit(last).cast("date")))

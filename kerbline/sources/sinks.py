"""Writers: clustered Parquet, once-only tables, JSON and text reports."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kerbline.columns import col

MANIFEST = "_manifest"


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_by(df: DataFrame, path: str, column: str) -> None:
    """Parquet with one directory per value, for partition pruning.

    Rows are rebalanced on the column first: small values share a task, and a
    value holding much of the table is split over several.
    """
    df.hint("rebalance", col(column)).write.mode("overwrite").partitionBy(column).parquet(path)


def write_clustered(df: DataFrame, path: str, column: str, partitions: int = 32) -> None:
    """Parquet hash-clustered on a column, without directories."""
    df.repartition(partitions, col(column)).write.mode("overwrite").parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing the path (its success marker exists)."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def fingerprint(df: DataFrame) -> str:
    """What a frame follows from: its plan, and name, size and time of every file it reads.

    Rows held in memory have no file, so a frame over such rows is read and told by its content.
    """
    spark = df.sparkSession
    width = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(width)
    spark.conf.set(width, "100000")
    try:
        plan = df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set(width, before)
    told = [re.sub(r"#\d+L?", "#", plan)]
    files = df.inputFiles()
    if files:
        # Only the file table is read, not the files.
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([unquote(f) for f in files])
        told.append(_content(listed.select("path", "length", "modificationTime")))
    if not files or re.search(r"LocalRelation|LogicalRDD", plan):
        told.append(_content(df))
    return hashlib.sha256("|".join(told).encode()).hexdigest()


def _content(df: DataFrame) -> str:
    """Rows and a sum of row hashes, whatever their order."""
    row = F.xxhash64(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    return str(tuple(df.agg(F.count("*"), F.sum(row.cast("decimal(38,0)"))).first()))


def _manifest(spark: SparkSession, path: str) -> str | None:
    inside = f"{path}/{MANIFEST}"
    if not (is_complete(spark, path) and is_complete(spark, inside)):
        return None
    return spark.read.text(inside).first()["value"]


def materialize(spark: SparkSession, path: str, make: Callable[[], DataFrame], also: Iterable[DataFrame] = ()) -> DataFrame:
    """Write a table and read it back; it is not written again while what it follows from is the same.

    The fingerprint of the plan and its files is stored inside the table, after its rows, so an
    overwrite or an unfinished write has none. ``also`` names stored frames that the result follows
    from but that its plan does not show, such as a table sent inside a function.
    """
    df = make()
    asked = "+".join(fingerprint(x) for x in (df, *also))
    if _manifest(spark, path) != asked:
        write_parquet(df, path)
        spark.range(1).select(F.lit(asked).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/{MANIFEST}")
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def nested_report(df: DataFrame, name: Column, *columns: str) -> DataFrame:
    """One row ``report``: a JSON object from group name to its measures.

    For summary tables, which have one short row per group.
    """
    value = F.struct(*[col(c) for c in columns])
    entries = F.sort_array(F.collect_list(F.struct(F.coalesce(name.cast("string"), F.lit("None")).alias("k"), value.alias("v"))))
    return df.agg(F.to_json(F.map_from_entries(entries)).alias("report"))


def write_lines(lines: DataFrame, path: str) -> None:
    """A short text report: the ``line`` column in ``line_no`` order, one file."""
    ordered = lines.orderBy("line_no").select("line")
    ordered.coalesce(1).write.mode("overwrite").text(path)


def show_head(df: DataFrame, n: int = 100) -> int:
    """Print the first rows; returns the number of rows."""
    total = df.count()
    df.limit(n).show(n)
    return total

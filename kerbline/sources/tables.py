"""Readers for the event, detail, place and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kerbline.columns import col
from kerbline.functions.rules import relabel
from kerbline.functions.temporal import parsed_date
from kerbline.operators.sampling import sample_at_most
from kerbline.profile import CLASS_CODES, GEO_SAMPLE, ROAD, Profile


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, date: str | None = None) -> DataFrame:
    """Latin-1 CSV with a header; types are inferred (one more pass) without a schema."""
    reader = spark.read.option("header", True).option("encoding", "ISO-8859-1")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if date and date in df.columns:
        df = df.withColumn(date, parsed_date(col(date)))
    return df


def read_event_tables(
    spark: SparkSession,
    events_path: str,
    details_path: str,
    events_schema: T.StructType | str | None = None,
    details_schema: T.StructType | str | None = None,
    profile: Profile = ROAD,
) -> tuple[DataFrame, DataFrame]:
    """The event table, with its date parsed, and the detail table."""
    return (
        read_csv(spark, events_path, events_schema, profile.date),
        read_csv(spark, details_path, details_schema),
    )


def place_reference(places: DataFrame, country: str | None = "GB") -> DataFrame:
    """Id, latitude and longitude of the places of one country, complete rows only."""
    if country is not None and "country" in places.columns:
        places = places.filter(F.col("country") == country)
    return places.select(F.col("id").cast("string").alias("id"), "latitude", "longitude").dropna()


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def located_sample(
    df: DataFrame, key: str, n: int = GEO_SAMPLE, profile: Profile = ROAD, seed: int = 42
) -> DataFrame:
    """At most ``n`` located rows with latitude, longitude and class name."""
    rows = df.select(
        col(key).alias("__key"), col(profile.lat), col(profile.lon), relabel(col(profile.label), CLASS_CODES).alias(profile.label)
    ).dropna(subset=[profile.lat, profile.lon])
    return sample_at_most(rows, n, "__key", seed).drop("__key")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report stored as multi-line JSON."""
    return spark.read.option("multiLine", True).json(path)


def read_findings(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Findings stored one JSON object per line."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)

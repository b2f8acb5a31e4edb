"""A training corpus from ``documents``: quality, near duplicates, repeats, personal data, packing.

Each stage takes and returns whole tables; ``run`` stores each result before the next stage reads
it. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbline.llm import neardup, packing, pii, quality, substring
from kerbline.scale import settle


def _with_text(df: DataFrame, row: str, text, columns: list[str]) -> DataFrame:
    """The stored row with a new text, and its length where the table has one."""
    out = df.select(*[text.alias("text") if c == "text" else F.col(f"{row}.`{c}`") for c in columns])
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType))
    return out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that fail or lose too much go."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    kept = quality.kept_rows(quality.clean(rows))
    return _with_text(kept, "row", F.col("clean_text"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, 0.8)."""
    return neardup.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier are cut out."""
    out = substring.without_repeats(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType))
    return out


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    found = pii.spans(rows, pii.fit(docs))
    return _with_text(found, "row", pii.redacted(F.col("text")), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# Sketches, trees and the genetic search are not SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settle(docs)
    return docs

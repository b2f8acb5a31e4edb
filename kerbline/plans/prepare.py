"""From the merged table to train and test feature tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from kerbline.columns import col
from kerbline.operators.cleaning import apply_row_rules, impute, imputing_columns
from kerbline.operators.encoding import DRIVER_CATEGORIES, FEATURES_OUTPUT, LABEL_OUTPUT, build_feature_job, derived_stages
from kerbline.operators.sampling import in_train_part, random_split, undersample
from kerbline.profile import ROAD, Profile
from kerbline.scale import compiled_methods, scratch_path, settle
from kerbline.sources.sinks import write_parquet

# The stored mark of the training rows.
TRAIN = "__train"


@dataclass
class Prepared:
    model: PipelineModel
    train: DataFrame
    test: DataFrame


def prepare(
    merged: DataFrame,
    profile: Profile = ROAD,
    split_key: str | None = None,
    balance_ratio: float | None = None,
    include_derived: bool = False,
    out_dir: str | None = None,
    at_random: bool = False,
    category_limit: int = DRIVER_CATEGORIES,
) -> Prepared:
    """Clean, split 80/20, fit on the training part, transform and store both.

    The split is a hash of ``split_key`` (by default the profile's key), so it
    does not depend on the partitioning and rows of one key stay together;
    ``at_random`` uses Spark's random split instead. Only the training part is
    ever rebalanced. ``category_limit`` only chooses how indices are kept.
    ``out_dir`` also receives the cleaned rows.
    """
    with compiled_methods(merged.sparkSession):
        return _prepared(merged, profile, split_key or profile.key, balance_ratio, include_derived, out_dir, at_random, category_limit)


def _prepared(
    merged: DataFrame, p: Profile, key: str, balance_ratio: float | None, include_derived: bool, out_dir: str | None, at_random: bool, category_limit: int
) -> Prepared:
    spark = merged.sparkSession
    base = out_dir or scratch_path(spark, "features")
    ruled = apply_row_rules(merged, p)
    if out_dir is None:
        # Nothing else of the rows is returned, so the join below need not carry it.
        ruled = ruled.select(*[col(c) for c in _used_columns(ruled, p, key)])
    # Stored once: every later step is a pass over it, and it outlives a lost executor.
    # Filling gaps is a lookup in each pass and costs less than storing the rows again.
    ruled = settle(ruled.withColumn(TRAIN, in_train_part(col(key))))
    marked = impute(ruled, p, facts=ruled)
    cleaned = marked.drop(TRAIN)
    if out_dir is not None:
        write_parquet(cleaned, f"{base}/cleaned.parquet")
    if at_random:
        train, test = random_split(settle(cleaned))
    else:
        train, test = (marked.filter(part).drop(TRAIN) for part in (F.col(TRAIN), ~F.col(TRAIN)))
    if balance_ratio is not None:
        # Stored: far fewer rows, which every fit and the transformation read.
        train = settle(undersample(train, p.label, key, balance_ratio))
    model = build_feature_job(p, include_derived, category_limit).fit(train)
    stored = []
    for name, part in (("train", train), ("test", test)):
        write_parquet(model.transform(part).select(FEATURES_OUTPUT, LABEL_OUTPUT), f"{base}/{name}.parquet")
        stored.append(spark.read.parquet(f"{base}/{name}.parquet"))
    return Prepared(model, *stored)


def _used_columns(df: DataFrame, p: Profile, key: str) -> list[str]:
    """The columns that the split, the imputing and the feature job read."""
    derived = [c for stage in derived_stages(p) for c in stage.getInputCols()]
    wanted = {key, p.label, *p.scaled, *p.one_hot, *p.indexed, *derived, *imputing_columns(df, p)}
    return [c for c in df.columns if c in wanted]


def label_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(LABEL_OUTPUT).agg(F.count("*").alias("n")).orderBy(LABEL_OUTPUT)

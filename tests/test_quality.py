import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import kerbline.scale as scale
from kerbline.operators import distribution, forest, profiling, quality, quantiles, relationships
from kerbline.plans.validate import findings_text, save_report, validate
from kerbline.profile import ROAD


def findings(df):
    return {(r["check"], r["column"]): r for r in df.collect()}


def test_null_handling_of_each_rule(spark):
    rows = [
        ("Slight", "30", 50.0, 0.0, 1, "Monday"),
        (None, None, None, None, None, None),
        ("4", "25", 48.0, 2.5, 0, "Mon"),
        ("1", "x", math.nan, -9.0, -1, "Sunday"),
    ]
    events = spark.createDataFrame(
        rows, "Accident_Severity string, Speed_limit string, Latitude double, Longitude double, Number_of_Vehicles int, Day_of_Week string"
    )
    details = spark.createDataFrame([(" male ", -1), ("FEMALE", 0), (None, None), ("Not known", 3)], "Sex_of_Driver string, Age_of_Vehicle int")
    got = findings(quality.check_accuracy(events, details))
    bad = {k[0]: v["n_bad"] for k, v in got.items()}
    assert bad["invalid_class"] == 2          # null counts
    assert bad["illegal_speed"] == 1          # null and text do not
    assert bad["latitude_out_of_bounds"] == 1  # null and NaN do not
    assert bad["longitude_out_of_bounds"] == 2
    assert bad["non_positive_count"] == 2
    assert bad["invalid_day_name"] == 2       # null counts
    assert bad["negative_age"] == 1
    assert bad["invalid_sex"] == 2            # null counts
    assert got[("distinct_categories", "Age_Band_of_Driver")]["status"] == "SKIPPED"


def test_consistency(spark):
    rows = [
        ("1", "2005-01-03", "2005", "Monday", "9:05"),
        ("2", "2005-01-03", "2006", "Tuesday", "09:5"),
        ("3", "03/01/2005", "2005", "Monday", "99:99"),
        ("4", None, None, None, None),
    ]
    events = spark.createDataFrame(rows, "Accident_Index string, Date string, Year string, Day_of_Week string, Time string")
    details = spark.createDataFrame([("1", 1, 2005), ("2", 1, 2005), ("9", 1, 2005)], "Accident_Index string, Vehicle_Reference int, Year int")
    bad = {k[0]: v["n_bad"] for k, v in findings(quality.check_consistency(events, details)).items()}
    assert bad == {
        "unreadable_date": 1,
        "year_differs_from_date": 3,
        "day_name_differs_from_date": 3,
        "bad_time_format": 1,
        "year_differs_across_tables": 1,
    }


def test_timeliness(spark):
    events = spark.createDataFrame([("2004-12-31",), ("2005-01-01",), ("2018-01-01",), ("?",), (None,)], "Date string")
    row = quality.date_range(events, now=F.lit("2017-12-31").cast("timestamp")).first()
    assert [str(v) for v in row] == ["2004-12-31", "2018-01-01", "1", "1"]


def test_odd_names_in_profiles(spark):
    df = spark.createDataFrame(
        [(1.0, None, None, 2), (0.0, "x", None, 2)],
        "`Engine_Capacity_.CC.` double, `Local_Authority_(District)` string, `Pedestrian_Crossing-Human_Control` string, `2nd_Road_Number` int",
    )
    nulls = {r["column"]: (r["null_count"], r["null_pct"]) for r in profiling.null_profile(df).collect()}
    assert nulls == {"Local_Authority_(District)": (1, 50.0), "Pedestrian_Crossing-Human_Control": (2, 100.0)}
    numbers = {r["column"]: r for r in profiling.numeric_profile(df).collect()}
    assert numbers["Engine_Capacity_.CC."]["min"] == 0.0  # zero is not missing
    assert numbers["2nd_Road_Number"]["stddev"] == 0.0
    missing = profiling.missing_profile(df, "t", ["Local_Authority_(District)"]).collect()
    assert {(r["column"], r["is_required"], r["is_high"]) for r in missing} == {
        ("Local_Authority_(District)", True, True),
        ("Pedestrian_Crossing-Human_Control", False, True),
    }


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), ("b", 2), ("b", 3)], "k string, n int")
    assert profiling.duplicate_rows(df).first()[0] == 2
    assert profiling.duplicate_rows(df, ["k"]).first()[0] == 3
    assert profiling.duplicate_rows(df.limit(0)).first()[0] == 0


@pytest.mark.parametrize("few", [20, 100_000])
def test_exact_quantiles_match_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    rng = np.random.default_rng(3)
    x = np.round(rng.gamma(2.0, 50.0, 997), 1)
    y = np.where(rng.random(997) < 0.4, 7.0, x * 3)  # one value holds much of the column
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, math.nan)], "x double, y double").repartition(4)
    got = {r["column"]: r for r in distribution.iqr_outliers(df, ["x", "y", "absent"]).collect()}
    for name, v in (("x", x), ("y", y)):
        q1, q3 = np.quantile(v, [0.25, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert got[name]["n_outliers"] == int(((v < lo) | (v > hi)).sum())
        assert got[name]["lower_fence"] == pytest.approx(lo, abs=0.006) and got[name]["upper_fence"] == pytest.approx(hi, abs=0.006)
    described = {r["column"]: r for r in distribution.describe_numeric(df, ["x", "y"]).collect()}
    assert described["x"]["median"] == pytest.approx(np.median(x), abs=6e-4)
    assert described["y"]["cardinality"] == len(set(y.tolist())) and described["y"]["n_valid"] == 997


def test_quantiles_of_many_rows_and_one_heavy_value(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 500)
    df = spark.range(0, 60_000, 1, 6).selectExpr("cast(id * 48271 % 60000 as double) AS x", "if(id % 3 = 0, cast(-0.0 AS double), cast(id AS double)) AS y", "cast(7 AS int) AS z")
    x, y = np.arange(60_000.0), np.array([0.0 if i % 3 == 0 else float(i) for i in range(60_000)])
    got = {(r["column"], r["p"]): r["value"] for r in quantiles.exact_quantiles(df, ["x", "y", "z"], [0.0, 0.1, 0.333, 0.5, 0.999, 1.0]).collect()}
    for (name, p), value in got.items():
        assert value == pytest.approx(np.quantile({"x": x, "y": y, "z": np.full(9, 7.0)}[name], p))
    assert len(got) == 18


def test_few_values_are_skipped_but_told(spark):
    df = spark.createDataFrame([(float(i % 3) if i < 9 else None, float(i)) for i in range(12)], "few double, enough double")
    got = {r["column"]: r for r in distribution.describe_numeric(df, ["few", "enough"]).collect()}
    assert (got["few"]["status"], got["few"]["n_valid"], got["few"]["cardinality"], got["few"]["mean"], got["few"]["median"]) == ("SKIPPED", 9, 3, None, None)
    assert (got["enough"]["status"], got["enough"]["median"]) == ("DONE", 5.5)
    assert distribution.describe_numeric(df.limit(0), ["few"]).first()["n_valid"] == 0


@pytest.mark.parametrize("bucket_values", [5, 100_000])
def test_spearman_matches_ranks(spark, monkeypatch, bucket_values):
    import pandas as pd

    monkeypatch.setattr(scale.cumulative_counts, "__defaults__", (bucket_values,))
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"a": rng.integers(0, 20, 400).astype(float), "b": rng.normal(size=400)})
    frame["c"] = np.exp(frame["a"]) + frame["b"]
    df = spark.createDataFrame(frame)
    got = {(r["left_column"], r["right_column"]): r["spearman"] for r in relationships.spearman_pairs(df, ["a", "b", "c"]).collect()}
    ranks = frame.rank()
    for (a, b), value in got.items():
        assert value == pytest.approx(np.corrcoef(ranks[a], ranks[b])[0, 1], abs=6e-4)
    both = relationships.compare_correlations(
        relationships.pearson_pairs(df, ["a", "b", "c"]), relationships.spearman_pairs(df, ["a", "b", "c"])
    ).collect()
    flagged = {(r["left_column"], r["right_column"]) for r in both if r["high"] and r["non_linear"]}
    assert flagged == {("a", "c")}


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(20)], "a double, b double")
    for pairs in (relationships.pearson_pairs(df, ["a", "b"]), relationships.spearman_pairs(df, ["a", "b"])):
        assert pairs.first()[2] is None
    row = relationships.compare_correlations(
        relationships.pearson_pairs(df, ["a", "b"]), relationships.spearman_pairs(df, ["a", "b"])
    ).first()
    assert (row["high"], row["non_linear"]) == (False, False)
    described = {r["column"]: r for r in distribution.describe_numeric(df, ["a", "b"]).collect()}
    assert (described["a"]["std"], described["a"]["median"], described["b"]["median"]) == (0.0, 1.0, 9.5)
    assert {r["column"]: r["n_outliers"] for r in distribution.zscore_outliers(df, ["a", "b"]).collect()} == {"a": 0, "b": 0}


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 10.0, 10.0], [3.0, 3.0], [0.1 * i for i in range(101)], [-1.0, 0.0, 0.3, 0.6, 1.0]])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = [r["n"] for r in distribution.histogram(df, ["x"]).orderBy("bin").collect()]
    assert got == np.histogram(values, bins=10)[0].tolist() and sum(got) == len(values)


def test_density_grid_matches_numpy(spark):
    rng = np.random.default_rng(9)
    x, y = rng.uniform(-8, 2, 500), rng.uniform(49, 61, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 50.0), (1.0, None)], "x double, y double")
    got = {(r["bx"] - 1, r["by"] - 1): r["n"] for r in distribution.density_grid(df, "x", "y").collect()}
    want = np.histogram2d(x, y, bins=40)[0]
    assert got == {(i, j): int(want[i, j]) for i, j in zip(*np.nonzero(want))}


def test_ks_statistic(spark):
    rng = np.random.default_rng(11)
    x = np.sort(rng.exponential(size=300))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id int, x double")
    row = distribution.ks_normal(df, "x", "id").first()
    cdf = np.array([0.5 * (1 + math.erf((v - x.mean()) / (x.std(ddof=1) * math.sqrt(2)))) for v in x])
    n = len(x)
    want = max((np.arange(1, n + 1) / n - cdf).max(), (cdf - np.arange(n) / n).max())
    assert row["ks_statistic"] == pytest.approx(want, abs=1e-4) and row["not_normal"]


def test_isolation_forest_finds_far_rows(spark):
    rng = np.random.default_rng(13)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))] + [(900, 9.0, 9.0), (901, -9.0, 8.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    scores = {r["key"]: r["score"] for r in forest.isolation_scores(df, ["a", "b"], "id").collect()}
    assert len(scores) == 602 and {900, 901} <= set(sorted(scores, key=scores.get)[-5:])
    row = forest.isolation_summary(df, ["a", "b"], "id", "t").first()
    assert row["sample_size"] == 602 and abs(row["n_anomalies"] - 30) <= 3
    for few in (forest.isolation_summary(df, ["a"], "id", "t"), forest.isolation_summary(df.limit(50), ["a", "b"], "id", "t")):
        skipped = few.first()
        assert skipped["status"] == "SKIPPED" and skipped["n_anomalies"] is None


def test_trees_see_rows_of_one_key_apart(spark):
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("key"), F.rand(1).alias("x0"))
    sizes = [r["size"] for r in forest.grow_trees(rows, 20_000, 1, trees=10).groupBy("tree").agg(F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("size")).collect()]
    assert len(sizes) == 10 and all(100 < n < 500 for n in sizes)
    # The share stays above nothing for very many rows.
    assert forest.grow_trees(rows, 10**13, 1, trees=1).count() <= 1


def test_trees_take_rows_apart(spark):
    rows = spark.range(60_000).select(F.col("id").alias("key"), F.rand(3).alias("x0"))
    leaves = forest.grow_trees(rows, 60_000, 1).filter("feature < 0").groupBy("tree").agg(F.sum("size").alias("n")).collect()
    assert len(leaves) == 100 and 23_000 < sum(r["n"] for r in leaves) < 28_000
    # A table too small for that gives each tree a full subset again.
    few = forest.grow_trees(rows.limit(600), 600, 1).filter("feature < 0").groupBy("tree").agg(F.sum("size").alias("n")).collect()
    assert len(few) == 100 and all(150 < r["n"] < 400 for r in few)


def test_ks_without_a_spread_is_skipped(spark):
    for values in ([3.0, 3.0, 3.0], [None, None], [1.0]):
        row = distribution.ks_normal(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double"), "x", "id").first()
        assert row["status"] == "SKIPPED" and row["ks_statistic"] is None


def test_full_report(spark, tmp_path):
    events = spark.createDataFrame(
        [("1", "Slight", "2005-01-03", 50.0, 0.0, 2005, 30, 1, 1), ("1", "Bad", "2004-01-03", 50.0, 0.5, 2004, 33, 2, 1)] * 6,
        "Accident_Index string, Accident_Severity string, Date string, Latitude double, Longitude double, Year int, Speed_limit int, "
        "Number_of_Vehicles int, Number_of_Casualties int",
    )
    details = spark.createDataFrame([("1", 1, None), ("7", 1, 3)], "Accident_Index string, Vehicle_Reference int, Age_of_Vehicle int")
    report = validate(events, details, ROAD, F.lit("2018-01-01").cast("timestamp"))
    rows = report.collect()
    issues = {(r["check"], r["table"]): r["n_bad"] for r in rows if r["status"] == "ISSUE"}
    assert issues[("invalid_class", "events")] == 6 and issues[("before_first_date", "events")] == 6
    assert issues[("duplicate_row", "events")] == 10 and issues[("details_without_event", "details")] == 1
    assert any(r["status"] == "SKIPPED" for r in rows)
    rolled = {r["dimension"]: r for r in quality.issue_rollup(report).collect()}
    assert sum(r["n_issues"] for r in rolled.values()) == next(iter(rolled.values()))["total_issues"]
    save_report(report, str(tmp_path))
    assert spark.read.json(str(tmp_path / "findings.json")).count() == len(rows)
    assert spark.read.text(str(tmp_path / "summary.txt")).count() == findings_text(report).count() == len(rows)

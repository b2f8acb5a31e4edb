import math

import numpy as np
import pytest

from kerbline.operators import joins, keys, sampling

POINTS = "id int, lat double, lon double"
PLACES = "id string, latitude double, longitude double"


def brute_force(points, places):
    out = {}
    ordered = sorted(places)
    la2 = np.radians([p[1] for p in ordered])
    lo2 = np.radians([p[2] for p in ordered])
    for i, lat, lon in points:
        if lat is None or lon is None or math.isnan(lat) or math.isnan(lon):
            out[i] = None
            continue
        la, lo = math.radians(lat), math.radians(lon)
        h = np.sin((la2 - la) / 2) ** 2 + math.cos(la) * np.cos(la2) * np.sin((lo2 - lo) / 2) ** 2
        out[i] = ordered[int(h.argmin())][0]
    return out


def nearest(spark, points, places, **more):
    df = spark.createDataFrame(points, POINTS)
    table = spark.createDataFrame(places, PLACES)
    return {r["id"]: r["station_id"] for r in joins.nearest_place(df, table, "lat", "lon", **more).collect()}


@pytest.mark.parametrize("scan_places", [4096, 0])
@pytest.mark.parametrize("spread", ["country", "world", "clustered"])
def test_nearest_is_brute_force(spark, scan_places, spread):
    rng = np.random.default_rng(7)
    n, m = 400, 120
    lat, lon = {"country": ((49, 61), (-8, 2)), "world": ((-90, 90), (-180, 180)), "clustered": ((51, 51.01), (0, 0.01))}[spread]
    places = [(f"s{i:03d}", float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(*lat, m), rng.uniform(*lon, m)))]
    box = ((-90, 90), (-180, 180)) if spread != "country" else (lat, lon)
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(*box[0], n), rng.uniform(*box[1], n)))]
    points += [(n, None, 1.0), (n + 1, 51.0, None), (n + 2, math.nan, 0.0), (n + 3, places[5][1], places[5][2])]
    assert nearest(spark, points, places, scan_places=scan_places) == brute_force(points, places)


@pytest.mark.parametrize("scan_places", [4096, 0])
def test_nearest_tie_takes_the_lowest_id(spark, scan_places):
    places = [("b", 50.0, 1.0), ("a", 50.0, 1.0), ("c", 50.0, -1.0)]
    assert nearest(spark, [(0, 50.0, 1.0), (1, 51.0, 1.5)], places, scan_places=scan_places) == {0: "a", 1: "a"}


@pytest.mark.parametrize("scan_places", [4096, 0])
def test_nearest_without_places(spark, scan_places):
    assert nearest(spark, [(0, 50.0, 1.0)], [("x", None, 1.0)], scan_places=scan_places) == {0: None}


def test_grid_join_keeps_repeated_locations(spark):
    points = [(i, 50.0, 1.0) for i in range(500)] + [(500, 50.5, 1.0)]
    got = nearest(spark, points, [("a", 50.1, 1.0), ("b", 50.4, 1.0)], scan_places=0)
    assert len(got) == 501 and got[0] == "a" and got[500] == "b"


def test_daily_join(spark):
    events = spark.createDataFrame([(1, "s", "d1"), (2, None, "d1"), (3, "s", None), (4, "t", "d1")], "id int, station string, day string")
    daily = spark.createDataFrame([("s", "d1", 1.5), ("s", "d1", 2.5), (None, "d1", 9.0)], "station_id string, time string, tavg double")
    out = joins.join_daily(events, daily, {"station": "station_id", "day": "time"})
    assert out.columns == ["id", "station", "day", "tavg"]
    assert sorted((r["id"], r["tavg"]) for r in out.collect()) == [(1, 1.5), (1, 2.5), (2, None), (3, None), (4, None)]


def test_missing_daily_table(spark, tmp_path):
    events = spark.createDataFrame([(1, "s", "d1")], "id int, station string, day string")
    out = joins.join_daily_from(events, str(tmp_path / "none"), {"station": "station_id", "day": "time"})
    assert out.columns == ["id", "station", "day", "tavg", "tmin", "tmax", "prcp", "snow", "wspd", "pres"]
    assert tuple(out.first())[3:] == (None,) * 7


def test_detail_join_with_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.createDataFrame([("hot", 1), ("one", 2), ("none", 3), (None, 4)], "k string, Year int")
        details = spark.range(3000).selectExpr("CASE WHEN id = 0 THEN 'one' WHEN id = 1 THEN 'orphan' ELSE 'hot' END AS k", "id AS ref", "1999 AS Year")
        out = joins.join_details(events, details, "k")
        assert out.columns == ["k", "Year", "ref"]
        counts = {r["k"]: r["count"] for r in out.groupBy("k").count().collect()}
        assert counts == {"hot": 2998, "one": 1, "none": 1, None: 1}
        assert out.filter("ref IS NULL").count() == 2
    finally:
        for key in ("skewJoin.skewedPartitionThresholdInBytes", "advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.adaptive.{key}")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_spread(spark):
    from pyspark.sql import functions as F

    from kerbline.scale import spread_left_join

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(2000).selectExpr("CASE WHEN id < 1500 THEN NULL ELSE id END AS k", "id AS n")
        right = spark.range(1500, 1700).selectExpr("id AS k", "id AS v")
        out = spread_left_join(left, right, ["k"])
        spread = out.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(spread) == 4 and max(r["count"] for r in spread) < 1000
        assert out.count() == 2000 and out.filter("v IS NOT NULL").count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_key_overlap(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("b",), ("c",), ("c",), (None,), (None,)], "k string")
    row = keys.key_overlap(left, right, "k").first().asDict()
    assert row == {"left_keys": 2, "right_keys": 2, "matched": 1, "only_left": 1, "only_right": 1, "only_left_pct": 50.0, "only_right_pct": 50.0}
    empty = keys.key_overlap(left, right.limit(0), "k").first()
    assert (empty["right_keys"], empty["only_right_pct"], empty["only_left"]) == (0, None, 2)


def test_cross_table_mismatch(spark):
    events = spark.createDataFrame([("a", "2005"), ("b", "x"), ("c", "2007"), ("d", "2008")], "k string, y string")
    details = spark.createDataFrame([("a", 2, 1999), ("a", 1, 2005), ("b", 1, 2006), ("c", 1, None)], "k string, ref int, y int")
    row = keys.cross_table_mismatch(events, details, "k", "ref", "y", "y").first()
    assert tuple(row) == (3, 2)


def test_samples(spark):
    df = spark.range(5000).selectExpr("id", "CASE WHEN id % 100 = 0 THEN 'Fatal' WHEN id % 100 < 15 THEN 'Serious' WHEN id % 7 = 0 THEN NULL ELSE 'Slight' END AS c")
    assert sampling.sample_at_most(df, 123, "id").distinct().count() == 123
    assert sampling.sample_at_most(df, 9999, "id").count() == 5000
    again = sampling.sample_at_most(df.repartition(7), 123, "id")
    assert again.exceptAll(sampling.sample_at_most(df, 123, "id")).count() == 0
    train, test = sampling.split_by_key(df, "id")
    assert train.count() + test.count() == 5000 and 0.77 < train.count() / 5000 < 0.83
    thin = {r["c"]: r["count"] for r in sampling.undersample(df, "c", "id").groupBy("c").count().collect()}
    assert set(thin) == {"Fatal", "Serious", "Slight"} and thin["Fatal"] == 50
    assert 100 <= thin["Slight"] <= 200 and 100 <= thin["Serious"] <= 200
    weights = {r["c"]: r["weight"] for r in sampling.class_weights(df.filter("c IS NOT NULL"), "c").collect()}
    counts = {r["c"]: r["n"] for r in sampling.class_counts(df.filter("c IS NOT NULL"), "c").collect()}
    total = sum(counts.values())
    assert weights == {k: pytest.approx(total / (3 * n)) for k, n in counts.items()}


def test_large_samples_are_narrowed_first(spark, monkeypatch):
    df = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 500 = 1 THEN NULL ELSE id END AS k", "id").repartition(4)
    want = sampling.sample_at_most(df, 9_000, "k").groupBy("k").count()
    monkeypatch.setattr(sampling, "MERGED_ROWS", 10)
    got = sampling.sample_at_most(df, 9_000, "k").groupBy("k").count()
    assert got.agg({"count": "sum"}).first()[0] == 9_000
    assert got.exceptAll(want).count() == 0
    assert sampling.sample_at_most(df, 50_000, "k").count() == 20_000


def test_undersampling_nothing(spark):
    empty = spark.createDataFrame([], "id long, c string")
    assert sampling.undersample(empty, "c", "id").count() == 0


@pytest.mark.parametrize("scan_places", [0, 100])
def test_both_nearest_paths_agree_on_odd_points(spark, scan_places):
    points = spark.createDataFrame([(1, float("inf"), 0.0), (2, 50.0, 1.0), (3, None, 0.0), (4, -50.0, 170.0)], "id int, lat double, lon double")
    points = points.selectExpr("'old' AS station_id", "id", "lat", "lon")
    places = spark.createDataFrame([("a", 50.0, 0.0), ("b", 51.0, 5.0), ("c", float("inf"), 0.0)], "id string, latitude double, longitude double")
    out = joins.nearest_place(points, places, "lat", "lon", scan_places=scan_places)
    assert out.columns == ["id", "lat", "lon", "station_id"]
    assert {r["id"]: r["station_id"] for r in out.collect()} == {1: None, 2: "a", 3: None, 4: "b"}


def test_a_key_with_a_third_of_the_details(spark):
    from pyspark.sql import functions as F

    events = spark.createDataFrame([("hot", 1), ("hot", 2), ("one", 3), ("none", 4), (None, 5)], "k string, e int")
    # Equal rows throughout, and a key of details that no event has.
    details = spark.range(3000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, "one").otherwise(F.concat(F.lit("x"), "id")).alias("k"), F.lit(7).alias("v"))
    assert [(r["k"], r["__copies"]) for r in joins.heavy_keys(details, "k", 100).collect()] == [("hot", 10)]
    # Keys are counted only where their hash group is large, which changes no count.
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(joins, "KEY_GROUPS", 1)
        assert [(r["k"], r["__copies"]) for r in joins.heavy_keys(details, "k", 100).collect()] == [("hot", 10)]
    whole, dealt = (joins.join_details(events, details, "k", most=n) for n in (10**6, 100))
    count = lambda df: {(r["k"], r["e"], r["v"]): r["count"] for r in df.groupBy("k", "e", "v").count().collect()}
    assert count(dealt) == count(whole) == {("hot", 1, 7): 1000, ("hot", 2, 7): 1000, ("one", 3, 7): 1, ("none", 4, None): 1, (None, 5, None): 1}
    assert dealt.columns == whole.columns == ["k", "e", "v"]

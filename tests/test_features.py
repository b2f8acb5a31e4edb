"""Risk index and vulnerability cases, centres and density bands."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from kerbline.functions import features
from kerbline.operators import encoding
from kerbline.profile import CLUSTER_CENTRES, LIGHT_RISK, WEATHER_RISK

BASE = ("Daylight", "Fine no high winds", "Dry", 30.0, "A-Road")


def risk(spark, *rows):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, light string, weather string, surface string, speed double, road string")
    out = df.select("id", features.risk_index(*[F.col(c) for c in ("light", "weather", "surface", "speed", "road")]).alias("r"))
    return [r["r"] for r in out.orderBy("id").collect()]


def vulnerable(spark, *rows):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, t string, cc double")
    out = df.select("id", features.vulnerable(F.col("t"), F.col("cc")).alias("v"))
    return [r["v"] for r in out.orderBy("id").collect()]


def test_known_risks(spark):
    high, low = risk(
        spark,
        ("Darkness - no lighting", "Fog or mist", "Icy", 70.0, "Minor Road"),
        ("Daylight", "Fine no high winds", "Dry", 20.0, "Motorway"),
    )
    assert high == pytest.approx(0.8875) and low == pytest.approx(0.22)


@pytest.mark.parametrize(
    "place, worse, better",
    [
        (0, "Darkness - no lighting", "Daylight"),
        (1, "Fog or mist", "Fine no high winds"),
        (2, "Icy", "Dry"),
        (3, 70.0, 20.0),
        (4, "Minor Road", "Motorway"),
    ],
)
def test_each_component_raises_the_risk(spark, place, worse, better):
    row = lambda v: BASE[:place] + (v,) + BASE[place + 1 :]
    a, b = risk(spark, row(worse), row(better))
    assert a > b


def test_missing_components(spark):
    no_light, no_weather, nothing, odd = risk(
        spark, (None, *BASE[1:]), (BASE[0], None, *BASE[2:]), (None,) * 5, ("?", "?", "?", None, "?")
    )
    assert 0 <= no_light <= 1 and 0 <= no_weather <= 1
    assert nothing == 0.5 and odd == pytest.approx(0.4)


def test_speed_is_clamped(spark):
    slow, fast, nan = risk(spark, (*BASE[:3], 5.0, BASE[4]), (*BASE[:3], 200.0, BASE[4]), (*BASE[:3], math.nan, BASE[4]))
    at20, at70 = risk(spark, (*BASE[:3], 20.0, BASE[4]), (*BASE[:3], 70.0, BASE[4]))
    assert slow == at20 and fast == at70 and nan == at70


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "x", *LIGHT_RISK]),
            st.sampled_from([None, "x", *WEATHER_RISK]),
            st.sampled_from([None, "Icy", "Dry"]),
            st.one_of(st.none(), st.floats(-500, 500)),
            st.sampled_from([None, "Minor Road"]),
        ),
        min_size=1,
        max_size=20,
    )
)
def test_risk_stays_in_range(spark, rows):
    assert all(0 <= r <= 1 for r in risk(spark, *rows))


def test_vulnerable_vehicles(spark):
    yes = [
        ("Motorcycle 50cc and under", None),
        ("Motorcycle 125cc and under", None),
        ("Motorcycle over 125cc and up to 500cc", None),
        ("Motorcycle over 500cc", None),
        ("Electric motorcycle", None),
        ("Pedal cycle", None),
        ("Ridden horse", None),
        ("Car", 999.0),
    ]
    no = [
        ("Car", 1500.0),
        ("Car", 1200.0),
        ("Bus or coach (17 or more pass seats)", 5000.0),
        ("Van / Goods 3.5 tonnes mgw or under", 2000.0),
        ("Car", None),
        ("Car", math.nan),
        ("Unknown type", None),
        (None, None),
    ]
    assert vulnerable(spark, *yes) == [True] * len(yes)
    assert vulnerable(spark, *no) == [False] * len(no)


def test_nearest_centre_is_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    points = [(float(a), float(b)) for a, b in zip(rng.uniform(49, 61, 300), rng.uniform(-8, 2, 300))]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, lat double, lon double")
    got = df.select("id", features.nearest_centre(F.col("lat"), F.col("lon")).alias("c")).orderBy("id").collect()
    want = [min(CLUSTER_CENTRES, key=lambda i: math.dist(p, CLUSTER_CENTRES[i])) for p in points]
    assert [r["c"] for r in got] == want


def test_centre_ties_and_missing(spark):
    centres = {3: (0.0, 0.0), 7: (0.0, 2.0)}
    df = spark.createDataFrame([(0, 0.0, 1.0), (1, None, 1.0), (2, math.nan, 1.0), (3, 0.0, 1.5)], "id int, lat double, lon double")
    got = df.select("id", features.nearest_centre(F.col("lat"), F.col("lon"), centres).alias("c")).orderBy("id").collect()
    assert [r["c"] for r in got] == [3, -1, -1, 7]


def test_density_bands(spark):
    ids = [None, -1, *range(10), 99]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(ids)], "id int, c int")
    got = [r["b"] for r in df.select("id", features.density_band(F.col("c")).alias("b")).orderBy("id").collect()]
    want = {0: "urban", 1: "suburban", 2: "rural", 3: "urban", 4: "suburban", 5: "urban", 6: "rural", 7: "urban", 8: "urban", 9: "suburban"}
    assert got == ["unknown", "unknown", *[want[i] for i in range(10)], "rural"]


def test_transformers_survive_storage(spark, tmp_path):
    df = spark.createDataFrame([("Car", 900.0)], "Vehicle_Type string, Engine_Capacity_CC double")
    stage = encoding.VulnerableFlag()
    stage.write().overwrite().save(str(tmp_path / "stage"))
    again = encoding.VulnerableFlag.load(str(tmp_path / "stage"))
    assert again.transform(df).first()["vehicle_vulnerable"] is True
    assert "Accident_Severity" not in {c for t in encoding.derived_stages() for c in t.getInputCols()}


def test_hotspots_find_separate_groups(spark):
    import numpy as np

    rng = np.random.default_rng(17)
    centres = [(50.0, -5.0), (54.0, 0.0), (58.0, -3.0)]
    rows = [(float(a + u), float(b + v)) for (a, b), n in zip(centres, (60, 30, 10)) for u, v in rng.normal(0, 0.05, (n, 2))]
    df = spark.createDataFrame(rows + [(None, 1.0)], "lat double, lon double")
    table = encoding.hotspot_table(encoding.fit_hotspots(df, "lat", "lon", k=3), df, "lat", "lon").orderBy("centre_lat").collect()
    assert [r["pct"] for r in table] == [60.0, 30.0, 10.0]
    for r, (a, b) in zip(table, centres):
        assert math.dist((r["centre_lat"], r["centre_lon"]), (a, b)) < 0.1


def test_joint_indices_are_those_of_single_indexers(spark, tmp_path):
    from pyspark.ml.feature import StringIndexer

    rows = [("b", "x", 1), ("a", "x", 1), ("a", None, 2), (None, "\U0001f600", 3), ("b", "\uff5e", 3), ("c", "y", 1)]
    df = spark.createDataFrame(rows, "p string, q string, label int")
    unseen = spark.createDataFrame([("z", "y", 1), (None, None, 2)], "p string, q string, label int")
    for limit in (1, 100):
        joint = encoding.JointIndexer(inputCols=["p", "q", "label"], outputCols=["i", "j", "l"], narrow=["label"], strict=["label"], limit=limit)
        model = joint.fit(df)
        for part in (df, unseen):
            got = sorted(tuple(r) for r in model.transform(part).select("i", "j", "l").collect())
            plain = part
            for c, o, kind in (("p", "i", "keep"), ("q", "j", "keep"), ("label", "l", "error")):
                plain = StringIndexer(inputCol=c, outputCol=o, handleInvalid=kind).fit(df).transform(plain)
            want = sorted(tuple(r) for r in plain.select("i", "j", "l").collect())
            assert got == want
    with pytest.raises(Exception, match="(?i)unseen"):
        model.transform(unseen.withColumn("label", F.lit(9))).collect()
    with pytest.raises(ValueError, match="label"):
        encoding.JointIndexer(inputCols=["label"], outputCols=["l"], narrow=["label"], most=2).fit(df)


def test_joint_indices_of_empty_columns(spark):
    df = spark.createDataFrame([], "p string, label string")
    model = encoding.JointIndexer(inputCols=["p"], outputCols=["i"]).fit(df)
    assert model.transform(spark.createDataFrame([("a",), (None,)], "p string")).agg(F.min("i"), F.max("i")).first() == (0.0, 0.0)

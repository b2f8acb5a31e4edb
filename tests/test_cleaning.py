import math

from hypothesis import HealthCheck, given, settings, strategies as st

from kerbline.operators import cleaning, imputing
from kerbline.profile import ROAD

LEGAL = {"Speed_limit": (20, 30, 40, 50, 60, 70)}


def _column(df, name):
    return [r[name] for r in df.collect()]


def test_snap_midpoints_go_down(spark):
    given_values = [None, 10.0, 15.0, 20.0, 25.0, 25.1, 35.0, 45.0, 55.0, 65.0, 65.5, 70.0, 999.0, -5.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given_values)], "id int, Speed_limit double")
    out = _column(cleaning.snap_to_legal(df, LEGAL).orderBy("id"), "Speed_limit")
    assert out == [None, 20.0, 20.0, 20.0, 20.0, 30.0, 30.0, 40.0, 50.0, 60.0, 70.0, 70.0, 70.0, 20.0]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=30))
def test_snap_is_idempotent_and_legal(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "Speed_limit double")
    once = cleaning.snap_to_legal(df, LEGAL)
    twice = cleaning.snap_to_legal(once, LEGAL)
    assert set(_column(once, "Speed_limit")) <= {20.0, 30.0, 40.0, 50.0, 60.0, 70.0}
    assert _column(once, "Speed_limit") == _column(twice, "Speed_limit")


def test_sentinels_are_exact(spark):
    texts = ["Unknown", "unknown", "N/A", "", "Data missing or out of range", " Unknown", "UNKNOWN", "Not known", None]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "id int, a string, n int")
    out = _column(cleaning.null_sentinels(df, ROAD.sentinels).orderBy("id"), "a")
    assert out == [None] * 5 + [" Unknown", "UNKNOWN", "Not known", None]


def test_bounds_are_closed(spark):
    values = [48.99, 49.0, 61.0, 61.01, None, math.nan]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, Latitude double")
    out = _column(cleaning.null_out_of_bounds(df, ROAD.bounds).orderBy("id"), "Latitude")
    assert out == [None, 49.0, 61.0, None, None, None]


def test_text_numbers_never_fail(spark):
    df = spark.createDataFrame([("12.5",), ("x",), (None,)], "Speed_limit string")
    assert _column(cleaning.cast_numeric(df, ["Speed_limit"]), "Speed_limit") == [12.5, None, None]


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("k", 1)], "key string, n int")
    out = cleaning.clean(df)
    assert out.columns == ["key", "n"] and out.count() == 1


def test_odd_column_names(spark):
    df = spark.createDataFrame(
        [("a", -1.0, "Unknown"), ("b", 2000.0, "x")], "`Accident_Index` string, `Engine_Capacity_.CC.` double, `2nd_Road (x)` string"
    )
    out = cleaning.apply_row_rules(df)
    assert out.columns == ["Accident_Index", "Engine_Capacity_CC", "2nd_Road (x)"]
    assert [tuple(r) for r in out.orderBy("Accident_Index").collect()] == [("a", None, None), ("b", 2000.0, "x")]


def test_safe_profile_keeps_frost(spark):
    df = spark.createDataFrame([(-3.5, -1.0)], "tavg double, prcp double")
    assert tuple(cleaning.null_negative(df, ROAD.null_negative).first()) == (None, None)
    assert tuple(cleaning.null_negative(df, ROAD.keeping_temperatures().null_negative).first()) == (-3.5, None)


def test_median_takes_an_observed_value(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (5.0,), (None,), (math.nan,)], "tavg double")
    for exact in (False, True):
        filled = sorted(_column(imputing.fill_median(df, ["tavg", "absent"], exact), "tavg"))
        assert filled == [1.0, 2.0, 2.0, 2.0, 4.0, 5.0]


def test_median_of_nothing_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "tavg double")
    assert _column(imputing.fill_median(df, ["tavg"]), "tavg") == [None, None]
    assert _column(imputing.fill_median(df, ["tavg"], exact=True), "tavg") == [None, None]


def test_exact_median_of_many_values(spark, monkeypatch):
    from kerbline.operators import quantiles

    # Brackets are narrowed until they hold few rows.
    monkeypatch.setattr(quantiles, "FEW", 10)
    values = [float((i * 7919) % 1001) for i in range(1001)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    assert imputing.medians(df, ["x"], exact=True).first()[0] == sorted(values)[500]
    assert imputing.medians(df.limit(0), ["x"], exact=True).first()[0] is None


def test_group_mode(spark):
    rows = [
        ("a", "x"), ("a", "y"), ("a", None),        # tie: lowest value
        ("b", None), ("b", None),                   # no value in the group: overall mode
        (None, None), (None, "z"),                  # no group: overall mode
        ("c", "z"), ("c", "z"), ("c", None),
    ]
    df = spark.createDataFrame(rows, "make string, model string")
    out = imputing.fill_group_mode(df, "model", "make")
    got = sorted((str(m), v) for m, v in out.collect())
    assert got == sorted(
        [("a", "x"), ("a", "y"), ("a", "x"), ("b", "z"), ("b", "z"), ("None", "z"), ("None", "z"), ("c", "z"), ("c", "z"), ("c", "z")]
    )
    assert out.columns == ["make", "model"]


def test_group_mode_without_any_value(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "make string, model string")
    assert _column(imputing.fill_group_mode(df, "model", "make"), "model") == ["Unknown", "Unknown"]


def test_lookup_join_without_broadcast(spark):
    from kerbline.scale import attach_by_key

    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, n int")
    table = spark.createDataFrame([("a", "A")], "k string, v string")
    out = attach_by_key(df, table, "k", max_rows=0)
    assert sorted((r["n"], r["v"]) for r in out.collect()) == [(1, None), (2, None), (3, "A"), (4, None)]
    assert out.columns == ["k", "n", "v"]


def test_required_rows_and_row_loss(spark):
    df = spark.createDataFrame([("Slight", 50.0, 0.0), (None, 50.0, 0.0), ("Fatal", None, 0.0)], "Accident_Severity string, Latitude double, Longitude double")
    kept = cleaning.require_columns(df, ROAD.required)
    assert tuple(cleaning.row_loss(df, kept).first()) == (3, 1, 2, 66.67)


def test_row_rules_run_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([("Slight", "Unknown", 50.0, 0.0, 15.0)], "Accident_Severity string, make string, Latitude double, Longitude double, Speed_limit double")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = cleaning.apply_row_rules(stream)
    query = (
        out.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "chk"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    assert query.awaitTermination(60)
    assert tuple(spark.read.parquet(str(tmp_path / "out")).first()) == ("Slight", None, 50.0, 0.0, 20.0)


def test_clean_order(spark):
    """The group mode sees a missing group, the constant fill comes last."""
    rows = [
        ("1", "Slight", 50.0, 0.0, "Ford", "Ka", 3),
        ("2", "Slight", 50.0, 0.0, "Unknown", None, 3),
        ("3", "Slight", 9999.0, 0.0, "Ford", "Ka", 3),
    ]
    df = spark.createDataFrame(
        rows, "Accident_Index string, Accident_Severity string, Latitude double, Longitude double, make string, model string, Number_of_Casualties int"
    )
    out = cleaning.clean(df).orderBy("Accident_Index")
    assert "Number_of_Casualties" not in out.columns
    assert [(r["make"], r["model"]) for r in out.collect()] == [("Ford", "Ka"), ("Unknown", "Ka")]

import gzip
from pathlib import Path

import pytest

from kerbline.operators import cleaning, encoding, quality, summaries
from kerbline.plans.explore import explore, save_report, summary_lines
from kerbline.plans.ingest import ingest, ingest_weather
from kerbline.plans.prepare import label_counts, prepare
from kerbline.profile import INDEXED_COLUMNS, NUMERIC_COLUMNS, ONE_HOT_COLUMNS, ROAD
from kerbline.sources import sinks, tables, weather


SF_DIR = Path("/root/testdata/sf0.001")


def _gz(path, text):
    with gzip.open(path, "wt") as f:
        f.write(text)


def test_ragged_weather_files(spark, tmp_path):
    _gz(tmp_path / "03005_2005.csv.gz", "year,month,day,temp,tmin,tmax,prcp,snwd,wspd,pres\n2005,1,2,1.5,0,3,0.2,4,10,1000\n2005,2,30,1,1,1,1,1,1,1\n2004,12,31,1,1,1,1,1,1,1\n")
    _gz(tmp_path / "A_B_2006.csv.gz", " year , month,day,temp,tmin,tmax,prcp,wspd,wpgt,tsun\n2006,3,4,x,,7,,5,99,1\n")
    _gz(tmp_path / "C_2006.csv.gz", "some,other,file\n1,2,3\n")
    rows = {r["station_id"]: r for r in weather.read_daily_weather(spark, str(tmp_path)).collect()}
    assert set(rows) == {"03005", "A_B"}
    a = rows["03005"]
    assert (str(a["time"]), a["tavg"], a["snow"], a["pres"]) == ("2005-01-02", 1.5, 4.0, 1000.0)
    b = rows["A_B"]
    assert (b["tavg"], b["tmin"], b["tmax"], b["snow"], b["wspd"], b["pres"]) == (None, None, 7.0, None, 5.0, None)


def test_no_weather_files(spark, tmp_path):
    _gz(tmp_path / "C_2006.csv.gz", "some,other,file\n1,2,3\n")
    with pytest.raises(ValueError):
        weather.read_daily_weather(spark, str(tmp_path))


def test_latin1_csv(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes("Accident_Index,Date,make\n1,2005-03-04,CITROËN\n2,bad,x\n".encode("latin-1"))
    (tmp_path / "d.csv").write_bytes(b"Accident_Index,Age_of_Vehicle\n1,4\n")
    events, details = tables.read_event_tables(spark, str(tmp_path / "e.csv"), str(tmp_path / "d.csv"), "Accident_Index STRING, Date STRING, make STRING")
    got = events.orderBy("Accident_Index").collect()
    assert got[0]["make"] == "CITROËN" and str(got[0]["Date"]) == "2005-03-04" and got[1]["Date"] is None
    assert dict(details.dtypes) == {"Accident_Index": "int", "Age_of_Vehicle": "int"}


def _parts(path):
    return sorted(x.name for x in path.glob("part-*"))


def test_materialize_repeats_a_partial_write(spark, tmp_path):
    make = lambda: spark.range(3)
    (tmp_path / "t").mkdir()
    assert sinks.materialize(spark, str(tmp_path / "t"), make).count() == 3
    first = _parts(tmp_path / "t")
    assert sinks.materialize(spark, str(tmp_path / "t"), make).count() == 3
    assert _parts(tmp_path / "t") == first
    # Rows without a finished manifest are not trusted.
    (tmp_path / "t" / "_manifest" / "_SUCCESS").unlink()
    assert sinks.materialize(spark, str(tmp_path / "t"), make).count() == 3
    assert _parts(tmp_path / "t") != first


def test_materialize_follows_its_inputs_and_its_plan(spark, tmp_path):
    source, path = str(tmp_path / "in put"), str(tmp_path / "t")
    spark.range(3).write.parquet(source)
    make = lambda: spark.read.parquet(source).filter("id > 0")
    assert sinks.materialize(spark, path, make).count() == 2
    first = _parts(tmp_path / "t")
    assert sinks.materialize(spark, path, make).count() == 2 and _parts(tmp_path / "t") == first
    spark.range(10, 12).write.mode("append").parquet(source)
    assert sinks.materialize(spark, path, make).count() == 4
    assert sinks.materialize(spark, path, lambda: spark.read.parquet(source).filter("id > 1")).count() == 3


def test_materialize_follows_rows_in_memory_and_side_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    table = lambda v: spark.createDataFrame([(1, v), (2, None)], "id int, v string")
    assert sinks.materialize(spark, path, lambda: table("a")).filter("v = 'a'").count() == 1
    assert sinks.materialize(spark, path, lambda: table("b")).filter("v = 'b'").count() == 1
    first = _parts(tmp_path / "t")
    sinks.materialize(spark, path, lambda: table("b"), also=(table("c"),))
    second = _parts(tmp_path / "t")
    sinks.materialize(spark, path, lambda: table("b"), also=(table("c"),))
    assert first != second == _parts(tmp_path / "t")


def test_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "years")
    df = spark.range(100).selectExpr("id", "CASE WHEN id < 90 THEN 2005 ELSE 2006 END AS Year")
    sinks.write_by(df, path, "Year")
    read = spark.read.parquet(path).filter("Year = 2006")
    assert read.count() == 10
    assert "PartitionFilters: [isnotnull(Year" in read._jdf.queryExecution().toString()


def road_tables(spark, n=240):
    events = spark.range(n).selectExpr(
        "concat('E', id) AS Accident_Index",
        "CASE WHEN id % 20 = 0 THEN 'Fatal' WHEN id % 5 = 0 THEN 'Serious' ELSE 'Slight' END AS Accident_Severity",
        "to_date('2005-01-01') + CAST(id % 700 AS INT) AS Date",
        "concat(id % 24, ':30') AS Time",
        "year(to_date('2005-01-01') + CAST(id % 700 AS INT)) AS Year",
        "CASE WHEN id % 30 = 7 THEN 9999.0D ELSE 50.0D + (id % 90) / 10 END AS Latitude",
        "-5.0D + (id % 60) / 10 AS Longitude",
        "20 + 10 * (id % 6) AS Speed_limit",
        "1 + id % 3 AS Number_of_Vehicles",
        "1 + id % 4 AS Number_of_Casualties",
        *[f"CASE id % 3 WHEN 0 THEN 'Unknown' ELSE concat('v', id % {3 + i}) END AS `{c}`" for i, c in enumerate(
            c for c in (*ONE_HOT_COLUMNS, *INDEXED_COLUMNS) if c not in ("Sex_of_Driver", "Age_Band_of_Driver", "Vehicle_Type", "make", "model"))],
    )
    details = spark.range(2 * n).selectExpr(
        "concat('E', CAST(id / 3 AS INT)) AS Accident_Index",
        "id % 3 AS Vehicle_Reference",
        "2005 AS Year",
        "CASE WHEN id % 4 = 0 THEN 'Pedal cycle' ELSE 'Car' END AS Vehicle_Type",
        "CASE WHEN id % 7 = 0 THEN -1 ELSE 800 + id % 900 END AS `Engine_Capacity_.CC.`",
        "id % 15 AS Age_of_Vehicle",
        "1 + id % 10 AS Driver_IMD_Decile",
        "CASE WHEN id % 6 = 0 THEN NULL ELSE concat('make', id % 4) END AS make",
        "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('model', id % 9) END AS model",
        "CASE WHEN id % 2 = 0 THEN 'Male' ELSE 'Female' END AS Sex_of_Driver",
        "concat('band', id % 4) AS Age_Band_of_Driver",
    )
    places = spark.range(12).selectExpr("concat('s', id) AS id", "50.0D + id AS latitude", "-5.0D + id / 2 AS longitude")
    daily = spark.range(12 * 700).selectExpr(
        "concat('s', id % 12) AS station_id", "to_date('2005-01-01') + CAST(id / 12 AS INT) AS time",
        *[f"CAST((id * {k + 3}) % 40 - 5 AS FLOAT) AS {c}" for k, c in enumerate(("tavg", "tmin", "tmax", "prcp", "snow", "wspd", "pres"))],
    )
    return events, details, places, daily


def test_ingest_prepare_and_explore(spark, tmp_path):
    events, details, places, daily = road_tables(spark)
    merged = ingest(spark, events, details, places, daily, str(tmp_path / "work"))
    n_merged = merged.count()
    assert n_merged == events.join(details.drop("Year"), "Accident_Index", "left").count()
    assert merged.filter("tavg IS NULL").count() == 0
    located = tmp_path / "work" / "events_with_station.parquet"
    first = _parts(located)
    # Other events in the same folder are not answered from the stored ones; equal ones are.
    assert ingest(spark, events.limit(0), details, places, daily, str(tmp_path / "work")).count() == 0
    merged = ingest(spark, events, details, places, daily, str(tmp_path / "work"))
    again = _parts(located)
    merged = ingest(spark, events, details, places, daily, str(tmp_path / "work"))
    assert merged.count() == n_merged and first != again == _parts(located)

    ready = prepare(merged, split_key="Accident_Index", out_dir=str(tmp_path / "out"))
    n_stages = 4 + 2 + 2 + 1  # derived, scaling, joint indices and one-hot, assembly
    assert len(ready.model.stages) == n_stages
    check = encoding.written_check(ready.train).first()
    assert check["n_rows"] > 0 and (check["null_features"], check["null_labels"]) == (0, 0)
    assert {r["label"] for r in label_counts(ready.train).collect()} == {0.0, 1.0, 2.0}
    joint = next(s for s in ready.model.stages if hasattr(s, "stages"))
    labels = joint.stages[-1].labels
    assert labels == ["Slight", "Serious", "Fatal"]  # most frequent first
    cleaned = spark.read.parquet(str(tmp_path / "out" / "cleaned.parquet"))
    scaled = ready.model.transform(cleaned)
    stats = encoding.vector_stats(scaled).collect()
    assert len(stats) == len(NUMERIC_COLUMNS)
    assert all(abs(r["mean"]) < 0.2 and 0.5 < r["std"] < 1.5 for r in stats if r["std"] > 0)

    report = explore(encoding.add_spatial_features(merged), ROAD)
    save_report(report, str(tmp_path / "eda"))
    assert report["severity_distribution"].count() == 3
    lines = [r["line"] for r in summary_lines(report).orderBy("line_no").collect()]
    assert lines[0] == "Size" and "Events by density band" in lines
    assert spark.read.json(str(tmp_path / "eda" / "hourly.json")).count() == 24


def test_frequency_index_equals_the_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.range(500).selectExpr("id", "CASE WHEN id % 11 = 0 THEN NULL ELSE concat('v', CAST(sqrt(id) AS INT) % 17) END AS c")
    seen = df.filter("c != 'v3' OR c IS NULL")
    want = StringIndexer(inputCol="c", outputCol="c_idx", handleInvalid="keep").fit(seen).transform(df)
    got = encoding.FrequencyIndex.fit(seen, "c").transform(df)
    pick = lambda x: {r["id"]: r["c_idx"] for r in x.select("id", "c_idx").collect()}
    assert pick(got) == pick(want)


def test_index_storage_does_not_change_the_features(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    from workload import views
    from workload.featuring import _merged

    if not SF_DIR.is_dir():
        pytest.skip("test tables not found")
    merged = _merged(spark, str(SF_DIR))
    few, many = (prepare(merged, views.VIEW, category_limit=n, out_dir=str(tmp_path / str(n))) for n in (2, 200_000))
    pick = lambda df: sorted((list(r["f"]), r["label"]) for r in df.select(vector_to_array("features").alias("f"), "label").collect())
    assert pick(few.train) == pick(many.train) and pick(few.test) == pick(many.test)
    few.model.save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(spark.read.parquet(str(tmp_path / "2" / "cleaned.parquet")))
    assert sorted(pick(few.train) + pick(few.test)) == pick(again)


@pytest.mark.parametrize(("ratio", "derived"), [(None, False), (3.0, True)])
def test_preparing_evaluates_the_merged_rows_once(spark, ratio, derived):
    from workload import views
    from workload.featuring import _merged

    if not SF_DIR.is_dir():
        pytest.skip("test tables not found")
    seen = spark.sparkContext.accumulator(0)
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = _merged(spark, str(SF_DIR))
    ready = prepare(rows.mapInArrow(counted, rows.schema), views.VIEW, split_key="acc_id", balance_ratio=ratio, include_derived=derived)
    assert ready.train.count() > 0 and ready.test.count() > 0
    assert seen.value == rows.count()
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit


def test_vector_inputs_are_computed_once(spark):
    from workload import views
    from workload.featuring import _merged

    if not SF_DIR.is_dir():
        pytest.skip("test tables not found")
    rows = cleaning.apply_row_rules(_merged(spark, str(SF_DIR)), views.VIEW)
    stages = encoding.build_feature_job(views.VIEW).fit(rows).transform(rows).select("features")
    # Six one-hot and nine index columns, the numbers twice, the vector.
    assert stages._jdf.queryExecution().optimizedPlan().toString().count("UDF(") == 6 + 9 + 2 + 1


def test_too_many_values_for_a_vector(spark):
    df = spark.range(200).selectExpr("CAST(id AS STRING) AS big", "'x' AS small")
    encoding.ValueLimit(inputCols=["small"], most=100).fit(df)
    with pytest.raises(ValueError, match="big"):
        encoding.ValueLimit(inputCols=["small", "big"], most=100).fit(df)


def test_many_layouts_and_a_damaged_file(spark, tmp_path):
    for i in range(300):
        _gz(tmp_path / f"S{i}_2005.csv.gz", f'year,extra{i},month,"day",temp\n2005,"a,b",1,{i % 28 + 1},{i}\n')
    whole = gzip.compress(("year,month,day,temp\n" + "2005,1,2,3\n" * 50_000).encode())
    (tmp_path / "BAD_2005.csv.gz").write_bytes(whole[: len(whole) // 2])
    _gz(tmp_path / "NONE_2005.csv.gz", "some,file\n1,2\n")
    rows = {r["station_id"]: r["tavg"] for r in weather.read_daily_weather(spark, str(tmp_path)).filter("station_id <> 'BAD'").collect()}
    assert rows == {f"S{i}": float(i) for i in range(300)}
    told = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in weather.unreadable_files(spark, str(tmp_path)).collect()}
    assert told == {"BAD_2005.csv.gz": "damaged", "NONE_2005.csv.gz": "no header"}
    daily, ledger = ingest_weather(spark, str(tmp_path), f"{tmp_path}-work")
    assert daily.filter("station_id <> 'BAD'").count() == 300
    files = {r["file"].rsplit("/", 1)[1]: (r["lines"], r["dated"], r["reason"]) for r in ledger.collect()}
    assert len(files) == 302 and files["S7_2005.csv.gz"] == (1, 1, None) and files["NONE_2005.csv.gz"] == (2, 0, "no header")
    assert files["BAD_2005.csv.gz"][2] == "damaged" and files["BAD_2005.csv.gz"][0] < 50_000
    findings = {r["check"]: (r["n_bad"], r["status"], r["detail"]) for r in quality.file_findings(ledger).collect()}
    assert findings["damaged_files"] == (1, "ISSUE", "BAD_2005.csv.gz")
    assert findings["files_without_header"] == (1, "ISSUE", "NONE_2005.csv.gz")


def test_oversized_categories(spark):
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS big", "CAST(id % 3 AS STRING) AS small")
    assert encoding.oversized_categories(df, ("big", "small", "absent"), 100) == ("big",)


def test_summaries_with_nulls(spark):
    df = spark.createDataFrame([("9:05", "2005-01-02"), ("x", None), (None, "2007-01-01")], "t string, d string").selectExpr("t", "CAST(d AS DATE) AS d")
    assert {r["hour"]: r["count"] for r in summaries.by_hour(df, "t").collect()} == {None: 2, 9: 1}
    assert {r["day_name"]: r["count"] for r in summaries.by_day_of_week(df, "d").collect()} == {"Sunday": 1, None: 1, "Monday": 1}
    years = [(r["year"], r["count"], r["is_dip"]) for r in summaries.yearly_coverage(df, "d").orderBy("year").collect()]
    assert years == [(2005, 1, False), (2006, 0, True), (2007, 1, False)]
    assert summaries.yearly_coverage(df.filter("d IS NULL"), "d").count() == 0

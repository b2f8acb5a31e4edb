"""Data-quality rules, profiles, distributions and relationships."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.operators import cleaning, distribution, forest, profiling, quality, relationships
from kerbline.plans.validate import validate
from workload import views
from workload.registry import query
from workload.views import VIEW, with_views

_NOW = "1998-01-01"
_DAYS = "('Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday')"


def _counted(rules: list[tuple[str, str, str]], source: str) -> str:
    """SQL rows (check, column, n_bad, n_total, pct, status) from (check, column, predicate)."""
    parts = [
        f"""SELECT '{check}' AS "check", '{column}' AS "column", count(*) FILTER ({bad}) AS n_bad, count(*) AS n_total FROM {source}"""
        for check, column, bad in rules
    ]
    union = " UNION ALL ".join(parts)
    return f"""SELECT "check", "column", n_bad, n_total, round(n_bad / n_total * 100, 2) AS pct,
 CASE WHEN n_bad > 0 THEN 'ISSUE' ELSE 'PASS' END AS status FROM ({union})"""


EVENT_RULES = [
    ("invalid_class", "severity", "severity IS NULL OR severity NOT IN ('Slight', 'Serious', 'Fatal', '1', '2', '3')"),
    ("illegal_speed", "speed", "speed NOT IN (20, 30, 40, 50, 60, 70)"),
    ("latitude_out_of_bounds", "lat", "lat < 49 OR lat > 61"),
    ("longitude_out_of_bounds", "lon", "lon < -8 OR lon > 2"),
    ("non_positive_count", "n_vehicles", "n_vehicles <= 0"),
    ("invalid_day_name", "day_name", f"day_name IS NULL OR day_name NOT IN {_DAYS}"),
]
DETAIL_RULES = [
    ("negative_age", "age", "age < 0"),
    ("invalid_sex", "sex", "sex IS NULL OR trim(sex) NOT IN ('Male', 'female')"),
]
DATE_RULES = [
    ("unreadable_date", "acc_date", "false"),
    ("year_differs_from_date", "acc_year", "acc_year IS NULL OR year(acc_date) != acc_year"),
    ("day_name_differs_from_date", "day_name", "day_name IS NULL OR dayname(acc_date) != day_name"),
    ("bad_time_format", "acc_time", "NOT regexp_full_match(acc_time, '[0-9]{1,2}:[0-9]{2}')"),
]
_FINDING = ("check", "column", "n_bad", "n_total", "pct", "status")


@query(
    "rule_violations",
    with_views(_counted(EVENT_RULES, "acc") + " UNION ALL " + _counted(DETAIL_RULES, "veh"), "acc", "veh"),
)
def rule_violations(spark, sf_dir):
    on_events, on_details = quality.accuracy_rules(VIEW)
    found = quality.run_rules(views.events(spark, sf_dir), "events", on_events).unionByName(
        quality.run_rules(views.details(spark, sf_dir), "details", on_details)
    )
    return found.select(*_FINDING)


@query("consistency_checks", with_views(_counted(DATE_RULES, "acc"), "acc"))
def consistency_checks(spark, sf_dir):
    return quality.run_rules(views.events(spark, sf_dir), "events", quality.consistency_rules(VIEW)).select(*_FINDING)


@query(
    "date_bounds",
    with_views(
        f"""SELECT min(acc_date) AS earliest, max(acc_date) AS latest, count(*) FILTER (acc_date > DATE '{_NOW}') AS n_future,
 count(*) FILTER (acc_date < DATE '2005-01-01') AS n_before_floor FROM acc""",
        "acc",
    ),
)
def date_bounds(spark, sf_dir):
    return quality.date_range(views.events(spark, sf_dir), VIEW, F.lit(_NOW).cast("timestamp"))


@query(
    "category_sample",
    with_views(
        """SELECT 'light' AS "column", count(*) AS n_distinct, (SELECT string_agg(light, '|' ORDER BY light)
 FROM (SELECT light FROM d ORDER BY light LIMIT 10)) AS sample FROM d
 UNION ALL SELECT 'model', count(*), (SELECT string_agg(model, '|' ORDER BY model) FROM (SELECT model FROM m ORDER BY model LIMIT 10)) FROM m""",
        "acc",
        "veh",
        d="SELECT DISTINCT light FROM acc WHERE light IS NOT NULL",
        m="SELECT DISTINCT model FROM veh WHERE model IS NOT NULL",
    ),
)
def category_sample(spark, sf_dir):
    return profiling.category_sample(views.events(spark, sf_dir), "light").unionByName(
        profiling.category_sample(views.details(spark, sf_dir), "model")
    )


def _nulls_sql(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS null_count,
 round(count(*) FILTER ({c} IS NULL) / count(*) * 100, 2) AS null_pct FROM {source}"""
        for c in columns
    )


def _required_sql(names) -> str:
    return '"column" IN (' + ", ".join(f"'{n}'" for n in names) + ")"


_MISSING = f"""SELECT 'events' AS "table", "column", null_count, null_pct, {_required_sql(VIEW.required_event)} AS is_required,
 null_pct > 20 AS is_high FROM ({_nulls_sql(views.EVENTS, 'acc')}) WHERE null_count > 0
 UNION ALL SELECT 'details', "column", null_count, null_pct, {_required_sql(VIEW.required_detail)}, null_pct > 20
 FROM ({_nulls_sql(views.DETAILS, 'veh')}) WHERE null_count > 0"""


def _missing(spark, sf_dir):
    return profiling.missing_profile(views.events(spark, sf_dir), "events", VIEW.required_event).unionByName(
        profiling.missing_profile(views.details(spark, sf_dir), "details", VIEW.required_detail)
    )


@query("missing_profile", with_views(_MISSING, "acc", "veh"))
def missing_profile(spark, sf_dir):
    return _missing(spark, sf_dir)


@query(
    "missing_top12",
    with_views('SELECT * FROM missing ORDER BY null_pct DESC, "column" LIMIT 12', "acc", "veh", missing=_MISSING),
)
def missing_top12(spark, sf_dir):
    return profiling.top_missing(_missing(spark, sf_dir))


@query("null_profile", with_views(f"SELECT * FROM ({_nulls_sql(views.EVENTS, 'acc')}) WHERE null_count > 0", "acc"))
def null_profile(spark, sf_dir):
    return profiling.null_profile(views.events(spark, sf_dir))


_NUMBERS = ("acc_id", "acc_year", "lat", "lon", "speed", "n_vehicles", "n_casualties")


@query(
    "numeric_profile",
    with_views(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
 round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS stddev FROM acc"""
            for c in _NUMBERS
        ),
        "acc",
    ),
)
def numeric_profile(spark, sf_dir):
    return profiling.numeric_profile(views.events(spark, sf_dir))


@query("dataset_shape", with_views(f"SELECT count(*) AS total_rows, CAST({len(views.EVENTS)} AS BIGINT) AS total_columns FROM acc", "acc"))
def dataset_shape(spark, sf_dir):
    return profiling.dataset_shape(views.events(spark, sf_dir))


@query(
    "duplicate_profile",
    with_views(
        """SELECT 'events_rows' AS "check", (SELECT count(*) FROM acc) - (SELECT count(*) FROM (SELECT DISTINCT * FROM acc)) AS n_duplicates
 UNION ALL SELECT 'events_key', (SELECT count(*) FROM acc) - (SELECT count(*) FROM (SELECT DISTINCT acc_id FROM acc))
 UNION ALL SELECT 'details_rows', (SELECT count(*) FROM veh) - (SELECT count(*) FROM (SELECT DISTINCT * FROM veh))
 UNION ALL SELECT 'details_key', (SELECT count(*) FROM veh) - (SELECT count(*) FROM (SELECT DISTINCT acc_id FROM veh))
 UNION ALL SELECT 'details_composite_key', (SELECT count(*) FROM veh) - (SELECT count(*) FROM (SELECT DISTINCT acc_id, veh_ref FROM veh))""",
        "acc",
        "veh",
    ),
)
def duplicate_profile(spark, sf_dir):
    acc, veh = views.events(spark, sf_dir), views.details(spark, sf_dir)
    return profiling.duplicate_profile([("events", acc, [["acc_id"]]), ("details", veh, [["acc_id"], ["acc_id", "veh_ref"]])])


_MEASURES = {"veh": ("age", "engine_cc"), "lineitem": ("l_quantity", "l_extendedprice", "l_discount")}


def _each(template: str) -> str:
    return " UNION ALL ".join(template.format(c=c, t=t) for t, names in _MEASURES.items() for c in names)


def _on_measures(spark, sf_dir, operator):
    veh = operator(views.details(spark, sf_dir), _MEASURES["veh"])
    return veh.unionByName(operator(views.table(spark, sf_dir, "lineitem"), _MEASURES["lineitem"]))


@query(
    "iqr_outliers",
    with_views(
        _each(
            """SELECT '{c}' AS "column", count(*) FILTER ({c} < lo OR {c} > hi) AS n_outliers, round(min(lo), 2) AS lower_fence,
 round(min(hi), 2) AS upper_fence FROM {t}, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
 FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t}))"""
        ),
        "veh",
    ),
)
def iqr_outliers(spark, sf_dir):
    return _on_measures(spark, sf_dir, distribution.iqr_outliers)


@query("iqr_outliers_sketch")
def iqr_outliers_sketch(spark, sf_dir):
    return _on_measures(spark, sf_dir, lambda df, names: distribution.iqr_outliers(df, names, exact=False))


@query(
    "zscore_outliers",
    with_views(
        _each(
            """SELECT '{c}' AS "column", count(*) FILTER (abs({c} - m) > 3 * s) AS n_outliers, count({c}) AS n_valid
 FROM {t}, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {t})"""
        ),
        "veh",
    ),
)
def zscore_outliers(spark, sf_dir):
    return _on_measures(spark, sf_dir, distribution.zscore_outliers)


@query(
    "describe_numeric",
    with_views(
        _each(
            """SELECT '{c}' AS "column", round(min({c}), 3) AS min, round(max({c}), 3) AS max, round(avg({c}), 3) AS mean,
 round(median({c}), 3) AS median, round(stddev_samp({c}), 3) AS std,
 round(avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5), 3) AS skewness,
 round(avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3, 3) AS kurtosis,
 count({c}) AS n_valid, count(DISTINCT {c}) AS cardinality, 'DONE' AS status FROM {t}, (SELECT avg({c}) AS m FROM {t})"""
        ),
        "veh",
    ),
)
def describe_numeric(spark, sf_dir):
    return _on_measures(spark, sf_dir, distribution.describe_numeric)


@query(
    "histogram_1d",
    with_views(
        _each(
            """SELECT '{c}' AS "column", CAST(b AS INTEGER) AS bin, round(e0, 3) AS bin_low, round(e1, 3) AS bin_high,
 count(v) AS n, round(count(v) / (SELECT count({c}) FROM {t}) * 100, 1) AS pct
 FROM (SELECT b, lo + (hi - lo) / 10 * (b - 1) AS e0, CASE WHEN b = 10 THEN hi ELSE lo + (hi - lo) / 10 * b END AS e1
 FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM {t}), range(1, 11) r(b))
 LEFT JOIN (SELECT {c} AS v FROM {t} WHERE {c} IS NOT NULL) ON v >= e0 AND (v < e1 OR (b = 10 AND v = e1)) GROUP BY b, e0, e1"""
        ),
        "veh",
    ),
)
def histogram_1d(spark, sf_dir):
    return _on_measures(spark, sf_dir, distribution.histogram)


def _axis_sql(c: str) -> str:
    """One more than the number of inner bin edges at or below the value."""
    return f"CAST(1 + len(list_filter(range(1, 40), lambda k: {c} >= {c}0 + ({c}1 - {c}0) / 40 * k)) AS INTEGER)"


def _grid_sql(source: str) -> str:
    return f"""SELECT {_axis_sql('x')} AS bx, {_axis_sql('y')} AS by, count(*) AS n
 FROM {source}, (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM {source}) GROUP BY 1, 2"""


@query("histogram_2d", f"WITH p AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem) {_grid_sql('p')}")
def histogram_2d(spark, sf_dir):
    return distribution.density_grid(views.table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")


@query("hotspot_grid", with_views(_grid_sql("p"), "acc", p="SELECT lon AS x, lat AS y FROM acc WHERE lat <= 61 AND lon IS NOT NULL"))
def hotspot_grid(spark, sf_dir):
    acc = cleaning.null_out_of_bounds(views.events(spark, sf_dir), {"lat": VIEW.bounds["lat"]})
    return distribution.density_grid(acc, "lon", "lat")


_CATEGORIES = {"acc": ("severity", *VIEW.category_event), "veh": VIEW.category_detail}


@query(
    "value_counts",
    with_views(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 2"""
            for t, names in _CATEGORIES.items()
            for c in names
        ),
        "acc",
        "veh",
    ),
)
def value_counts(spark, sf_dir):
    return profiling.value_counts(views.events(spark, sf_dir), _CATEGORIES["acc"]).unionByName(
        profiling.value_counts(views.details(spark, sf_dir), _CATEGORIES["veh"])
    )


_RELATED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_PAIRS = [(a, b) for i, a in enumerate(_RELATED) for b in _RELATED[i + 1 :]]
_RANKS = "SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _RELATED
) + " FROM lineitem"


def _corr_sql(measure: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({a}, {b}), 3) AS {measure} FROM {source}" for a, b in _PAIRS
    )


@query("pearson_pairs", _corr_sql("pearson", "lineitem"))
def pearson_pairs(spark, sf_dir):
    return relationships.pearson_pairs(views.table(spark, sf_dir, "lineitem"), _RELATED)


@query("spearman_pairs", f"WITH ranks AS ({_RANKS}) {_corr_sql('spearman', 'ranks')}")
def spearman_pairs(spark, sf_dir):
    return relationships.spearman_pairs(views.table(spark, sf_dir, "lineitem"), _RELATED)


@query(
    "corr_compare",
    f"""WITH ranks AS ({_RANKS}), p AS ({_corr_sql('pearson', 'lineitem')}), s AS ({_corr_sql('spearman', 'ranks')})
 SELECT left_column, right_column, pearson, spearman, round(abs(pearson - spearman), 3) AS diff,
 abs(pearson - spearman) > 0.10 AS non_linear, abs(pearson) > 0.85 OR abs(spearman) > 0.85 AS high
 FROM p JOIN s USING (left_column, right_column)""",
)
def corr_compare(spark, sf_dir):
    rows = views.table(spark, sf_dir, "lineitem")
    return relationships.compare_correlations(
        relationships.pearson_pairs(rows, _RELATED), relationships.spearman_pairs(rows, _RELATED)
    )


_ERF = "1 - (((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t) * exp(-x * x)"
_KS_SQL = f"""v AS (SELECT 'lat' AS c, lat AS v FROM acc WHERE lat IS NOT NULL UNION ALL SELECT 'speed', speed FROM acc WHERE speed IS NOT NULL
 UNION ALL SELECT 'n_vehicles', CAST(n_vehicles AS DOUBLE) FROM acc),
m AS (SELECT c, avg(v) AS mean, stddev_samp(v) AS sd, count(*) AS total FROM v GROUP BY c),
d AS (SELECT c, v, count(*) AS n FROM v GROUP BY c, v),
r AS (SELECT d.c, v, n, sum(n) OVER (PARTITION BY d.c ORDER BY v) AS upto, total, (v - mean) / sd AS z FROM d JOIN m USING (c)),
e AS (SELECT *, abs(z) / sqrt(2.0) AS x, 1 / (1 + 0.3275911 * abs(z) / sqrt(2.0)) AS t FROM r),
f AS (SELECT *, CASE WHEN z >= 0 THEN (1 + ({_ERF})) / 2 ELSE (1 - ({_ERF})) / 2 END AS phi FROM e),
g AS (SELECT c, max(greatest(upto / total - phi, phi - (upto - n) / total)) AS dist FROM f GROUP BY c)"""


@query(
    "ks_profile",
    with_views("", "acc").rstrip()
    + ",\n"
    + _KS_SQL
    + """ SELECT c AS "column", total AS n_valid, round(dist, 4) AS ks_statistic FROM g JOIN m USING (c)""",
)
def ks_profile(spark, sf_dir):
    found = distribution.ks_profile(views.events(spark, sf_dir), ["lat", "speed", "n_vehicles"])
    return found.select("column", "n_valid", "ks_statistic")


@query(
    "unreadable_dates",
    with_views(
        """SELECT count(*) FILTER (WHERE d IS NOT NULL AND TRY_CAST(d AS DATE) IS NULL) AS n_bad, count(*) AS n_total FROM
 (SELECT CASE WHEN acc_id % 43 = 0 THEN 'soon' WHEN acc_id % 41 = 0 THEN NULL WHEN acc_id % 37 = 0 THEN '2001-02-30' ELSE CAST(acc_date AS VARCHAR) END AS d FROM acc)""",
        "acc",
    ),
)
def unreadable_dates(spark, sf_dir):
    text = """CASE WHEN acc_id % 43 = 0 THEN 'soon' WHEN acc_id % 41 = 0 THEN NULL WHEN acc_id % 37 = 0 THEN '2001-02-30'
        ELSE CAST(acc_date AS STRING) END"""
    acc = views.events(spark, sf_dir).withColumn("acc_date", F.expr(text))
    rules = [r for r in quality.consistency_rules(VIEW) if r.check == "unreadable_date"]
    return quality.run_rules(acc, "events", rules).select("n_bad", "n_total")


@query("ks_normal")
def ks_normal(spark, sf_dir):
    return distribution.ks_normal(views.table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey")


@query("isolation_forest")
def isolation_forest(spark, sf_dir):
    return forest.isolation_summary(
        views.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_totalprice", "o_custkey"),
        ["o_totalprice", "o_custkey"],
        "o_orderkey",
        "orders",
    )


def _findings(spark, sf_dir):
    veh = views.details(spark, sf_dir).withColumnRenamed("veh_year", "acc_year")
    return validate(views.events(spark, sf_dir), veh, VIEW, F.lit(_NOW).cast("timestamp"))


@query("quality_findings")
def quality_findings(spark, sf_dir):
    return _findings(spark, sf_dir)


@query(
    "issue_rollup",
    with_views(
        f"""SELECT dimension, n_issues, CAST(sum(n_issues) OVER () AS BIGINT) AS total_issues FROM (
 SELECT dimension, count(*) AS n_issues FROM (
 SELECT 'accuracy' AS dimension FROM ({_counted(EVENT_RULES, 'acc')} UNION ALL {_counted(DETAIL_RULES, 'veh')}) WHERE status = 'ISSUE'
 UNION ALL SELECT 'consistency' FROM ({_counted(DATE_RULES, 'acc')}) WHERE status = 'ISSUE'
 UNION ALL SELECT 'timeliness' FROM acc WHERE acc_date > DATE '{_NOW}' GROUP BY 1
 UNION ALL SELECT 'timeliness' FROM acc WHERE acc_date < DATE '2005-01-01' GROUP BY 1) GROUP BY 1)""",
        "acc",
        "veh",
    ),
)
def issue_rollup(spark, sf_dir):
    acc, veh = views.events(spark, sf_dir), views.details(spark, sf_dir)
    on_events, on_details = quality.accuracy_rules(VIEW)
    rules = on_events + quality.consistency_rules(VIEW) + quality.timeliness_rules(VIEW, F.lit(_NOW).cast("timestamp"))
    found = quality.run_rules(acc, "events", rules).unionByName(quality.run_rules(veh, "details", on_details))
    return quality.issue_rollup(found)

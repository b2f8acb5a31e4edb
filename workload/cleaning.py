"""Cleaning and imputation."""

from __future__ import annotations

from kerbline.operators import cleaning, imputing, joins
from kerbline.scale import settle
from workload import views
from workload.registry import query
from workload.views import VIEW, with_views

SENTINELS = "('Data missing or out of range', 'Unknown', 'unknown', 'N/A', '')"
SNAP = """CASE WHEN speed IS NULL OR speed IN (20, 30, 40, 50, 60, 70) THEN speed WHEN speed <= 25 THEN 20 WHEN speed <= 35 THEN 30
 WHEN speed <= 45 THEN 40 WHEN speed <= 55 THEN 50 WHEN speed <= 65 THEN 60 ELSE 70 END"""


def sentinel_sql(name: str) -> str:
    return f"CASE WHEN {name} IN {SENTINELS} THEN NULL ELSE {name} END"


def bound_sql(name: str, low: float, high: float) -> str:
    return f"CASE WHEN {name} < {low} OR {name} > {high} THEN NULL ELSE {name} END"


def mode_sql(source: str) -> dict[str, str]:
    return {
        "counted": f"SELECT make, model, count(*) AS n FROM {source} WHERE model IS NOT NULL GROUP BY 1, 2",
        "modes": """SELECT make, model AS m FROM (SELECT *, row_number() OVER (PARTITION BY make ORDER BY n DESC, model) AS rk FROM counted)
 WHERE rk = 1 AND make IS NOT NULL""",
        "overall": "SELECT model AS m FROM (SELECT model, sum(n) AS n FROM counted GROUP BY 1) ORDER BY n DESC, model LIMIT 1",
    }


@query(
    "clean_sentinels",
    with_views(
        "SELECT acc_id, "
        + ", ".join(f"{sentinel_sql(c)} AS {c}" for c in ("acc_time", "severity", "light", "weather", "surface", "road_type", "day_name"))
        + " FROM acc",
        "acc",
    ),
)
def clean_sentinels(spark, sf_dir):
    acc = views.events(spark, sf_dir).select("acc_id", "acc_time", "severity", "light", "weather", "surface", "road_type", "day_name")
    return cleaning.null_sentinels(acc, VIEW.sentinels)


@query(
    "null_negative",
    with_views(
        """SELECT acc_id, veh_ref, CASE WHEN age < 0 THEN NULL ELSE age END AS age,
 CASE WHEN engine_cc < 0 THEN NULL ELSE engine_cc END AS engine_cc FROM veh""",
        "veh",
    ),
)
def null_negative(spark, sf_dir):
    veh = views.details(spark, sf_dir).select("acc_id", "veh_ref", "age", "engine_cc")
    return cleaning.null_negative(veh, VIEW.null_negative)


@query("snap_legal", with_views(f"SELECT acc_id, CAST({SNAP} AS DOUBLE) AS speed FROM acc", "acc"))
def snap_legal(spark, sf_dir):
    return cleaning.snap_to_legal(views.events(spark, sf_dir).select("acc_id", "speed"), VIEW.legal_values)


@query(
    "bounds_null",
    with_views(
        f"SELECT acc_id, {bound_sql('lat', 49, 61)} AS lat, {bound_sql('lon', -8, 2)} AS lon, {bound_sql('n_vehicles', 1, 100)} AS n_vehicles FROM acc",
        "acc",
    ),
)
def bounds_null(spark, sf_dir):
    acc = views.events(spark, sf_dir).select("acc_id", "lat", "lon", "n_vehicles")
    return cleaning.null_out_of_bounds(acc, VIEW.bounds)


@query(
    "require_cols",
    with_views(
        "SELECT acc_id, severity, lat, lon FROM acc WHERE severity IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL", "acc"
    ),
)
def require_cols(spark, sf_dir):
    return cleaning.require_columns(views.events(spark, sf_dir).select("acc_id", "severity", "lat", "lon"), VIEW.required)


@query(
    "fill_const",
    with_views("SELECT acc_id, coalesce(light, 'Unknown') AS light, coalesce(surface, 'Unknown') AS surface FROM acc", "acc"),
)
def fill_const(spark, sf_dir):
    acc = views.events(spark, sf_dir).select("acc_id", "light", "surface")
    return cleaning.fill_constant(acc, VIEW.unknown_fill, VIEW.fill_value)


@query(
    "cast_numeric",
    "SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS o_orderpriority, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders",
)
def cast_numeric(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return cleaning.cast_numeric(rows, ["o_orderpriority", "o_totalprice", "absent"])


@query(
    "drop_and_rename",
    with_views("SELECT acc_id, severity, lat AS latitude, lon AS longitude FROM acc", "acc"),
)
def drop_and_rename(spark, sf_dir):
    acc = views.events(spark, sf_dir).select("acc_id", "severity", "lat", "lon", "n_casualties")
    kept = cleaning.drop_columns(acc, ["n_casualties", "absent"])
    return cleaning.rename_columns(kept, {"lat": "latitude", "lon": "longitude", "absent": "x"})


@query(
    "median_impute",
    with_views(
        "SELECT acc_id, veh_ref, coalesce(age, (SELECT quantile_disc(age, 0.5) FROM veh)) AS age, "
        "coalesce(engine_cc, (SELECT quantile_disc(engine_cc, 0.5) FROM veh)) AS engine_cc FROM veh",
        "veh",
    ),
)
def median_impute(spark, sf_dir):
    veh = views.details(spark, sf_dir).select("acc_id", "veh_ref", "age", "engine_cc")
    return imputing.fill_median(veh, VIEW.median, exact=True)


@query("median_impute_sketch")
def median_impute_sketch(spark, sf_dir):
    veh = views.details(spark, sf_dir).select("acc_id", "veh_ref", "age", "engine_cc")
    return imputing.fill_median(veh, VIEW.median)


@query(
    "mode_by_group_impute",
    with_views(
        "SELECT acc_id, veh_ref, veh.make, coalesce(model, m, (SELECT m FROM overall), 'Unknown') AS model FROM veh LEFT JOIN modes USING (make)",
        "veh",
        **mode_sql("veh"),
    ),
)
def mode_by_group_impute(spark, sf_dir):
    veh = views.details(spark, sf_dir).select("acc_id", "veh_ref", "make", "model")
    return imputing.fill_group_mode(veh, "model", "make")


@query(
    "group_modes",
    with_views(
        "SELECT make, model AS mode FROM (SELECT *, row_number() OVER (PARTITION BY make ORDER BY n DESC, model) AS rk FROM counted) WHERE rk = 1",
        "veh",
        **mode_sql("veh"),
    ),
)
def group_modes(spark, sf_dir):
    return imputing.group_modes(views.details(spark, sf_dir), "model", "make")


def joined(spark, sf_dir):
    """The merged table."""
    return joins.join_details(views.events(spark, sf_dir), views.details(spark, sf_dir), "acc_id", drop=("veh_year",))


def merged(spark, sf_dir):
    """The merged table, stored before it is cleaned, as an ingest leaves it."""
    return settle(joined(spark, sf_dir))


_TEXT = ("acc_time", "light", "weather", "surface", "road_type", "day_name", "vehicle_type", "make", "model", "sex")
RULED = {
    "merged": """SELECT acc.*, veh_ref, vehicle_type, engine_cc, age, make, model, sex FROM acc LEFT JOIN veh ON acc.acc_id = veh.acc_id""",
    "ruled": f"""SELECT acc_id, acc_date, acc_year, {", ".join(f"{sentinel_sql(c)} AS {c}" for c in _TEXT)}, severity, veh_ref,
 CAST({SNAP} AS DOUBLE) AS speed, {bound_sql('lat', 49, 61)} AS lat, {bound_sql('lon', -8, 2)} AS lon,
 CAST({bound_sql('n_vehicles', 1, 100)} AS DOUBLE) AS n_vehicles, {bound_sql('engine_cc', 50, 8000)} AS engine_cc,
 {bound_sql('age', 0, 100)} AS age FROM merged""",
    "kept": "SELECT * FROM ruled WHERE severity IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL",
}
CLEANED = """SELECT acc_id, acc_date, acc_year, acc_time, severity, lat, lon, speed, coalesce(light, 'Unknown') AS light,
 coalesce(weather, 'Unknown') AS weather, coalesce(surface, 'Unknown') AS surface, coalesce(road_type, 'Unknown') AS road_type,
 n_vehicles, day_name, veh_ref, coalesce(vehicle_type, 'Unknown') AS vehicle_type,
 coalesce(engine_cc, (SELECT quantile_disc(engine_cc, 0.5) FROM kept)) AS engine_cc,
 coalesce(age, (SELECT quantile_disc(age, 0.5) FROM kept)) AS age, coalesce(kept.make, 'Unknown') AS make,
 coalesce(model, m, (SELECT m FROM overall), 'Unknown') AS model, sex FROM kept LEFT JOIN modes ON kept.make = modes.make"""


@query("clean_full", with_views(CLEANED, "acc", "veh", **RULED, **mode_sql("kept")))
def clean_full(spark, sf_dir):
    return cleaning.clean(merged(spark, sf_dir), VIEW, exact_median=True)


@query(
    "clean_row_loss",
    with_views(
        """SELECT b AS n_before, a AS n_after, b - a AS n_lost, round((b - a) / b * 100, 2) AS pct_lost
 FROM (SELECT (SELECT count(*) FROM merged) AS b, (SELECT count(*) FROM kept) AS a)""",
        "acc",
        "veh",
        **RULED,
    ),
)
def clean_row_loss(spark, sf_dir):
    before = merged(spark, sf_dir)
    return cleaning.row_loss(before, cleaning.apply_row_rules(before, VIEW))

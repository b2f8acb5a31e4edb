"""Data-quality checks as findings.

A finding is one row (dimension, check, table, column, n_bad, n_total, pct,
status, detail). All rules on a table are evaluated in one aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbline import profile as fixed
from kerbline.columns import col, measured, numeric
from kerbline.functions.rules import capitalised
from kerbline.functions.temporal import bad_time_format, day_name, parsed_date
from kerbline.operators.distribution import FEWEST_DESCRIBED, ks_table, normal_gap
from kerbline.operators.forest import isolation_summary
from kerbline.operators.keys import cross_table_mismatch, key_overlap
from kerbline.operators.profiling import melted, missing_profile, nested_duplicates, pct, value_counts
from kerbline.operators.quantiles import value_of
from kerbline.operators.summaries import yearly_coverage
from kerbline.operators.relationships import compare_correlations, spearman_pairs
from kerbline.profile import ROAD, Profile
from kerbline.scale import cumulative_counts, settle, value_counts_long

# File names written into a finding's text; the ledger holds all.
SHOWN_FILES = 20
PASS, ISSUE, INFO, SKIPPED = "PASS", "ISSUE", "INFO", "SKIPPED"
FINDING_COLUMNS = ("dimension", "check", "table", "column", "n_bad", "n_total", "pct", "status", "detail")


@dataclass(frozen=True)
class Rule:
    """Counts the rows of a table for which ``bad`` holds."""

    dimension: str
    check: str
    column: str
    needs: tuple[str, ...]
    bad: Column


def not_in_set(c: Column, allowed: Iterable[str]) -> Column:
    """True outside the set; a null counts as outside."""
    return F.coalesce(~c.cast("string").isin(*allowed), F.lit(True))


def number_not_in_set(c: Column, allowed: Iterable[float]) -> Column:
    """True for a number outside the set; what is no number is not counted."""
    return measured(c) & ~c.isin(*[float(v) for v in allowed])


def outside(c: Column, low: float, high: float) -> Column:
    return measured(c) & ((c < low) | (c > high))


def differs(a: Column, b: Column) -> Column:
    """True unless both sides are present and equal."""
    return F.coalesce(a != b, F.lit(True))


def accuracy_rules(p: Profile = ROAD) -> tuple[list[Rule], list[Rule]]:
    """Rules on the event table and on the detail table."""
    lat_low, lat_high = fixed.VALIDITY_BOUNDS["Latitude"]
    lon_low, lon_high = fixed.VALIDITY_BOUNDS["Longitude"]
    both = (p.lat, p.lon)
    events = [
        Rule("accuracy", "invalid_class", p.label, (p.label,), not_in_set(col(p.label), fixed.VALID_CLASSES)),
        Rule("accuracy", "illegal_speed", p.speed, (p.speed,), number_not_in_set(numeric(p.speed), fixed.LEGAL_SPEEDS)),
        Rule("accuracy", "latitude_out_of_bounds", p.lat, both, outside(numeric(p.lat), lat_low, lat_high)),
        Rule("accuracy", "longitude_out_of_bounds", p.lon, both, outside(numeric(p.lon), lon_low, lon_high)),
        Rule("accuracy", "non_positive_count", p.n_details, (p.n_details,), numeric(p.n_details) <= 0),
        Rule("accuracy", "invalid_day_name", p.day_name, (p.day_name,), not_in_set(col(p.day_name), fixed.VALID_DAYS)),
    ]
    details = [
        Rule("accuracy", "negative_age", p.age, (p.age,), numeric(p.age) < 0),
        Rule("accuracy", "invalid_sex", p.sex, (p.sex,), not_in_set(capitalised(col(p.sex)), fixed.VALID_SEXES)),
    ]
    return events, details


def consistency_rules(p: Profile = ROAD) -> list[Rule]:
    date = parsed_date(col(p.date))
    return [
        Rule("consistency", "unreadable_date", p.date, (p.date,), date.isNull() & col(p.date).isNotNull()),
        Rule(
            "consistency",
            "year_differs_from_date",
            p.year,
            (p.date, p.year),
            differs(F.year(date).cast("double"), numeric(p.year)),
        ),
        Rule(
            "consistency",
            "day_name_differs_from_date",
            p.day_name,
            (p.date, p.day_name),
            differs(day_name(date), col(p.day_name)),
        ),
        Rule("consistency", "bad_time_format", p.time, (p.time,), bad_time_format(col(p.time))),
    ]


def timeliness_rules(p: Profile = ROAD, now: Column | None = None) -> list[Rule]:
    """Future dates and dates before the floor; ``now`` may be fixed for a repeatable run."""
    date = parsed_date(col(p.date))
    moment = F.current_timestamp() if now is None else now
    return [
        Rule("timeliness", "future_date", p.date, (p.date,), date.cast("timestamp") > moment),
        Rule("timeliness", "before_first_date", p.date, (p.date,), date < F.lit(fixed.EARLIEST_DATE).cast("date")),
    ]


def rule_counts(columns: list[str], rules: list[Rule]) -> list[Column]:
    """Aggregates that ``rules_from`` reads; rules on absent columns have none."""
    have = set(columns)
    usable = [(i, r) for i, r in enumerate(rules) if set(r.needs) <= have]
    return [F.count("*").alias("n_total"), *[F.count_if(F.coalesce(r.bad, F.lit(False))).alias(f"k_{i}") for i, r in usable]]


def rules_from(row: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Findings of all rules from one row of ``rule_counts``; a rule on an absent column is SKIPPED."""
    usable = [f"k_{i}" in row.columns for i in range(len(rules))]
    structs = []
    for i, r in enumerate(rules):
        n_bad = F.col(f"k_{i}") if usable[i] else F.lit(None).cast("long")
        status = F.when(n_bad > 0, ISSUE).otherwise(PASS) if usable[i] else F.lit(SKIPPED)
        structs.append(
            F.struct(
                F.lit(r.dimension).alias("dimension"),
                F.lit(r.check).alias("check"),
                F.lit(table).alias("table"),
                F.lit(r.column).alias("column"),
                n_bad.alias("n_bad"),
                F.col("n_total").alias("n_total"),
                (pct(n_bad, F.col("n_total")) if usable[i] else F.lit(None).cast("double")).alias("pct"),
                status.alias("status"),
                F.lit(None if usable[i] else "column not found").cast("string").alias("detail"),
            )
        )
    return row.select(F.inline(F.array(*structs)))


def run_rules(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Evaluate all rules in one pass."""
    return rules_from(df.agg(*rule_counts(df.columns, rules)), table, rules)


def as_findings(
    df: DataFrame,
    dimension: str,
    check: str | Column,
    table: str | Column,
    column: str | Column,
    n_bad: Column,
    n_total: Column | None = None,
    issue: Column | None = None,
    detail: Column | None = None,
    status: Column | None = None,
    pct: Column | None = None,
) -> DataFrame:
    """Reshape any result into findings; an issue is a positive ``n_bad`` by default."""
    text = lambda v: F.lit(v) if isinstance(v, str) else v
    total = F.lit(None).cast("long") if n_total is None else n_total.cast("long")
    bad = n_bad.cast("long")
    found = bad > 0 if issue is None else issue
    return df.select(
        F.lit(dimension).alias("dimension"),
        text(check).alias("check"),
        text(table).alias("table"),
        text(column).alias("column"),
        bad.alias("n_bad"),
        total.alias("n_total"),
        (F.when(total > 0, F.round(bad / total * 100, 2)) if pct is None else pct).alias("pct"),
        (F.when(found, ISSUE).otherwise(PASS) if status is None else status).alias("status"),
        (F.lit(None).cast("string") if detail is None else detail.cast("string")).alias("detail"),
    )


def skipped(df: DataFrame, dimension: str, check: str, table: str, column: str) -> DataFrame:
    """The finding of a check whose column is absent."""
    one = df.sparkSession.range(1)
    return as_findings(
        one, dimension, check, table, column, F.lit(None), status=F.lit(SKIPPED), detail=F.lit("column not found")
    )


def union_findings(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def category_findings(details: DataFrame, p: Profile = ROAD) -> DataFrame:
    """How many driver age bands there are, for information."""
    if p.age_band not in details.columns:
        return skipped(details, "accuracy", "distinct_categories", "details", p.age_band)
    bands = details.agg(F.count_distinct(col(p.age_band)).alias("n"))
    text = F.concat(F.col("n").cast("string"), F.lit(" categories"))
    return as_findings(bands, "accuracy", "distinct_categories", "details", p.age_band, F.lit(0), status=F.lit(INFO), detail=text)


def cross_table_findings(events: DataFrame, details: DataFrame, p: Profile = ROAD) -> DataFrame:
    """Events whose year is not that of their first detail row."""
    check = "year_differs_across_tables"
    if not ({p.key, p.year} <= set(events.columns) and {p.key, p.year, p.detail_key} <= set(details.columns)):
        return skipped(events, "consistency", check, "both", p.year)
    years = cross_table_mismatch(events, details, p.key, p.detail_key, p.year, p.year)
    return as_findings(years, "consistency", check, "both", p.year, F.col("n_bad"), F.col("n_total"))


def check_accuracy(events: DataFrame, details: DataFrame, p: Profile = ROAD) -> DataFrame:
    on_events, on_details = accuracy_rules(p)
    return union_findings(
        [run_rules(events, "events", on_events), run_rules(details, "details", on_details), category_findings(details, p)]
    )


def check_consistency(events: DataFrame, details: DataFrame, p: Profile = ROAD) -> DataFrame:
    return union_findings([run_rules(events, "events", consistency_rules(p)), cross_table_findings(events, details, p)])


def completeness_findings(missing: DataFrame) -> DataFrame:
    """A finding per required column with nulls, and one per column above the threshold."""
    both = F.array(
        F.struct(F.lit("required_column_has_nulls").alias("check"), F.col("is_required").alias("hit")),
        F.struct(F.lit("mostly_missing").alias("check"), F.col("is_high").alias("hit")),
    )
    hits = missing.select("*", F.inline(both)).filter("hit")
    return as_findings(hits, "completeness", F.col("check"), F.col("table"), F.col("column"), F.col("null_count"), pct=F.col("null_pct"))


def check_completeness(events: DataFrame, details: DataFrame, p: Profile = ROAD) -> DataFrame:
    sides = (("events", events, p.required_event), ("details", details, p.required_detail))
    return union_findings([completeness_findings(missing_profile(df, table, required)) for table, df, required in sides])


def check_uniqueness(events: DataFrame, details: DataFrame, p: Profile = ROAD) -> DataFrame:
    pair = [p.key, p.detail_key]
    paired = set(pair) <= set(details.columns)
    on_events = nested_duplicates(events, [[p.key]])
    on_details = nested_duplicates(details, [[p.key], pair] if paired else [[p.key]])

    def told(row: DataFrame, *checks) -> DataFrame:
        shown = [F.struct(F.lit(c).alias("check"), F.lit(t).alias("t"), F.lit(k).alias("k"), col(n).alias("n"), F.lit(info).alias("info")) for c, t, k, n, info in checks]
        long = row.select(F.inline(F.array(*shown)))
        # Several details per event are expected.
        status = F.when(F.col("info"), INFO).when(F.col("n") > 0, ISSUE).otherwise(PASS)
        return as_findings(long, "uniqueness", F.col("check"), F.col("t"), F.col("k"), F.col("n"), status=status)

    both = [("duplicate_composite_key", "details", ", ".join(pair), ",".join(pair), False)] if paired else []
    parts = [
        told(on_events, ("duplicate_row", "events", "*", "rows", False), ("duplicate_key", "events", p.key, p.key, False)),
        told(on_details, ("duplicate_row", "details", "*", "rows", False), ("repeated_event_key", "details", p.key, p.key, True), *both),
    ]
    if not paired:
        parts.append(skipped(details, "uniqueness", "duplicate_composite_key", "details", ", ".join(pair)))
    return union_findings(parts)


def here(df: DataFrame) -> DataFrame:
    """A frame of a few rows as a local table, so that what reads it runs no job of the source."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def moment_counts(names: list[str]) -> list[Column]:
    """Aggregates that ``number_table`` reads."""
    aggs = []
    for i, n in enumerate(names):
        c = value_of(n)
        for name, f in (("n_valid", F.count), ("mean", F.avg), ("sd", F.stddev), ("skewness", F.skewness)):
            aggs.append(f(c).alias(f"{name}_{i}"))
    return aggs


def number_table(df: DataFrame, names: list[str], row: DataFrame) -> DataFrame:
    """Per column quartiles, fences, outliers, moments and distance from the normal.

    One table of ranked values serves them all; ``row`` holds ``moment_counts``.
    """
    # Bounded: one row per named column, here and below.
    stats = melted(row, names, {"n_valid": "n_valid", "mean": "mean", "sd": "sd", "skewness": "skewness"})
    ranked = settle(cumulative_counts(value_counts_long(df, names)))

    def quantile(p: float) -> Column:
        k = F.lit(p) * (F.col("total") - 1)
        at = lambda r: F.max(F.when((F.col("before") <= r) & (r < F.col("before") + F.col("n")), F.col("value")))
        return at(F.floor(k)) + (at(F.ceil(k)) - at(F.floor(k))) * F.max(k - F.floor(k))

    far = F.abs(F.col("value") - F.col("mean")) > 3.0 * F.col("sd")
    first = ranked.join(F.broadcast(stats), "column").groupBy("column").agg(
        quantile(0.25).alias("q1"), quantile(0.5).alias("median"), quantile(0.75).alias("q3"),
        F.sum(F.when(far, F.col("n")).otherwise(0)).alias("n_far"), F.max(F.when(F.col("sd") > 0, normal_gap())).alias("d"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    first = here(first).withColumns({"lo": F.col("q1") - reach, "hi": F.col("q3") + reach})
    outside = (F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))
    beyond = ranked.join(F.broadcast(first), "column").groupBy("column").agg(F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("n_outliers"))
    return here(stats.join(F.broadcast(first), "column", "left").join(F.broadcast(beyond), "column", "left"))


def outlier_findings(numbers: DataFrame, table: str, names: list[str]) -> DataFrame:
    """IQR and z-score outliers, for information; removing them is up to cleaning."""
    rows = numbers.filter(F.col("column").isin(*names) & (F.col("n_valid") > 0))
    span = F.format_string("[%.2f, %.2f]", F.round("lo", 2), F.round("hi", 2))
    return as_findings(rows, "outliers", "iqr", table, F.col("column"), F.col("n_outliers"), status=F.lit(INFO), detail=span).unionByName(
        as_findings(rows, "outliers", "z_score", table, F.col("column"), F.col("n_far"), F.col("n_valid"), status=F.lit(INFO))
    )


def forest_findings(df: DataFrame, table: str, names: list[str], p: Profile = ROAD) -> DataFrame:
    apart = isolation_summary(df, names, p.key, table)
    shown = F.when(F.col("status") == SKIPPED, SKIPPED).otherwise(INFO)
    return as_findings(apart, "outliers", "isolation_forest", table, F.col("features"), F.col("n_anomalies"), F.col("sample_size"), status=shown)


def distribution_findings(numbers: DataFrame, table: str, names: list[str]) -> DataFrame:
    """Moments of the described columns and whether a normal fits them, for information."""
    rows = numbers.filter(F.col("column").isin(*names))
    few = F.col("n_valid") < FEWEST_DESCRIBED
    rounded = [F.round(c, 3) for c in ("mean", "median", "sd", "skewness")]
    text = F.when(~few, F.format_string("mean=%.3f median=%.3f std=%.3f skewness=%.3f", *rounded)).otherwise("fewer than ten values")
    shown = F.when(few, SKIPPED).otherwise(INFO)
    moments = as_findings(rows, "distribution", "describe", table, F.col("column"), F.lit(0), F.col("n_valid"), status=shown, detail=text)
    tests = ks_table(rows)
    shown = F.when(F.col("status") == SKIPPED, SKIPPED).otherwise(INFO)
    text = F.format_string("D=%.4f p=%.6f", "ks_statistic", "p_value")
    bad = F.coalesce(F.col("not_normal").cast("int"), F.lit(0))
    fits = as_findings(tests, "distribution", "not_normal", table, F.col("column"), bad, F.col("n_valid"), status=shown, detail=F.when(F.col("status") != SKIPPED, text), pct=F.lit(None).cast("double"))
    return moments.unionByName(fits)


def share_findings(df: DataFrame, table: str, names: list[str]) -> DataFrame:
    """Values and the share of the most frequent one of each category column, for information."""
    counts = value_counts(df, names)
    top = F.max(F.struct("n", "value")).alias("top")
    rows = counts.groupBy("column").agg(F.count("*").alias("values"), F.sum("n").alias("total"), top)
    text = F.format_string("%d values, most often %s (%.2f%%)", F.col("values"), F.col("top.value"), F.round(F.col("top.n") / F.col("total") * 100, 2))
    return as_findings(rows, "distribution", "category_shares", table, F.col("column"), F.lit(0), F.col("total"), status=F.lit(INFO), detail=text)


def check_coverage(events: DataFrame, p: Profile = ROAD) -> DataFrame:
    """Years with far fewer rows than the year before, for information."""
    if p.date not in events.columns:
        return skipped(events, "timeliness", "yearly_dip", "events", p.date)
    years = yearly_coverage(events.select(parsed_date(col(p.date)).alias("day")), "day")
    told = F.array_join(F.array_sort(F.collect_list(F.when(F.col("is_dip"), F.col("year")).cast("string"))), ", ")
    # One row per year goes in, one comes out.
    dips = years.agg(F.count_if("is_dip").alias("n"), F.count("*").alias("years"), told.alias("told"))
    return as_findings(dips, "timeliness", "yearly_dip", "events", p.date, F.col("n"), F.col("years"), status=F.lit(INFO), detail=F.nullif("told", F.lit("")))


def date_range(events: DataFrame, p: Profile = ROAD, now: Column | None = None) -> DataFrame:
    """One row: earliest and latest readable date, future dates, dates before the floor."""
    future, early = timeliness_rules(p, now)
    date = parsed_date(col(p.date))
    return events.agg(
        F.min(date).alias("earliest"),
        F.max(date).alias("latest"),
        F.count_if(F.coalesce(future.bad, F.lit(False))).alias("n_future"),
        F.count_if(F.coalesce(early.bad, F.lit(False))).alias("n_before_floor"),
    )


def check_timeliness(events: DataFrame, p: Profile = ROAD, now: Column | None = None) -> DataFrame:
    return run_rules(events, "events", timeliness_rules(p, now))


def relationship_findings(events: DataFrame, pearson: DataFrame, found: list[str]) -> DataFrame:
    pairs = compare_correlations(pearson, spearman_pairs(events, found))
    name = F.concat(F.col("left_column"), F.lit(" x "), F.col("right_column"))
    text = F.format_string("pearson=%.3f spearman=%.3f", F.col("pearson"), F.col("spearman"))
    return as_findings(
        pairs, "relationships", "high_correlation", "events", name,
        F.when(F.col("high"), 1).otherwise(0), issue=F.col("high"), detail=text,
    )


def check_join_integrity(events: DataFrame, details: DataFrame, p: Profile = ROAD) -> DataFrame:
    counts = key_overlap(events, details, p.key)
    sides = F.array(
        F.struct(F.lit("events_without_details").alias("check"), F.lit("events").alias("t"),
                 F.col("only_left").alias("bad"), F.col("left_keys").alias("all")),
        F.struct(F.lit("details_without_event").alias("check"), F.lit("details").alias("t"),
                 F.col("only_right").alias("bad"), F.col("right_keys").alias("all")),
    )
    long = counts.select(F.inline(sides))
    return as_findings(long, "join_integrity", F.col("check"), F.col("t"), p.key, F.col("bad"), F.col("all"))


def file_findings(ledger: DataFrame, table: str = "weather") -> DataFrame:
    """Files read in part or not at all, and lines without a valid date, from a ledger of ``file_ledger``."""
    parts = []
    for reason, check in (("damaged", "damaged_files"), ("no header", "files_without_header")):
        bad = F.col("reason") == reason
        row = ledger.agg(
            F.count_if(bad).alias("bad"),
            F.count("*").alias("total"),
            F.array_join(F.slice(F.array_sort(F.collect_set(F.when(bad, F.regexp_extract("file", "[^/]*$", 0)))), 1, SHOWN_FILES), ", ").alias("names"),
        )
        status = F.when(F.col("bad") > 0, F.lit(ISSUE)).otherwise(F.lit(PASS))
        parts.append(as_findings(row, "completeness", check, table, "file", F.col("bad"), F.col("total"), status=status, detail=F.nullif("names", F.lit(""))))
    row = ledger.agg(F.sum(F.col("lines") - F.col("dated")).alias("bad"), F.sum("lines").alias("total"))
    parts.append(as_findings(row, "completeness", "lines_without_date", table, "file", F.coalesce("bad", F.lit(0)), F.coalesce("total", F.lit(0))))
    return union_findings(parts)


def issue_rollup(findings: DataFrame) -> DataFrame:
    """Issues per dimension, with their overall number on every row."""
    counts = findings.filter(F.col("status") == ISSUE).groupBy("dimension").agg(F.count("*").alias("n_issues"))
    # One row per dimension.
    total = F.sum("n_issues").over(Window.partitionBy(F.lit(1)))
    return counts.select("dimension", "n_issues", total.alias("total_issues"))

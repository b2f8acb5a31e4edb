"""The full data-quality report as one table of findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbline.columns import present
from kerbline.operators import profiling, quality, relationships
from kerbline.profile import ROAD, Profile
from kerbline.sources.sinks import write_json, write_lines


def validate(
    events: DataFrame, details: DataFrame, profile: Profile = ROAD, now: Column | None = None, files: DataFrame | None = None
) -> DataFrame:
    """Findings of all dimensions and of the join between the tables.

    Raw text columns are expected, dates included. Each table gives its rules,
    nulls, moments and correlations in one aggregate, and one table of ranked
    values serves quartiles, outliers, medians and the normality test. ``files``
    is the ledger of the weather files read (``ingest_weather``).
    """
    p = profile
    on_events, on_details = quality.accuracy_rules(p)
    on_events = on_events + quality.consistency_rules(p) + quality.timeliness_rules(p, now)
    related = present(events, p.related)
    sides = (
        ("events", events, on_events, p.required_event, p.outlier_event, p.described_event, p.category_event),
        ("details", details, on_details, p.required_detail, p.outlier_detail, p.described_detail, p.category_detail),
    )
    parts = []
    for table, df, rules, required, outlying, described, categories in sides:
        outlying, described, categories = (present(df, names) for names in (outlying, described, categories))
        numbers = list(dict.fromkeys([*outlying, *described]))
        pairs = relationships.pearson_counts(related) if table == "events" and len(related) > 1 else []
        asked = [*quality.rule_counts(df.columns, rules), *profiling.null_counts(df.columns), *quality.moment_counts(numbers), *pairs]
        row = quality.here(df.agg(*asked))
        parts.append(quality.rules_from(row, table, rules))
        nulls = profiling.nulls_from(row, df.columns)
        parts.append(quality.completeness_findings(profiling.missing_from(nulls, table, list(required))))
        ranked = quality.number_table(df, numbers, row) if numbers else None
        if outlying:
            parts.append(quality.outlier_findings(ranked, table, outlying))
        if outlying and p.key in df.columns:
            parts.append(quality.forest_findings(df, table, outlying, p))
        if described:
            parts.append(quality.distribution_findings(ranked, table, described))
        else:
            parts.append(quality.skipped(df, "distribution", "describe", table, "*"))
        if categories:
            parts.append(quality.share_findings(df, table, categories))
        if pairs:
            parts.append(quality.relationship_findings(df, relationships.pearson_from(row, related), related))
    if len(related) < 2:
        parts.append(quality.skipped(events, "relationships", "high_correlation", "events", "*"))
    return quality.union_findings(
        [
            *parts,
            quality.category_findings(details, p),
            quality.cross_table_findings(events, details, p),
            quality.check_uniqueness(events, details, p),
            quality.check_coverage(events, p),
            quality.check_join_integrity(events, details, p),
            *([quality.file_findings(files)] if files is not None else []),
        ]
    )


def findings_text(findings: DataFrame) -> DataFrame:
    """Rows (line_no, line) listing every finding by dimension."""
    from pyspark.sql import Window

    text = F.format_string(
        "[%s] %s / %s / %s.%s: %s",
        "status",
        "dimension",
        "check",
        "table",
        "column",
        F.coalesce(F.col("n_bad").cast("string"), F.col("detail"), F.lit("-")),
    )
    # A few rows per column of the checked tables.
    order = Window.partitionBy(F.lit(1)).orderBy("dimension", "check", "table", "column")
    return findings.select(F.row_number().over(order).alias("line_no"), text.alias("line"))


def save_report(findings: DataFrame, out_dir: str) -> None:
    """Store the findings as JSON lines and as text."""
    write_json(findings, f"{out_dir}/findings.json")
    write_lines(findings_text(findings), f"{out_dir}/summary.txt")

"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` (optional) a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kerbline.session import build_session  # noqa: E402
from workload import catalogue  # noqa: E402

HEADLINE = (
    "clean_full",
    "median_impute",
    "mode_by_group_impute",
    "nearest_point",
    "side_join_daily",
    "detail_left_join",
    "merge_all",
    "key_overlap",
    "rule_violations",
    "consistency_checks",
    "missing_profile",
    "duplicate_profile",
    "iqr_outliers",
    "describe_numeric",
    "histogram_1d",
    "value_counts",
    "pearson_pairs",
    "spearman_pairs",
    "quality_findings",
    "isolation_forest",
    "summary_by_class",
    "summary_by_condition",
    "kpis",
    "risk_index",
    "vulnerable_flag",
    "density_band",
    "kmeans_hotspots",
    "feature_matrix",
    "undersample",
    "ragged_csv_union",
    "year_partitioned_roundtrip",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 4)
    chosen = os.environ.get("BENCH_QUERIES")
    names = [n for n in chosen.split(",") if n] if chosen else list(HEADLINE)
    spark = build_session(
        "kerbline-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up and code generation are not counted: every query first runs on
    # the smallest tables, if they are there.
    smallest = Path(sf_dir).parent / "sf0.001"
    warm_dir = str(smallest) if smallest.is_dir() else sf_dir
    for name in names:
        catalogue.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()

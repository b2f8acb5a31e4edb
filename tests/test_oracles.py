"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from workload import catalogue

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = [p.stem for p in sorted(SF_DIR.glob("*.parquet"))] if SF_DIR.is_dir() else []
SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not TABLES, reason="test tables not found")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, str(SF_DIR))
    want = duck.execute(catalogue.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    types = {d[0]: str(d[1]) for d in want.description}
    assert {c: SPARK_TYPES[t] for c, t in got.dtypes} == types
    order = sorted(names)
    left = _sorted([tuple(_plain(r[c]) for c in order) for r in got.collect()])
    at = [names.index(c) for c in order]
    right = _sorted([tuple(_plain(r[i]) for i in at) for r in want.fetchall()])
    assert left == right


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert catalogue.QUERIES[name](spark, str(SF_DIR)).count() > 0


def test_every_oracle_has_a_query():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert {r["severity"] for r in rows} == {"Fatal", "Serious", "Slight"}

"""Every query with SQL gives DuckDB's rows."""

import math
from pathlib import Path

import duckdb
import pytest

from repseq.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def norm(x):
    if isinstance(x, float):
        return float(f"{x:.10g}") if math.isfinite(x) else str(x)
    return tuple(map(norm, x)) if isinstance(x, list | tuple) else x


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(([norm(r[k]) for k in order] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, db, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = db.sql(catalogue.ORACLES[name])
    have = ordered(got.columns, [tuple(r) for r in got.collect()])
    assert have == ordered(want.columns, want.fetchall())
    assert have[1]


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0

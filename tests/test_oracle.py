"""Every registered query against its SQL on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from docspark.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()
DUCK_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, small):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = df.collect()
    want = duck.sql(ORACLE[name])
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == types
    assert canonical(df.columns, got) == canonical(want.columns, want.fetchall())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["doc_id", "section", "text", "field_hint", "n_occurrences", "confidence", "candidates"]
    assert df.count() > 0

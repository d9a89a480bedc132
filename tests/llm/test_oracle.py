"""The queries that SQL can express, against their SQL on a whole small table."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from docspark.llm import catalog
from tests.test_oracle import DUCK_TYPES, TABLES, canonical


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(catalog.QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(catalog.ORACLE) <= set(entry_points.oracle_sql()) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query(name, spark, small):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, small)
    want = duck.sql(catalog.ORACLE[name])
    kinds = DUCK_TYPES | {"int": "INTEGER"}
    assert {c: kinds[t] for c, t in df.dtypes} == dict(zip(want.columns, map(str, want.types)))
    assert canonical(df.columns, df.collect()) == canonical(want.columns, want.fetchall())

"""All registered queries and their oracle statements."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.plans import layout, ledger, prose, quality, reports, scoring

MODULES = [prose, layout, reports, quality, ledger, scoring]


def _widen(df: DataFrame) -> DataFrame:
    """Result columns in the types the oracle uses: BIGINT and DOUBLE numbers."""
    wide = {
        T.ByteType(): "bigint",
        T.ShortType(): "bigint",
        T.IntegerType(): "bigint",
        T.FloatType(): "double",
    }
    return df.select(
        *[F.col(f.name).cast(wide[f.dataType]) if f.dataType in wide else F.col(f.name) for f in df.schema]
    )


def _registered(fn: Callable) -> Callable:
    @wraps(fn)
    def run(spark, sf_dir):
        return _widen(fn(spark, sf_dir))

    return run


def queries() -> dict[str, Callable]:
    return {name: _registered(fn) for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for m in MODULES for name, sql in m.ORACLE.items()}

"""Query registration and output tidying shared by all families."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabspark.functions.scalar import ident
from tabspark.sources.fixtures import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, using: tuple[str, ...] = (), extra: str = ""):
    """Register a query; ``using`` names the fixtures its SQL reads."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(using, sql, extra) if using or extra else sql
        return fn
    return add


def tidy(df: DataFrame, digits: int = 6, exact: tuple[str, ...] = (), **per_column: int) -> DataFrame:
    """Integers as BIGINT, other numbers as rounded DOUBLE without a negative zero."""
    out = []
    for f in df.schema:
        c = F.col(ident(f.name))
        if isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.NumericType):
            c = c.cast("double")
            if f.name not in exact:
                c = F.round(c, per_column.get(f.name, digits)) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)

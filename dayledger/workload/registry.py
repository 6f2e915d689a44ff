"""Registry of the queries and of the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .oracle_views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its SQL over the given tables when it has one."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return function

    return add


def rounded_sql(sql: str, columns: list[str]) -> str:
    """The statement with the named doubles rounded like the query's (and without negative zero)."""
    changes = ", ".join(f"round({c} + 1e-9, 6) + 0.0 AS {c}" for c in columns)
    return f"SELECT * REPLACE ({changes}) FROM ({sql.strip()}) rounded_rows"


# Means of six-digit scores often end half-way between two roundings, where the last bit of a sum decides.
# Both sides add this much first, so that such values round up on both.
NUDGE = 1e-9


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits: sums of doubles depend on the order of addition."""
    return df.select(
        *[
            F.round(F.col(f.name) + NUDGE, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )

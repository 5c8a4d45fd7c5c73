"""All registered queries of the spatial and crash-record operators, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numerics import floor_round
from ..shipping import ship

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP = "unit_analyze"
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL if it has any."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r(column: Column | str, places: int = 4) -> Column:
    """A rounded double under the column's own name if it is given by name."""
    c = F.col(column) if isinstance(column, str) else column
    out = floor_round(c, places)
    return out.alias(column) if isinstance(column, str) else out


def sr(expression: str, places: int = 4) -> str:
    """The same rounding in SQL."""
    return f"floor(({expression}) * 1e{places} + 0.5e0) / 1e{places}"


from . import city_queries, crash_queries, governance_queries, lineage_queries, source_queries, sql_queries, stream_queries  # noqa: E402, F401

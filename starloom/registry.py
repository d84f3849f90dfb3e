"""Registration of queries with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as long, floating ones as double rounded to `digits`: what two engines can agree on."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint", "bigint"):
            c = c.cast("long")
        elif kind in ("float", "double") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


def rounded(*names: str, digits: int = 6) -> str:
    """SQL select list of names rounded alike (a name may be 'expression AS name')."""
    parts = []
    for n in names:
        expr, _, alias = n.rpartition(" AS ")
        parts.append(f"round(CAST({expr or alias} AS DOUBLE), {digits}) + 0.0::DOUBLE AS {alias}")
    return ", ".join(parts)

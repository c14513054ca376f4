"""Registered queries: ``name -> (spark callable, oracle SQL or None)``.

Every callable reads the driver tables at ``sf_dir`` (through the adapter
views) so its work grows with them.  Doubles that come out of transcendental
functions or order-dependent sums are rounded to ``DIGITS`` decimals in both
engines' final projection, nowhere earlier.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 9

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, cols, digits: int = DIGITS) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


def rounded_sql(body: str, all_cols, cols, digits: int = DIGITS) -> str:
    cols = set(cols)
    sel = ", ".join(f'round("{c}", {digits}) AS "{c}"' if c in cols else f'"{c}"' for c in all_cols)
    return f"SELECT {sel} FROM ({body}) q"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalog, catalog_anchor, catalog_io, catalog_more, catalog_store  # noqa: F401  (registers everything)
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalog, catalog_anchor, catalog_io, catalog_more, catalog_store  # noqa: F401
    return dict(_SQL)

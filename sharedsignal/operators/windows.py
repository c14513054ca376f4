"""Window-function operators: keep-first de-duplication and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_order(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """Rows ranked 1..k per group under a total order.

    ``row_number() <= k`` lets Catalyst insert a WindowGroupLimit below the
    shuffle, so each map task forwards at most k rows per group: a group holding
    a third of the data does not land whole in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*[_as_order(c) for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def keep_first(df: DataFrame, subset: Sequence[str], order_col: str, ascending: bool = True,
               tiebreak: Sequence[str] = (), order_digits: int | None = None) -> DataFrame:
    """drop_duplicates(keep='first') by ``order_col`` within ``subset``.

    NULLs of the order column sort last in both directions.  ``tiebreak``
    columns make the order total (the legacy code used a non-deterministic row id).
    ``order_digits`` compares the order column rounded to that many decimals,
    so values equal up to floating-point summation noise count as ties.
    """
    if not isinstance(subset, (list, tuple)):
        raise TypeError("subset must be a list of column names")
    o = F.col(order_col) if order_digits is None else F.round(F.col(order_col), order_digits)
    oc = o.asc_nulls_last() if ascending else o.desc_nulls_last()
    order = [oc] + [F.col(c).asc_nulls_last() for c in tiebreak]
    return top_k_per_group(df, subset, order, 1)

"""Dense ids of distinct keys: a written dictionary instead of hashes (no two keys can share an id)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import materialize

#: ``monotonically_increasing_id`` holds the partition above this bit and the row's number below.
_ROW_BITS = 33


def dictionary(rows: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """One row per distinct value of ``cols`` (NULL = NULL), numbered 0, 1, 2 ... in ``id_col``.

    Rows are numbered within their partition and written; a prefix sum over the
    partitions' sizes (one row per partition) makes the numbers dense.  What is read back
    is the written table, so a repeated task cannot number rows differently.
    """
    found = rows.select(*cols).distinct().withColumn("__at", F.monotonically_increasing_id())
    found = materialize(found, f"dictionary-{id_col.strip('_')}")
    found = found.withColumns({"__part": F.shiftright("__at", _ROW_BITS), "__row": F.col("__at").bitwiseAND((1 << _ROW_BITS) - 1)})
    sizes = found.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    return found.join(start, "__part").select(*cols, (F.col("__start") + F.col("__row")).alias(id_col))


def encode(df: DataFrame, ids: DataFrame, cols: Mapping[str, str], id_col: str, as_col: str | None = None, how: str = "inner") -> DataFrame:
    """``df`` with the id of the dictionary key in ``cols`` ({column of df: column of ids}), matched null-safe."""
    o = ids.select(*[F.col(k).alias(f"__k_{k}") for k in cols.values()], F.col(id_col).alias("__id"))
    cond = None
    for a, k in cols.items():
        e = F.col(a).eqNullSafe(F.col(f"__k_{k}"))
        cond = e if cond is None else cond & e
    return df.join(o, cond, how).withColumnRenamed("__id", as_col or id_col).drop(*[f"__k_{k}" for k in cols.values()])

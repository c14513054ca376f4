"""Merging result releases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windows import keep_first


def merge_raw(prev: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side become NULL."""
    return prev.unionByName(new, allowMissingColumns=True)


def merge_processed(prev: DataFrame, new: DataFrame) -> DataFrame:
    """Strict union by name (fails on column drift); no de-duplication."""
    return prev.unionByName(new)


def schema_drift(prev: DataFrame, new: DataFrame) -> DataFrame:
    """U4: (column, only_in) for columns present in just one release.

    Built from the two schemas (metadata, a handful of rows), not from data.
    """
    p, n = prev.columns, new.columns
    rows = [(c, "previous") for c in p if c not in n] + [(c, "new") for c in n if c not in p]
    schema = T.StructType([T.StructField("column", T.StringType()), T.StructField("only_in", T.StringType())])
    return prev.sparkSession.createDataFrame(rows, schema)


def merge_audit(prev: DataFrame, new: DataFrame) -> DataFrame:
    """Rows loaded from each release and in total (rollup over the source tag)."""
    p = prev.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("previous").alias("source"), "n_rows")
    n = new.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("new").alias("source"), "n_rows")
    both = p.unionByName(n)
    total = both.agg(F.sum("n_rows").alias("n_rows")).select(F.lit("total").alias("source"), "n_rows")
    return both.unionByName(total)


def merge_releases(prev: DataFrame, new: DataFrame, strict: bool = False,
                   prefer: str | None = None, id_cols=None) -> DataFrame:
    """M7: merged release.  ``prefer='new'`` keeps one row per test, the new one
    (W1 keyed by the 16 ids); the legacy default keeps both."""
    merged = merge_processed(prev, new) if strict else merge_raw(prev, new)
    if prefer is None:
        return merged
    tagged = (prev.withColumn("__rank", F.lit(1 if prefer == "previous" else 2))
                  .unionByName(new.withColumn("__rank", F.lit(1 if prefer == "new" else 2)),
                               allowMissingColumns=not strict))
    return keep_first(tagged, list(id_cols), "__rank").drop("__rank")

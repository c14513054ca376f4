"""Query catalogue, part 3: the CSV feature sink and reader, files of results (S3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as ft
from ..sources import io
from . import jobs
from .adapters_sql import with_adapters
from .registry import query


@query("features_csv")
def q_features_csv(spark, d):
    """S17 + S9: complete feature rows written as one CSV with header, read back
    with a declared schema (dotted feature names are kept as CSV headers)."""
    f = jobs.coloc_features(spark, d)
    complete = f.filter(F.col("total_overlap").isNotNull() & F.col("coloc_log2_h4_h3").isNotNull())
    path = io.scratch_path(spark, "features_csv")
    io.write_csv(complete, path)
    return io.read_csv_table(spark, path, complete.schema)


_FILES_SQL = """SELECT right_type AS folder, 'written' AS kind, count(*) AS rows_read, count(*) FILTER (nsnps % 7 = 0) AS rows_bad
FROM coloc_raw_v GROUP BY right_type
UNION ALL SELECT 'none', 'empty', 0, 0"""


@query("results_files", with_adapters(_FILES_SQL, "coloc_raw_v"))
def q_results_files(spark, d):
    """S3: rows read and rows bad per folder of result files; lines of tests with 7k variants are cut in half, one file is empty."""
    raw = jobs.coloc_raw(spark, d)
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]))
    cut = F.when(F.col("nsnps") % 7 == 0, line.substr(F.lit(1), F.floor(F.length(line) / 2).cast("int"))).otherwise(line)
    path = io.scratch_path(spark, "results_files")
    raw.select(F.col("right_type").alias("folder"), cut.alias("value")).write.partitionBy("folder").text(path, compression="gzip")
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/folder=none")
    report = io.results_file_report(spark, path, raw.schema)
    empty = F.when(F.col("status") == "empty", "empty").otherwise("written")
    return (report.groupBy(F.regexp_extract("file", "folder=([^/]*)", 1).alias("folder"), empty.alias("kind"))
            .agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_bad").alias("rows_bad")))

"""Scans and sinks.

Readers declare the schema where the legacy job inferred it, so absent
optional columns come back as NULL and Parquet/JSON scans get column pruning
and predicate pushdown.  Writers never ``coalesce(1)`` unless asked.
Scratch output goes below the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


_TABLES: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``{sf_dir}/{name}.parquet``.

    The DataFrame is reused per session and path, so the file listing and
    footer reads happen once per job instead of once per reference.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    k = (spark.sparkContext.applicationId, path)
    if k not in _TABLES:
        _TABLES[k] = spark.read.parquet(path)
    return _TABLES[k]


# --- scratch space -----------------------------------------------------------

def scratch_root(spark: SparkSession) -> str:
    """Shared scratch folder: ``spark.checkpoint.dir`` if the cluster names one.

    A local session without one gets a temporary folder; a cluster must name its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="sharedsignal-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing Parquet to the shared scratch folder and reading it back.

    Survives executor loss (unlike ``localCheckpoint``) and gives the optimizer
    exact statistics for the next stage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# --- boundary normalisation ---------------------------------------------------

def none_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Map the literal text ``"None"`` (legacy partition paths) to NULL."""
    out = df
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    for c in cols:
        if c in strings:
            out = out.withColumn(c, F.when(F.col(c) == "None", F.lit(None).cast("string"))
                                 .otherwise(F.col(c)))
    return out


def fill_none(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fill string NULLs with ``"None"`` (legacy text convention, boundary only)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna("None", subset=list(cols))


# --- S1: credible sets -------------------------------------------------------

def read_credset(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines with a declared schema: missing phenotype_id / bio_feature read as NULL."""
    df = spark.read.schema(schemas.CREDSET).json(path)
    return df.select(*schemas.CREDSET.fieldNames())


# --- S2: summary statistics --------------------------------------------------

def sumstats_region(df: DataFrame, min_maf: float | None = None, **region) -> DataFrame:
    """Sumstats columns of one region with ``variant_id``; ``region`` as in ``region_filter``.

    The predicates are plain comparisons on scan columns, so row groups and partitions are pruned.
    """
    from ..functions.variants import variant_id
    from ..operators.sumstats import maf_filter, region_filter

    out = region_filter(df.select(*schemas.SUMSTATS_COLS).withColumn("chrom", F.col("chrom").cast("string")), **region)
    out = out if min_maf is None else maf_filter(out, min_maf)
    return out.withColumn("variant_id", variant_id("chrom", "pos", "ref", "alt"))


# --- S3 / S4: results ---------------------------------------------------------

def read_results_dir(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Many small JSON results; ids come from hive directories (``basePath``).

    Corrupt or empty files are skipped (``ignoreCorruptFiles`` as a read option);
    the text ``"None"`` in partition values becomes NULL.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)  # without one, Spark reads all files to infer it
    df = (reader.option("basePath", path)
          .option("ignoreCorruptFiles", "true")
          .option("recursiveFileLookup", "false")
          .json(path))
    id_cols = [c for c in df.columns if c.startswith(("left_", "right_"))]
    return none_to_null(df, id_cols)


_LINE = "_line"


def _gzip_ends():
    """Column function: whether every gzip member of a file's bytes reaches its checked end."""
    def ends(data: bytes) -> bool:
        while data:
            part = zlib.decompressobj(wbits=31)
            try:
                part.decompress(data, 1 << 20)  # what comes out is dropped, 1 MB at a time
                while part.unconsumed_tail:
                    part.decompress(part.unconsumed_tail, 1 << 20)
            except zlib.error:
                return False
            if not part.eof:
                return False
            data = part.unused_data
        return True

    @F.pandas_udf(T.BooleanType())
    def whole(content: pd.Series) -> pd.Series:
        return content.map(ends)
    return whole


def results_file_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: one row per file below ``path``: file, n_bytes, rows_read, rows_bad, status.

    ``read_results_dir`` skips what it cannot read; here it stays visible.  ``rows_read`` are
    the lines that hold something, ``rows_bad`` those of them that are no JSON object of
    ``schema``.  Status, the first that applies: ``empty`` (no bytes), ``broken`` (a gzip file
    that does not reach its end: its later rows are lost), ``no rows``, ``bad rows``, ``read``.
    Result files hold one test or one task's rows; a gzip file of 2 GB or more is an error.
    Spark's scans leave empty files out, so the names come from the listing that any read
    of the folder holds on the driver.
    """
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = (spark.createDataFrame([(n,) for n in read.inputFiles()], "file string")
             .withColumn("file", F.regexp_replace("file", "^file:/+", "file:/")))  # as _metadata writes local names
    files = read.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("n_bytes"), "content")
    zipped = files.filter("file LIKE '%.gz' AND n_bytes > 0").select("file", _gzip_ends()("content").alias("__ends"))
    lines = (spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias(_LINE)).filter(F.trim(_LINE) != ""))
    marked = T.StructType(schema.fields + [T.StructField("__bad", T.StringType())])
    parsed = F.from_json(_LINE, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    counts = (lines.select("file", parsed["__bad"].isNotNull().alias("__bad")).groupBy("file")
              .agg(F.count(F.lit(1)).alias("rows_read"), F.count_if("__bad").alias("rows_bad")))
    out = (names.join(files.select("file", "n_bytes"), "file", "left").join(zipped, "file", "left").join(counts, "file", "left")
           .fillna(0, ["n_bytes", "rows_read", "rows_bad"]))
    status = (F.when(F.col("n_bytes") == 0, "empty").when(~F.col("__ends"), "broken").when(F.col("rows_read") == 0, "no rows")
              .when(F.col("rows_bad") > 0, "bad rows").otherwise("read"))
    return out.select("file", "n_bytes", "rows_read", "rows_bad", status.alias("status"))


# --- S5 / S6 / S7 / S9: delimited text and top loci ---------------------------

def read_ld_tsv(spark: SparkSession, pattern: str) -> DataFrame:
    return spark.read.csv(pattern, sep="\t", header=True, schema=schemas.LD_TEXT)


def read_pheno_gene(spark: SparkSession, pattern: str) -> DataFrame:
    """phenotype -> gene look-up TSV(s), any column order, keeps ENSG genes only."""
    df = spark.read.csv(pattern, sep="\t", header=True).select("phenotype_id", "gene_id")
    from ..operators.results import clean_pheno_gene
    return clean_pheno_gene(df)


def read_toploci(spark: SparkSession, path: str, chrom: str | None = None) -> DataFrame:
    """Top loci JSON lines, optionally one chromosome (partition pruning when laid
    out by ``partition_toploci``)."""
    df = spark.read.schema(schemas.TOPLOCI).json(path)
    if chrom is not None:
        df = df.filter(F.col("chrom") == str(chrom))
    return df


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.option("header", True)
    return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)


# --- S10-S17: sinks -----------------------------------------------------------

def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Gzip JSON lines.  ``single_file`` funnels through one task: only for small tables."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").json(path, compression="gzip")


def write_compacted(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Few larger Parquet files.  Spark rebalances the rows to partitions of the advisory
    size (hot ones split, small ones merged); the upstream work keeps its own parallelism."""
    (df.hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
       .parquet(path, compression="snappy"))


def range_sorted(df: DataFrame, chrom_col: str, pos_col: str, n_parts: int | None = None) -> DataFrame:
    """S12 layout: range-partition by (chrom, pos) and sort within partitions.

    Gives min/max statistics per file for later position predicates.  The range
    boundaries come from sampling, so a hot chromosome is split by position.
    """
    parts = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(parts, chrom_col, pos_col)
              .sortWithinPartitions(chrom_col, pos_col))


def write_range_sorted(df: DataFrame, path: str, chrom_col: str = "left_chrom",
                       pos_col: str = "left_pos") -> None:
    range_sorted(df, chrom_col, pos_col).write.mode("overwrite").parquet(path)


def partition_sumstats(df: DataFrame, path: str, mode: str = "append") -> None:
    """Hive layout study_id / bio_feature / chrom / phenotype_id."""
    # range partitions over the hive keys *and* position: boundaries come from a sample,
    # so a study/chromosome holding a large share of rows is split across tasks
    _parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(_parts, "study_id", "bio_feature", "chrom", "phenotype_id", "pos")
       .sortWithinPartitions("study_id", "bio_feature", "chrom", "phenotype_id", "pos")
       .write.mode(mode).partitionBy("study_id", "bio_feature", "chrom", "phenotype_id")
       .parquet(path, compression="snappy"))


def partition_credset(df: DataFrame, path: str) -> None:
    """Gzip JSON partitioned by study_id / bio_feature / lead_chrom."""
    _parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(_parts, "study_id", "bio_feature", "lead_chrom", "lead_pos", "tag_pos")
       .write.mode("overwrite").partitionBy("study_id", "bio_feature", "lead_chrom")
       .json(path, compression="gzip"))


def partition_toploci(df: DataFrame, path: str) -> None:
    """Top loci partitioned by chromosome."""
    _parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(_parts, "chrom", "pos").write.mode("overwrite").partitionBy("chrom").json(path)


def concat_json(spark: SparkSession, paths: Sequence[str], out: str | None = None) -> DataFrame:
    """Union of JSON-lines inputs by column name (missing columns -> NULL)."""
    dfs = [spark.read.json(p) for p in paths]
    res = dfs[0]
    for d in dfs[1:]:
        res = res.unionByName(d, allowMissingColumns=True)
    if out:
        res.write.mode("overwrite").json(out)
    return res


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header; ``single_file`` funnels through one task (small outputs only)."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").csv(path, header=True)


def write_signal_stats(df: DataFrame, path: str) -> None:
    """Prepared per-signal statistics, partitioned by chromosome, sorted by
    (signal_id, pos) inside files so a test reads contiguous row groups."""
    _parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(_parts, "chrom", "signal_id", "pos").sortWithinPartitions("signal_id", "pos")
       .write.mode("overwrite").partitionBy("chrom").parquet(path))

"""Prepared signal statistics kept between runs.

A store is a folder with two tables:

* ``stats``: the statistics of every prepared signal, partitioned by run, bucketed by
  ``signal_id`` and sorted by (signal_id, pos), so that a join by signal moves only the tests;
* ``signals``: one row per prepared signal with its number of statistics, partitioned by
  run.  A signal without any statistics has a row too and is not prepared again.

A run prepares what is not in the store yet: requested signals are matched with the stored
ones on all their columns (NULL = NULL), never on the hash alone.  The statistics are
written first and the signals last, so a run that dies in between leaves a run folder that no
reader takes up.  One writer at a time; window and MAF filter belong to the store's identity
and a run with others is refused.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import materialize
from .manifest import anti_join_null_safe, semi_join_null_safe
from .sumstats import COLOC_WINDOW_KB, MIN_MAF, SIGNAL_COLS, signal_stats

#: Buckets of the statistics; a power of two, fixed when the store is made.
BUCKETS = 64


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass(frozen=True)
class SignalStore:
    """A folder of prepared statistics; ``table`` is its name in this session's catalog."""

    path: str
    table: str
    window_kb: int = COLOC_WINDOW_KB
    min_maf: float = MIN_MAF
    buckets: int = BUCKETS

    def signals(self, spark: SparkSession) -> DataFrame | None:
        """Stored signals (run, signal_id, the signal columns, n_stats, window_kb, min_maf); None for a new store."""
        return _read(spark, f"{self.path}/signals")

    def missing(self, signals: DataFrame) -> DataFrame:
        """The requested signals that no run has prepared."""
        held = self.signals(signals.sparkSession)
        if held is None:
            return signals
        other = held.filter((F.col("window_kb") != self.window_kb) | (F.col("min_maf") != self.min_maf))
        if not other.isEmpty():
            raise ValueError("the store holds statistics of another window or MAF filter")
        return anti_join_null_safe(signals, held, SIGNAL_COLS)

    def prepared(self, new: DataFrame, sumstats: DataFrame, part: str) -> DataFrame:
        """The rows that a run writes.  Every task of the range join writes its share of the buckets itself, so rows, of which
        there is one per signal and statistic, are not shuffled once more; a bucket may have several files."""
        return signal_stats(new, sumstats, self.window_kb, self.min_maf).withColumn("run", F.lit(part))

    def prepare(self, signals: DataFrame, sumstats: DataFrame, run: str) -> DataFrame:
        """Prepare the missing ones of ``signals`` (signal_id and the signal columns) as ``run``.

        Returns one row (run, n_requested, n_reused, n_prepared, n_stats).  Its folder is
        named by the run and a random suffix, so a run that died may be repeated by its name.
        """
        spark = signals.sparkSession
        self.attach(spark)
        part = f"{run}-{uuid.uuid4().hex[:8]}"
        wanted = materialize(signals.select("signal_id", *SIGNAL_COLS).distinct(), "requested-signals")
        new = materialize(self.missing(wanted), "new-signals")
        if not new.isEmpty():
            (self.prepared(new, sumstats, part).write.format("parquet").mode("append").option("path", f"{self.path}/stats")
             .partitionBy("run").bucketBy(self.buckets, "signal_id").sortBy("signal_id", "pos").saveAsTable(self.table))
            counts = spark.table(self.table).filter(F.col("run") == part).groupBy("signal_id").agg(F.count(F.lit(1)).alias("n_stats"))
            index = new.join(counts, "signal_id", "left").select(
                F.lit(part).alias("run"), "signal_id", *SIGNAL_COLS, F.coalesce("n_stats", F.lit(0)).cast("bigint").alias("n_stats"),
                F.lit(self.window_kb).alias("window_kb"), F.lit(self.min_maf).cast("double").alias("min_maf"))
            index.write.mode("append").partitionBy("run").parquet(f"{self.path}/signals")  # the commit of the run
        held = self.signals(spark)
        if held is None:  # nothing was ever requested
            held = spark.createDataFrame([], T.StructType([*wanted.schema.fields, T.StructField("run", T.StringType()),
                                                           T.StructField("n_stats", T.LongType())]))
        own = semi_join_null_safe(held, wanted, SIGNAL_COLS)
        return own.agg(F.lit(run).alias("run"), F.count(F.lit(1)).alias("n_requested"),
                       F.count(F.when(F.col("run") != part, 1)).alias("n_reused"),
                       F.count(F.when(F.col("run") == part, 1)).alias("n_prepared"),
                       F.coalesce(F.sum("n_stats"), F.lit(0)).alias("n_stats"))

    def attach(self, spark: SparkSession) -> None:
        """Name the folder of an earlier session in this one's catalog; bucketing and runs are kept."""
        if spark.catalog.tableExists(self.table):
            return
        held = _read(spark, f"{self.path}/stats")
        if held is None:
            return
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields)
        spark.sql(f"CREATE TABLE {self.table} ({fields}) USING parquet PARTITIONED BY (run) "
                  f"CLUSTERED BY (signal_id) SORTED BY (signal_id, pos) INTO {self.buckets} BUCKETS LOCATION '{self.path}/stats'")
        spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")

    def stats(self, spark: SparkSession) -> DataFrame:
        """Statistics of all finished runs; run names are partition values, so unfinished ones are not read."""
        self.attach(spark)
        runs = [r.run for r in self.signals(spark).select("run").distinct().collect()]  # one short name per run
        return spark.table(self.table).filter(F.col("run").isin(runs)).drop("run")


def new_store(root: str, **options) -> SignalStore:
    """A store in a fresh folder below ``root``."""
    name = f"signal_store_{uuid.uuid4().hex[:12]}"
    return SignalStore(f"{root.rstrip('/')}/{name}", name, **options)

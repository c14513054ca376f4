"""Statistics of signals kept between runs."""

import pytest
from pyspark.sql import functions as F

from sharedsignal.operators.overlap import locus_id
from sharedsignal.operators.store import SignalStore, new_store
from sharedsignal.operators.sumstats import signal_stats
from sharedsignal.sources.io import scratch_root

SIGNALS = ("type string, study_id string, phenotype_id string, bio_feature string, lead_chrom string, lead_pos int, "
           "lead_ref string, lead_alt string")
SUMSTATS = ("study_id string, phenotype_id string, bio_feature string, chrom string, pos int, ref string, alt string, beta double, "
            "se double, pval double, n_total int, n_cases int, eaf double, is_cc boolean")
A = ("gwas", "S1", None, None, "1", 1_000, "A", "C")
B = ("eqtl", "S2", "P", "T", "1", 2_000, "A", "C")
EMPTY = ("eqtl", "S2", "P", "T", "9", 2_000, "A", "C")


def _signals(spark, *rows):
    return spark.createDataFrame(list(rows), SIGNALS).withColumn("signal_id", locus_id())


def _sumstats(spark):
    rows = [(s, p, f, "1", pos, "A", "C", 0.1, 0.01, 0.5, 100, None, 0.3, False)
            for s, p, f in (("S1", None, None), ("S2", "P", "T")) for pos in range(500, 600_000, 100_000)]
    return spark.createDataFrame(rows, SUMSTATS)


def _sorted(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_only_new_signals_are_prepared(spark):
    store, ss = new_store(scratch_root(spark)), _sumstats(spark)
    report = lambda run, *rows: tuple(store.prepare(_signals(spark, *rows), ss, run).first())
    assert report("none") == ("none", 0, 0, 0, 0)
    one = report("one", A, EMPTY)
    assert one[1:4] == (2, 0, 2)
    assert report("two", A, B, EMPTY, B)[1:4] == (3, 2, 1)
    assert report("three", A, B, EMPTY)[1:4] == (3, 3, 0)  # a signal without statistics is not asked for again
    assert report("four", B)[1:4] == (1, 1, 0)
    assert _sorted(store.stats(spark)) == _sorted(signal_stats(_signals(spark, A, B, EMPTY), ss))


def test_equal_hashes_are_not_one_signal(spark):
    store, ss = new_store(scratch_root(spark)), _sumstats(spark)
    store.prepare(_signals(spark, A).withColumn("signal_id", F.lit(7).cast("bigint")), ss, "one")
    missing = store.missing(_signals(spark, B).withColumn("signal_id", F.lit(7).cast("bigint")))
    assert missing.count() == 1


def test_a_dead_run_is_not_read_and_may_be_repeated(spark):
    store, ss = new_store(scratch_root(spark)), _sumstats(spark)
    store.prepare(_signals(spark, A), ss, "one")
    # statistics without their signals: the run ended in between
    (signal_stats(_signals(spark, B), ss).withColumn("run", F.lit("two-dead")).write.format("parquet").mode("append")
     .option("path", f"{store.path}/stats").partitionBy("run").bucketBy(store.buckets, "signal_id").sortBy("signal_id", "pos").saveAsTable(store.table))
    assert _sorted(store.stats(spark)) == _sorted(signal_stats(_signals(spark, A), ss))
    assert store.prepare(_signals(spark, A, B), ss, "two").first().n_prepared == 1
    assert _sorted(store.stats(spark)) == _sorted(signal_stats(_signals(spark, A, B), ss))


def test_another_session_reads_buckets_without_a_shuffle(spark):
    store, ss = new_store(scratch_root(spark)), _sumstats(spark)
    store.prepare(_signals(spark, A), ss, "one")
    store.prepare(_signals(spark, A, B), ss, "two")
    again = SignalStore(store.path, store.table + "_again")
    assert _sorted(again.stats(spark)) == _sorted(store.stats(spark))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = _signals(spark, A, B).select("signal_id").repartition(3).join(again.stats(spark), "signal_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning(signal_id") == 1


def test_other_parameters_are_refused(spark):
    store, ss = new_store(scratch_root(spark)), _sumstats(spark)
    store.prepare(_signals(spark, A), ss, "one")
    with pytest.raises(ValueError):
        SignalStore(store.path, store.table, window_kb=100).missing(_signals(spark, B))

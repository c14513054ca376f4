"""Composite jobs on the driver tables (the user-level API applied to the adapters).

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame; nothing is
collected.  Parameters are fixed per job (FIXTURES.md): credible set 95,
all methods, 500 kb lead distance, overlap proportion 0.01, MAF 0.01.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import abf, manifest as mf, overlap as ov, results as rs
from ..sources import adapters as A
from ..sources.io import materialize

WHICH_SET = "95"
WHICH_METHOD = "all"
MAX_DIST = 500_000
MIN_PROP = 0.01
QUERY_MIN_VARS = 70
ENTRY_MIN_VARS = 5
ORDER_DIGITS = 9  # the queries are compared with another engine


def overlap_table(spark: SparkSession, d: str) -> DataFrame:
    return ov.find_overlaps(A.credset(spark, d), WHICH_SET, WHICH_METHOD, MAX_DIST)


def manifest(spark: SparkSession, d: str) -> DataFrame:
    return mf.make_manifest(overlap_table(spark, d), MIN_PROP)


def tests(spark: SparkSession, d: str) -> DataFrame:
    """The tests of the manifest, written once to the shared scratch folder (stage boundary
    before the heavy step: lineage cut, exact sizes for the next plan): the loci of both sides
    and their LD references; the paths of logs and outputs are not read again."""
    cols = [f"{s}_{c}" for s in abf.SIDES for c in (*abf.LOCUS_COLS, "ld")]
    return materialize(manifest(spark, d).select(*cols), "tests")


def signal_stats(spark: SparkSession, d: str, t: DataFrame | None = None) -> DataFrame:
    t = tests(spark, d) if t is None else t
    return abf.prepare_signals(t, A.sumstats(spark, d))


_RAW_CACHE: dict[tuple[str, str], DataFrame] = {}


def clear_cache() -> None:
    _RAW_CACHE.clear()


def coloc_raw(spark: SparkSession, d: str, reuse: bool = True) -> DataFrame:
    """Raw coloc results, written to the scratch folder.  Within one session the
    written table is reused by later queries on the same inputs (``reuse``)."""
    k = (spark.sparkContext.applicationId, d)
    if reuse and k in _RAW_CACHE:
        return _RAW_CACHE[k]
    t = tests(spark, d)
    out = materialize(abf.run_coloc_windows(t, A.sumstats(spark, d)), "coloc_raw")
    _RAW_CACHE[k] = out
    return out


def routed_signals(spark: SparkSession, d: str, t: DataFrame) -> DataFrame:
    """Signals of the tests with their LD reference and multi-signal method."""
    keys = abf.LOCUS_COLS
    method = A.credset(spark, d).select(*keys, F.col("multisignal_method").alias("method")).distinct()
    signals = mf.signals_to_prepare(t).withColumn("signal_id", ov.locus_id())
    m = method.withColumn("signal_id", ov.locus_id()).select("signal_id", "method")
    return signals.join(m, "signal_id", "left")


def conditional_stats(spark: SparkSession, d: str, t: DataFrame) -> DataFrame:
    from ..operators.conditional import prepare_signals_conditional
    return prepare_signals_conditional(routed_signals(spark, d, t), A.sumstats(spark, d), A.toploci(spark, d),
                                       A.genotypes(spark, d), A.genotype_samples(spark, d))


def coloc_raw_conditional(spark: SparkSession, d: str) -> DataFrame:
    """Raw results with every signal that has an LD reference conditioned on its neighbours."""
    t = tests(spark, d)
    stats = materialize(conditional_stats(spark, d, t), "signal_stats_conditional")
    return materialize(abf.run_coloc(t, stats, window_kb=abf.COLOC_WINDOW_KB), "coloc_raw_conditional")


def coloc_processed_conditional(spark: SparkSession, d: str, min_vars: int = QUERY_MIN_VARS) -> DataFrame:
    return rs.process_results(coloc_raw_conditional(spark, d), A.pheno_gene(spark, d),
                              min_overlapping_vars=min_vars, order_digits=ORDER_DIGITS)


def coloc_processed(spark: SparkSession, d: str, min_vars: int = QUERY_MIN_VARS) -> DataFrame:
    return rs.process_results(coloc_raw(spark, d), A.pheno_gene(spark, d),
                              min_overlapping_vars=min_vars, order_digits=ORDER_DIGITS)


def coloc_features_input(spark: SparkSession, d: str) -> DataFrame:
    """Processed-like coloc table that keeps all 16 ids (input of M9)."""
    df = rs.add_ratios(rs.rename_raw(coloc_raw(spark, d)))
    return rs.make_symmetric(df)


def lead_variants(spark: SparkSession, d: str) -> DataFrame:
    """A14 on results: distinct lead variants of both sides."""
    raw = coloc_raw(spark, d)
    out = None
    for s in ("left", "right"):
        x = raw.select(*[F.col(f"{s}_{c}").alias(f"lead_{c}") for c in ("chrom", "pos", "ref", "alt")])
        out = x if out is None else out.unionByName(x)
    return out.distinct()


def ld_for_features(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """Synthetic LD (R = exp(-|d|/50 kb)) between result leads and sumstats variants."""
    raw = coloc_raw(spark, d) if raw is None else raw
    from ..operators.ld import distinct_lead_variants
    variants = A.sumstats(spark, d).select("chrom", "pos", "ref", "alt").distinct()
    return A.ld_model(variants, distinct_lead_variants(raw))


FEATURE_MIN_VARS = QUERY_MIN_VARS


def coloc_features(spark: SparkSession, d: str, all_pairs: bool = False) -> DataFrame:
    from ..operators.features import build_features
    raw = coloc_raw(spark, d)
    coloc = rs.make_symmetric(rs.add_ratios(rs.rename_raw(raw)))
    return build_features(ld_for_features(spark, d, raw), coloc, A.toploci(spark, d), FEATURE_MIN_VARS, all_pairs)


def feature_match_counts(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.features import match_counts
    raw = coloc_raw(spark, d)
    coloc = rs.make_symmetric(rs.add_ratios(rs.rename_raw(raw)))
    return match_counts(ld_for_features(spark, d, raw), coloc, A.toploci(spark, d), FEATURE_MIN_VARS)


def previous_release(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """Earlier release: raw results with even left_pos, carrying a legacy extra column."""
    raw = coloc_raw(spark, d) if raw is None else raw
    return (raw.filter(F.col("left_pos") % 2 == 0)
               .withColumn("left_sumstat", F.concat(F.lit("/data/"), F.col("left_study"), F.lit(".parquet"))))


def new_release(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    raw = coloc_raw(spark, d) if raw is None else raw
    return raw.filter(F.col("left_pos") % 2 == 1)


def toploci_leads(spark: SparkSession, d: str) -> DataFrame:
    """Distinct top-locus variants as LD leads."""
    return A.toploci(spark, d).select(*[F.col(c).alias(f"lead_{c}") for c in ("chrom", "pos", "ref", "alt")]).distinct()


def event_log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Task-log lines derived from the ``events`` table: one log per user, one line
    per event; errors become ERROR lines (half of them 'no intersection'), the
    rest report 'Time taken: h:mm:ss.ffffff' with value x 37 seconds."""
    from ..sources.io import read_table
    ev = read_table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    secs = F.col("value") * F.lit(37.0)
    h = F.floor(secs / 3600)
    m = F.floor((secs - h * 3600) / 60)
    s = secs - h * 3600 - m * 60
    line = (F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0),
                   F.lit("ERROR Cannot run coloc with no intersection"))
             .when(F.col("event_type") == "error",
                   F.concat(F.lit("ERROR conditioning failed for task "), F.col("event_id").cast("string")))
             .otherwise(F.concat(F.lit("INFO Time taken: "), h.cast("string"), F.lit(":"),
                                 F.lpad(m.cast("string"), 2, "0"), F.lit(":"), F.format_string("%09.6f", s))))
    return ev.select(F.col("user_id").alias("log_id"), F.col("event_id").alias("line_no"), line.alias("line"))

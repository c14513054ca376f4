"""Shared-signal posteriors of all tests in one plan.

Legacy: one OS process per test (pandas intersection -> R coloc.abf).  Here:

  tests --(signal ids)--> distinct signals
  summary statistics --> blocks of arrays per study and stretch of a chromosome
  tests x signals x blocks that their windows touch, grouped by region: the windows (J7),
  shared variants (J10), first-row study constants (A6), nsnps and log sums (A4), then the
  posteriors (A5)

A block is sent once to each region that needs it, so nothing that is shuffled has a row
per test and variant or per signal and variant (``regions``).  Statistics that were prepared
per signal (``prepare_signals``: stored or conditional ones) go the same way as arrays per signal.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import (PRIOR_P1, PRIOR_P2, PRIOR_P12, eaf_to_maf, with_log_abf,
                               with_log_diff, with_log_sum_exp, with_z_from_pval)
from ..functions.variants import variant_id
from ..schemas import LOCUS_COLS, RESULT_ID_COLS
from ..sources.io import materialize
from . import regions as rg
from .manifest import signals_to_prepare
from .overlap import locus_id
from .sumstats import COLOC_WINDOW_KB, MIN_MAF, maf_filter, signal_stats

SIDES = ("left", "right")


WINDOW_ANCHORS = ("own", "left")


def _check_anchor(window_anchor: str) -> None:
    if window_anchor not in WINDOW_ANCHORS:
        raise ValueError(f"window_anchor must be one of {WINDOW_ANCHORS}")


def with_test_ids(tests: DataFrame, window_anchor: str = "own") -> DataFrame:
    """Add left_signal_id, right_signal_id and test_id (64-bit hashes of the ids).

    With ``window_anchor='left'`` the right side's statistics are cut around the
    left lead, so its signal id also carries that anchor.
    """
    _check_anchor(window_anchor)
    out = tests.withColumn("left_signal_id", locus_id("left_"))
    rid = locus_id("right_")
    if window_anchor == "left":
        rid = F.xxhash64(rid, F.col("left_lead_chrom"), F.col("left_lead_pos"))
    out = out.withColumn("right_signal_id", rid)
    return out.withColumn("test_id", F.xxhash64("left_signal_id", "right_signal_id"))


def signals_with_ids(tests: DataFrame, window_anchor: str = "own") -> DataFrame:
    """U5 + ids: distinct signals of both sides of the tests.

    ``lead_chrom`` / ``lead_pos`` are the window centre used by ``signal_stats``:
    each signal's own lead (``'own'``, the optimised legacy path) or, for right
    signals, the left lead of the test (``'left'``, the all-in-one legacy path).
    """
    _check_anchor(window_anchor)
    if window_anchor == "own":
        return signals_to_prepare(tests).drop("ld").distinct().withColumn("signal_id", locus_id())
    left = (tests.select(*[F.col(f"left_{c}").alias(c) for c in LOCUS_COLS]).distinct()
                 .withColumn("signal_id", locus_id()))
    right = tests.select(*[F.col(f"right_{c}").alias(c) for c in LOCUS_COLS],
                         F.col("left_lead_chrom").alias("__ac"), F.col("left_lead_pos").alias("__ap")).distinct()
    right = (right.withColumn("signal_id", F.xxhash64(locus_id(), F.col("__ac"), F.col("__ap")))
                  .withColumn("lead_chrom", F.col("__ac")).withColumn("lead_pos", F.col("__ap"))
                  .drop("__ac", "__ap"))
    return left.unionByName(right).distinct()


def id_collisions(signals: DataFrame) -> DataFrame:
    """Signal ids shared by more than one signal (expected empty)."""
    return (signals.groupBy("signal_id").agg(F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") > 1))


def prepare_signals(tests: DataFrame, sumstats: DataFrame, window_kb: int = COLOC_WINDOW_KB,
                    min_maf: float | None = MIN_MAF, window_anchor: str = "own") -> DataFrame:
    """M4 without LD: per-signal statistics within +-window_kb of the window centre
    (its own lead, or the test's left lead for right signals with ``'left'``)."""
    return signal_stats(signals_with_ids(tests, window_anchor), sumstats, window_kb, min_maf)


def usable_constants(n, share, is_cc):
    """Study constants with which a Bayes factor exists: N > 0, and cases and controls in a case-control study."""
    return F.coalesce((n > 0) & (~is_cc | ((share > 0) & (share < 1))), F.lit(False))


def with_z(stats: DataFrame) -> DataFrame:
    """|z| per row: of ``z_cond`` where conditioning gave one (its p-value can be too small for a
    double), else from the p-value; ``informative``: whether the row has a usable one."""
    given = F.abs("z_cond") if "z_cond" in stats.columns else F.lit(None).cast("double")
    x = with_z_from_pval(stats, "pval", "__zp")
    return (x.withColumn("z", F.coalesce(given, F.col("__zp"))).drop("__zp")
             .withColumn("informative", F.coalesce(given.isNotNull() | ((F.col("pval") > 0) & ~F.isnan("pval")), F.lit(False))))


def _test_keys(tests: DataFrame, window_kb: int | None) -> DataFrame:
    return tests.select("test_id", "left_signal_id", "right_signal_id", *(["right_lead_pos"] if window_kb is not None else []))


def _left_rows(t: DataFrame, left: DataFrame, window_kb: int | None) -> DataFrame:
    """Left rows of each test; those outside the right signal's window match nothing and are
    dropped before the shuffle to the variant."""
    x = t.join(left, "left_signal_id")
    if window_kb is None:
        return x
    return x.filter(F.abs(F.col("pos") - F.col("right_lead_pos")) <= 1000 * window_kb).drop("right_lead_pos")


def harmonise(tests: DataFrame, stats: DataFrame, window_kb: int | None = None) -> DataFrame:
    """Shared variants of each test (inner join of the two signals on variant)."""
    t = _test_keys(tests, window_kb)
    # z and MAF depend on the (signal, variant) row only: computed once per prepared
    # row on the scan side, not once per test that reuses the signal.
    pre = with_z(stats.withColumn("maf", eaf_to_maf(F.col("eaf"))))

    def side(p):
        return pre.select(F.col("signal_id").alias(f"{p}_signal_id"), "chrom", "pos", "ref", "alt",
                          F.col("pval").alias(f"{p}_pval"), F.col("maf").alias(f"{p}_maf"),
                          F.col("z").alias(f"{p}_z"), F.col("informative").alias(f"{p}_ok"),
                          F.col("n_total").alias(f"{p}_n"), F.col("n_cases").alias(f"{p}_ncases"),
                          F.col("is_cc").alias(f"{p}_cc"))

    return (_left_rows(t, side("left"), window_kb)
             .join(side("right"), ["right_signal_id", "chrom", "pos", "ref", "alt"]))


def harmonise_windows(tests: DataFrame, sumstats: DataFrame, window_kb: int = COLOC_WINDOW_KB, min_maf: float | None = MIN_MAF) -> DataFrame:
    """J10 of tests whose signals' windows are cut region by region: the ids of ``results_naming``, chrom, pos, ref, alt and both p-values.

    The same rows as ``harmonise`` on ``prepare_signals``, without a shuffled row per signal or test and variant.
    """
    t = distinct_tests(tests)
    ss = sumstats if min_maf is None else maf_filter(sumstats, min_maf)
    x = rg.window_shared(t, signals_with_ids(tests), ss, 1000 * window_kb, "pval")
    return x.select(*results_naming(t), F.col("left_lead_chrom").alias("chrom"), F.col("pos").cast(sumstats.schema["pos"].dataType).alias("pos"),
                    "ref", "alt", "left_pval", "right_pval")


def coloc_posteriors(shared: DataFrame, p1: float = PRIOR_P1, p2: float = PRIOR_P2,
                     p12: float = PRIOR_P12) -> DataFrame:
    """(test_id, nsnps, coloc_h0..coloc_h4) from per-variant rows.

    Study constants (N, cases, cc) of each side come from the first shared
    variant in ``chrom:pos:ref:alt`` text order, before dropping variants with
    p <= 0 or MAF <= 0 (NaN counts as missing), as the legacy script did.
    ``test_posteriors`` gives the same from tests and statistics without these rows.
    """
    x = shared.withColumn("__vid", variant_id("chrom", "pos", "ref", "alt"))
    for s in SIDES:  # rows from ``harmonise`` carry z and MAF; raw rows get them here
        if f"{s}_maf" not in x.columns:
            x = x.withColumn(f"{s}_maf", eaf_to_maf(F.col(f"{s}_eaf")))
        if f"{s}_z" not in x.columns:
            x = with_z_from_pval(x, f"{s}_pval", f"{s}_z")
        if f"{s}_ok" not in x.columns:
            x = x.withColumn(f"{s}_ok", (F.col(f"{s}_pval") > 0) & ~F.isnan(f"{s}_pval"))
        x = x.withColumn(f"{s}_ok", F.coalesce(F.col(f"{s}_ok") & (F.col(f"{s}_maf") > 0) & ~F.isnan(f"{s}_maf"), F.lit(False)))
    x = x.select("test_id", F.col("pos").cast("bigint").alias("pos"), rg.variant_code().alias("code"), "__vid",
                 *[f"{s}_{c}" for s in SIDES for c in ("z", "maf", "ok", "n", "ncases", "cc")])

    def sums(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        t = t.take(pc.sort_indices(t, [("pos", "ascending"), ("code", "ascending")]))
        first = int(np.argmin(np.array(t.column("__vid").to_pylist(), object)))
        keep, sides = np.ones(t.num_rows, bool), []
        with np.errstate(all="ignore"):
            for s in SIDES:
                col = {c: t.column(f"{s}_{c}").combine_chunks() for c in ("z", "maf", "ok", "n", "ncases", "cc")}
                *c, good = rg.study_constants(*[col[k].slice(first, 1) for k in ("n", "ncases", "cc")])
                keep &= np.asarray(col["ok"]) & good[0]
                sides.append((col["z"].to_numpy(zero_copy_only=False), col["maf"].to_numpy(zero_copy_only=False), np.asarray(col["z"].is_null()), c))
            k = np.flatnonzero(keep)
            args = [y for z, maf, none, c in sides for y in (z[k], maf[k], none[k], c)]
            return rg.posterior_sums(np.asarray(t.column("test_id"))[:1], np.zeros(len(k), np.int64), *args)

    return posteriors_from_sums(x.groupBy("test_id").applyInArrow(sums, rg.SUMS_SCHEMA), p1, p2, p12)


def test_posteriors(tests: DataFrame, stats: DataFrame, p1: float = PRIOR_P1, p2: float = PRIOR_P2,
                    p12: float = PRIOR_P12) -> DataFrame:
    """J10 + A4-A6: ``coloc_posteriors`` of tests (with ids) and prepared statistics, region by region."""
    pre = with_z(stats.withColumn("maf", eaf_to_maf(F.col("eaf"))))
    return posteriors_from_sums(rg.test_sums(tests, pre), p1, p2, p12)


def window_posteriors(tests: DataFrame, signals: DataFrame, sumstats: DataFrame, p1: float = PRIOR_P1, p2: float = PRIOR_P2,
                      p12: float = PRIOR_P12, window_kb: int = COLOC_WINDOW_KB, min_maf: float | None = MIN_MAF) -> DataFrame:
    """M4 without LD, then ``test_posteriors``: the windows of ``signals`` (with ids) are cut where their tests are made."""
    ss = sumstats if min_maf is None else maf_filter(sumstats, min_maf)
    pre = with_z(ss.withColumn("maf", eaf_to_maf(F.col("eaf"))))
    return posteriors_from_sums(rg.window_sums(tests, signals, pre, 1000 * window_kb), p1, p2, p12)


def posteriors_from_sums(g: DataFrame, p1: float = PRIOR_P1, p2: float = PRIOR_P2, p12: float = PRIOR_P12) -> DataFrame:
    """A5: (test_id, nsnps, coloc_h0..h4) from the log sums L1, L2 and L12 of each test."""
    g = g.withColumn("__l1l2", F.col("L1") + F.col("L2"))
    g = with_log_diff(g, "__l1l2", "L12", "__ld")
    g = g.select("test_id", "nsnps",
                 F.lit(0.0).alias("__lh0"),
                 (F.lit(math.log(p1)) + F.col("L1")).alias("__lh1"),
                 (F.lit(math.log(p2)) + F.col("L2")).alias("__lh2"),
                 (F.lit(math.log(p1) + math.log(p2)) + F.col("__ld")).alias("__lh3"),
                 (F.lit(math.log(p12)) + F.col("L12")).alias("__lh4"))
    g = with_log_sum_exp(g, [f"__lh{i}" for i in range(5)], "__den")
    return g.select("test_id", "nsnps",
                    *[F.exp(F.col(f"__lh{i}") - F.col("__den")).alias(f"coloc_h{i}") for i in range(5)])


def uniform_signals(stats: DataFrame) -> DataFrame:
    """(signal_id, uniform): whether n_total, n_cases and is_cc are each constant (or all NULL).

    Then the first-row rule of A6 picks the same values as any row, and lABF can be
    computed once per (signal, variant).
    """
    tot = F.count(F.lit(1))
    flags = None
    for c in ("n_total", "n_cases", "is_cc"):
        cnt = F.count(c)
        one = (cnt == 0) | ((cnt == tot) & (F.min(c) == F.max(c)))
        flags = one if flags is None else flags & one
    return stats.groupBy("signal_id").agg(flags.alias("uniform"))


def results_naming(tests: DataFrame) -> list:
    """Manifest locus columns -> results id columns (left_study, left_phenotype, ...)."""
    return [F.col(f"{s}_{m}").alias(f"{s}_{r}") for s in SIDES
            for m, r in zip(LOCUS_COLS, RESULT_ID_COLS)]


def run_coloc(tests: DataFrame, stats: DataFrame, p1: float = PRIOR_P1, p2: float = PRIOR_P2,
              p12: float = PRIOR_P12, window_anchor: str = "own", window_kb: int | None = None) -> DataFrame:
    """M5: raw coloc results, one row per test with at least one usable shared variant.

    ``tests`` carries the 16 locus columns (manifest naming); ``stats`` is
    ``prepare_signals`` output built with the same ``window_anchor``.  Output
    columns: left_/right_ x (type, study, phenotype, bio_feature, chrom, pos, ref,
    alt), nsnps, coloc_h0..coloc_h4.

    ``window_kb``, the window with which ``stats`` were cut, does not change the results.

    Study constants are those of the test's first shared variant; a group of tests whose
    signals all have constant ones computes the factors once per (signal, variant).
    """
    t = distinct_tests(tests, window_anchor)
    post = test_posteriors(t, stats, p1, p2, p12)
    return t.join(post, "test_id").select(*results_naming(t), "nsnps",
                                          *[f"coloc_h{i}" for i in range(5)])


def distinct_tests(tests: DataFrame, window_anchor: str = "own") -> DataFrame:
    """The distinct tests with their ids, written: groups, their signals and the results all read them."""
    return materialize(with_test_ids(tests.select(*[f"{s}_{c}" for s in SIDES for c in LOCUS_COLS]).distinct(), window_anchor), "distinct-tests")


def run_coloc_windows(tests: DataFrame, sumstats: DataFrame, p1: float = PRIOR_P1, p2: float = PRIOR_P2, p12: float = PRIOR_P12,
                      window_anchor: str = "own", window_kb: int = COLOC_WINDOW_KB, min_maf: float | None = MIN_MAF) -> DataFrame:
    """``run_coloc(tests, prepare_signals(tests, sumstats, ...))`` without a row per signal and variant written or sent."""
    t = distinct_tests(tests, window_anchor)
    post = window_posteriors(t, signals_with_ids(tests, window_anchor), sumstats, p1, p2, p12, window_kb, min_maf)
    return t.join(post, "test_id").select(*results_naming(t), "nsnps", *[f"coloc_h{i}" for i in range(5)])


def coloc_status(tests: DataFrame, raw: DataFrame) -> DataFrame:
    """Tests without a result get status 'no_intersection' (instead of an empty file)."""
    t = with_test_ids(tests.select(*[f"{s}_{c}" for s in SIDES for c in LOCUS_COLS]).distinct())
    r = raw.select(*[F.col(f"{s}_{rc}").alias(f"{s}_{mc}") for s in SIDES
                     for mc, rc in zip(LOCUS_COLS, RESULT_ID_COLS)])
    done = with_test_ids(r).select("test_id", F.lit("ok").alias("status"))
    return (t.join(done, "test_id", "left")
             .select(*[f"{s}_{c}" for s in SIDES for c in LOCUS_COLS],
                     F.coalesce("status", F.lit("no_intersection")).alias("status")))


def side_constants(shared: DataFrame) -> DataFrame:
    """Per test and side, N, cases = min(n_cases, N - n_cases), s = cases / N
    and the cc flag, from the first shared variant in variant-id order."""
    vid = variant_id("chrom", "pos", "ref", "alt")
    cols = [F.col(f"{s}_{c}") for s in SIDES for c in ("n", "ncases", "cc")]
    g = shared.groupBy("test_id").agg(F.min_by(F.struct(*cols), vid).alias("f"))
    return _constants(g.select("test_id", "f.*"))


def test_constants(tests: DataFrame, stats: DataFrame) -> DataFrame:
    """J10 + A6: ``side_constants`` of tests (with ids) and prepared statistics, region by region."""
    pre = with_z(stats.withColumn("maf", eaf_to_maf(F.col("eaf"))))
    return _constants(rg.first_constants(tests, pre))


def _constants(g: DataFrame) -> DataFrame:
    out = [F.col("test_id")]
    for s in SIDES:
        n = F.col(f"{s}_n")
        nc = F.least(F.col(f"{s}_ncases"), n - F.col(f"{s}_ncases"))
        out += [n.alias(f"{s}_N"), nc.alias(f"{s}_cases"), (nc.cast("double") / n).alias(f"{s}_s"),
                F.coalesce(F.col(f"{s}_cc"), F.lit(False)).alias(f"{s}_is_cc")]
    return g.select(*out)


def abf_per_variant(stats: DataFrame) -> DataFrame:
    """A4 on prepared statistics: lABF of every (signal, variant) with the row's
    own N / cases / cc (rows with p <= 0, MAF <= 0 or NaN are dropped)."""
    n = F.col("n_total").cast("double")
    nc = F.col("n_cases").cast("double")
    x = stats.withColumns({"__N": n, "__s": F.try_divide(F.least(nc, n - nc), n),
                           "__cc": F.coalesce(F.col("is_cc"), F.lit(False)),
                           "maf": eaf_to_maf(F.col("eaf"))})
    x = x.filter((F.col("pval") > 0) & ~F.isnan("pval") & (F.col("maf") > 0) & ~F.isnan("maf")
                 & usable_constants(F.col("__N"), F.col("__s"), F.col("__cc")))
    x = with_z_from_pval(x, "pval", "z")
    x = with_log_abf(x, "z", "maf", "__N", "__cc", "__s", "labf")
    return x.drop("__N", "__s", "__cc")

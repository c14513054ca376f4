"""Statistics: AS241 quantile, Wakefield ABF, five posteriors against a NumPy reference."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from sharedsignal.functions.stats import (PRIOR_P1, PRIOR_P2, PRIOR_P12, with_log_abf, with_z_from_pval)
from sharedsignal.operators.abf import coloc_posteriors


def test_z_matches_normal_quantile(spark):
    ps = [0.9, 0.5, 0.1, 0.05, 1e-3, 1e-8, 1e-30, 1e-100, 1e-300]
    df = spark.createDataFrame([(p,) for p in ps] + [(0.0,), (float("nan"),)], "p double")
    rows = with_z_from_pval(df, "p", "z").collect()
    for r in rows:
        if r.p == 0 or math.isnan(r.p):
            assert r.z is None
            continue
        ref = -NormalDist().inv_cdf(r.p / 2)
        assert r.z == pytest.approx(ref, rel=1e-12)
        assert math.erfc(r.z / math.sqrt(2)) == pytest.approx(r.p, rel=1e-9)


def _labf_np(p, maf, n, cc, s):
    z = -NormalDist().inv_cdf(p / 2)
    v = 1 / (2 * n * maf * (1 - maf) * (s * (1 - s) if cc else 1))
    w = 0.2 ** 2 if cc else 0.15 ** 2
    r = w / (w + v)
    return 0.5 * (math.log(1 - r) + r * z * z)


def test_log_abf_quant_and_cc(spark):
    rows = [(1e-6, 0.3, 5000.0, False, None), (0.2, 0.05, 800.0, True, 0.25), (1e-40, 0.5, 1e5, True, 0.5)]
    df = spark.createDataFrame(rows, "p double, maf double, n double, cc boolean, s double")
    df = with_log_abf(with_z_from_pval(df, "p", "z"), "z", "maf", "n", "cc", "s", "l")
    for r in df.collect():
        assert r.l == pytest.approx(_labf_np(r.p, r.maf, r.n, r.cc, r.s or 0), rel=1e-10)


def _posteriors_np(l1, l2):
    def lse(x):
        m = np.max(x)
        return m + math.log(np.sum(np.exp(x - m)))
    L1, L2, L12 = lse(l1), lse(l2), lse(l1 + l2)
    a, b = L1 + L2, L12
    m = max(a, b)
    d = math.exp(a - m) - math.exp(b - m)
    lh3 = math.log(PRIOR_P1) + math.log(PRIOR_P2) + (m + math.log(d) if d > 0 else -math.inf)
    lh = np.array([0.0, math.log(PRIOR_P1) + L1, math.log(PRIOR_P2) + L2, lh3, math.log(PRIOR_P12) + L12])
    return np.exp(lh - lse(lh))


def _shared_rows(rng, test_id, n, n_l=5000, n_r=800, cc_r=True, ncases_r=300):
    out = []
    for i in range(n):
        out.append((test_id, "1", 1000 + i, "A", "C", float(10 ** -rng.uniform(0, 12)), float(rng.uniform(0.02, 0.98)),
                    n_l, None, False, float(10 ** -rng.uniform(0, 8)), float(rng.uniform(0.02, 0.98)), n_r, ncases_r, cc_r))
    return out


SCHEMA = ("test_id long, chrom string, pos int, ref string, alt string, left_pval double, left_eaf double, "
          "left_n int, left_ncases int, left_cc boolean, right_pval double, right_eaf double, right_n int, "
          "right_ncases int, right_cc boolean")


def test_posteriors_match_numpy(spark):
    rng = np.random.default_rng(7)
    rows = _shared_rows(rng, 1, 60) + _shared_rows(rng, 2, 1) + _shared_rows(rng, 3, 25, cc_r=False)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.test_id: r for r in coloc_posteriors(df).collect()}
    for tid in (1, 2, 3):
        sub = [r for r in rows if r[0] == tid]
        l1 = np.array([_labf_np(r[5], min(r[6], 1 - r[6]), r[7], r[9], 0) for r in sub])
        s_r = min(sub[0][13], sub[0][12] - sub[0][13]) / sub[0][12]
        l2 = np.array([_labf_np(r[10], min(r[11], 1 - r[11]), r[12], r[14], s_r) for r in sub])
        ref = _posteriors_np(l1, l2)
        g = got[tid]
        assert g.nsnps == len(sub)
        for i in range(5):
            assert getattr(g, f"coloc_h{i}") == pytest.approx(ref[i], rel=1e-9, abs=1e-300)
        assert sum(getattr(g, f"coloc_h{i}") for i in range(5)) == pytest.approx(1.0, abs=1e-12)
    assert got[2].coloc_h3 == 0.0  # one variant: H3 impossible


def test_swapping_sides_swaps_h1_h2(spark):
    rng = np.random.default_rng(3)
    rows = _shared_rows(rng, 1, 40, cc_r=False, ncases_r=None)
    df = spark.createDataFrame(rows, SCHEMA)
    swapped = df.select("test_id", "chrom", "pos", "ref", "alt",
                        *[F.col(f"right_{c}").alias(f"left_{c}") for c in ("pval", "eaf", "n", "ncases", "cc")],
                        *[F.col(f"left_{c}").alias(f"right_{c}") for c in ("pval", "eaf", "n", "ncases", "cc")])
    a = coloc_posteriors(df).collect()[0]
    b = coloc_posteriors(swapped).collect()[0]
    assert a.coloc_h1 == pytest.approx(b.coloc_h2, rel=1e-9)
    assert a.coloc_h2 == pytest.approx(b.coloc_h1, rel=1e-9)
    for h in ("coloc_h0", "coloc_h3", "coloc_h4"):
        assert getattr(a, h) == pytest.approx(getattr(b, h), rel=1e-9)


def test_invalid_variants_dropped_but_first_row_constants_kept(spark):
    rng = np.random.default_rng(11)
    rows = _shared_rows(rng, 1, 10)
    bad = list(rows[0])
    bad[5] = 0.0  # p = 0 on the first variant in id order: dropped, but its N still used
    rows[0] = tuple(bad)
    nan = list(rows[1])
    nan[6] = float("nan")
    rows[1] = tuple(nan)
    g = coloc_posteriors(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    assert g.nsnps == 8


def test_uniform_fast_path_equals_first_row_path(spark):
    from sharedsignal.operators.abf import coloc_posteriors, harmonise, run_coloc, uniform_signals
    rng = np.random.default_rng(21)
    cols = ("left", "right")
    tests = spark.createDataFrame(
        [("gwas", "G1", None, None, "1", 1000, "A", "C", "eqtl", "Q1", "E1", "T1", "1", 1500, "A", "C"),
         ("gwas", "G2", None, None, "1", 1200, "A", "C", "eqtl", "Q1", "E1", "T1", "1", 1500, "A", "C")],
        ", ".join(f"{s}_{c} {'int' if c == 'lead_pos' else 'string'}" for s in cols
                  for c in ("type", "study_id", "phenotype_id", "bio_feature", "lead_chrom", "lead_pos",
                            "lead_ref", "lead_alt")))
    from sharedsignal.operators.abf import with_test_ids
    ids = {r.left_study_id: (r.left_signal_id, r.right_signal_id) for r in with_test_ids(tests).collect()}
    rows = []
    for sid, n, nc, cc in ((ids["G1"][0], 5000, None, False), (ids["G2"][0], 3000, 900, True),
                           (ids["G1"][1], 800, None, False)):
        for i in range(40):
            p = 0.0 if i == 3 else float(10 ** -rng.uniform(0, 10))
            rows.append((sid, "1", 1000 + i, "A", "C", 0.1, 0.01, p, n, nc, float(rng.uniform(0.01, 0.99)), cc))
    stats = spark.createDataFrame(rows, "signal_id long, chrom string, pos int, ref string, alt string, beta double, "
                                        "se double, pval double, n_total int, n_cases int, eaf double, is_cc boolean")
    assert all(r.uniform for r in uniform_signals(stats).collect())
    fast = {r.left_study: r for r in run_coloc(tests, stats).collect()}
    t = with_test_ids(tests)
    study = {r.test_id: r.left_study_id for r in t.collect()}
    slow = {study[r.test_id]: r for r in coloc_posteriors(harmonise(t, stats)).collect()}
    assert set(fast) == set(slow) == {"G1", "G2"}
    for k in fast:
        assert fast[k].nsnps == slow[k].nsnps == 39
        for i in range(5):
            assert getattr(fast[k], f"coloc_h{i}") == getattr(slow[k], f"coloc_h{i}")
    # one signal with mixed constants sends only its own test to the first-row plan
    mixed = stats.union(spark.createDataFrame([(ids["G1"][0], "1", 5000, "A", "C", 0.1, 0.01, 0.5, 4999, None, 0.3, False)],
                                              stats.schema))
    assert {r.signal_id: r.uniform for r in uniform_signals(mixed).collect()}[ids["G1"][0]] is False
    again = {r.left_study: r for r in run_coloc(tests, mixed).collect()}
    assert again["G1"].coloc_h4 == fast["G1"].coloc_h4 and again["G2"].coloc_h4 == fast["G2"].coloc_h4


def test_bad_study_constants_lose_only_their_rows(spark):
    from sharedsignal.operators.abf import abf_per_variant
    rows = [(1, 0.3, 1000, 0, True), (2, 0.3, 0, None, False), (3, 0.3, 1000, 250, True), (4, 0.3, 1000, 1000, True)]
    stats = spark.createDataFrame([(i, "1", 5, "A", "C", 0.1, 0.01, 1e-4, n, nc, f, cc) for i, f, n, nc, cc in rows],
                                  "signal_id long, chrom string, pos long, ref string, alt string, beta double, se double, "
                                  "pval double, n_total int, n_cases int, eaf double, is_cc boolean")
    assert [r.signal_id for r in abf_per_variant(stats).collect()] == [3]

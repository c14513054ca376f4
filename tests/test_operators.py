"""Operators on hand-written rows, checked against brute-force Python."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sharedsignal import schemas
from sharedsignal.operators import conditional as cd
from sharedsignal.operators import ld as ldm
from sharedsignal.operators import manifest as mf
from sharedsignal.operators import overlap as ov
from sharedsignal.operators import results as rs
from sharedsignal.operators.sumstats import maf_filter, window_join


def _cs(type_, study, pheno, feat, lead_pos, tag_pos, method="conditional", is95=True, chrom="1"):
    return (type_, study, pheno, feat, chrom, lead_pos, "A", "G", chrom, tag_pos, "C", "T", is95, True, method)


CREDSET_ROWS = [
    _cs("gwas", "G1", None, None, 1000, 10), _cs("gwas", "G1", None, None, 1000, 11),
    _cs("gwas", "G2", None, None, 1500, 10), _cs("gwas", "G2", None, None, 1500, 12),
    _cs("eqtl", "Q1", "ENSG1", "T1", 2000, 10), _cs("eqtl", "Q1", "ENSG1", "T1", 2000, 11),
    _cs("eqtl", "Q2", "ENSG2", "T1", 3000, 10),                   # eQTL-eQTL never paired
    _cs("gwas", "G1", None, None, 501000, 10, is95=False),        # not in the 95 % set
    _cs("gwas", "G3", None, None, 501000, 12),                    # distance exactly 500,000 to G1
    _cs("gwas", "G4", None, None, 501001, 12),                    # distance 500,001 to G1
    _cs("gwas", "G3", None, None, 501000, 12, method="distance"),  # duplicate tag: counts multiply
]


def _legacy_overlap(rows, max_dist=500_000):
    rows = [r for r in rows if r[12]]
    key = lambda r: "_".join(str(x) for x in r[:8] if x is not None)
    out = {}
    for l, r in itertools.product(rows, rows):
        if l[8:12] != r[8:12] or l[1] == r[1] or not (l[0] == "gwas" or r[0] == "gwas") or not key(l) > key(r):
            continue
        if abs(l[5] - r[5]) > max_dist:
            continue
        out[(key(l), key(r))] = out.get((key(l), key(r)), 0) + 1
    return out


def test_find_overlaps_matches_legacy_self_join(spark):
    df = spark.createDataFrame(CREDSET_ROWS, schemas.CREDSET)
    got = {(r.left_key, r.right_key): r.num_overlapping
           for r in ov.find_overlaps(df, "95", "all", 500_000, keep_keys=True).collect()}
    assert got == _legacy_overlap(CREDSET_ROWS)
    assert not any("Q2" in k[0] and "Q1" in k[1] for k in got)


def test_overlap_props_and_totals(spark):
    df = spark.createDataFrame(CREDSET_ROWS, schemas.CREDSET)
    for r in ov.find_overlaps(df, keep_keys=True).collect():
        assert r.num_overlapping <= max(r.left_num_tags, r.right_num_tags) ** 2
        assert r.left_overlap_prop == r.num_overlapping / r.left_num_tags


def test_window_join_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    left = [(i, "S1" if i % 2 else "S2", None if i % 3 else "P", str(1 + i % 2), int(rng.integers(0, 3_000_000)))
            for i in range(40)]
    right = [("S1" if j % 2 else "S2", None if j % 3 else "P", str(1 + j % 2), int(rng.integers(0, 3_000_000)), j)
             for j in range(400)]
    L = spark.createDataFrame(left, "lid int, study string, pheno string, lchrom string, lpos int")
    R = spark.createDataFrame(right, "study string, pheno string, rchrom string, rpos int, rid int")
    got = sorted((r.lid, r.rid) for r in window_join(L, R, ["study", "pheno"], "lchrom", "lpos", "rchrom", "rpos",
                                                      250_000).collect())
    ref = sorted((a[0], b[4]) for a in left for b in right
                 if a[1] == b[0] and a[2] == b[1] and a[3] == b[2] and abs(a[4] - b[3]) <= 250_000)
    assert got == ref


def test_maf_filter_keeps_nan_and_null(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (float("nan"),), (None,), (0.995,), (0.01,)], "eaf double")
    got = sorted(str(r.eaf) for r in maf_filter(df, 0.01).collect())
    assert got == sorted(["0.5", "nan", "None", "0.01"])


def _raw(spark, rows):
    cols = [f"{s}_{c}" for s in ("left", "right") for c in schemas.RESULT_ID_COLS]
    schema = ", ".join(f"{c} {'int' if c.endswith('_pos') else 'string'}" for c in cols)
    schema += ", nsnps int, coloc_h0 double, coloc_h1 double, coloc_h2 double, coloc_h3 double, coloc_h4 double"
    return spark.createDataFrame(rows, schema)


def _loc(t, study, pheno, pos):
    return (t, study, pheno, None if pheno is None else "T1", "1", pos, "A", "C")


def test_process_results_symmetry_dedup_and_na_order(spark):
    rows = [
        _loc("gwas", "G1", None, 100) + _loc("eqtl", "Q1", "ENSG1", 200) + (120, 0.0, 0.0, 0.0, 0.2, 0.8),
        _loc("gwas", "G1", None, 100) + _loc("eqtl", "Q1", "ENSG1", 300) + (120, 0.0, 0.0, 0.0, 0.1, 0.9),
        _loc("gwas", "G1", None, 100) + _loc("gwas", "G2", None, 400) + (150, 0.0, 0.0, 0.0, 0.5, 0.5),
        _loc("gwas", "G3", None, 100) + _loc("eqtl", "Q1", "ENSG1", 200) + (150, 0.0, 0.0, 0.0, 0.0, 1.0),  # h3 = 0
        _loc("gwas", "G3", None, 100) + _loc("eqtl", "Q1", "ENSG1", 250) + (150, 0.0, 0.0, 0.0, 0.5, 0.5),
        _loc("gwas", "G4", None, 100) + _loc("eqtl", "Q2", "PROT_1", 200) + (50, 0.0, 0.0, 0.0, 0.5, 0.5),  # too few
    ]
    raw = _raw(spark, rows)
    lut = spark.createDataFrame([("ENSG1", "ENSG0000001"), ("ENSG1", "ENSG0000000"), ("PROT_1", "nogene")],
                                "phenotype_id string, gene_id string")
    sym = rs.make_symmetric(raw)
    assert sym.count() == 2 * raw.count()
    out = rs.process_results(raw, lut, min_overlapping_vars=100).collect()
    by_left = {(r.left_study, r.right_study, r.is_flipped): r for r in out}
    # best right locus for (G1, Q1) is h4 = 0.9 (pos 300)
    assert by_left[("G1", "Q1", False)].right_pos == 300
    # gene id: max of duplicates, must start with ENSG
    assert by_left[("G1", "Q1", False)].right_gene_id == "ENSG0000001"
    # GWAS-GWAS appears in both orientations
    assert ("G1", "G2", False) in by_left and ("G2", "G1", True) in by_left
    # NA filter after dedup: best row of (G3, Q1) has h3 = 0 -> group disappears
    assert ("G3", "Q1", False) not in by_left
    assert all(r.right_study != "Q2" for r in out)


def test_keep_first_ties_are_deterministic(spark):
    rows = [_loc("gwas", "G1", None, 100) + _loc("eqtl", "Q1", "ENSG1", p) + (120, 0.0, 0.0, 0.0, 0.1, 0.5)
            for p in (900, 300, 600)]
    sym = rs.make_symmetric(rs.add_ratios(rs.rename_raw(_raw(spark, rows))))
    best = rs.dedup_right(rs.filter_left_gwas(sym)).collect()
    assert [r.right_pos for r in best] == [300]


def test_filter_manifest_null_safe_and_none_text(spark):
    cols = [f"{s}_{c}" for s in ("left", "right") for c in schemas.LOCUS_COLS]
    schema = ", ".join(f"{c} {'int' if c.endswith('_pos') else 'string'}" for c in cols)
    m = spark.createDataFrame([
        ("gwas", "G1", "None", "None", "1", 100, "A", "C", "eqtl", "Q1", "ENSG1", "T1", "1", 200, "A", "C"),
        ("gwas", "G1", "None", "None", "1", 100, "A", "C", "eqtl", "Q1", "ENSG2", "T1", "1", 200, "A", "C"),
    ], schema)
    done = spark.createDataFrame([
        ("gwas", "G1", None, None, "1", 100, "A", "C", "eqtl", "Q1", "ENSG1", "T1", "1", 200, "A", "C"),
    ], ", ".join(f"{s}_{c} {'int' if c == 'pos' else 'string'}" for s in ("left", "right")
                 for c in schemas.RESULT_ID_COLS))
    left = mf.filter_manifest(m, done).collect()
    assert [r.right_phenotype_id for r in left] == ["ENSG2"]
    assert left[0].left_phenotype_id is None


def test_ld_pairs_match_numpy_corr(spark):
    rng = np.random.default_rng(5)
    n_samples, n_var = 30, 6
    g = rng.integers(0, 3, size=(n_samples, n_var))
    g[:, 5] = 0
    g[3, 5] = 2  # a rare variant: few common carriers
    rows = [(int(s), "1", 1000 * (v + 1), "A", "C", int(g[s, v])) for s in range(n_samples) for v in range(n_var)
            if g[s, v] > 0]
    geno = spark.createDataFrame(rows, schemas.GENOTYPES)
    leads = spark.createDataFrame([("1", 1000, "A", "C")], "lead_chrom string, lead_pos int, lead_ref string, lead_alt string")
    got = {r.tag_pos: r.R_EUR for r in ldm.ld_pairs(geno, leads, n_samples).collect()}
    assert len(got) == n_var
    for v in range(n_var):
        ref = np.corrcoef(g[:, 0], g[:, v])[0, 1]
        assert got[1000 * (v + 1)] == pytest.approx(ref, rel=1e-9, abs=1e-12)


def test_cojo_single_equals_multi_for_one_variant(spark):
    rng = np.random.default_rng(9)
    n_samples, n_var = 200, 12
    base = rng.integers(0, 3, size=n_samples)
    g = np.stack([np.where(rng.random(n_samples) < 0.7, base, rng.integers(0, 3, n_samples)) for _ in range(n_var)], 1)
    rows = [(int(s), "1", 1000 * (v + 1), "A", "C", int(g[s, v])) for s in range(n_samples) for v in range(n_var)
            if g[s, v] > 0]
    geno = spark.createDataFrame(rows, schemas.GENOTYPES)
    stats = spark.createDataFrame(
        [(7, "1", 1000 * (v + 1), "A", "C", float(rng.normal(0, 0.1)), 0.02, 1e-3, 5000, None,
          float(g[:, v].mean() / 2), False) for v in range(n_var)],
        "signal_id long, chrom string, pos int, ref string, alt string, beta double, se double, pval double, "
        "n_total int, n_cases int, eaf double, is_cc boolean")
    conds = spark.createDataFrame([(7, "1", 5000, "A", "C")],
                                  "signal_id long, cond_chrom string, cond_pos int, cond_ref string, cond_alt string")
    a = {r.pos: r for r in cd.cojo_single(stats, conds, geno, n_samples).collect()}
    b = {r.pos: r for r in cd.cojo_multi(stats, conds, geno, n_samples).collect()}
    assert set(a) == set(b) and 5000 not in a
    for p in a:
        assert a[p].beta_cond == pytest.approx(b[p].beta_cond, rel=1e-9)
        assert a[p].se_cond == pytest.approx(b[p].se_cond, rel=1e-9)
        assert a[p].pval_cond == pytest.approx(math.erfc(abs(a[p].z_cond) / math.sqrt(2)), rel=2e-7)


def test_cojo_three_conditioning_variants(spark):
    """Against loops over the formulas: joint effects of the conditioning variants taken off each variant."""
    rng = np.random.default_rng(4)
    n_samples, n_var, ks = 400, 10, [2, 5, 8]
    g = rng.integers(0, 3, size=(n_samples, n_var))
    rows = [(int(s), "1", 1000 * (v + 1), "A", "C", int(g[s, v])) for s in range(n_samples) for v in range(n_var) if g[s, v] > 0]
    f, b, n, se = g.mean(0) / 2, rng.normal(0, 0.1, n_var), 5000.0, 0.02
    stats = spark.createDataFrame(
        [(7, "1", 1000 * (v + 1), "A", "C", float(b[v]), se, 1e-3, int(n), None, float(f[v]), False) for v in range(n_var)],
        "signal_id long, chrom string, pos long, ref string, alt string, beta double, se double, pval double, "
        "n_total int, n_cases int, eaf double, is_cc boolean")
    conds = spark.createDataFrame([(7, "1", 1000 * (k + 1), "A", "C") for k in ks],
                                  "signal_id long, cond_chrom string, cond_pos long, cond_ref string, cond_alt string")
    got = {r.pos // 1000 - 1: r for r in cd.cojo_multi(stats, conds, spark.createDataFrame(rows, schemas.GENOTYPES), n_samples).collect()}
    r, v = np.corrcoef(g.T), f * (1 - f)
    d = 2 * v * n
    cross = lambda i, j: n * 2 * math.sqrt(v[i] * v[j]) * r[i, j]
    B = np.array([[d[i] if i == j else cross(i, j) for j in ks] for i in ks])
    joint = np.linalg.solve(B, d[ks] * b[ks])
    yy = np.median(d * se ** 2 * (n - 1) + d * b ** 2)
    assert set(got) == set(range(n_var)) - set(ks)
    for j in got:
        c = np.array([cross(j, k) for k in ks])
        beta = b[j] - c @ joint / d[j]
        s2 = (yy - joint @ (d[ks] * b[ks]) - d[j] * b[j] * beta) / (n - len(ks) - 1)
        var = s2 * (d[j] - c @ np.linalg.solve(B, c)) / d[j] ** 2
        assert got[j].beta_cond == pytest.approx(beta, rel=1e-6)
        assert got[j].se_cond == pytest.approx(math.sqrt(var), rel=1e-6)


def test_signals_without_reference_are_not_conditioned(spark):
    sig = spark.createDataFrame([(1, "p", "conditional"), (2, None, "conditional"), (3, "p", "distance"), (4, "p", None)],
                                "signal_id int, ld string, method string")
    assert [r.signal_id for r in sig.filter(cd.conditionable(sig)).orderBy("signal_id").collect()] == [1, 4]

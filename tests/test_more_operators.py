"""Manifest, variant ids, releases, logs and feature operators on hand-written rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sharedsignal import schemas
from sharedsignal.functions.variants import parse_variant_id, swap_separators
from sharedsignal.operators import features as ft
from sharedsignal.operators import logs as lg
from sharedsignal.operators import manifest as mf
from sharedsignal.operators import releases as rl
from sharedsignal.sources import io

SIDES = ("left", "right")


def _overlap(spark, rows):
    cols = [f"{s}_{c}" for s in SIDES for c in schemas.LOCUS_COLS]
    schema = ", ".join(f"{c} {'int' if c.endswith('_pos') else 'string'}" for c in cols)
    schema += (", num_overlapping long, left_num_tags long, right_num_tags long, "
               "left_overlap_prop double, right_overlap_prop double")
    return spark.createDataFrame(rows, schema)


def _pair(ls, rs_, n, ln, rn, lchrom="1"):
    left = ("gwas", ls, None, None, lchrom, 100, "A", "C")
    right = ("eqtl", rs_, "ENSG1", "T1", "1", 200, "A", "C")
    return left + right + (n, ln, rn, n / ln, n / rn)


def test_manifest_filters_paths_and_ld(spark):
    ov = _overlap(spark, [_pair("FINNGEN_R5_X", "Q1", 2, 200, 150), _pair("G2", "Q1", 5, 10, 10),
                          _pair("G3", "Q2", 3, 30, 400, lchrom="7"), _pair("G4", "Q2", 1, 200, 150)])
    m = mf.make_manifest(ov, min_prop=0.01, max_size=200).collect()
    by = {r.left_study_id: r for r in m}
    # 400 tags > 200; G4: max prop 1/150 < 0.01; FINNGEN: 2/150 >= 0.01 and 200 tags <= 200
    assert set(by) == {"FINNGEN_R5_X", "G2"}
    assert by["FINNGEN_R5_X"].left_ld is None           # no conditioning for FINNGEN
    assert by["G2"].left_ld.endswith("panel_chr1")
    assert by["G2"].left_sumstats.endswith("/gwas/G2.parquet")
    assert by["G2"].right_sumstats.endswith("/molecular_trait/Q1.parquet")
    assert "left_phenotype=None" in by["G2"].out and "right_phenotype=ENSG1" in by["G2"].out
    assert by["G2"].method == "conditional"


def test_custom_studies_left_or_right(spark):
    ov = _overlap(spark, [_pair("G1", "Q1", 5, 10, 10), _pair("G2", "Q2", 5, 10, 10), _pair("G3", "Q3", 5, 10, 10)])
    studies = spark.createDataFrame([("G1",), ("Q3",), ("Q3",)], "study_id string")
    got = sorted(r.left_study_id for r in mf.filter_custom_studies(ov, studies).collect())
    assert got == ["G1", "G3"]


def test_missing_inputs_reports_absent_paths(spark):
    m = mf.make_manifest(_overlap(spark, [_pair("G1", "Q1", 5, 10, 10)]))
    catalog = spark.createDataFrame([("/data/sumstats/gwas/G1.parquet",)], "path string")
    got = sorted((r.column, r.path.rsplit("/", 1)[1]) for r in mf.missing_inputs(m, catalog).collect())
    assert got == [("left_ld", "panel_chr1.bed"), ("right_ld", "panel_chr1.bed"),
                   ("right_sumstats", "Q1.parquet")]


def test_parse_variant_id_malformed_is_null(spark):
    df = spark.createDataFrame([("1_100_A_C",), ("X_notanint_G_T",), ("2_5",)], "v string")
    rows = {r.v: r for r in df.select("v", *parse_variant_id("v", "lead")).collect()}
    assert (rows["1_100_A_C"].lead_chrom, rows["1_100_A_C"].lead_pos) == ("1", 100)
    assert rows["X_notanint_G_T"].lead_pos is None and rows["X_notanint_G_T"].lead_alt == "T"
    assert rows["2_5"].lead_ref is None
    swapped = df.select(swap_separators("v").alias("s")).collect()
    assert swapped[0].s == "1:100:A:C"


def test_releases_merge_drift_and_audit(spark):
    prev = spark.createDataFrame([(1, 0.5, "x")], "left_pos int, coloc_h4 double, left_sumstat string")
    new = spark.createDataFrame([(2, 0.7)], "left_pos int, coloc_h4 double")
    merged = rl.merge_raw(prev, new).collect()
    assert len(merged) == 2 and {r.left_sumstat for r in merged} == {"x", None}
    with pytest.raises(Exception):
        rl.merge_processed(prev, new).collect()
    drift = rl.schema_drift(prev, new).collect()
    assert [(r.column, r.only_in) for r in drift] == [("left_sumstat", "previous")]
    audit = {r.source: r.n_rows for r in rl.merge_audit(prev, new).collect()}
    assert audit == {"previous": 1, "new": 1, "total": 2}


def test_log_parsing_errors_and_running_mean(spark):
    lines = spark.createDataFrame([
        ("a", 1, "INFO start"), ("a", 2, "INFO Time taken: 0:01:10.500000"), ("a", 3, "INFO Time taken: 9:00:00.0"),
        ("b", 1, "ERROR Cannot run coloc with no intersection"), ("b", 2, "ERROR GCTA failed"),
        ("c", 1, "INFO Time taken: 1:00:00.25")], "log_id string, line_no int, line string")
    secs = {r.log_id: r.seconds for r in lg.task_seconds(lines).collect()}
    assert secs == {"a": 70.5, "c": 3600.25}
    assert [r.line for r in lg.error_lines(lines).collect()] == ["ERROR GCTA failed"]
    seq = spark.createDataFrame([(10 * i, float(i)) for i in range(2500)], "log_id int, seconds double")
    rm = [(r.iteration, r.mean_seconds) for r in lg.running_mean(seq).orderBy("iteration").collect()]
    assert rm == [(1000, pytest.approx(sum(range(1000)) / 1000)), (2000, pytest.approx(sum(range(2000)) / 2000))]
    bad = spark.createDataFrame([("a", 1, "Time taken: soon"), ("a", 2, "Time taken: 0:00:02.0"), ("a", 3, "Time taken: 0:00:01.0")], lines.schema)
    assert [r.seconds for r in lg.task_seconds(bad).collect()] == [2.0]


def test_logs_keep_their_line_order(spark, tmp_path):
    (tmp_path / "x.txt").write_text("start\nTime taken: 0:09:00.0\nTime taken: 0:01:00.0\n")
    assert [r.seconds for r in lg.task_seconds(lg.read_logs(spark, f"{tmp_path}/*.txt")).collect()] == [540.0]


def test_ld_overlap_features_thresholds(spark):
    ids = {f"{s}_{c}": v for s in SIDES for c, v in zip(schemas.RESULT_ID_COLS,
                                                        ("gwas", "G1", None, None, "1", 100, "A", "C"))}
    rows = []
    for tag, (l, r) in enumerate([(1.0, 1.0), (0.5, 0.95), (0.05, 0.2)]):
        rows.append({**ids, "tag_chrom": "1", "tag_pos": tag, "tag_ref": "A", "tag_alt": "C",
                     "left_R2_EUR": l, "right_R2_EUR": r})
    names = list(rows[0])
    schema = ", ".join(f"{n} {'int' if n.endswith('_pos') else 'double' if n.endswith('R2_EUR') else 'string'}"
                       for n in names)
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    f = ft.ld_overlap_features(df).collect()[0].asDict()
    assert f["total_overlap"] == 3
    assert f["prop_overlap_0.1"] == pytest.approx(2 / 3)
    assert f["prop_overlap_0.5"] == pytest.approx(2 / 3)
    assert f["prop_overlap_0.6"] == pytest.approx(1 / 3)
    assert f["prop_overlap_1.0"] == pytest.approx(1 / 3)


def test_materialize_uses_checkpoint_dir(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    out = io.materialize(df, "unit")
    assert out.count() == 10
    assert io.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_window_anchor_left_cuts_right_side_around_left_lead(spark):
    from sharedsignal.operators import abf
    cols = [f"{s}_{c}" for s in SIDES for c in schemas.LOCUS_COLS]
    schema = ", ".join(f"{c} {'int' if c.endswith('_pos') else 'string'}" for c in cols)
    tests = spark.createDataFrame([("gwas", "G1", None, None, "1", 1_000_000, "A", "C",
                                    "eqtl", "Q1", "E1", "T1", "1", 1_400_000, "A", "C")], schema)
    ss_rows = [("G1", None, None, "1", p, "A", "C", 0.01, 0.01, 1e-3, 1000, None, 0.3, False)
               for p in (600_000, 1_000_000, 1_450_000)]
    ss_rows += [("Q1", "E1", "T1", "1", p, "A", "C", 0.01, 0.01, 1e-3, 1000, None, 0.3, False)
                for p in (600_000, 1_000_000, 1_450_000, 1_850_000)]
    ss = spark.createDataFrame(ss_rows, schemas.SUMSTATS)
    own = abf.prepare_signals(tests, ss, window_anchor="own")
    left = abf.prepare_signals(tests, ss, window_anchor="left")
    right_id_own = abf.with_test_ids(tests).first().right_signal_id
    right_id_left = abf.with_test_ids(tests, "left").first().right_signal_id
    assert sorted(r.pos for r in own.filter(F.col("signal_id") == right_id_own).collect()) == \
        [1_000_000, 1_450_000, 1_850_000]
    assert sorted(r.pos for r in left.filter(F.col("signal_id") == right_id_left).collect()) == \
        [600_000, 1_000_000, 1_450_000]
    n_own = abf.run_coloc(tests, own).first().nsnps
    n_left = abf.run_coloc(tests, left, window_anchor="left").first().nsnps
    assert (n_own, n_left) == (2, 3)


def _conditioning(spark, g, conds, f=None):
    """Statistics and a solve of one signal over genotypes g (samples x variants at 1000, 2000, ...)."""
    from sharedsignal.operators import conditional as cd
    n, v = g.shape
    rows = [(int(s), "1", 1000 * (k + 1), "A", "C", int(g[s, k])) for s in range(n) for k in range(v) if g[s, k] > 0]
    geno = spark.createDataFrame(rows, schemas.GENOTYPES)
    stats = spark.createDataFrame([(7, "1", 1000 * (k + 1), "A", "C", 0.05 * (k + 1), 0.02, 1e-3, 5000, None,
                                    float(f[k] if f else max(g[:, k].mean() / 2, 0.2)), False) for k in range(v)],
                                  "signal_id long, chrom string, pos int, ref string, alt string, beta double, se double, pval double, "
                                  "n_total int, n_cases int, eaf double, is_cc boolean")
    listed = spark.createDataFrame([(7, "1", 1000 * (k + 1), "A", "C") for k in conds],
                                   "signal_id long, cond_chrom string, cond_pos int, cond_ref string, cond_alt string")
    solved = cd.cojo_solve(stats, listed, geno, n)
    single = cd.cojo_single(stats, listed.limit(1), geno, n)
    rows = solved.collect()
    status = [tuple(r[c] for c in cd.STATUS_COLS) for r in rows if r.chrom is None]
    return status, {r.pos: r for r in rows if r.chrom is not None}, {r.pos: r for r in single.collect()}


def test_collinear_and_missing_conditions(spark):
    rng = np.random.default_rng(4)
    g = rng.integers(0, 3, size=(120, 7))
    g[:, 1] = g[:, 0]  # the same variant twice
    g[:, 6] = 0  # no genotypes
    # two perfectly correlated conditions: the first is used, as if it were alone; neither is reported
    status, both, one = _conditioning(spark, g, [0, 1])
    assert status == [(2, 2, 1, "collinear variants left out")]
    assert set(both) == {3000, 4000, 5000, 6000}
    for p in both:
        assert both[p].beta_cond == pytest.approx(one[p].beta_cond) and both[p].z_cond == pytest.approx(one[p].z_cond)
    status, some, one = _conditioning(spark, g, [2, 6])
    assert status == [(2, 1, 1, "variants without genotypes left out")]
    assert set(some) == {1000, 2000, 4000, 5000, 6000} and some[1000].beta_cond == pytest.approx(one[1000].beta_cond)
    status, none, _ = _conditioning(spark, g, [6])
    assert status == [(1, 0, 0, "no genotypes")] and none == {}
    status, fine, _ = _conditioning(spark, g, [2, 3])
    assert status == [(2, 2, 2, None)] and set(fine) == {1000, 2000, 5000, 6000}
    status, odd, _ = _conditioning(spark, g, [2], f=[0.3, 0.3, 0.0, 0.3, 0.3, 0.3, 0.3])
    assert status == [(1, 1, 0, "singular")] and odd == {}


def test_pivoted_choice_keeps_what_adds_information():
    from sharedsignal.operators.conditional import pivoted_choice
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 6))
    x[:, 2] = x[:, 0] + x[:, 1]
    x[:, 4] = -x[:, 3]
    r = np.corrcoef(x.T)
    chosen = pivoted_choice(r)
    assert chosen == [0, 1, 3, 5] or (len(chosen) == 4 and 5 in chosen and len({3, 4} & set(chosen)) == 1)
    assert pivoted_choice(np.eye(3)) == [0, 1, 2] and pivoted_choice(np.zeros((2, 2))) == []

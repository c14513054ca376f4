"""Queries whose rows per signal and variant, or per test and variant, stay inside the group of their region."""
import pandas as pd
import pytest

import __spark_entry__ as entry
from sharedsignal.operators import abf, conditional as cd, regions as rg, sumstats as sm
from sharedsignal.plans import catalog_more, jobs
from sharedsignal.sources import adapters as A
from sharedsignal.sources import io
from test_bounded_shuffles import SUMSTATS, _coloc_case, genotypes


@pytest.fixture(scope="session")
def tables(tmp_path_factory):
    """Driver tables of one chromosome's worth of parts: enough leads, tests and carriers for every step."""
    d = tmp_path_factory.mktemp("tables")
    n = 2600
    parts = [22 * (k % 130) for k in range(n)]
    pd.DataFrame({"l_orderkey": [k % 400 for k in range(n)], "l_partkey": parts, "l_suppkey": [(k * 7 + k // 130) % 12 for k in range(n)], "l_linenumber": [1 + (k * 5 + k // 7) % 7 for k in range(n)],
                  "l_quantity": [float(1 + (k * 13) % 50) for k in range(n)], "l_extendedprice": [float(3000 + (k * 7919) % 60000) for k in range(n)],
                  "l_discount": [0.01 * ((k * 31) % 11) for k in range(n)], "l_tax": [0.01 * ((k * 17) % 9) for k in range(n)]}).astype(
        {"l_linenumber": "int32"}).to_parquet(d / "lineitem.parquet")
    pd.DataFrame({"o_orderkey": range(400), "o_custkey": [(k * 3) % 150 for k in range(400)]}).to_parquet(d / "orders.parquet")
    jobs.clear_cache()
    return str(d)


@pytest.fixture
def written(monkeypatch):
    """Names of the scratch tables that are written."""
    names, write = [], io.materialize

    def noted(df, name):
        names.append(name)
        return write(df, name)

    for m in (abf, rg, catalog_more, jobs):
        monkeypatch.setattr(m, "materialize", noted)
    return names


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def ordered(df, digits=9):
    return sorted(tuple(f"{x:.{digits}g}" if isinstance(x, float) else str(x) for x in r) for r in df.collect())


@pytest.mark.parametrize("group_signals", [64, 1])
def test_shared_variants_come_from_the_groups(spark, group_signals, monkeypatch):
    monkeypatch.setattr(rg.window_shared, "__defaults__", (group_signals,))
    tests, ss = _coloc_case(spark)
    t = abf.distinct_tests(tests)
    want = abf.harmonise(t, abf.prepare_signals(tests, ss)).join(t, "test_id").select(*abf.results_naming(t), "chrom", "pos", "ref", "alt", "left_pval", "right_pval")
    got = abf.harmonise_windows(tests, ss)
    assert got.dtypes == want.dtypes and ordered(got) == ordered(want) and want.count() > 100
    assert abf.harmonise_windows(tests, ss.limit(0)).count() == 0


def test_harmonise_pair_joins_no_shared_variant(spark, tables):
    got = entry.queries()["harmonise_pair"](spark, tables)
    t, stats = catalog_more._tests_stats(spark, tables)
    want = abf.harmonise(t, stats).join(t, "test_id").select(*abf.results_naming(t), "chrom", "pos", "ref", "alt", "left_pval", "right_pval")
    assert got.count() == want.count() > 1000 and ordered(got) == ordered(want)
    assert not [x for x in plan(got).splitlines() if "Join " in x and "right_pval" in x or "Join " in x and "right_signal_id" in x]


def test_left_anchor_writes_no_row_per_signal_and_variant(spark, tables, written):
    got = entry.queries()["coloc_results_left_anchor"](spark, tables)
    assert "signal_stats_la" not in written and "group-signals" in written
    t = jobs.tests(spark, tables)
    want = abf.run_coloc(t, abf.prepare_signals(t, A.sumstats(spark, tables), window_anchor="left"), window_anchor="left")
    assert got.count() > 20 and ordered(got.drop(*[f"coloc_h{i}" for i in range(5)])) == ordered(want.drop(*[f"coloc_h{i}" for i in range(5)]))


def test_conditioning_by_region_gives_what_the_solver_gives(spark, tables):
    """Also the statistics that pass unconditioned, and no join makes a row per window variant and conditioning variant."""
    sig, ws, conds = catalog_more._cond_inputs(spark, tables)
    geno, n = A.genotypes(spark, tables), A.genotype_samples(spark, tables)
    solved = cd.cojo_solve(ws, conds, geno, n).localCheckpoint()
    merged = cd.merge_conditional(ws, solved.filter("chrom is not null").select(*cd.COJO_COLS)).join(sig, "signal_id").select(*catalog_more._MERGED)
    query = entry.queries()
    got = query["merge_conditional"](spark, tables)
    assert merged.count() > 300 and ordered(got, 5) == ordered(catalog_more.rounded(merged, catalog_more._MERGED_ROUND, catalog_more._COJO_DIGITS), 5)
    assert "cond_pos" not in plan(got) or not [x for x in plan(got).splitlines() if "Join " in x and "cond_pos" in x]
    status = cd.conditioning_status(sig, solved).select(*catalog_more._STATUS)
    assert status.filter("n_used > 0").count() > 5 and ordered(query["conditioning_status"](spark, tables)) == ordered(status)
    assert ordered(query["conditioning_failures"](spark, tables)) == ordered(status.filter("n_used = 0"))


@pytest.mark.parametrize("group_signals", [128, 1])
def test_solve_windows_of_odd_signals(spark, group_signals, monkeypatch):
    """Lists of several variants, without genotypes, collinear ones; a signal without a list, one without a position."""
    g, geno = genotypes(spark)
    double = geno.filter("pos = 3000").selectExpr("sample_id", "chrom", "25000 as pos", "ref", "alt", "dosage")  # variant 25 is variant 3 again
    geno = geno.union(double)
    ss = spark.createDataFrame([(s, None, None, "1", 1000 * k, "A", "C", 0.01 * ((k * 7 + len(s)) % 9 - 4), 0.02 + 0.001 * k, 10.0 ** -(k % 5), 5000, None, 0.1 + 0.03 * (k % 20), False)
                                for s in ("G1", "G2", "G3") for k in range(1, 28)], SUMSTATS)
    locus = "type string, study_id string, phenotype_id string, bio_feature string, lead_chrom string, lead_pos int, lead_ref string, lead_alt string"
    signals = spark.createDataFrame([(i, "gwas", s, None, None, c, p, "A", "C") for i, (s, c, p) in enumerate(
        [("G1", "1", 6000), ("G1", "1", 12000), ("G2", "1", 9000), ("G3", "1", 5000), ("G3", "1", None), ("G3", "2", 5000), ("G9", "1", 5)])], "signal_id long, " + locus)
    top = spark.createDataFrame([(s, None, None, "1", 1000 * k, "A", "C", 1e-3) for s, ks in (("G1", (2, 3, 6, 12, 25)), ("G2", (9, 27))) for k in ks],
                                "study_id string, phenotype_id string, bio_feature string, chrom string, pos int, ref string, alt string, pval double")
    ws = sm.signal_sumstats_join(signals, ss, 1000).select("signal_id", "lead_pos", *sm.STAT_COLS)
    conds, tops = cd.window_conditions(signals, ss, top)
    assert ordered(conds) == ordered(cd.condition_list(signals, ws, top))
    solved = cd.cojo_solve(ws.drop("lead_pos"), conds, geno, 300).localCheckpoint()
    solve = lambda stats, **k: cd.solve_windows(signals, conds, stats, geno, 300, group_signals=group_signals, **k)
    want = cd.merge_conditional(ws.drop("lead_pos"), solved.filter("chrom is not null").select(*cd.COJO_COLS)).select("signal_id", *sm.STAT_COLS, "z_cond")
    got = solve(ss, plain=True).localCheckpoint()
    assert dict(got.dtypes)["pos"] == "int"
    assert ordered(cd.solved_rows(got).filter("z_cond is not null"), 7) == ordered(want.filter("z_cond is not null"), 7) and want.count() > 30
    plain = cd.solved_rows(got).join(conds, "signal_id", "left_anti")
    assert ordered(plain.drop("z_cond")) == ordered(ws.join(conds, "signal_id", "left_anti").select("signal_id", *sm.STAT_COLS)) and plain.count() > 20
    status = solved.filter("chrom is null").select("signal_id", *cd.STATUS_COLS)
    for x in (got.filter("chrom is null"), solve(tops, rows=False)):
        assert ordered(x.select("signal_id", *cd.STATUS_COLS)) == ordered(status)
    assert {r.reason for r in status.collect()} == {"collinear variants left out", "no genotypes"}
    assert solve(ss, kept_window_kb=3).filter("signal_id = 0 and abs(pos - 6000) > 3000").count() == 0
    assert solve(ss.limit(0), plain=True).count() == 0 and solve(ss, rows=False).filter("chrom is not null").count() == 0

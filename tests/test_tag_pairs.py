"""Tags that leads share, tests whose signals have statistics, and tables that are made once."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sharedsignal.operators import betas as bt, features as ft, ld as ldm, sumstats as sm
from sharedsignal.plans import catalog
from test_bounded_shuffles import _coloc_case
from test_feature_groups import LD, _case
from test_region_queries import ordered, plan


@pytest.mark.parametrize("shares", [64, 1])
def test_shared_tags_come_from_the_groups(spark, shares):
    coloc, ld, _ = _case(spark)
    ld = ld.union(spark.createDataFrame([("1", 10, "A", "C", "1", 1, "G", "T", 0.5, 0.6), ("1", 20, "A", "C", "1", 3, "G", "T", 0.1, None), ("1", 20, "A", "C", None, 3, "G", "T", 0.1, 0.3)], LD))
    want = ft.ld_tag_intersection(ft.locus_ld_tags(coloc, ld, "left"), ft.locus_ld_tags(coloc, ld, "right"), coloc)
    got = ft.pair_tag_intersection(coloc, ld, shares)
    assert sorted(got.dtypes) == sorted(want.dtypes) and ordered(got.select(*want.columns)) == ordered(want) and want.count() > 10
    assert not [x for x in plan(got).splitlines() if "Join " in x and ("R2_EUR" in x or "tag_pos" in x)]
    assert ft.pair_tag_intersection(coloc, ld.limit(0)).count() == 0


@pytest.mark.parametrize("shares", [256, 2])
def test_linked_rows(spark, shares):
    """Leads of two chromosomes; tags far from their lead, without a position, repeated; a lead without tags."""
    rng = np.random.default_rng(4)
    leads = [("1" if k < 30 else "2", 150_000 * k, "A", "C") for k in range(40)]
    rows = [(*a, "1" if rng.random() < 0.5 else a[0], int(a[1] + 100_000 * rng.integers(-6, 7) + (5_000_000 if rng.random() < 0.1 else 0)), "G", "T", 0.5, 0.25)
            for a in leads[:-1] for _ in range(6)]
    rows += rows[:5] + [(*leads[0], "1", None, "G", "T", 0.5, 0.2), (*leads[3], "1", None, "G", "T", 0.5, 0.2)]
    weights = [(*a, int(rng.integers(0, 4)), int(rng.integers(0, 4))) for a in leads]
    tags = {}
    for r in rows:
        if r[5] is not None:
            tags.setdefault(r[:4], set()).add(r[4:8])
    want = sum(a[4] * b[5] for a in weights for b in weights if tags.get(a[:4], set()) & tags.get(b[:4], set()))
    w = spark.createDataFrame(weights, "chrom string, pos int, ref string, alt string, left_rows long, right_rows long")
    got = ft.linked_rows(spark.createDataFrame(rows, LD), w, shares)
    assert got.collect()[0].pairs == want > 0
    assert ft.linked_rows(spark.createDataFrame(rows, LD).limit(0), w).collect()[0].pairs == 0


def test_signals_with_statistics(spark):
    tests, ss = _coloc_case(spark)
    locus = "type string, study_id string, phenotype_id string, bio_feature string, lead_chrom string, lead_pos int, lead_ref string, lead_alt string"
    signals = spark.createDataFrame([(k, "gwas", s, p, None, c, x, "A", "C") for k, (s, p, c, x) in enumerate(
        [("G1", None, "1", 600_000), ("G1", None, "1", 3_500_000), ("G1", None, "1", 3_500_001), ("Q1", "P", "1", -500_000), ("Q1", "P", "1", -500_001), ("Q1", None, "1", 5),
         ("G1", None, "2", 5), ("G1", None, "1", None), ("G9", None, "1", 500_007), ("G9", None, "1", 500_008)])], "signal_id long, " + locus)
    want = sm.signal_stats(signals, ss).select("signal_id").distinct()
    got = sm.signals_with_stats(signals, ss)
    assert ordered(got.select("signal_id")) == ordered(want) and {r.signal_id for r in got.collect()} == {0, 1, 3, 8}
    assert "Generate" in plan(got) and "alt#" not in [x for x in plan(got).splitlines() if "LeftSemi" in x][0]


def test_results_for_betas_are_made_once(spark):
    _, ss = _coloc_case(spark)
    coloc = spark.createDataFrame([("1", 20_000, "A", "C", "G2", None, None, 7), ("9", 5, "A", "C", "G2", None, None, 8)],
                                  "left_chrom string, left_pos int, left_ref string, left_alt string, right_study string, right_phenotype string, right_bio_feature string, n int")
    counted = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda n: counted.add(1) or n, "int").asNondeterministic()
    got = bt.join_betas(coloc.withColumn("n", seen("n")), ss)
    assert {(r.n, r.left_var_right_study_beta) for r in got.collect()} == {(7, 0.1), (8, None)}
    assert counted.value == 2


def test_ld_text_is_made_of_pairs_above_the_limit(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(ldm, "ld_pairs", lambda *a, **k: asked.append(k) or (_ for _ in ()).throw(KeyError("stop")))
    monkeypatch.setattr(catalog.A, "genotype_samples", lambda *a: 1)
    monkeypatch.setattr(catalog.A, "genotypes", lambda *a: None)
    monkeypatch.setattr(catalog.jobs, "toploci_leads", lambda *a: None)
    with pytest.raises(KeyError):
        catalog.q_ld_scan(spark, "")
    assert asked == [{"min_r2": ldm.MIN_R2}]

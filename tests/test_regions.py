"""Overlaps and coloc by blocks of a chromosome: the same results, with shuffles that do not grow with shared variants."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sharedsignal import schemas
from sharedsignal.operators import abf, features as ft, overlap as ov, regions as rg, sumstats as sm

LOCUS = ("type", "study_id", "phenotype_id", "bio_feature", "lead_chrom", "lead_pos", "lead_ref", "lead_alt")
TESTS = ", ".join(f"{s}_{c} {'int' if c == 'lead_pos' else 'string'}" for s in ("left", "right") for c in LOCUS)
STATS = ("signal_id long, chrom string, pos int, ref string, alt string, beta double, se double, pval double, n_total int, "
         "n_cases int, eaf double, is_cc boolean")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hits_of_a_pair_lie_in_one_task(no_broadcast):
    spark = no_broadcast
    loci = [("gwas", "S1", None, None, "1", 500, "A", "C"), ("eqtl", "S2", "P", "T", "1", 900, "A", "C")]
    rows = [dict(zip([*schemas.LOCUS_COLS, *ov.TAG_COLS], (*k, "1", t, "A", "C"))) | {"is95_credset": True, "is99_credset": True,
            "multisignal_method": "conditional"} for k in loci for t in range(200)]
    df = spark.createDataFrame(rows, schemas.CREDSET)
    numbered, _ = ov.number_loci(ov.prepare_credset(df))
    pairs = ov.overlap_pairs(numbered)
    assert pairs.select(F.spark_partition_id()).distinct().count() == 1  # 200 hits, counted before any shuffle
    assert [r.num_overlapping for r in ov.overlap_counts(pairs).collect()] == [200]
    assert [(r.num_overlapping, r.left_num_tags) for r in ov.find_overlaps(df).collect()] == [(200, 200)]


def _case(spark):
    """Five tests over three regions; constants that vary in one signal, a repeated row, values without a factor."""
    locus = lambda k, study, pos: (k, study, None, None, "1", pos, "A", "C")
    pairs = [(locus("gwas", "G1", 1000), locus("eqtl", "Q1", 1500)), (locus("gwas", "G2", 1200), locus("eqtl", "Q1", 1500)),
             (locus("gwas", "G1", 1000), locus("gwas", "G2", 1200)), (locus("gwas", "G3", 2_000_100), locus("eqtl", "Q2", 2_000_000)),
             (locus("gwas", "G4", None), locus("eqtl", "Q1", 1500))]
    tests = spark.createDataFrame([a + b for a, b in pairs], TESTS)
    ids = {r.left_study_id: r.left_signal_id for r in abf.with_test_ids(tests).collect()}
    ids |= {r.right_study_id: r.right_signal_id for r in abf.with_test_ids(tests).collect()}
    rng, rows = np.random.default_rng(3), []
    for study, n, nc, cc in (("G1", 5000, None, False), ("G2", 3000, 900, True), ("Q1", 800, None, False), ("G3", 700, 50, True),
                             ("Q2", 900, None, None), ("G4", None, None, None)):
        base = 2_000_000 if study in ("G3", "Q2") else 990
        for i in range(30):
            p = [0.0, float("nan"), None][i - 3] if 3 <= i < 6 and study == "G2" else float(10 ** -rng.uniform(0, 10))
            rows.append((ids[study], "1", base + i, "A", "C" if i % 7 else "GT", 0.1, 0.01, p,
                         n - i if study == "G3" else n, nc, None if i == 9 else float(rng.uniform(0.01, 0.99)), cc))
    rows.append(rows[5])
    rows.append((ids["Q1"], None, 991, "A", "C", 0.1, 0.01, 0.5, 800, None, 0.2, False))
    return tests, spark.createDataFrame(rows, STATS)


@pytest.mark.parametrize("most", [1, 256])
def test_groups_give_what_rows_of_tests_and_variants_give(spark, most):
    tests, stats = _case(spark)
    t = abf.with_test_ids(tests)
    shared = abf.harmonise(t, stats)
    want = {r.test_id: r for r in abf.coloc_posteriors(shared).collect()}
    pre = abf.with_z(stats.withColumn("maf", abf.eaf_to_maf(F.col("eaf"))))
    got = {r.test_id: r for r in abf.posteriors_from_sums(rg.test_sums(t, pre, most)).collect()}
    assert set(got) == set(want) and len(got) == 4
    for k, r in want.items():
        assert got[k].nsnps == r.nsnps
        assert [got[k][f"coloc_h{i}"] for i in range(5)] == pytest.approx([r[f"coloc_h{i}"] for i in range(5)], rel=1e-12)
    ordered = lambda df: sorted(map(tuple, df.collect()), key=str)
    first = rg.first_constants(t, pre, most)
    assert ordered(abf.side_constants(shared)) == ordered(abf.test_constants(t, stats))
    assert first.count() == 5


def test_no_join_of_tests_on_variants(no_broadcast):
    tests, stats = _case(no_broadcast)
    for df in (abf.run_coloc(tests, stats), abf.test_constants(abf.with_test_ids(tests), stats)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins = [x for x in plan.splitlines() if "Join Inner" in x]
        assert joins and not [x for x in joins if "(pos" in x] and "Window" not in plan


def test_codes_are_read_back():
    for chrom, ref, alt in (("1", "A", "C"), ("", "1:A", "2"), ("X:1", "", "")):
        assert rg.variant_text(f"{len(chrom)}:{chrom}{len(ref)}:{ref}{alt}", 5) == f"{chrom}:5:{ref}:{alt}"


def test_pairs_of_leads_meet_by_region(no_broadcast):
    spark = no_broadcast
    tags = spark.createDataFrame([(i, [10, 11, 12 + i], [3, 14, 1]) for i in range(6)], "lead long, tags array<long>, codes array<int>")
    pairs = spark.createDataFrame([(i, j, "1", i * 700_000) for i in range(7) for j in range(7)] + [(0, 1, "1", 0)],
                                  "left_lead long, right_lead long, left_chrom string, left_pos long")
    df = ft.pair_overlaps(pairs, tags)
    got = {(r.left_lead, r.right_lead): (r.total_overlap, r["prop_overlap_0.3"], r["prop_overlap_0.4"]) for r in df.collect()}
    assert len(got) == 36 == df.count()  # lead 6 has no tags
    assert got[0, 1] == (2, 1.0, 0.5) and got[2, 2] == (3, pytest.approx(2 / 3), pytest.approx(1 / 3))
    joins = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x]
    assert joins and not [x for x in joins if "left_lead" in x or "right_lead" in x]  # tags are not copied to every pair


def test_named_statistics_need_no_join_back(no_broadcast):
    _, stats = _case(no_broadcast)
    signals = no_broadcast.createDataFrame([(1, "gwas", "G1", None, None, "1", 1000, "A", "C")], "signal_id long, " + ", ".join(
        f"{c} {'int' if c == 'lead_pos' else 'string'}" for c in LOCUS))
    ss = stats.drop("signal_id").withColumns({"study_id": F.lit("G1"), "phenotype_id": F.lit(None).cast("string"), "bio_feature": F.lit(None).cast("string")})
    df = sm.signal_stats(signals, ss, 500, named=True)
    assert df.columns == ["signal_id", *sm.SIGNAL_COLS, *sm.STAT_COLS] and df.count() == sm.signal_stats(signals, ss, 500).count() > 0
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1

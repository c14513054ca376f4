"""LD, conditioning and coloc of many variants: the same results without a shuffled row per pair of variants or per signal and variant."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sharedsignal.operators import abf, conditional as cd, ld as ldm, regions as rg

GENO = "sample_id bigint, chrom string, pos int, ref string, alt string, dosage int"
STATS = ("signal_id long, chrom string, pos int, ref string, alt string, beta double, se double, pval double, n_total int, "
         "n_cases int, eaf double, is_cc boolean")


def genotypes(spark, n=300, v=24, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 3, n)
    g = np.stack([np.where(rng.random(n) < rng.random(), base, rng.integers(0, 3, n) * (rng.random(n) < 0.4)) for _ in range(v)], 1)
    return g, spark.createDataFrame([(s, "1", 1000 * (k + 1), "A", "C", int(g[s, k])) for s in range(n) for k in range(v) if g[s, k]], GENO)


@pytest.mark.parametrize("block_lanes", [1024, 1])
def test_pairs_below_the_limit_leave_no_row(spark, block_lanes):
    g, geno = genotypes(spark)
    leads = spark.createDataFrame([("1", 1000 * k, "A", "C") for k in range(1, 25)], "lead_chrom string, lead_pos int, lead_ref string, lead_alt string")
    key = lambda df: {(r.lead_pos, r.tag_pos): r.R2_EUR for r in df.collect()}
    every = ldm.ld_pairs(geno, leads, 300, window_kb=15, block_lanes=block_lanes)
    some = ldm.ld_pairs(geno, leads, 300, window_kb=15, block_lanes=block_lanes, min_r2=0.3)
    want = {k: x for k, x in key(every).items() if x >= 0.3}
    assert key(ldm.ld_r2_filter(some, 0.3)) == want and 24 <= len(want) < every.count()
    if block_lanes == 1024:  # one block: nothing else is sent
        assert key(some) == want


@pytest.mark.parametrize("shares", [256, 1])
def test_single_conditions_by_region(spark, shares, monkeypatch):
    monkeypatch.setattr(cd.single_conditions, "__defaults__", (4000, shares))
    g, geno = genotypes(spark)
    rng = np.random.default_rng(2)
    stats = spark.createDataFrame(
        [(s, "1", 1000 * k, "A", "C", float(rng.normal(0, 0.1)), 0.02, 1e-3, 5000 + s, None, float(rng.uniform(0.1, 0.9)), False)
         for s in (1, 2, 3, 4) for k in range(1, 27)], STATS)  # variants 25 and 26 have no genotypes
    conds = spark.createDataFrame([(1, "1", 5000, "A", "C"), (2, "1", 9000, "A", "C"), (3, "1", 26000, "A", "C"), (4, "1", 5000, "A", "C"), (4, "1", 7000, "A", "C"),
                                   (5, "1", 5000, "A", "C")], "signal_id long, cond_chrom string, cond_pos int, cond_ref string, cond_alt string")
    out = cd.cojo_single(stats, conds, geno, 300, window_kb=10)
    got = {(r.signal_id, r.pos): r for r in out.collect()}
    assert got and {k[0] for k in got} == {1, 2}  # 3: no genotypes, 4: two conditions, 5: no statistics
    assert dict(out.dtypes)["pos"] == "int"
    held = stats.collect()
    for (s, p), r in got.items():
        at = 5000 if s == 1 else 9000
        rows = {x.pos: x for x in held if x.signal_id == s and x.pos <= 24000 and abs(x.pos - at) <= 10_000}
        n = 5000 + s
        d = {q: 2 * x.eaf * (1 - x.eaf) * n for q, x in rows.items()}
        yy = np.median([d[q] * x.se ** 2 * (n - 1) + d[q] * x.beta ** 2 for q, x in rows.items()])
        c = n * 2 * np.sqrt(d[p] / 2 / n * d[at] / 2 / n) * np.corrcoef(g[:, p // 1000 - 1], g[:, at // 1000 - 1])[0, 1]
        b = rows[p].beta - c / d[p] * rows[at].beta
        s2 = (yy - d[at] * rows[at].beta ** 2 - d[p] * rows[p].beta * b) / (n - 2)
        assert r.beta_cond == pytest.approx(b, rel=1e-9)
        assert r.se_cond == pytest.approx(np.sqrt(s2 * (d[p] - c * c / d[at]) / d[p] ** 2), rel=1e-9)


def test_repeated_conditioning_rows_multiply(spark):
    g, geno = genotypes(spark)
    row = lambda k: (1, "1", 1000 * k, "A", "C", 0.01 * k, 0.02, 1e-3, 5000, None, 0.3, False)
    stats = spark.createDataFrame([row(k) for k in (1, 2, 3, 4, 4)], STATS)
    conds = spark.createDataFrame([(1, "1", 4000, "A", "C")], "signal_id long, cond_chrom string, cond_pos int, cond_ref string, cond_alt string")
    got = sorted(r.pos for r in cd.cojo_single(stats, conds, geno, 300).collect())
    assert got and all(got.count(p) == 2 for p in got) and 4000 not in got
    assert cd.cojo_single(stats, conds, geno.limit(0), 300).count() == 0 and cd.cojo_single(stats.filter("pos < 4000"), conds, geno, 300).count() == 0


LOCUS = ("type", "study_id", "phenotype_id", "bio_feature", "lead_chrom", "lead_pos", "lead_ref", "lead_alt")
TESTS = ", ".join(f"{s}_{c} {'int' if c == 'lead_pos' else 'string'}" for s in ("left", "right") for c in LOCUS)
SUMSTATS = "study_id string, phenotype_id string, bio_feature string, " + STATS.removeprefix("signal_id long, ")


def _coloc_case(spark):
    """Overlapping windows, statistics on their very edge, repeated and incomplete rows, constants that vary between blocks."""
    rng = np.random.default_rng(8)
    rows = []
    for study, ph, n, nc, cc in (("G1", None, 5000, None, False), ("G2", None, 3000, 900, True), ("Q1", "P", 800, None, None), ("Q1", "R", 700, 50, True)):
        for pos in [*range(0, 3_000_001, 20_000), 1_100_000, 1_100_001]:
            p = [0.0, float("nan"), None][pos // 20_000 - 40] if 40 <= pos // 20_000 < 43 and study == "G2" else float(10 ** -rng.uniform(0, 6))
            eaf = None if pos == 500_000 else float("nan") if pos == 520_000 else float(rng.uniform(0, 1))
            rows.append((study, ph, None, "1", pos, "A", "C" if pos % 60_000 else "GT", 0.1, 0.01, p, n - (pos > 1_000_000) * (ph == "R"), nc, eaf, cc))
    rows += rows[5:9] + [("G1", None, None, None, 400_000, "A", "C", 0.1, 0.01, 0.1, 5000, None, 0.2, False),
                         ("G1", None, None, "1", None, "A", "C", 0.1, 0.01, 0.1, 5000, None, 0.2, False), ("G9", None, None, "1", 7, "A", "C", 0.1, 0.01, 0.1, 5000, None, 0.2, False)]
    locus = lambda k, study, ph, pos, chrom="1": (k, study, ph, None, chrom, pos, "A", "C")
    pairs = [(locus("gwas", "G1", None, a), locus("gwas", "G2", None, b)) for a in (600_000, 750_000, 1_600_000) for b in (600_001, 900_000)]
    pairs += [(locus("gwas", "G1", None, 600_000), locus("eqtl", "Q1", x, y)) for x in ("P", "R") for y in (600_000, 1_000_000)]
    pairs += [(locus("gwas", "G2", None, 2_900_000), locus("eqtl", "Q1", "R", 2_900_000)), (locus("gwas", "G1", None, None), locus("eqtl", "Q1", "P", 5)),
              (locus("gwas", "G3", None, 5), locus("eqtl", "Q1", "P", 5)), (locus("gwas", "G1", None, 5, "2"), locus("eqtl", "Q1", "P", 5, "2"))]
    return spark.createDataFrame([a + b for a, b in pairs], TESTS), spark.createDataFrame(rows, SUMSTATS)


@pytest.mark.parametrize("anchor,group_signals", [("own", 256), ("own", 1), ("left", 256)])
def test_windows_cut_in_groups_give_what_prepared_signals_give(spark, anchor, group_signals, monkeypatch):
    monkeypatch.setattr(rg.window_sums, "__defaults__", (group_signals,))
    tests, ss = _coloc_case(spark)
    key = lambda df: {(r.left_study, r.left_pos, r.right_study, r.right_phenotype, r.right_pos): r for r in df.collect()}
    want = key(abf.run_coloc(tests, abf.prepare_signals(tests, ss, window_anchor=anchor), window_anchor=anchor))
    got = key(abf.run_coloc_windows(tests, ss, window_anchor=anchor))
    assert set(got) == set(want) and len(got) >= 9
    for k, r in want.items():
        assert got[k].nsnps == r.nsnps
        assert [got[k][f"coloc_h{i}"] for i in range(5)] == pytest.approx([r[f"coloc_h{i}"] for i in range(5)], rel=1e-12)
    assert abf.run_coloc_windows(tests, ss.limit(0), window_anchor=anchor).count() == 0


def test_blocks_hold_each_statistic_once(spark):
    tests, ss = _coloc_case(spark)
    signals = abf.signals_with_ids(tests).filter("lead_chrom is not null")
    tracks = rg.dictionary(signals, ["study_id", "phenotype_id", "bio_feature", "lead_chrom"], "track")
    blocks = rg.window_blocks(abf.with_z(ss.withColumn("maf", abf.eaf_to_maf(F.col("eaf")))), tracks, 250_000)
    assert blocks.agg(F.sum(F.size("pos"))).first()[0] == ss.filter("study_id <> 'G9' and chrom is not null and pos is not null").count()


def test_carriers_without_a_sample_id(spark):
    """They are a block of their own: pairs of variants that both have such carriers occur twice, as ``ld_pairs`` gives them."""
    g, geno = genotypes(spark)
    geno = geno.union(spark.createDataFrame([(None, "1", 1000 * k, "A", "C", 1) for k in (4, 6)], GENO))
    stats = spark.createDataFrame([(1, "1", 1000 * k, "A", "C", 0.01 * k, 0.02, 1e-3, 5000, None, 0.3, False) for k in range(1, 10)], STATS)
    conds = spark.createDataFrame([(1, "1", 4000, "A", "C")], "signal_id long, cond_chrom string, cond_pos int, cond_ref string, cond_alt string")
    c1 = cd.single_conditions(conds)
    got = sorted((r.pos, r.r) for r in cd.with_single_r(stats.join(c1, "signal_id"), c1, geno, 300, 4000).collect())
    pairs = ldm.ld_pairs(geno, conds.select(*[F.col(f"cond_{c}").alias(f"lead_{c}") for c in cd.VAR]), 300).filter("tag_pos < 10000")
    want = sorted((r.tag_pos, r.R_EUR) for r in pairs.collect())
    assert [p for p, _ in got] == [p for p, _ in want] == [1000, 2000, 3000, 4000, 4000, 5000, 6000, 6000, 7000, 8000, 9000]
    assert [r for _, r in got] == pytest.approx([r for _, r in want], rel=1e-12)


def test_stored_statistics_are_not_shuffled_again(spark):
    """Rows leave the range join as they are written; a bucket of several files is read whole, each signal in one task."""
    from sharedsignal.operators.store import new_store
    from sharedsignal.sources.io import scratch_root

    tests, ss = _coloc_case(spark)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")
    old = [spark.conf.get(x) for x in names]
    for x, value in zip(names, ("-1", "false")):
        spark.conf.set(x, value)
    try:
        store, signals = new_store(scratch_root(spark), buckets=2), abf.signals_with_ids(tests)
        plan = store.prepared(signals, ss, "run")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join") == 1 and "Repartition" not in plan
        store.prepare(signals.filter("lead_pos % 3 = 0"), ss, "one")
        store.prepare(signals, ss, "two")
        assert len(store.stats(spark).inputFiles()) > 4
        assert store.stats(spark).groupBy("signal_id").count()._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
    finally:
        for x, value in zip(names, old):
            spark.conf.set(x, value)
    ordered = lambda df: sorted(map(str, df.drop(*[f"coloc_h{i}" for i in range(5)]).collect()))
    want = abf.run_coloc(tests, abf.prepare_signals(tests, ss))
    got = abf.run_coloc(tests, store.stats(spark))
    assert ordered(got) == ordered(want) and want.count() >= 9
    assert "Aggregate [left_type" not in got._jdf.queryExecution().optimizedPlan().toString()  # the distinct tests are written once


def test_signal_arrays_are_in_order_of_position(spark):
    _, ss = _coloc_case(spark)
    pre = abf.with_z(ss.withColumns({"maf": abf.eaf_to_maf(F.col("eaf")), "signal_id": F.xxhash64("study_id", "phenotype_id")}))
    rows = rg.signal_arrays(pre.repartition(5)).collect()
    assert rows and all(r.pos == sorted(r.pos) and len(r.pos) == len(r.z) == len(r.code) for r in rows)

"""Features of tested pairs: made where the pair's group is, so neither pairs nor tags are shuffled to be joined."""

import pytest

from sharedsignal.operators import features as ft
from sharedsignal.operators import regions as rg
from sharedsignal.schemas import RESULT_ID_COLS

KINDS = ", ".join(f"{s}_{c} {'bigint' if c == 'pos' else 'string'}" for s in ("left", "right") for c in RESULT_ID_COLS)
LD = ("lead_chrom string, lead_pos int, lead_ref string, lead_alt string, tag_chrom string, tag_pos int, tag_ref string, tag_alt string, "
      "R_EUR double, R2_EUR double")
TOP = "study_id string, phenotype_id string, bio_feature string, chrom string, pos int, ref string, alt string, pval double"


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _case(spark):
    locus = lambda study, pos, kind="gwas", ph=None: (kind, study, ph, None, "1", pos, "A", "C")
    pairs = [(locus("A", 10), locus("B", 20)), (locus("A", 10), locus("B", 30)), (locus("A", 10), locus("Q", 20, "eqtl", "P")),
             (locus("A", None), locus("B", 20)), (locus("A", 3_000_000), locus("B", 20)), (locus("C", 10), locus("B", 20)),
             (locus("A", 10, None), locus("B", 20)), (locus("A", 10), locus("B", 20))]
    coloc = spark.createDataFrame([(*a, *b, 500, 0.1, 0.8, float(k)) for k, (a, b) in enumerate(pairs)],
                                  KINDS + ", coloc_n_vars int, coloc_h3 double, coloc_h4 double, coloc_log2_h4_h3 double")
    tag = lambda lead, t, r2: ("1", lead, "A", "C", "1", t, "G", "T", 0.5, r2)
    ld = spark.createDataFrame([tag(10, 1, 0.5), tag(10, 2, 0.2), tag(10, 3, 1.0), tag(20, 1, 0.4), tag(20, 3, 1.0), tag(20, 9, 0.9), tag(30, 8, 0.9),
                                tag(3_000_000, 3, 0.95)], LD)
    top = spark.createDataFrame([("A", None, None, "1", 10, "A", "C", 1e-5), ("A", None, None, "1", 10, "A", "C", 1e-7), ("B", None, None, "1", 20, "A", "C", 1e-3),
                                 ("B", None, None, "1", 30, "A", "C", 1e-3), ("Q", "P", None, "1", 20, "A", "C", 1e-4), ("A", None, None, "1", 3_000_000, "A", "C", 1e-2)], TOP)
    return coloc, ld, top


@pytest.mark.parametrize("shares", [256, 1])
def test_features_by_group(spark, shares, monkeypatch):
    monkeypatch.setattr(ft.with_pair_features, "__defaults__", (shares, 2))
    coloc, ld, top = _case(spark)
    c = ft.with_pair_features(coloc.filter("left_type = 'gwas' or left_type is null"), ld, top).collect()
    got = {}
    for r in c:
        got.setdefault(int(r.coloc_log2_h4_h3), []).append(r)
    assert {k: len(v) for k, v in got.items()} == {0: 2, 1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 6: 2, 7: 2}
    assert all(got[k][0].total_overlap is None and got[k][0].left_is_gwas is None for k in (1, 3, 5))  # no shared tag, no position, no top locus
    for k in (0, 7):
        r = got[k][0]
        assert (r.total_overlap, r["prop_overlap_0.4"], r["prop_overlap_0.5"], r.left_num_tags, r.right_num_tags) == (2, 1.0, 0.5, 6, 3)  # two left types
        assert sorted(x.left_log_pval for x in got[k]) == pytest.approx([5, 7]) and r.right_log_pval == pytest.approx(3)
        assert (r.left_prop_total_overlap, r.abs_distance, r.left_is_gwas, r.right_is_gwas) == (pytest.approx(1 / 3), 10, 1, 1)
    assert got[2][0].right_log_pval == pytest.approx(4) and got[2][0].right_is_gwas == 0
    assert (got[4][0].total_overlap, got[4][0].abs_distance, got[4][0]["prop_overlap_0.95"], got[4][0]["prop_overlap_0.975"]) == (1, 2_999_980, 1.0, 0.0)
    for a, b in ((ld.limit(0), top), (ld, top.limit(0))):
        x = ft.build_features(a, coloc, top if b is top else b)
        assert x.count() == 7 and x.filter("total_overlap is not null").count() == 0
    assert ft.build_features(ld, coloc.limit(0), top).count() == 0


def test_pairs_are_not_joined_and_tags_get_no_ids(no_broadcast):
    coloc, ld, top = _case(no_broadcast)
    plan = ft.build_features(ld, coloc, top)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [x for x in plan if "Join " in x]
    assert joins and not [x for x in joins if "left_study" in x or "left_pos" in x or "left_lead#" in x or "tag_pos" in x or "__k_tag_pos" in x]


def test_sizes_of_regions_are_written(no_broadcast):
    """Their exact size is known before the tests are joined with them."""
    t = no_broadcast.createDataFrame([(k, k % 5, k % 7, "1", k * 100_000) for k in range(60)], "test_id long, left_signal_id long, right_signal_id long, left_lead_chrom string, left_lead_pos long")
    for n, groups in ((256, 3), (1, 60)):
        x = rg.with_groups(t, n)
        assert x.count() == 60 and "Aggregate" not in x._jdf.queryExecution().optimizedPlan().toString()
        assert 3 <= x.select("group").distinct().count() <= groups

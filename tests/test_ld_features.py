"""Dense dictionaries, blocked LD products and threshold-coded LD features against direct loops."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from sharedsignal import schemas
from sharedsignal.operators import features as ft
from sharedsignal.operators import ld as ldm
from sharedsignal.operators.dictionary import dictionary, encode
from sharedsignal.schemas import RESULT_ID_COLS


def test_dictionary_is_dense_and_null_safe(spark):
    rows = [(k % 70, None if k % 7 == 0 else f"v{k % 5}") for k in range(500)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(13)
    ids = dictionary(df, ["a", "b"], "id")
    got = [(r.a, r.b, r.id) for r in ids.collect()]
    assert sorted(i for *_, i in got) == list(range(len(set(rows))))
    assert {(a, b) for a, b, _ in got} == set(rows)
    known = {(a, b): i for a, b, i in got}
    out = encode(df.withColumnRenamed("b", "c"), ids, {"a": "a", "c": "b"}, "id")
    assert out.columns == ["a", "c", "id"] and all(known[r.a, r.c] == r.id for r in out.collect()) and out.count() == 500
    assert dictionary(df.limit(0), ["a"], "id").count() == 0


@pytest.mark.parametrize("block_lanes,names", [(1024, False), (1, False), (2, True)])
def test_blocked_ld_equals_numpy(spark, block_lanes, names):
    rng = np.random.default_rng(3)
    n, v = 300, 40
    g = rng.integers(0, 3, size=(n, v)) * (rng.random((n, v)) < rng.random(v))
    pos = np.sort(rng.choice(4000, v, replace=False)) * 10
    rows = [(f"s{s}" if names else int(s), "1" if k % 5 else "2", int(pos[k]), "A", "C", int(g[s, k])) for s in range(n) for k in range(v) if g[s, k]]
    kind = "sample_id string" if names else "sample_id bigint"
    geno = spark.createDataFrame(rows, f"{kind}, chrom string, pos int, ref string, alt string, dosage int")
    asked = [0, 3, 4, 5, 20, v - 1]
    leads = spark.createDataFrame([("1" if k % 5 else "2", int(pos[k]), "A", "C") for k in asked] + [("1", 5, "A", "C")],
                                  "lead_chrom string, lead_pos int, lead_ref string, lead_alt string")
    got = {(r.lead_pos, r.tag_pos): r.R_EUR for r in ldm.ld_pairs(geno, leads, n, window_kb=8, block_lanes=block_lanes).collect()}
    want = {}
    for a, b in itertools.product(asked, range(v)):
        if g[:, a].any() and g[:, b].any() and bool(a % 5) == bool(b % 5) and abs(pos[a] - pos[b]) <= 8000:
            want[int(pos[a]), int(pos[b])] = np.corrcoef(g[:, a], g[:, b])[0, 1]
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-12) for k in want)


ID = dict(type="gwas", study="S", phenotype=None, bio_feature=None, chrom="1", pos=0, ref="A", alt="C")


def loops(pairs, ld):
    """Features by the definition: all tag rows of both leads, joined on the tag."""
    out = {}
    for left, right in pairs:
        own = [[(r[4:8], r[8]) for r in ld if r[:4] == tuple(x[k] for k in ("chrom", "pos", "ref", "alt"))] for x in (left, right)]
        both = [(a, b) for t, a in own[0] for u, b in own[1] if t == u]
        if both:
            base = sum(a is not None for a, _ in both)
            hit = lambda t: sum(a is not None and b is not None and a >= t and b >= t for a, b in both)
            out[left["study"], left["pos"], right["study"], right["pos"]] = (
                hit(0), [hit(t) / base if base else None for t in ft.R2_THRESHOLDS], len(own[0]), len(own[1]))
    return out


def test_threshold_codes_equal_loops(spark):
    rng = np.random.default_rng(8)
    levels = [None, 0.0, 0.05, *ft.R2_THRESHOLDS, 0.4999999]
    ld = [("1", int(p), "A", "C", "1", int(t), "A", "G", levels[rng.integers(len(levels))]) for p in range(0, 60, 10) for t in range(40)
          if rng.random() < 0.4]
    ld += ld[:7] + [(*ld[0][:8], 0.33)]  # repeated tags of a lead
    loci = [{**ID, "study": f"S{k % 3}", "phenotype": None if k % 2 else "P", "pos": 10 * (k % 7), "type": "gwas" if k < 9 else "eqtl"} for k in range(14)]
    pairs = [(a, b) for a in loci[:9] for b in loci if a["study"] != b["study"]]
    names = [f"{s}_{c}" for s in ("left", "right") for c in RESULT_ID_COLS]
    kinds = ", ".join(f"{n} {'int' if n.endswith('pos') else 'string'}" for n in names)
    rows = [tuple(x[c] for x in p for c in RESULT_ID_COLS) for p in pairs]
    coloc = spark.createDataFrame([(*r, 500, 0.1, 0.8, 1.5) for r in [*rows, rows[0]]],
                                  kinds + ", coloc_n_vars int, coloc_h3 double, coloc_h4 double, coloc_log2_h4_h3 double")
    table = spark.createDataFrame([(*r[:8], 0.1, r[8]) for r in ld], schemas.LD if hasattr(schemas, "LD") else
                                  "lead_chrom string, lead_pos int, lead_ref string, lead_alt string, tag_chrom string, tag_pos int, "
                                  "tag_ref string, tag_alt string, R_EUR double, R2_EUR double")
    top = spark.createDataFrame([(x["study"], x["phenotype"], x["bio_feature"], x["chrom"], x["pos"], x["ref"], x["alt"], 1e-5 if k else 0.0)
                                 for k, x in enumerate({(y["study"], y["phenotype"], y["pos"]): y for y in loci if y["pos"] != 50}.values())],
                                "study_id string, phenotype_id string, bio_feature string, chrom string, pos int, ref string, alt string, pval double")
    want = loops(pairs, ld)
    got = ft.locus_pair_overlaps(coloc, table).collect()
    for r in got:
        total, props, *_ = want[r.left_study, r.left_pos, r.right_study, r.right_pos]
        assert r.total_overlap == total and [r[f"prop_overlap_{t}"] for t in ft.R2_THRESHOLDS] == pytest.approx(props)
    assert {(r.left_study, r.left_pos, r.right_study, r.right_pos) for r in got} == want.keys()
    full = ft.build_features(table, coloc, top)
    assert full.count() == len(rows) + 1  # the repeated outcome keeps its row
    for r in full.collect():
        key = r.left_study, r.left_pos, r.right_study, r.right_pos
        assert (r.total_overlap is None) == (key not in want or 50 in (r.left_pos, r.right_pos))
        if r.total_overlap is not None:
            # types are not in the key of the number of tags: a locus with two types counts twice
            assert r.left_num_tags % want[key][2] == 0 and r.left_prop_total_overlap == pytest.approx(want[key][0] / r.left_num_tags)
    slow = ft.feature_match_counts(ft.build_features(table, coloc.distinct(), top, all_pairs=True)).first()
    assert tuple(ft.match_counts(table, coloc.distinct(), top).first()) == tuple(slow)
    shared = ft.ld_tag_intersection(ft.locus_ld_tags(coloc, table, "left"), ft.locus_ld_tags(coloc, table, "right"), coloc)
    legacy = ft.ld_tag_intersection(ft.locus_ld_tags(coloc, table, "left"), ft.locus_ld_tags(coloc, table, "right"), None)
    columns = sorted(legacy.columns)
    legacy = ft.join_null_safe(legacy, coloc.select(*ft.ID16).distinct(), ft.ID16)
    rows_of = lambda d: sorted(map(str, d.select(*columns).collect()))
    assert rows_of(shared) == rows_of(legacy)
    assert shared.agg(F.count("*")).first()[0] > 0

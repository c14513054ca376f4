"""Query catalogue, part 2: joins, aggregates, windows, set operations, LD,
features, conditional analysis, models and logs (SURVEY 2.3-2.8)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.stats import eaf_to_maf_sql, log_abf_sql, z_from_pval_sql
from ..operators import abf, betas as bt, conditional as cd, features as ft, impute as im
from ..operators import ld as ldm, logs as lg, manifest as mf, overlap as ov, releases as rl, results as rs
from ..operators import sumstats as sm
from ..operators.windows import keep_first
from ..schemas import LOCUS_COLS, RESULT_ID_COLS
from ..sources import adapters as A
from ..sources.io import materialize
from . import jobs, oracle as O
from .adapters_sql import register, with_adapters
from .catalog import MV, PP, PROC_COLS, PROC_ROUND, RATIO_ROUND, SIGSTAT_COLS, SS_COLS, _ratio, \
    _signal_stats_named, _sym
from .registry import query, rounded, rounded_sql

S = with_adapters
SIDES = ("left", "right")
RES16 = O.RES16
LOC16 = O.LOC16
ID7 = {s: [f"{s}_{c}" for c in RESULT_ID_COLS if c != "type"] for s in SIDES}


def nse_cols(a, b, cols):
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def q(c):
    return f'"{c}"'


# ============================================================================
# 2.3 joins
# ============================================================================

def _prepared(spark, d):
    return ov.prepare_credset(A.credset(spark, d))


@query("overlap_join", S("SELECT left_key, right_key FROM overlap_hits", "overlap_hits"))
def q_overlap_join(spark, d):
    """Oriented tag hits (GWAS side x all, rewritten upper triangle)."""
    return ov.overlap_pairs(ov.number_loci(_prepared(spark, d))[0]).select("left_key", "right_key")


@query("overlap_distance", S("""SELECT l.key AS left_key, r.key AS right_key FROM cs95 l JOIN cs95 r
  ON l.tag_chrom = r.tag_chrom AND l.tag_pos = r.tag_pos AND l.tag_ref = r.tag_ref AND l.tag_alt = r.tag_alt
WHERE l.study_id <> r.study_id AND (l.type = 'gwas' OR r.type = 'gwas') AND l.key > r.key
  AND abs(l.lead_pos - r.lead_pos) <= 100000""", "cs95"))
def q_overlap_distance(spark, d):
    """Lead distance <= 100 kb as a join residual."""
    return ov.overlap_pairs(ov.number_loci(_prepared(spark, d))[0], 100_000).select("left_key", "right_key")


def _overlap_keys(spark, d):
    return ov.find_overlaps(A.credset(spark, d), keep_keys=True)


@query("overlap_tag_totals", S("""SELECT o.left_key, o.right_key, lt.num_tags AS left_num_tags, rt.num_tags AS right_num_tags
FROM overlap_counts_v o JOIN tag_counts_v lt ON o.left_key = lt.key JOIN tag_counts_v rt ON o.right_key = rt.key""",
                               "overlap_counts_v", "tag_counts_v"))
def q_overlap_tag_totals(spark, d):
    return _overlap_keys(spark, d).select("left_key", "right_key", "left_num_tags", "right_num_tags")


@query("overlap_counts", S("SELECT left_key, right_key, num_overlapping FROM overlap_counts_v", "overlap_counts_v"))
def q_overlap_counts(spark, d):
    return _overlap_keys(spark, d).select("left_key", "right_key", "num_overlapping")


@query("tag_counts", S("SELECT key, num_tags FROM tag_counts_v", "tag_counts_v"))
def q_tag_counts(spark, d):
    return ov.tag_counts(_prepared(spark, d))


@query("overlap_proportions", S("""SELECT o.left_key, o.right_key, o.num_overlapping / lt.num_tags AS left_overlap_prop,
  o.num_overlapping / rt.num_tags AS right_overlap_prop
FROM overlap_counts_v o JOIN tag_counts_v lt ON o.left_key = lt.key JOIN tag_counts_v rt ON o.right_key = rt.key""",
                                "overlap_counts_v", "tag_counts_v"))
def q_overlap_proportions(spark, d):
    return _overlap_keys(spark, d).select("left_key", "right_key", "left_overlap_prop", "right_overlap_prop")


def _completed_from_manifest(m, mod):
    """Completed tests in results naming: manifest rows with (left+right lead pos) % 3 = mod."""
    return m.filter((F.col("left_lead_pos") + F.col("right_lead_pos")) % 3 == mod).select(*abf.results_naming(m))


MAN_COLS_SQL = "m.*"
_ID14 = [(f"{s}_{m}", f"{s}_{r}") for s in SIDES for m, r in zip(LOCUS_COLS, RESULT_ID_COLS) if m != "type"]
_ID14_LOC = [(a, a) for a, _ in _ID14]


@query("manifest_anti_previous", S(f"""SELECT m.* FROM manifest_v m WHERE NOT EXISTS (
  SELECT 1 FROM manifest_v c WHERE (c.left_lead_pos + c.right_lead_pos) % 3 = 0 AND
  {' AND '.join(f'm.{a} IS NOT DISTINCT FROM c.{a}' for a, _ in _ID14)})""", "manifest_v"))
def q_manifest_anti_previous(spark, d):
    """Manifest (phenotype/feature written as 'None' text) minus completed tests."""
    m = jobs.manifest(spark, d)
    text = m.fillna("None", subset=[f"{s}_{c}" for s in SIDES for c in ("phenotype_id", "bio_feature")])
    return mf.filter_manifest(text, _completed_from_manifest(m, 0)).select(*m.columns)


def _tests16(spark, d):
    return jobs.manifest(spark, d).select(*LOC16).distinct()


def _tests_and_done(spark, d, mod):
    """(distinct tests, completed tests) from one written table of the manifest's tests."""
    t = jobs.tests(spark, d)
    return t.select(*LOC16).distinct(), _completed_from_manifest(t, mod)


_todo_sql = f"""SELECT t.* FROM tests_v t WHERE {{neg}} EXISTS (
  SELECT 1 FROM manifest_v c WHERE (c.left_lead_pos + c.right_lead_pos) % 3 = 1 AND
  {' AND '.join(f't.{a} IS NOT DISTINCT FROM c.{a}' for a, _ in _ID14)})"""


@query("tests_todo", S(_todo_sql.format(neg="NOT"), "tests_v", "manifest_v"))
def q_tests_todo(spark, d):
    """Tests without results."""
    return mf.tests_todo(*_tests_and_done(spark, d, 1))


@query("tests_done", S(_todo_sql.format(neg=""), "tests_v", "manifest_v"))
def q_tests_done(spark, d):
    """Tests with results."""
    return mf.tests_done(*_tests_and_done(spark, d, 1))


@query("progress_counts", S(f"""SELECT 'outstanding' AS state, count(*) AS n_tests FROM ({_todo_sql.format(neg='NOT')}) a
UNION ALL SELECT 'finished' AS state, count(*) AS n_tests FROM ({_todo_sql.format(neg='')}) b""", "tests_v", "manifest_v"))
def q_progress_counts(spark, d):
    """Finished vs outstanding tests."""
    t, done = _tests_and_done(spark, d, 1)
    return lg.progress_counts(mf.tests_todo(t, done), mf.tests_done(t, done))


_catalog_sql = """SELECT DISTINCT '/data/sumstats/' || (CASE WHEN type = 'gwas' THEN 'gwas' ELSE 'molecular_trait' END)
  || '/' || study_id || '.parquet' AS path FROM sumstats WHERE study_id <> 'S5'
UNION SELECT DISTINCT '/data/ld/panel_chr' || chrom || '.bed' AS path FROM sumstats WHERE chrom <> '7'"""


@query("missing_inputs", S(f"""SELECT DISTINCT r.col AS "column", r.path FROM (
  SELECT 'left_sumstats' AS col, left_sumstats AS path FROM manifest_v
  UNION ALL SELECT 'left_ld', left_ld || '.bed' FROM manifest_v WHERE left_ld IS NOT NULL
  UNION ALL SELECT 'right_sumstats', right_sumstats FROM manifest_v
  UNION ALL SELECT 'right_ld', right_ld || '.bed' FROM manifest_v WHERE right_ld IS NOT NULL) r
WHERE r.path NOT IN ({_catalog_sql})""", "manifest_v", "sumstats"))
def q_missing_inputs(spark, d):
    """Referenced inputs absent from a catalogue (study S5 and chromosome 7 missing)."""
    ss = A.sumstats(spark, d)
    cat = (ss.filter(F.col("study_id") != "S5").select(
        F.concat(F.lit("/data/sumstats/"), mf.dataset_class(F.col("type")), F.lit("/"), F.col("study_id"),
                 F.lit(".parquet")).alias("path"))
        .unionByName(ss.filter(F.col("chrom") != "7").select(
            F.concat(F.lit("/data/ld/panel_chr"), F.col("chrom"), F.lit(".bed")).alias("path"))))
    return mf.missing_inputs(jobs.manifest(spark, d), cat)


def _signals(spark, d):
    return abf.signals_with_ids(jobs.tests(spark, d))


COND_OUT = LOCUS_COLS + ["cond_chrom", "cond_pos", "cond_ref", "cond_alt"]


@query("condition_list", S(f"""SELECT DISTINCT {', '.join('g.' + c for c in LOCUS_COLS)}, t.chrom AS cond_chrom,
  t.pos AS cond_pos, t.ref AS cond_ref, t.alt AS cond_alt
FROM signals_v g JOIN toploci t ON t.study_id = g.study_id AND t.phenotype_id IS NOT DISTINCT FROM g.phenotype_id
  AND t.bio_feature IS NOT DISTINCT FROM g.bio_feature AND t.chrom = g.lead_chrom
WHERE NOT (t.pos = g.lead_pos AND t.ref = g.lead_ref AND t.alt = g.lead_alt)
  AND EXISTS (SELECT 1 FROM sig_stats_cond_v w WHERE {nse_cols('w', 'g', LOCUS_COLS)}
              AND w.chrom = t.chrom AND w.pos = t.pos AND w.ref = t.ref AND w.alt = t.alt)""",
                           "signals_v", "toploci", "sig_stats_cond_v"))
def q_condition_list(spark, d):
    """Window variants n top loci of the same study/phenotype/feature/chrom, minus the index."""
    sig = _signals(spark, d)
    ws = sm.signal_stats(sig, A.sumstats(spark, d), sm.COND_WINDOW_KB)
    c = cd.condition_list(sig, ws, A.toploci(spark, d))
    return c.join(sig, "signal_id").select(*COND_OUT)


def _tests_ids(spark, d):
    return abf.with_test_ids(_tests16(spark, d))


def _tests_stats(spark, d):
    tests = jobs.tests(spark, d)
    t = abf.with_test_ids(tests.select(*LOC16).distinct())
    return t, sm.signal_stats(abf.signals_with_ids(tests), A.sumstats(spark, d))


_ren = ", ".join(f"{s}_{m} AS {s}_{r}" for s in SIDES for m, r in zip(LOCUS_COLS, RESULT_ID_COLS))


@query("harmonise_pair", S(f"SELECT {_ren}, chrom, pos, ref, alt, left_pval, right_pval FROM shared_v", "shared_v"))
def q_harmonise_pair(spark, d):
    """Shared variants of each test."""
    return abf.harmonise_windows(jobs.tests(spark, d), A.sumstats(spark, d))


@query("abf_side_constants", S(f"""SELECT {_ren},
  arg_min(left_n, vid) AS left_N, least(arg_min(left_ncases, vid), arg_min(left_n, vid) - arg_min(left_ncases, vid)) AS left_cases,
  CAST(least(arg_min(left_ncases, vid), arg_min(left_n, vid) - arg_min(left_ncases, vid)) AS DOUBLE) / arg_min(left_n, vid) AS left_s,
  coalesce(arg_min(left_cc, vid), false) AS left_is_cc,
  arg_min(right_n, vid) AS right_N, least(arg_min(right_ncases, vid), arg_min(right_n, vid) - arg_min(right_ncases, vid)) AS right_cases,
  CAST(least(arg_min(right_ncases, vid), arg_min(right_n, vid) - arg_min(right_ncases, vid)) AS DOUBLE) / arg_min(right_n, vid) AS right_s,
  coalesce(arg_min(right_cc, vid), false) AS right_is_cc
FROM shared_v GROUP BY {', '.join(LOC16)}""", "shared_v"))
def q_abf_side_constants(spark, d):
    """Study constants of each side from the first shared variant (variant-id order)."""
    t, stats = _tests_stats(spark, d)
    return abf.test_constants(t, stats).join(t, "test_id").select(
        *abf.results_naming(t), *[f"{s}_{c}" for s in SIDES for c in ("N", "cases", "s", "is_cc")])


def _labf_sql():
    n = "CAST(n_total AS DOUBLE)"
    nc = "CAST(n_cases AS DOUBLE)"
    s = f"(least({nc}, {n} - {nc}) / {n})"
    maf = eaf_to_maf_sql("eaf")
    return (f"SELECT {', '.join(LOCUS_COLS)}, chrom, pos, ref, alt, pval, {maf} AS maf, "
            f"{log_abf_sql(z_from_pval_sql('pval'), maf, n, 'coalesce(is_cc, false)', s)} AS labf "
            f"FROM sig_stats_v WHERE pval > 0 AND NOT isnan(pval) AND {maf} > 0 AND NOT isnan({maf})")


ABF_COLS = LOCUS_COLS + ["chrom", "pos", "ref", "alt", "pval", "maf", "labf"]


@query("abf_per_variant", S(rounded_sql(_labf_sql(), ABF_COLS, ["labf"]), "sig_stats_v"))
def q_abf_per_variant(spark, d):
    """A4: Wakefield log ABF per prepared (signal, variant)."""
    return rounded(abf.abf_per_variant(_signal_stats_named(spark, d)).select(*ABF_COLS), ["labf"])


@query("coloc_posteriors", S(rounded_sql("SELECT * EXCLUDE (nsnps) FROM coloc_raw_v", RES16 + PP, PP), "coloc_raw_v"))
def q_coloc_posteriors(spark, d):
    """A5: five posteriors per test (log-sum-exp over its shared variants)."""
    tests = jobs.tests(spark, d)
    t = abf.distinct_tests(tests)
    post = abf.window_posteriors(t, abf.signals_with_ids(tests), A.sumstats(spark, d))
    return rounded(post.join(t, "test_id").select(*abf.results_naming(t), *PP), PP)


JB_COLS = PROC_COLS + list(bt.BETA_COLS.values())


@query("join_betas", S(rounded_sql(f"""SELECT p.*, s.beta AS left_var_right_study_beta, s.se AS left_var_right_study_se,
  s.pval AS left_var_right_study_pval, s.is_cc AS left_var_right_isCC
FROM (SELECT {', '.join(PROC_COLS)} FROM coloc_processed_{MV}) p LEFT JOIN sumstats s
  ON p.left_chrom = s.chrom AND p.left_pos = s.pos AND p.left_ref = s.ref AND p.left_alt = s.alt
 AND p.right_study = s.study_id AND p.right_phenotype IS NOT DISTINCT FROM s.phenotype_id
 AND p.right_bio_feature IS NOT DISTINCT FROM s.bio_feature""", JB_COLS, PROC_ROUND),
                         f"coloc_processed_{MV}", "sumstats"))
def q_join_betas(spark, d):
    """Left variant's effect in the right study, null-safe left outer join."""
    p = jobs.coloc_processed(spark, d, MV).select(*PROC_COLS)
    return rounded(bt.join_betas(p, A.sumstats(spark, d)).select(*JB_COLS), PROC_ROUND)


# ============================================================================
# 2.4-2.6 aggregates, windows, set operations
# ============================================================================

_audit_sql = f"""SELECT '0_loaded' AS stage, count(*) AS n_rows FROM coloc_ratio_v
UNION ALL SELECT '1_min_vars', count(*) FROM coloc_minvars_{MV}
UNION ALL SELECT '2_symmetric', count(*) FROM coloc_sym_{MV}
UNION ALL SELECT '3_left_gwas', count(*) FROM coloc_sym_{MV} WHERE left_type = 'gwas'
UNION ALL SELECT '4_dedup_right', count(*) FROM coloc_dedup_{MV}
UNION ALL SELECT '5_non_null', count(*) FROM coloc_processed_{MV}"""


@query("stage_audit", S(_audit_sql, f"coloc_processed_{MV}"))
def q_stage_audit(spark, d):
    """Rows after each processing step."""
    return rs.stage_audit(jobs.coloc_raw(spark, d), MV, jobs.ORDER_DIGITS)


_SYM_COLS = O.RATIO_COLS + ["is_flipped"]


@query("make_symmetric", S(rounded_sql(f"SELECT * FROM coloc_sym_{MV}", _SYM_COLS, RATIO_ROUND), f"coloc_sym_{MV}"))
def q_make_symmetric(spark, d):
    """Union with sides swapped, is_flipped flag."""
    return rounded(_sym(spark, d).select(*_SYM_COLS), RATIO_ROUND)


@query("dedup_right", S(rounded_sql(f"SELECT * FROM coloc_dedup_{MV}", _SYM_COLS, RATIO_ROUND), f"coloc_dedup_{MV}"))
def q_dedup_right(spark, d):
    """Best right locus by coloc_h4 per left locus and right dataset."""
    return rounded(rs.dedup_right(rs.filter_left_gwas(_sym(spark, d)), jobs.ORDER_DIGITS).select(*_SYM_COLS), RATIO_ROUND)


@query("keep_first", S(f"""SELECT {', '.join(SS_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY study_id, chrom
  ORDER BY pval ASC NULLS LAST, pos ASC NULLS LAST) AS rn FROM sumstats) t WHERE rn = 1""", "sumstats"))
def q_keep_first(spark, d):
    """drop_duplicates keep-first by pval within (study, chrom), position tiebreak."""
    return keep_first(A.sumstats(spark, d), ["study_id", "chrom"], "pval", True, tiebreak=["pos"])


_PREV_SQL = "SELECT *, '/data/' || left_study || '.parquet' AS left_sumstat FROM coloc_raw_v WHERE left_pos % 2 = 0"
_NEW_SQL = "SELECT *, CAST(NULL AS VARCHAR) AS left_sumstat FROM coloc_raw_v WHERE left_pos % 2 = 1"
MERGE_COLS = RES16 + ["nsnps"] + PP + ["left_sumstat"]


@query("merge_raw", S(rounded_sql(f"{_PREV_SQL} UNION ALL {_NEW_SQL}", MERGE_COLS, PP), "coloc_raw_v"))
def q_merge_raw(spark, d):
    """Union by name allowing missing columns."""
    return rounded(rl.merge_raw(jobs.previous_release(spark, d), jobs.new_release(spark, d)).select(*MERGE_COLS), PP)


@query("merge_processed", S(rounded_sql(f"SELECT {', '.join(PROC_COLS)} FROM coloc_processed_{MV}", PROC_COLS, PROC_ROUND),
                            f"coloc_processed_{MV}"))
def q_merge_processed(spark, d):
    """Strict union of two processed releases (split by left_pos parity)."""
    p = jobs.coloc_processed(spark, d, MV).select(*PROC_COLS)
    return rounded(rl.merge_processed(p.filter(F.col("left_pos") % 2 == 0), p.filter(F.col("left_pos") % 2 == 1)),
                   PROC_ROUND)


@query("schema_drift")
def q_schema_drift(spark, d):
    """U4: columns present in only one release."""
    return rl.schema_drift(jobs.previous_release(spark, d), jobs.new_release(spark, d))


@query("merge_audit", S("""SELECT 'previous' AS source, count(*) AS n_rows FROM coloc_raw_v WHERE left_pos % 2 = 0
UNION ALL SELECT 'new', count(*) FROM coloc_raw_v WHERE left_pos % 2 = 1
UNION ALL SELECT 'total', count(*) FROM coloc_raw_v""", "coloc_raw_v"))
def q_merge_audit(spark, d):
    """Previous / new / total rows (rollup)."""
    return rl.merge_audit(jobs.previous_release(spark, d), jobs.new_release(spark, d))


@query("merge_releases", S(rounded_sql(f"{_PREV_SQL} UNION ALL {_NEW_SQL}", MERGE_COLS, PP), "coloc_raw_v"))
def q_merge_releases(spark, d):
    """M7: previous release (all tests) merged with a new release (odd left_pos),
    new rows preferred per test."""
    raw = jobs.coloc_raw(spark, d)
    prev = raw.withColumn("left_sumstat", F.concat(F.lit("/data/"), F.col("left_study"), F.lit(".parquet")))
    out = rl.merge_releases(prev, jobs.new_release(spark, d, raw), prefer="new", id_cols=RES16)
    return rounded(out.select(*MERGE_COLS), PP)


@query("signals_to_prepare", S(" UNION ".join(
    f"SELECT DISTINCT {', '.join(f'{s}_{c} AS {c}' for c in LOCUS_COLS)}, {s}_ld AS ld FROM manifest_v" for s in SIDES),
    "manifest_v"))
def q_signals_to_prepare(spark, d):
    """Distinct signals (left u right) with their LD reference."""
    return mf.signals_to_prepare(jobs.manifest(spark, d))


_LOCUS_TEXT = "concat_ws('|', " + ", ".join(f"coalesce(CAST({{0}}{c} AS VARCHAR), '~')" for c in LOCUS_COLS) + ")"


@query("coloc_tests", S(f"""SELECT t.* FROM tests_v t
WHERE {_LOCUS_TEXT.format('t.left_')} IN (SELECT DISTINCT {_LOCUS_TEXT.format('')} FROM sig_stats_v)
  AND {_LOCUS_TEXT.format('t.right_')} IN (SELECT DISTINCT {_LOCUS_TEXT.format('')} FROM sig_stats_v)""", "tests_v", "sig_stats_v"))
def q_coloc_tests(spark, d):
    """Tests whose two signals both have prepared statistics."""
    tests = jobs.tests(spark, d)
    prepared = sm.signals_with_stats(abf.signals_with_ids(tests), A.sumstats(spark, d)).select(*LOCUS_COLS)
    return mf.coloc_tests(tests, prepared)


@query("manifest_filtered", S(f"""SELECT m.* FROM manifest_v m WHERE NOT EXISTS (
  SELECT 1 FROM coloc_raw_v c WHERE c.nsnps >= 75 AND
  {' AND '.join(f'm.{a} IS NOT DISTINCT FROM c.{b}' for a, b in _ID14)})""", "manifest_v", "coloc_raw_v"))
def q_manifest_filtered(spark, d):
    """M3: manifest minus tests already in the results table (here: results with >= 75 variants)."""
    raw = jobs.coloc_raw(spark, d)
    return mf.filter_manifest(jobs.manifest(spark, d), raw.filter(F.col("nsnps") >= 75))


@query("distinct_lead_variants", S("""SELECT left_chrom AS lead_chrom, left_pos AS lead_pos, left_ref AS lead_ref,
  left_alt AS lead_alt FROM coloc_raw_v UNION SELECT right_chrom, right_pos, right_ref, right_alt FROM coloc_raw_v""",
                                   "coloc_raw_v"))
def q_distinct_lead_variants(spark, d):
    """A14."""
    return ldm.distinct_lead_variants(jobs.coloc_raw(spark, d))


@query("method_switch", S("SELECT * FROM credset WHERE multisignal_method = 'distance'", "credset"))
def q_method_switch(spark, d):
    """The 'distance' branch (skips conditioning)."""
    return cd.method_switch(A.credset(spark, d))["distance"]


# ============================================================================
# 2.8 LD
# ============================================================================

def _ld_sql(leads_sql: str, extra_where: str = "", window: int = 500000, digits: int | None = 9) -> str:
    out = (f"round(R_EUR, {digits}) AS R_EUR, round(R_EUR * R_EUR, {digits}) AS R2_EUR" if digits is not None
           else "R_EUR, R_EUR * R_EUR AS R2_EUR")
    return f"""WITH mom AS (SELECT chrom, pos, ref, alt, CAST(sum(dosage) AS DOUBLE) AS sx,
       CAST(sum(dosage * dosage) AS DOUBLE) AS sxx FROM genotypes GROUP BY chrom, pos, ref, alt),
leads AS (SELECT DISTINCT l.lead_chrom, l.lead_pos, l.lead_ref, l.lead_alt, m.sx AS lsx, m.sxx AS lsxx
  FROM ({leads_sql}) l JOIN mom m ON m.chrom = l.lead_chrom AND m.pos = l.lead_pos AND m.ref = l.lead_ref AND m.alt = l.lead_alt),
pairs AS (SELECT l.*, t.chrom AS tag_chrom, t.pos AS tag_pos, t.ref AS tag_ref, t.alt AS tag_alt, t.sx AS tsx, t.sxx AS tsxx
  FROM leads l JOIN mom t ON t.chrom = l.lead_chrom AND abs(CAST(t.pos AS BIGINT) - l.lead_pos) <= {window}),
cross_m AS (SELECT l.lead_chrom, l.lead_pos, l.lead_ref, l.lead_alt, y.chrom AS tag_chrom, y.pos AS tag_pos,
    y.ref AS tag_ref, y.alt AS tag_alt, CAST(sum(x.dosage * y.dosage) AS DOUBLE) AS sxy
  FROM leads l JOIN genotypes x ON x.chrom = l.lead_chrom AND x.pos = l.lead_pos AND x.ref = l.lead_ref AND x.alt = l.lead_alt
  JOIN genotypes y ON y.sample_id = x.sample_id AND y.chrom = x.chrom AND abs(CAST(y.pos AS BIGINT) - x.pos) <= {window}
  GROUP BY ALL),
r AS (SELECT p.lead_chrom, p.lead_pos, p.lead_ref, p.lead_alt, p.tag_chrom, p.tag_pos, p.tag_ref, p.tag_alt,
    CASE WHEN sqrt((n_s * lsxx - lsx * lsx) * (n_s * tsxx - tsx * tsx)) > 0 THEN
      (n_s * coalesce(c.sxy, 0.0) - lsx * tsx) / sqrt((n_s * lsxx - lsx * lsx) * (n_s * tsxx - tsx * tsx)) END AS R_EUR
  FROM pairs p CROSS JOIN (SELECT CAST(count(DISTINCT sample_id) AS DOUBLE) AS n_s FROM genotypes) ns
  LEFT JOIN cross_m c ON c.lead_chrom = p.lead_chrom AND c.lead_pos = p.lead_pos AND c.lead_ref = p.lead_ref
   AND c.lead_alt = p.lead_alt AND c.tag_chrom = p.tag_chrom AND c.tag_pos = p.tag_pos AND c.tag_ref = p.tag_ref
   AND c.tag_alt = p.tag_alt)
SELECT lead_chrom, lead_pos, lead_ref, lead_alt, tag_chrom, tag_pos, tag_ref, tag_alt, {out}
FROM r {extra_where}"""


_TL_LEADS = "SELECT DISTINCT chrom AS lead_chrom, pos AS lead_pos, ref AS lead_ref, alt AS lead_alt FROM toploci"
_RES_LEADS = ("SELECT left_chrom AS lead_chrom, left_pos AS lead_pos, left_ref AS lead_ref, left_alt AS lead_alt "
              "FROM coloc_raw_v UNION SELECT right_chrom, right_pos, right_ref, right_alt FROM coloc_raw_v")
LD_ROUND = ["R_EUR", "R2_EUR"]


def _ld_views(body: str, *views: str) -> str:
    s = with_adapters("SELECT 1", *views)
    head = s[: s.rfind("SELECT 1")].rstrip()
    return body.replace("WITH mom AS", f"{head},\nmom AS", 1) if head else body


@query("ld_pairs", _ld_views(_ld_sql(_TL_LEADS), "genotypes", "toploci"))
def q_ld_pairs(spark, d):
    """R between each genotyped top-locus lead and variants within 500 kb."""
    pairs = ldm.ld_pairs(A.genotypes(spark, d), jobs.toploci_leads(spark, d), A.genotype_samples(spark, d))
    return rounded(pairs, LD_ROUND)


@query("ld_r2_filter", _ld_views(_ld_sql(_TL_LEADS, "WHERE R_EUR * R_EUR >= 0.05"), "genotypes", "toploci"))
def q_ld_r2_filter(spark, d):
    """R2 >= 0.05."""
    pairs = ldm.ld_pairs(A.genotypes(spark, d), jobs.toploci_leads(spark, d), A.genotype_samples(spark, d))
    return rounded(ldm.ld_r2_filter(pairs), LD_ROUND)


@query("ld_table", _ld_views(_ld_sql(_RES_LEADS, "WHERE R_EUR * R_EUR >= 0.05"), "genotypes", "coloc_raw_v"))
def q_ld_table(spark, d):
    """L1: result leads -> LD -> R2 filter -> text ids -> parsed table."""
    return rounded(ldm.ld_table(A.genotypes(spark, d), jobs.coloc_raw(spark, d), A.genotype_samples(spark, d)), LD_ROUND)


# ============================================================================
# 2.7 / 2.8 features (M9) and models
# ============================================================================

O.min_vars_view(0)
FMV = jobs.FEATURE_MIN_VARS
_left8 = [f"left_{c}" for c in RESULT_ID_COLS]
_right8 = [f"right_{c}" for c in RESULT_ID_COLS]
register("coloc_f_v", ("coloc_sym_0",), f"SELECT * FROM coloc_sym_0 WHERE coloc_n_vars > {FMV} AND left_type = 'gwas'")
register("ld_feat_v", ("coloc_raw_v", "sumstats"), f"""
SELECT l.lead_chrom, l.lead_pos, l.lead_ref, l.lead_alt, t.chrom AS tag_chrom, t.pos AS tag_pos, t.ref AS tag_ref,
  t.alt AS tag_alt, exp(-CAST(abs(CAST(t.pos AS BIGINT) - l.lead_pos) AS DOUBLE) / 50000.0) AS R_EUR,
  exp(-CAST(abs(CAST(t.pos AS BIGINT) - l.lead_pos) AS DOUBLE) / 50000.0)
    * exp(-CAST(abs(CAST(t.pos AS BIGINT) - l.lead_pos) AS DOUBLE) / 50000.0) AS R2_EUR
FROM ({_RES_LEADS}) l JOIN (SELECT DISTINCT chrom, pos, ref, alt FROM sumstats) t
  ON t.chrom = l.lead_chrom AND abs(CAST(t.pos AS BIGINT) - l.lead_pos) <= 500000""")
for _s, _ids in (("left", _left8), ("right", _right8)):
    register(f"{_s}_tags_v", ("coloc_f_v", "ld_feat_v"), f"""
SELECT c.*, x.tag_chrom, x.tag_pos, x.tag_ref, x.tag_alt, x.R2_EUR AS {_s}_R2_EUR
FROM (SELECT DISTINCT {', '.join(_ids)} FROM coloc_f_v) c JOIN ld_feat_v x
  ON x.lead_chrom = c.{_s}_chrom AND x.lead_pos = c.{_s}_pos AND x.lead_ref = c.{_s}_ref AND x.lead_alt = c.{_s}_alt""")
register("inter_all_v", ("left_tags_v", "right_tags_v"), f"""
SELECT l.*, {', '.join('r.' + c for c in _right8)}, r.right_R2_EUR FROM left_tags_v l JOIN right_tags_v r
  ON l.tag_chrom = r.tag_chrom AND l.tag_pos = r.tag_pos AND l.tag_ref = r.tag_ref AND l.tag_alt = r.tag_alt""")
register("inter_v", ("inter_all_v", "coloc_f_v"), f"""
SELECT i.* FROM inter_all_v i JOIN (SELECT DISTINCT {', '.join(RES16)} FROM coloc_f_v) p ON {nse_cols('i', 'p', RES16)}""")
_props = ", ".join(
    f"count(CASE WHEN left_R2_EUR >= {t} AND right_R2_EUR >= {t} THEN 1 END) / count(left_R2_EUR) AS {q(f'prop_overlap_{t}')}"
    for t in ft.R2_THRESHOLDS)
register("feat_a7_v", ("inter_v",), f"""
SELECT {', '.join(RES16)}, count(CASE WHEN left_R2_EUR >= 0 AND right_R2_EUR >= 0 THEN 1 END) AS total_overlap, {_props}
FROM inter_v GROUP BY {', '.join(RES16)}""")
for _s in SIDES:
    register(f"{_s}_ntags_v", (f"{_s}_tags_v",), f"""
SELECT {', '.join(ID7[_s])}, count(tag_chrom) AS {_s}_num_tags FROM {_s}_tags_v GROUP BY {', '.join(ID7[_s])}""")
register("feat_a9_v", ("feat_a7_v", "left_ntags_v", "right_ntags_v"), f"""
SELECT f.*, l.left_num_tags, r.right_num_tags, f.total_overlap / l.left_num_tags AS left_prop_total_overlap,
  f.total_overlap / r.right_num_tags AS right_prop_total_overlap
FROM feat_a7_v f JOIN left_ntags_v l ON {nse_cols('f', 'l', ID7['left'])}
JOIN right_ntags_v r ON {nse_cols('f', 'r', ID7['right'])}""")
register("lead_pv_v", ("toploci",), f"""SELECT study_id, phenotype_id, bio_feature, chrom, pos, ref, alt,
  coalesce(-(CASE WHEN pval > 0 THEN log10(pval) END), {ft.NEG_LOG10_MIN_DOUBLE!r}) AS log_pval FROM toploci""")


def _pv_join(alias, side):
    m = {"study": "study_id", "phenotype": "phenotype_id", "bio_feature": "bio_feature", "chrom": "chrom",
         "pos": "pos", "ref": "ref", "alt": "alt"}
    return " AND ".join(f"f.{side}_{k} IS NOT DISTINCT FROM {alias}.{v}" for k, v in m.items())


register("feat_full_v", ("feat_a9_v", "lead_pv_v"), f"""
SELECT f.*, lp.log_pval AS left_log_pval, rp.log_pval AS right_log_pval,
  abs(f.left_pos - f.right_pos) AS abs_distance,
  CASE WHEN f.left_type = 'gwas' THEN 1 ELSE 0 END AS left_is_gwas,
  CASE WHEN f.right_type = 'gwas' THEN 1 ELSE 0 END AS right_is_gwas
FROM feat_a9_v f JOIN lead_pv_v lp ON {_pv_join('lp', 'left')} JOIN lead_pv_v rp ON {_pv_join('rp', 'right')}""")
_COLOC_KEEP = ["coloc_h3", "coloc_h4", "coloc_log2_h4_h3"]
register("features_v", ("feat_full_v", "coloc_f_v"), f"""
SELECT {', '.join(f'coalesce(f.{c}, c.{c}) AS {c}' for c in RES16)},
  {', '.join('f.' + q(c) for c in ft.FEATURE_COLS)}, {', '.join('c.' + c for c in _COLOC_KEEP)}
FROM feat_full_v f FULL OUTER JOIN coloc_f_v c ON {nse_cols('f', 'c', RES16)}""")

FEAT_ALL = RES16 + ft.FEATURE_COLS + _COLOC_KEEP
FEAT_ROUND = [c for c in ft.FEATURE_COLS if c.startswith("prop_") or c.endswith("log_pval")
              or c.endswith("total_overlap") and c != "total_overlap"] + _COLOC_KEEP


def _features(spark, d):
    return jobs.coloc_features(spark, d)


def _fcols(df, cols):
    return df.select(*[F.col(f"`{c}`") for c in cols])


@query("coloc_features", S(rounded_sql("SELECT * FROM features_v", FEAT_ALL, FEAT_ROUND), "features_v"))
def q_coloc_features(spark, d):
    """M9: LD-overlap features x coloc outcomes (full outer on the 16 ids)."""
    return rounded(_fcols(_features(spark, d), FEAT_ALL), FEAT_ROUND)


@query("feature_outcome_outer", S(rounded_sql("SELECT " + ", ".join(RES16) + ", total_overlap, coloc_log2_h4_h3 FROM features_v",
                                              RES16 + ["total_overlap", "coloc_log2_h4_h3"], ["coloc_log2_h4_h3"]),
                                  "features_v"))
def q_feature_outcome_outer(spark, d):
    """Presence of LD features and coloc outcomes per pair."""
    return rounded(_fcols(_features(spark, d), RES16 + ["total_overlap", "coloc_log2_h4_h3"]), ["coloc_log2_h4_h3"])


@query("feature_match_counts", S("""SELECT count_if(total_overlap IS NOT NULL AND coloc_log2_h4_h3 IS NULL) AS ld_only,
  count_if(total_overlap IS NULL AND coloc_log2_h4_h3 IS NOT NULL) AS coloc_only,
  count_if(total_overlap IS NOT NULL AND coloc_log2_h4_h3 IS NOT NULL) AS both
FROM (SELECT a.total_overlap, c.coloc_log2_h4_h3 FROM (
    SELECT i.* FROM (SELECT """ + ", ".join(RES16) + """, count(*) AS total_overlap FROM inter_all_v GROUP BY ALL) i
    JOIN lead_pv_v lp ON """ + _pv_join("lp", "left").replace("f.", "i.") + " JOIN lead_pv_v rp ON "
    + _pv_join("rp", "right").replace("f.", "i.") + ") a FULL OUTER JOIN coloc_f_v c ON " + nse_cols("a", "c", RES16) + ")",
    "inter_all_v", "coloc_f_v", "lead_pv_v"))
def q_feature_match_counts(spark, d):
    """A10: LD only / coloc only / both, over all loci that share an LD tag."""
    return jobs.feature_match_counts(spark, d)


def _ld_feat(spark, d):
    return jobs.ld_for_features(spark, d)


def _coloc_f(spark, d):
    raw = jobs.coloc_raw(spark, d)
    return ft.coloc_for_features(rs.make_symmetric(rs.add_ratios(rs.rename_raw(raw))), FMV)


@query("locus_ld_tags", S(rounded_sql("SELECT * FROM left_tags_v", _left8 + ["tag_chrom", "tag_pos", "tag_ref", "tag_alt",
                                                                           "left_R2_EUR"], ["left_R2_EUR"]), "left_tags_v"))
def q_locus_ld_tags(spark, d):
    """Distinct left loci x LD of their lead."""
    t = ft.locus_ld_tags(_coloc_f(spark, d), _ld_feat(spark, d), "left")
    return rounded(t.select(*_left8, "tag_chrom", "tag_pos", "tag_ref", "tag_alt", "left_R2_EUR"), ["left_R2_EUR"])


_INTER_COLS = RES16 + ["tag_chrom", "tag_pos", "tag_ref", "tag_alt", "left_R2_EUR", "right_R2_EUR"]


@query("ld_tag_intersection", S(rounded_sql(f"SELECT {', '.join(_INTER_COLS)} FROM inter_v", _INTER_COLS,
                                            ["left_R2_EUR", "right_R2_EUR"]), "inter_v"))
def q_ld_tag_intersection(spark, d):
    """Left and right loci sharing an LD tag."""
    x = ft.pair_tag_intersection(_coloc_f(spark, d), _ld_feat(spark, d))
    return rounded(x.select(*_INTER_COLS), ["left_R2_EUR", "right_R2_EUR"])


_A7 = RES16 + ["total_overlap"] + [f"prop_overlap_{t}" for t in ft.R2_THRESHOLDS]


@query("ld_overlap_features", S(rounded_sql("SELECT * FROM feat_a7_v", _A7, _A7[17:]), "feat_a7_v"))
def q_ld_overlap_features(spark, d):
    """Total overlap and thresholded overlap proportions."""
    return rounded(_fcols(ft.locus_pair_overlaps(_coloc_f(spark, d), _ld_feat(spark, d)), _A7), _A7[17:])


@query("ld_num_tags", S("SELECT * FROM left_ntags_v", "left_ntags_v"))
def q_ld_num_tags(spark, d):
    """LD tags per left locus."""
    return ft.ld_num_tags(ft.locus_ld_tags(_coloc_f(spark, d), _ld_feat(spark, d), "left"), "left")


_A9 = RES16 + ["total_overlap", "left_num_tags", "right_num_tags", "left_prop_total_overlap", "right_prop_total_overlap"]


@query("ld_total_proportions", S(rounded_sql(f"SELECT {', '.join(_A9)} FROM feat_a9_v", _A9, _A9[-2:]), "feat_a9_v"))
def q_ld_total_proportions(spark, d):
    """Total overlap as a share of each side's tags."""
    return rounded(_fcols(_features(spark, d).filter(F.col("total_overlap").isNotNull()), _A9), _A9[-2:])


_J15 = RES16 + ["left_log_pval", "right_log_pval"]


@query("feature_lead_pvals", S(rounded_sql(f"SELECT {', '.join(_J15)} FROM feat_full_v", _J15, _J15[-2:]), "feat_full_v"))
def q_feature_lead_pvals(spark, d):
    """Lead -log10 p attached to both sides."""
    return rounded(_fcols(_features(spark, d).filter(F.col("total_overlap").isNotNull()), _J15), _J15[-2:])


@query("feature_subsets", S(rounded_sql("SELECT * FROM features_v WHERE right_type <> 'gwas'", FEAT_ALL, FEAT_ROUND),
                            "features_v"))
def q_feature_subsets(spark, d):
    """The molecular_trait subset (right_type != gwas)."""
    return rounded(_fcols(ft.feature_subset(_features(spark, d), "molecular_trait"), FEAT_ALL), FEAT_ROUND)


@query("feature_vectors")
def q_feature_vectors(spark, d):
    """24 features assembled into a vector (complete rows)."""
    from pyspark.ml.functions import vector_to_array
    v = im.feature_vectors(im.complete_rows(_features(spark, d)))
    return v.select(*RES16, vector_to_array("features").alias("features"))


def _ids_md5(seed):
    text = " || '|' || ".join([f"'{seed}'"] + [f"coalesce(CAST({c} AS VARCHAR), '')" for c in RES16])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _ols_sql(select: str) -> str:
    """All OLS fits by Gauss-Jordan steps over the correlations of each training set; R^2 from the rows' predictions."""
    x, y = [f'CAST("{c}" AS DOUBLE)' for c in im.FEATURE_COLS], [f"CAST({c} AS DOUBLE)" for c in im.OUTCOMES.values()]
    n, m = len(x), len(y)
    cov = ", ".join("[" + ", ".join(f"covar_pop(v[{i}], v[{j}])" for j in range(1, n + m + 1)) + "]" for i in range(1, n + 1))
    sizes = ", ".join(f"({s!r})" for s in im.TRAIN_SIZES)
    head = "WITH RECURSIVE" + with_adapters("", "features_v").strip()[len("WITH"):]
    return f"""{head},
r AS MATERIALIZED (
  SELECT [{', '.join(x + y)}] AS v, right_type, {_ids_md5(123)} % 5 AS fold, ({_ids_md5(124)} % 10000) / 10000.0 AS u
  FROM features_v WHERE total_overlap IS NOT NULL AND coloc_log2_h4_h3 IS NOT NULL),
s AS MATERIALIZED (SELECT subset, r.* FROM r JOIN (VALUES ('all'), ('gwas'), ('molecular_trait')) t(subset)
      ON subset = 'all' OR (subset = 'gwas' AND right_type = 'gwas') OR (subset = 'molecular_trait' AND right_type <> 'gwas')),
sets AS (SELECT k.k, z.z FROM (SELECT unnest([0, 1, 2, 3, 4]) AS k) k, (VALUES {sizes}) z(z)),
train AS (SELECT subset, k, z, v FROM s JOIN sets ON fold <> k AND u < z),
g AS (SELECT subset, k, z, count(*) AS n_train, [{', '.join(f'avg(v[{i}])' for i in range(1, n + m + 1))}] AS mean, [{cov}] AS c,
             [{', '.join(f'CASE WHEN stddev_pop(v[{i}]) > 1e-9 THEN stddev_pop(v[{i}]) ELSE 0 END' for i in range(1, n + 1))}] AS sd
      FROM train GROUP BY ALL HAVING count(*) > 1),
scaled AS (SELECT subset, k, z, list_transform(c, lambda row, i: list_transform(row, lambda e, j:
             CASE WHEN sd[i] = 0 OR (j <= {n} AND sd[j] = 0) THEN 0.0 WHEN j <= {n} THEN e / sd[i] / sd[j] ELSE e / sd[i] END)) AS a FROM g),
steps AS (
  SELECT subset, k, z, 1 AS p, a FROM scaled
  UNION ALL
  SELECT subset, k, z, p + 1, list_transform(a, lambda row, i: CASE
    WHEN a[p][p] <= 1e-9 THEN CASE WHEN i = p THEN list_transform(row, lambda e: 0.0) ELSE row END
    WHEN i = p THEN list_transform(row, lambda e: e / a[p][p])
    ELSE list_transform(row, lambda e, j: e - row[p] * (a[p][j] / a[p][p])) END)
  FROM steps WHERE p <= {n}),
coefs AS (SELECT g.subset, g.k, g.z, n_train, o, mean, list_transform(a, lambda row, i: CASE WHEN sd[i] = 0 THEN 0.0 ELSE row[{n} + o] / sd[i] END) AS b
          FROM g JOIN steps ON steps.subset = g.subset AND steps.k = g.k AND steps.z = g.z AND p = {n + 1}, (SELECT unnest([1, 2, 3]) AS o)),
pred AS (SELECT c.subset, c.k, c.z, n_train, o, fold = k AS test, v[{n} + o] AS y,
                mean[{n} + o] + list_sum(list_transform(b, lambda e, i: e * (v[i] - mean[i]))) AS f
         FROM coefs c JOIN s ON s.subset = c.subset AND (fold = k OR u < z)),
score AS (SELECT subset, k, z, n_train, o, test, 1 - sum((y - f) * (y - f)) / nullif(var_pop(y) * count(*), 0) AS r2 FROM pred GROUP BY ALL),
fits AS (SELECT 'OLS' AS model, ['h3', 'h4', 'log_h4_h3'][o] AS outcome, subset, CAST(k AS INTEGER) AS fold, CAST(z AS DOUBLE) AS train_size, n_train,
                max(r2) FILTER (WHERE NOT test) AS train_r2, max(r2) FILTER (WHERE test) AS test_r2 FROM score GROUP BY ALL)
{select}"""


_R2_DIGITS = 5  # sums of two engines, divided by pivots of correlated features


def _ols(spark, d):
    return im.ols_fits(im.model_rows(_features(spark, d)))


@query("impute_ols", _ols_sql(f"""SELECT model, outcome, subset, round(avg(test_r2), {_R2_DIGITS}) AS r2_mean,
  round(stddev_pop(test_r2), {_R2_DIGITS}) AS r2_sd, count(*) AS n_folds FROM fits WHERE train_size = 1.0 GROUP BY ALL"""))
def q_impute_ols(spark, d):
    """I3 + I5: OLS, 5-fold CV R^2 mean / sd over outcomes and subsets."""
    out = im.summarise_scores(im.ols_scores(_ols(spark, d)))
    return out.withColumns({c: F.round(c, _R2_DIGITS) for c in ("r2_mean", "r2_sd")})


@query("impute_rf")
def q_impute_rf(spark, d):
    """I4 + I5: random forest (100 trees), 5-fold CV R^2 mean / sd, all rows."""
    scores, _, _ = im.cross_validate(_features(spark, d), models=["RandomForest_100"], subsets=["all"])
    return im.summarise_scores(scores)


@query("impute_cv")
def q_impute_cv(spark, d):
    """Per-fold R^2 of both models, every outcome and subset."""
    features = _features(spark, d)
    scores, _, _ = im.cross_validate(features, models=["RandomForest_100"])
    return im.ols_scores(im.ols_fits(im.model_rows(features))).unionByName(scores)


@query("impute_predictions")
def q_impute_predictions(spark, d):
    """Out-of-fold OLS predictions, every outcome and subset."""
    rows = im.model_rows(_features(spark, d))
    return im.ols_predictions(rows, im.ols_fits(rows))


@query("impute_importance")
def q_impute_importance(spark, d):
    """Random-forest feature importance mean / sd over folds (h4, all rows)."""
    _, _, imps = im.cross_validate(_features(spark, d), models=["RandomForest_100"], outcomes=["h4"], subsets=["all"])
    return im.summarise_importance(imps)


_CURVE_R2 = ["train_r2", "test_r2"]


@query("impute_learning_curve", _ols_sql("SELECT model, outcome, subset, train_size, fold, n_train, " + ", ".join(
    f"round({c}, {_R2_DIGITS}) AS {c}" for c in _CURVE_R2) + " FROM fits"))
def q_impute_learning_curve(spark, d):
    """I8: OLS learning curves at 5 training fractions, every outcome and subset."""
    out = im.learning_curve(_features(spark, d))
    return out.withColumns({c: F.round(c, _R2_DIGITS) for c in _CURVE_R2})


# ============================================================================
# conditional analysis (C1, C2, J9, M4 with LD)
# ============================================================================

def _cond_inputs(spark, d):
    sig = _signals(spark, d)
    ws = sm.signal_sumstats_join(sig.select("signal_id", *sm.SIGNAL_COLS), A.sumstats(spark, d), sm.COND_WINDOW_KB)
    wstats = ws.select("signal_id", *sm.STAT_COLS)
    conds = cd.condition_list(sig, wstats, A.toploci(spark, d))
    return sig, wstats, conds


def _erfc_p_sql(z: str) -> str:
    x = f"(abs({z}) / {math.sqrt(2.0)!r})"
    t = f"(1.0 / (1.0 + 0.5 * {x}))"
    acc = repr(cd.ERFC_COEFS[-1])
    for c in reversed(cd.ERFC_COEFS[:-1]):
        acc = f"({acc} * {t} + {c!r})"
    return f"({t} * exp(-{x} * {x} + {acc}))"


_LOC = ", ".join(LOCUS_COLS)
_COND_SQL = f"""SELECT DISTINCT {', '.join('g.' + c for c in LOCUS_COLS)}, t.chrom AS cond_chrom,
  t.pos AS cond_pos, t.ref AS cond_ref, t.alt AS cond_alt
FROM signals_v g JOIN toploci t ON t.study_id = g.study_id AND t.phenotype_id IS NOT DISTINCT FROM g.phenotype_id
  AND t.bio_feature IS NOT DISTINCT FROM g.bio_feature AND t.chrom = g.lead_chrom
WHERE NOT (t.pos = g.lead_pos AND t.ref = g.lead_ref AND t.alt = g.lead_alt)
  AND EXISTS (SELECT 1 FROM sig_stats_cond_v w WHERE {nse_cols('w', 'g', LOCUS_COLS)}
              AND w.chrom = t.chrom AND w.pos = t.pos AND w.ref = t.ref AND w.alt = t.alt)"""
_C1_LEADS = ("SELECT DISTINCT cond_chrom AS lead_chrom, cond_pos AS lead_pos, cond_ref AS lead_ref, "
             "cond_alt AS lead_alt FROM c1")
_CVAR = "cond_chrom, cond_pos, cond_ref, cond_alt"
COJO_COLS = LOCUS_COLS + ["chrom", "pos", "ref", "alt", "beta_cond", "se_cond", "pval_cond", "z_cond"]
_COJO_SQL = f"""SELECT {_LOC}, chrom, pos, ref, alt, beta_cond, se_cond, {_erfc_p_sql('z_cond')} AS pval_cond, z_cond
FROM (SELECT *, beta_cond / se_cond AS z_cond FROM (
 SELECT *, CASE WHEN var_cond > 0 THEN sqrt(var_cond) END AS se_cond FROM (
  SELECT *, s2 * (d_j - c_jk * c_jk / d_k) / (d_j * d_j) AS var_cond FROM (
   SELECT *, (yy - d_k * b_k * b_k - d_j * beta * beta_cond) / (n_j - 2.0) AS s2 FROM (
    SELECT *, beta - c_jk / d_j * b_k AS beta_cond FROM (
     SELECT *, median(yy_j) OVER (PARTITION BY {_LOC}) AS yy FROM (
      SELECT *, d_j * se * se * (n_j - 1.0) + d_j * beta * beta AS yy_j FROM (
       SELECT *, 2.0 * v_j * n_j AS d_j, 2.0 * v_k * n_k AS d_k, least(n_j, n_k) * 2.0 * sqrt(v_j * v_k) * r AS c_jk FROM (
        SELECT *, CAST(n_total AS DOUBLE) AS n_j, eaf * (1.0 - eaf) AS v_j, f_k * (1.0 - f_k) AS v_k FROM x2) a) b) c) d
     WHERE NOT (pos = cond_pos AND ref = cond_ref AND alt = cond_alt AND chrom = cond_chrom) AND r * r <= 0.9) e) f) g) h) i"""


def _cojo_views(v: str, signals: str) -> None:
    """Condition lists and conditional statistics of the signals in one view, for lists of one
    or two variants (all there are at sf0.01), by the closed forms of a 1 x 1 and 2 x 2 system."""
    register(f"{v}cond_v", (signals, "toploci", "sig_stats_cond_v"), _COND_SQL.replace("signals_v", signals))
    register(f"{v}cr_v", (f"{v}cond_v",), f"""
SELECT *, row_number() OVER (PARTITION BY {_LOC} ORDER BY cond_pos, cond_ref, cond_alt) AS i,
  count(*) OVER (PARTITION BY {_LOC}) AS k FROM {v}cond_v""")
    register(f"{v}ld_v", (f"{v}cond_v", "genotypes"),
             _ld_sql(_C1_LEADS.replace("c1", f"{v}cond_v"), "", window=2_000_000, digits=None))
    var = ("chrom", "pos", "ref", "alt")
    ld = lambda a, lead, tag: " AND ".join([f"{a}.lead_{c} = {lead}{c}" for c in var] + [f"{a}.tag_{c} = {tag}{c}" for c in var])
    own = lambda a, c: f"{nse_cols(a, c, LOCUS_COLS)} AND " + " AND ".join(f"{a}.{x} = {c}.cond_{x}" for x in var)
    register(f"{v}cx_v", (f"{v}cr_v", f"{v}ld_v", "sig_stats_cond_v"), f"""
SELECT {', '.join('w.' + c for c in LOCUS_COLS)}, w.chrom, w.pos, w.ref, w.alt, w.beta, w.se, w.eaf, w.n_total, c.k,
  l1.R_EUR AS r1, l2.R_EUR AS r2, l12.R_EUR AS r12, a.beta AS b1, e.beta AS b2,
  CAST(w.n_total AS DOUBLE) AS nj, CAST(a.n_total AS DOUBLE) AS n1, CAST(e.n_total AS DOUBLE) AS n2,
  w.eaf * (1.0 - w.eaf) AS vj, a.eaf * (1.0 - a.eaf) AS v1, e.eaf * (1.0 - e.eaf) AS v2,
  (w.chrom = c.cond_chrom AND w.pos = c.cond_pos AND w.ref = c.cond_ref AND w.alt = c.cond_alt)
   OR coalesce(w.pos = c2.cond_pos AND w.ref = c2.cond_ref AND w.alt = c2.cond_alt, false) AS is_k
FROM sig_stats_cond_v w JOIN {v}cr_v c ON c.i = 1 AND c.k <= 2 AND {nse_cols('w', 'c', LOCUS_COLS)}
JOIN {v}ld_v l1 ON {ld('l1', 'c.cond_', 'w.')}
JOIN sig_stats_cond_v a ON {own('a', 'c')}
LEFT JOIN {v}cr_v c2 ON c2.i = 2 AND {nse_cols('w', 'c2', LOCUS_COLS)}
LEFT JOIN {v}ld_v l2 ON {ld('l2', 'c2.cond_', 'w.')}
LEFT JOIN {v}ld_v l12 ON {ld('l12', 'c2.cond_', 'c.cond_')}
LEFT JOIN sig_stats_cond_v e ON {own('e', 'c2')}
WHERE c.k = 1 OR l2.R_EUR IS NOT NULL""")
    register(f"{v}cojo_v", (f"{v}cx_v",), f"""
SELECT *, beta_cond / se_cond AS z_cond FROM (
 SELECT *, CASE WHEN s2 * (dj - quad) / (dj * dj) > 0 THEN sqrt(s2 * (dj - quad) / (dj * dj)) END AS se_cond FROM (
  SELECT *, (yy - fit - dj * beta * beta_cond) / (nj - k - 1) AS s2 FROM (
   SELECT *, beta - (cj1 * bs1 + coalesce(cj2 * bs2, 0)) / dj AS beta_cond,
     bs1 * d1 * b1 + coalesce(bs2 * d2 * b2, 0) AS fit,
     CASE WHEN k = 1 THEN cj1 * cj1 / d1 ELSE (cj1 * cj1 * d2 - 2 * cj1 * cj2 * c12 + cj2 * cj2 * d1) / det END AS quad,
     CASE WHEN k = 1 THEN r1 * r1 ELSE (r1 * r1 - 2 * r1 * r2 * r12 + r2 * r2) / (1 - r12 * r12) END AS rr FROM (
    SELECT *, CASE WHEN k = 1 THEN b1 ELSE (d2 * d1 * b1 - c12 * d2 * b2) / det END AS bs1,
      CASE WHEN k = 2 THEN (d1 * d2 * b2 - c12 * d1 * b1) / det END AS bs2 FROM (
     SELECT *, d1 * d2 - c12 * c12 AS det, median(dj * se * se * (nj - 1) + dj * beta * beta) OVER (PARTITION BY {_LOC}) AS yy FROM (
      SELECT *, 2 * vj * nj AS dj, 2 * v1 * n1 AS d1, 2 * v2 * n2 AS d2, least(nj, n1) * 2 * sqrt(vj * v1) * r1 AS cj1,
        least(nj, n2) * 2 * sqrt(vj * v2) * r2 AS cj2, least(n1, n2) * 2 * sqrt(v1 * v2) * r12 AS c12 FROM {v}cx_v) a) b) c) d) e
 WHERE NOT is_k AND rr <= 0.9) f""")


_cojo_views("", "signals_v")
register("near_v", ("cond_v",), f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {_LOC}
  ORDER BY abs(cond_pos - lead_pos), cond_pos, cond_ref, cond_alt) AS rn FROM cond_v) WHERE rn = 1""")
register("routed_v", ("signals_v", "credset"), f"""
SELECT g.* FROM signals_v g JOIN (SELECT DISTINCT {_LOC}, multisignal_method FROM credset) m
  ON {nse_cols('g', 'm', LOCUS_COLS)} WHERE NOT starts_with(g.study_id, 'FINNGEN') AND multisignal_method <> 'distance'""")
_cojo_views("r_", "routed_v")
_PLAIN = ", ".join("w." + c for c in LOCUS_COLS + sm.STAT_COLS)


def _merged_sql(cojo: str) -> str:
    kept = [c for c in sm.STAT_COLS if c not in ("beta", "se", "pval")]
    return (f"SELECT {', '.join('w.' + c for c in LOCUS_COLS)}, {', '.join('w.' + c for c in kept)}, c.beta_cond AS beta, "
            f"c.se_cond AS se, {_erfc_p_sql('c.z_cond')} AS pval, c.z_cond FROM sig_stats_cond_v w JOIN {cojo} c "
            f"ON {nse_cols('w', 'c', LOCUS_COLS)} AND w.chrom = c.chrom AND w.pos = c.pos AND w.ref = c.ref AND w.alt = c.alt")


register("sig_stats_routed_v", ("sig_stats_cond_v", "r_cond_v", "r_cojo_v"), f"""
SELECT * FROM (
SELECT {_PLAIN}, CAST(NULL AS DOUBLE) AS z_cond FROM sig_stats_cond_v w
WHERE NOT EXISTS (SELECT 1 FROM r_cond_v c WHERE {nse_cols('w', 'c', LOCUS_COLS)})
UNION ALL BY NAME {_merged_sql('r_cojo_v')}) u WHERE abs(pos - lead_pos) <= 500000""")
O.register_coloc("r_", "sig_stats_routed_v", True)
_COJO_DIGITS = 6
_MERGED = LOCUS_COLS + sm.STAT_COLS + ["z_cond"]
_MERGED_ROUND = ["beta", "se", "pval", "z_cond", "eaf"]


def _near(conds, sig):
    """The condition list cut to the nearest variant of each signal."""
    from ..operators.windows import top_k_per_group
    c = conds.join(sig.select("signal_id", "lead_pos"), "signal_id")
    order = [F.abs(F.col("cond_pos") - F.col("lead_pos")), "cond_pos", "cond_ref", "cond_alt"]
    return top_k_per_group(c, ["signal_id"], order, 1).drop("lead_pos")


def _single_inputs(spark, d):
    """Signals, their window rows with the nearest condition, and that condition: the condition list meets the statistics
    of top loci only, and the window rows are made once, with the columns that the solver needs."""
    sig = _signals(spark, d)
    ss, tl = A.sumstats(spark, d), A.toploci(spark, d)
    names = sig.select("signal_id", *sm.SIGNAL_COLS)
    tops = sm.top_locus_stats(ss, tl)
    conds = cd.condition_list(sig, sm.signal_sumstats_join(names, tops, sm.COND_WINDOW_KB), tl)
    c1 = materialize(cd.single_conditions(_near(conds, sig)), "single-conditions")
    ws = sm.signal_sumstats_join(names.join(c1, "signal_id"), ss, sm.COND_WINDOW_KB)
    return sig, ws, c1


def _cojo_single_sql() -> str:
    ld = _ld_sql(_C1_LEADS, "", window=2_000_000, digits=None)
    body = f"""c1 AS (SELECT * FROM near_v),
ld AS ({ld}),
x2 AS (SELECT {', '.join('w.' + c for c in LOCUS_COLS)}, w.chrom, w.pos, w.ref, w.alt, w.beta, w.se, w.eaf, w.n_total,
    c.cond_chrom, c.cond_pos, c.cond_ref, c.cond_alt, ld.R_EUR AS r, k.beta AS b_k, k.eaf AS f_k,
    CAST(k.n_total AS DOUBLE) AS n_k
  FROM sig_stats_cond_v w JOIN c1 c ON {nse_cols('w', 'c', LOCUS_COLS)}
  JOIN ld ON ld.lead_chrom = c.cond_chrom AND ld.lead_pos = c.cond_pos AND ld.lead_ref = c.cond_ref
   AND ld.lead_alt = c.cond_alt AND ld.tag_chrom = w.chrom AND ld.tag_pos = w.pos AND ld.tag_ref = w.ref
   AND ld.tag_alt = w.alt
  JOIN sig_stats_cond_v k ON {nse_cols('k', 'c', LOCUS_COLS)} AND k.chrom = c.cond_chrom AND k.pos = c.cond_pos
   AND k.ref = c.cond_ref AND k.alt = c.cond_alt)
{rounded_sql(_COJO_SQL, COJO_COLS, COJO_COLS[-4:], _COJO_DIGITS)}"""
    head = with_adapters("SELECT 1", "near_v", "genotypes")
    return head[: head.rfind("SELECT 1")].rstrip() + ",\n" + body


@query("cojo_single", _cojo_single_sql())
def q_cojo_single(spark, d):
    """C1, k = 1: closed-form conditional statistics given each signal's nearest other lead."""
    sig, ws, conds = _single_inputs(spark, d)
    out = cd.cojo_single_rows(ws, conds, A.genotypes(spark, d), A.genotype_samples(spark, d), kept=LOCUS_COLS)
    return rounded(out.select(*COJO_COLS), COJO_COLS[-4:], _COJO_DIGITS)


@query("cojo_multi", S(rounded_sql(f"SELECT {_LOC}, chrom, pos, ref, alt, beta_cond, se_cond, {_erfc_p_sql('z_cond')} AS pval_cond, "
                                   "z_cond FROM cojo_v", COJO_COLS, COJO_COLS[-4:], _COJO_DIGITS), "cojo_v"))
def q_cojo_multi(spark, d):
    """C1, k >= 1: grouped NumPy solve per signal."""
    sig, ws, conds = _cond_inputs(spark, d)
    out = cd.cojo_multi(ws, conds, A.genotypes(spark, d), A.genotype_samples(spark, d))
    return rounded(out.join(sig, "signal_id").select(*COJO_COLS), COJO_COLS[-4:], _COJO_DIGITS)


@query("merge_conditional", S(rounded_sql(_merged_sql("cojo_v"), _MERGED, _MERGED_ROUND, _COJO_DIGITS), "cojo_v", "sig_stats_cond_v"))
def q_merge_conditional(spark, d):
    """Conditional statistics merged onto the window (inner on variant)."""
    sig = _signals(spark, d)
    ss = A.sumstats(spark, d)
    conds, _ = cd.window_conditions(sig, ss, A.toploci(spark, d))
    out = cd.solved_rows(cd.solve_windows(sig, conds, ss, A.genotypes(spark, d), A.genotype_samples(spark, d)))
    return rounded(out.join(sig, "signal_id").select(*_MERGED), _MERGED_ROUND, _COJO_DIGITS)


_STATUS = LOCUS_COLS + cd.STATUS_COLS


def _status_sql(where: str) -> str:
    """Lists of one or two variants: genotyped ones, and of two with r^2 > 0.9 one, are used."""
    return f"""SELECT {_LOC}, CAST(k AS INTEGER) AS n_requested, CAST(n_g AS INTEGER) AS n_genotyped, CAST(n_g - coll AS INTEGER) AS n_used,
  CASE WHEN n_g = 0 THEN 'no genotypes' WHEN coll > 0 THEN 'collinear variants left out'
       WHEN n_g < k THEN 'variants without genotypes left out' END AS reason
FROM (SELECT {', '.join('c.' + c for c in LOCUS_COLS)}, max(c.k) AS k, count(DISTINCT m.lead_pos) AS n_g, max(CASE WHEN l.R_EUR * l.R_EUR > 0.9 THEN 1 ELSE 0 END) AS coll
  FROM cr_v c LEFT JOIN (SELECT DISTINCT lead_chrom, lead_pos, lead_ref, lead_alt FROM ld_v) m
    ON m.lead_chrom = c.cond_chrom AND m.lead_pos = c.cond_pos AND m.lead_ref = c.cond_ref AND m.lead_alt = c.cond_alt
  LEFT JOIN cr_v d ON d.i > c.i AND {nse_cols('c', 'd', LOCUS_COLS)}
  LEFT JOIN ld_v l ON l.lead_chrom = c.cond_chrom AND l.lead_pos = c.cond_pos AND l.lead_ref = c.cond_ref AND l.lead_alt = c.cond_alt
    AND l.tag_chrom = d.cond_chrom AND l.tag_pos = d.cond_pos AND l.tag_ref = d.cond_ref AND l.tag_alt = d.cond_alt
  GROUP BY ALL) x {where}"""


def _solved(spark, d):
    """What becomes of a list depends on its own variants alone, all of them top loci: only their statistics are read again."""
    sig = _signals(spark, d)
    conds, tops = cd.window_conditions(sig, A.sumstats(spark, d), A.toploci(spark, d))
    return sig, cd.solve_windows(sig, conds, tops, A.genotypes(spark, d), A.genotype_samples(spark, d), rows=False)


@query("conditioning_status", S(_status_sql(""), "cr_v", "ld_v"))
def q_conditioning_status(spark, d):
    """Per signal with a condition list, variants asked for, genotyped and used, and why some were not."""
    return cd.conditioning_status(*_solved(spark, d)).select(*_STATUS)


@query("conditioning_failures", S(_status_sql("WHERE n_g = 0"), "cr_v", "ld_v"))
def q_conditioning_failures(spark, d):
    """Signals that could not be conditioned, with the reason."""
    return cd.conditioning_failures(*_solved(spark, d)).select(*_STATUS)


@query("signal_stats_conditional", S(rounded_sql("SELECT * FROM sig_stats_routed_v", _MERGED, _MERGED_ROUND, _COJO_DIGITS),
                                     "sig_stats_routed_v"))
def q_signal_stats_conditional(spark, d):
    """M4 with LD: routing, condition window, COJO, then the coloc window."""
    t = jobs.tests(spark, d)
    sig = jobs.routed_signals(spark, d, t).select("signal_id", *LOCUS_COLS)
    return rounded(jobs.conditional_stats(spark, d, t).join(sig, "signal_id").select(*_MERGED), _MERGED_ROUND, _COJO_DIGITS)


_RAW_COLS = RES16 + ["nsnps"] + [f"coloc_h{i}" for i in range(5)]


@query("coloc_results_conditional", S(rounded_sql("SELECT * FROM r_coloc_raw_v", _RAW_COLS, _RAW_COLS[-5:], _COJO_DIGITS), "r_coloc_raw_v"))
def q_coloc_results_conditional(spark, d):
    """M5 on conditional statistics: signals routed by LD reference and method."""
    return rounded(jobs.coloc_raw_conditional(spark, d).select(*_RAW_COLS), _RAW_COLS[-5:], _COJO_DIGITS)


@query("coloc_processed_conditional")
def q_coloc_processed_conditional(spark, d):
    """M6 on conditional results (ties of posteriors that differ by summation order have no common order in two engines)."""
    return jobs.coloc_processed_conditional(spark, d)


@query("coloc_status", S(f"""SELECT {', '.join('t.' + c for c in O.LOC16)}, CASE WHEN r.nsnps IS NULL THEN 'no_intersection' ELSE 'ok' END AS status
FROM tests_v t LEFT JOIN coloc_raw_v r ON """ + " AND ".join(
    f"t.{s}_{m} IS NOT DISTINCT FROM r.{s}_{c}" for s in SIDES for m, c in zip(LOCUS_COLS, RESULT_ID_COLS)), "tests_v", "coloc_raw_v"))
def q_coloc_status(spark, d):
    """Status of every test: a result, or no usable shared variant."""
    return abf.coloc_status(jobs.tests(spark, d), jobs.coloc_raw(spark, d))


# ============================================================================
# logs (G1, G2, W4)
# ============================================================================

# seconds as the log lines print them: value x 37, microseconds kept
_LOG_SECONDS = """secs AS (SELECT user_id AS log_id, arg_min(round(value * 37.0, 6), event_id) AS seconds
  FROM events WHERE event_type <> 'error' GROUP BY user_id)"""


@query("log_task_seconds", f"WITH {_LOG_SECONDS} SELECT log_id, round(seconds, 5) AS seconds FROM secs")
def q_log_task_seconds(spark, d):
    """G1: seconds from the first 'Time taken' line of each task log."""
    return rounded(lg.task_seconds(jobs.event_log_lines(spark, d)), ["seconds"], 5)


@query("log_errors", S("""SELECT log_id, line_no, line FROM (
  SELECT user_id AS log_id, event_id AS line_no,
    CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'ERROR Cannot run coloc with no intersection'
         WHEN event_type = 'error' THEN 'ERROR conditioning failed for task ' || CAST(event_id AS VARCHAR)
         ELSE 'INFO' END AS line FROM events) t
WHERE regexp_matches(line, 'ERROR') AND NOT regexp_matches(line, 'no intersection')"""))
def q_log_errors(spark, d):
    """ERROR lines except 'no intersection'."""
    return lg.error_lines(jobs.event_log_lines(spark, d))


@query("log_running_mean", f"""WITH {_LOG_SECONDS},
n AS (SELECT *, row_number() OVER (ORDER BY log_id) - 1 AS k FROM secs)
SELECT (b + 1) * 10 AS iteration, round(avg_s, 5) AS mean_seconds FROM (
  SELECT k // 10 AS b, count(*) AS c, sum(sum(seconds)) OVER (ORDER BY k // 10) / sum(count(*)) OVER (ORDER BY k // 10) AS avg_s
  FROM n GROUP BY k // 10) WHERE c = 10""")
def q_log_running_mean(spark, d):
    """Running mean of task seconds after every 10 logs, in the order of the log ids."""
    return rounded(lg.running_mean(lg.task_seconds(jobs.event_log_lines(spark, d)), interval=10), ["mean_seconds"], 5)

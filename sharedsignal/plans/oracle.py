"""DuckDB oracle SQL for the registered queries.

Written from the legacy semantics (plain self-joins, GROUP BY on all id
columns, window functions over the id columns), *not* from the Spark plan
rewrites, so a mismatch points at a rewrite error.  Shared statistics text
comes from ``functions.stats`` so both engines evaluate the same formulas.
"""

from __future__ import annotations

import math

from ..functions.stats import (PRIOR_P1, PRIOR_P2, PRIOR_P12, eaf_to_maf_sql, log_abf_sql,
                               log_diff_sql, log_sum_exp_sql, z_from_pval_sql)
from ..schemas import LOCUS_COLS, RESULT_ID_COLS
from .adapters_sql import register, with_adapters

SIDES = ("left", "right")
LOC16 = [f"{s}_{c}" for s in SIDES for c in LOCUS_COLS]
RES16 = [f"{s}_{c}" for s in SIDES for c in RESULT_ID_COLS]


def nse(a: str, b: str, cols) -> str:
    """Null-safe equality of ``a.col`` and ``b.col`` over ``cols``."""
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def nse_map(a: str, b: str, pairs) -> str:
    return " AND ".join(f"{a}.{x} IS NOT DISTINCT FROM {b}.{y}" for x, y in pairs)


def key_sql(prefix: str = "") -> str:
    parts = [f"{prefix}{c}" if c != "lead_pos" else f"CAST({prefix}{c} AS VARCHAR)" for c in LOCUS_COLS]
    return f"concat_ws('_', {', '.join(parts)})"


# --- M1 overlap ---------------------------------------------------------------

register("cs95", ("credset",), f"""
SELECT {', '.join(LOCUS_COLS)}, tag_chrom, tag_pos, tag_ref, tag_alt, {key_sql()} AS key
FROM credset WHERE is95_credset""")

register("tag_counts_v", ("cs95",), "SELECT key, count(tag_chrom) AS num_tags FROM cs95 GROUP BY key")

_l_cols = ", ".join(f"l.{c} AS left_{c}" for c in LOCUS_COLS)
_r_cols = ", ".join(f"r.{c} AS right_{c}" for c in LOCUS_COLS)
register("overlap_hits", ("cs95",), f"""
SELECT l.key AS left_key, r.key AS right_key, {_l_cols}, {_r_cols}, l.tag_chrom AS tag_chrom
FROM cs95 l JOIN cs95 r
  ON l.tag_chrom = r.tag_chrom AND l.tag_pos = r.tag_pos AND l.tag_ref = r.tag_ref AND l.tag_alt = r.tag_alt
WHERE l.study_id <> r.study_id AND (l.type = 'gwas' OR r.type = 'gwas') AND l.key > r.key
  AND abs(l.lead_pos - r.lead_pos) <= 500000""")

register("overlap_counts_v", ("overlap_hits",), f"""
SELECT left_key, right_key, {', '.join(LOC16)}, count(tag_chrom) AS num_overlapping
FROM overlap_hits GROUP BY left_key, right_key, {', '.join(LOC16)}""")

OVERLAP_COLS = LOC16 + ["num_overlapping", "left_num_tags", "right_num_tags",
                        "left_overlap_prop", "right_overlap_prop"]

register("overlap_v", ("overlap_counts_v", "tag_counts_v"), f"""
SELECT {', '.join('o.' + c for c in LOC16)}, o.num_overlapping,
       lt.num_tags AS left_num_tags, rt.num_tags AS right_num_tags,
       o.num_overlapping / lt.num_tags AS left_overlap_prop,
       o.num_overlapping / rt.num_tags AS right_overlap_prop
FROM overlap_counts_v o JOIN tag_counts_v lt ON o.left_key = lt.key
JOIN tag_counts_v rt ON o.right_key = rt.key""")


def _partition_path_sql() -> str:
    order = [("study", "study_id"), ("type", "type"), ("phenotype", "phenotype_id"),
             ("bio_feature", "bio_feature"), ("chrom", "lead_chrom"), ("pos", "lead_pos"),
             ("ref", "lead_ref"), ("alt", "lead_alt")]
    parts = [f"'{s}_{n}=' || coalesce(CAST({s}_{c} AS VARCHAR), 'None')" for s in SIDES for n, c in order]
    return " || '/' || ".join(parts)


def _manifest_select() -> str:
    cols = []
    for s in SIDES:
        cols.append(f"'/data/sumstats/' || (CASE WHEN {s}_type = 'gwas' THEN 'gwas' ELSE 'molecular_trait' END)"
                    f" || '/' || {s}_study_id || '.parquet' AS {s}_sumstats")
        cols.append(f"CASE WHEN starts_with({s}_study_id, 'FINNGEN') THEN CAST(NULL AS VARCHAR) ELSE "
                    f"'/data/ld/panel_chr' || CAST({s}_lead_chrom AS VARCHAR) || '' END AS {s}_ld")
        cols += [f"{s}_{c}" for c in LOCUS_COLS]
    p = _partition_path_sql()
    cols += ["'conditional' AS method",
             f"'/output/data/' || {p} || '/coloc_res.json.gz' AS out",
             f"'/output/logs/' || {p} || '/log_file.txt' AS log",
             f"'/output/tmp/' || {p} AS tmpdir",
             f"'/output/plot/' || {p} || '/plot.png' AS plot"]
    return ", ".join(cols)


register("manifest_v", ("overlap_v",), f"""
SELECT {_manifest_select()} FROM overlap_v
WHERE greatest(left_overlap_prop, right_overlap_prop) >= 0.01""")

# --- M4/M5 coloc -----------------------------------------------------------------

register("tests_v", ("manifest_v",), f"SELECT DISTINCT {', '.join(LOC16)} FROM manifest_v")

register("signals_v", ("tests_v",), " UNION ".join(
    f"SELECT {', '.join(f'{s}_{c} AS {c}' for c in LOCUS_COLS)} FROM tests_v" for s in SIDES))

register("sig_stats_v", ("signals_v", "sumstats"), f"""
SELECT {', '.join('g.' + c for c in LOCUS_COLS)}, s.chrom, s.pos, s.ref, s.alt, s.beta, s.se, s.pval,
       s.n_total, s.n_cases, s.eaf, s.is_cc
FROM signals_v g JOIN sumstats s
  ON s.study_id = g.study_id AND s.phenotype_id IS NOT DISTINCT FROM g.phenotype_id
 AND s.bio_feature IS NOT DISTINCT FROM g.bio_feature AND s.chrom = g.lead_chrom
 AND abs(CAST(s.pos AS BIGINT) - CAST(g.lead_pos AS BIGINT)) <= 500000
WHERE ({eaf_to_maf_sql('s.eaf')} >= 0.01 OR s.eaf IS NULL OR isnan(s.eaf))""")

_side_stats = lambda p, a, cond=False: ", ".join([f"{a}.pval AS {p}_pval", f"{a}.eaf AS {p}_eaf", f"{a}.n_total AS {p}_n",
                                      f"{a}.n_cases AS {p}_ncases", f"{a}.is_cc AS {p}_cc"] + ([f"{a}.z_cond AS {p}_zc"] if cond else []))
_P16 = ", ".join(LOC16)
_first = []
for _s in SIDES:
    for _c in ("n", "ncases", "cc"):
        _first.append(f"arg_min({_s}_{_c}, vid) OVER (PARTITION BY {_P16}) AS f_{_s}_{_c}")


def _labf(side: str, cond: bool = False) -> str:
    n = f"CAST(f_{side}_n AS DOUBLE)"
    nc = f"CAST(f_{side}_ncases AS DOUBLE)"
    s = f"(least({nc}, {n} - {nc}) / {n})"
    cc = f"coalesce(f_{side}_cc, false)"
    maf = eaf_to_maf_sql(f"{side}_eaf")
    z = z_from_pval_sql(f"{side}_pval")
    return log_abf_sql(f"coalesce(abs({side}_zc), {z})" if cond else z, maf, n, cc, s)


def _valid(side: str, cond: bool = False) -> str:
    maf = eaf_to_maf_sql(f"{side}_eaf")
    p = f"({side}_pval > 0 AND NOT isnan({side}_pval))"
    return (f"({side}_zc IS NOT NULL OR {p})" if cond else p) + f" AND {maf} > 0 AND NOT isnan({maf})"


_lh = ["CAST(0.0 AS DOUBLE)", f"({math.log(PRIOR_P1)!r} + L1)", f"({math.log(PRIOR_P2)!r} + L2)",
       f"({math.log(PRIOR_P1) + math.log(PRIOR_P2)!r} + {log_diff_sql('(L1 + L2)', 'L12')})",
       f"({math.log(PRIOR_P12)!r} + L12)"]
_den = log_sum_exp_sql(*[f"lh{i}" for i in range(5)])
_rename16 = ", ".join(f"{s}_{m} AS {s}_{r}" for s in SIDES for m, r in zip(LOCUS_COLS, RESULT_ID_COLS))


def register_coloc(v: str, stats: str, cond: bool) -> None:
    """The coloc chain over one view of prepared statistics; view names start with ``v``."""
    register(f"{v}shared_v", ("tests_v", stats), f"""
SELECT {', '.join('t.' + c for c in LOC16)}, l.chrom, l.pos, l.ref, l.alt,
       concat_ws(':', l.chrom, CAST(l.pos AS VARCHAR), l.ref, l.alt) AS vid,
       {_side_stats('left', 'l', cond)}, {_side_stats('right', 'r', cond)}
FROM tests_v t
JOIN {stats} l ON {nse_map('t', 'l', [(f'left_{c}', c) for c in LOCUS_COLS])}
JOIN {stats} r ON {nse_map('t', 'r', [(f'right_{c}', c) for c in LOCUS_COLS])}
 AND r.chrom = l.chrom AND r.pos = l.pos AND r.ref = l.ref AND r.alt = l.alt""")

    register(f"{v}shared_first_v", (f"{v}shared_v",), f"SELECT *, {', '.join(_first)} FROM {v}shared_v")


    register(f"{v}labf_v", (f"{v}shared_first_v",), f"""
SELECT {_P16}, vid, {_labf('left', cond)} AS l1, {_labf('right', cond)} AS l2
FROM {v}shared_first_v WHERE {_valid('left', cond)} AND {_valid('right', cond)}""")

    register(f"{v}labf_max_v", (f"{v}labf_v",), f"""
SELECT {_P16}, l1, l2, l1 + l2 AS l12,
       max(l1) OVER (PARTITION BY {_P16}) AS m1, max(l2) OVER (PARTITION BY {_P16}) AS m2,
       max(l1 + l2) OVER (PARTITION BY {_P16}) AS m12
FROM {v}labf_v""")

    register(f"{v}coloc_L_v", (f"{v}labf_max_v",), f"""
SELECT {_P16}, CAST(count(*) AS INTEGER) AS nsnps,
       max(m1) + ln(sum(exp(l1 - m1))) AS L1, max(m2) + ln(sum(exp(l2 - m2))) AS L2,
       max(m12) + ln(sum(exp(l12 - m12))) AS L12
FROM {v}labf_max_v GROUP BY {_P16}""")

    register(f"{v}coloc_lh_v", (f"{v}coloc_L_v",), f"""
SELECT {_P16}, nsnps, {', '.join(f'{x} AS lh{i}' for i, x in enumerate(_lh))} FROM {v}coloc_L_v""")

    register(f"{v}coloc_raw_v", (f"{v}coloc_lh_v",), f"""
SELECT {_rename16}, nsnps, {', '.join(f'exp(lh{i} - {_den}) AS coloc_h{i}' for i in range(5))}
FROM {v}coloc_lh_v""")

    register(f"{v}coloc_ratio_v", (f"{v}coloc_raw_v",), f"""
SELECT * EXCLUDE (nsnps), nsnps AS coloc_n_vars,
       coloc_h4 / NULLIF(coloc_h3, 0) AS coloc_h4_h3,
       CASE WHEN coloc_h4 / NULLIF(coloc_h3, 0) > 0 THEN log2(coloc_h4 / NULLIF(coloc_h3, 0)) END AS coloc_log2_h4_h3
FROM {v}coloc_raw_v""")


register_coloc("", "sig_stats_v", False)

# --- M6 processing ---------------------------------------------------------------

def _swap_select(cols_left_right) -> str:
    out = []
    for c in cols_left_right:
        if c.startswith("left_"):
            out.append(f"right_{c[5:]} AS {c}")
        elif c.startswith("right_"):
            out.append(f"left_{c[6:]} AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


RATIO_COLS = RES16 + ["coloc_h0", "coloc_h1", "coloc_h2", "coloc_h3", "coloc_h4",
                      "coloc_n_vars", "coloc_h4_h3", "coloc_log2_h4_h3"]


def min_vars_view(n: int, v: str = "") -> str:
    name = f"{v}coloc_sym_{n}"
    register(f"{v}coloc_minvars_{n}", (f"{v}coloc_ratio_v",),
             f"SELECT {', '.join(RATIO_COLS)} FROM {v}coloc_ratio_v WHERE coloc_n_vars >= {n}")
    register(name, (f"{v}coloc_minvars_{n}",), f"""
SELECT {', '.join(RATIO_COLS)}, false AS is_flipped FROM {v}coloc_minvars_{n}
UNION ALL
SELECT {_swap_select(RATIO_COLS)}, true AS is_flipped FROM {v}coloc_minvars_{n}""")
    dedup_subset = ["left_type", "left_study", "left_phenotype", "left_bio_feature", "left_chrom",
                    "left_pos", "left_ref", "left_alt", "right_type", "right_study",
                    "right_bio_feature", "right_phenotype"]
    register(f"{v}coloc_dedup_{n}", (name,), f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(dedup_subset)}
     ORDER BY round(coloc_h4, 9) DESC NULLS LAST, right_chrom ASC NULLS LAST, right_pos ASC NULLS LAST,
              right_ref ASC NULLS LAST, right_alt ASC NULLS LAST, is_flipped ASC NULLS LAST) AS rn
  FROM {name} WHERE left_type = 'gwas') x WHERE rn = 1""")
    register(f"{v}coloc_processed_{n}", (f"{v}coloc_dedup_{n}", "pheno_gene"), f"""
SELECT d.* EXCLUDE (left_phenotype, left_bio_feature),
  CASE WHEN starts_with(coalesce(g.gene_id, d.right_phenotype), 'ENSG')
       THEN coalesce(g.gene_id, d.right_phenotype) END AS right_gene_id
FROM {v}coloc_dedup_{n} d
LEFT JOIN (SELECT phenotype_id, max(gene_id) AS gene_id FROM pheno_gene
           WHERE starts_with(gene_id, 'ENSG') GROUP BY phenotype_id) g
  ON d.right_phenotype = g.phenotype_id
WHERE d.coloc_h3 IS NOT NULL AND NOT isnan(d.coloc_h3) AND d.coloc_h4 IS NOT NULL
  AND NOT isnan(d.coloc_h4) AND d.coloc_log2_h4_h3 IS NOT NULL AND NOT isnan(d.coloc_log2_h4_h3)""")
    return f"{v}coloc_processed_{n}"

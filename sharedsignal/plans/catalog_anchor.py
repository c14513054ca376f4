"""Query catalogue, part 4: coloc with both windows cut around the left lead
(``window_anchor='left'``, the all-in-one legacy path; SURVEY 2.9)."""

from __future__ import annotations

import re

from ..functions.stats import eaf_to_maf_sql
from ..operators import abf
from ..schemas import LOCUS_COLS
from ..sources import adapters as A
from . import jobs, oracle as O
from .adapters_sql import CTES, register, with_adapters
from .registry import query, rounded, rounded_sql

PP = [f"coloc_h{i}" for i in range(5)]
RAW_COLS = O.RES16 + ["nsnps"] + PP

_stats = lambda p, a: ", ".join([f"{a}.pval AS {p}_pval", f"{a}.eaf AS {p}_eaf", f"{a}.n_total AS {p}_n",
                                 f"{a}.n_cases AS {p}_ncases", f"{a}.is_cc AS {p}_cc"])

register("shared_la_v", ("tests_v", "sig_stats_v", "sumstats"), f"""
SELECT {', '.join('t.' + c for c in O.LOC16)}, l.chrom, l.pos, l.ref, l.alt,
       concat_ws(':', l.chrom, CAST(l.pos AS VARCHAR), l.ref, l.alt) AS vid,
       {_stats('left', 'l')}, {_stats('right', 'r')}
FROM tests_v t
JOIN sig_stats_v l ON {O.nse_map('t', 'l', [(f'left_{c}', c) for c in LOCUS_COLS])}
JOIN sumstats r ON r.study_id = t.right_study_id AND r.phenotype_id IS NOT DISTINCT FROM t.right_phenotype_id
 AND r.bio_feature IS NOT DISTINCT FROM t.right_bio_feature AND r.chrom = t.left_lead_chrom
 AND abs(CAST(r.pos AS BIGINT) - CAST(t.left_lead_pos AS BIGINT)) <= 500000
 AND ({eaf_to_maf_sql('r.eaf')} >= 0.01 OR r.eaf IS NULL OR isnan(r.eaf))
 AND r.chrom = l.chrom AND r.pos = l.pos AND r.ref = l.ref AND r.alt = l.alt""")

# the downstream chain is the same SQL over the new shared view
_CHAIN = ["shared_first_v", "labf_v", "labf_max_v", "coloc_L_v", "coloc_lh_v", "coloc_raw_v"]
_RENAME = {"shared_v": "shared_la_v", **{n: n.replace("_v", "_la_v", 1) if n.endswith("_v") else n for n in _CHAIN}}
for _name in _CHAIN:
    _deps, _sql = CTES[_name]
    for _old, _new in _RENAME.items():
        _sql = re.sub(rf"\b{_old}\b", _new, _sql)
    register(_RENAME[_name], tuple(_RENAME.get(d, d) for d in _deps), _sql)


@query("coloc_results_left_anchor", with_adapters(rounded_sql("SELECT * FROM coloc_raw_la_v", RAW_COLS, PP),
                                                  "coloc_raw_la_v"))
def q_coloc_results_left_anchor(spark, d):
    """M5 with window_anchor='left': the right signal's statistics are cut around the left lead."""
    t = jobs.tests(spark, d)
    return rounded(abf.run_coloc_windows(t, A.sumstats(spark, d), window_anchor="left").select(*RAW_COLS), PP)

"""Query catalogue: every SURVEY section-2 operator registered over the driver tables.

Each entry pairs a Spark callable with DuckDB SQL (or none, for sinks and
model fitting: rows-only check).  Composite views in SQL come from
``oracle``; Spark inputs from ``plans.jobs`` and ``sources.adapters``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import abf, overlap as ov, results as rs
from ..schemas import LOCUS_COLS
from ..sources import adapters as A
from . import jobs, oracle as O
from .adapters_sql import with_adapters
from .registry import query, rounded, rounded_sql

PP = [f"coloc_h{i}" for i in range(5)]
MV = jobs.QUERY_MIN_VARS
RAW_COLS = O.RES16 + ["nsnps"] + PP


# --- composite jobs (M1, M2, M5, M6) --------------------------------------------

@query("overlap_table", with_adapters(f"SELECT {', '.join(O.OVERLAP_COLS)} FROM overlap_v", "overlap_v"))
def q_overlap_table(spark, d):
    return jobs.overlap_table(spark, d)


@query("manifest", with_adapters("SELECT * FROM manifest_v", "manifest_v"))
def q_manifest(spark, d):
    return jobs.manifest(spark, d)


@query("coloc_results", with_adapters(rounded_sql("SELECT * FROM coloc_raw_v", RAW_COLS, PP), "coloc_raw_v"))
def q_coloc_results(spark, d):
    return rounded(jobs.coloc_raw(spark, d), PP)


_proc = O.min_vars_view(MV)
PROC_COLS = (["left_type", "left_study", "left_chrom", "left_pos", "left_ref", "left_alt"]
             + [f"right_{c}" for c in ("type", "study", "phenotype", "bio_feature", "chrom", "pos", "ref", "alt")]
             + PP + ["coloc_n_vars", "coloc_h4_h3", "coloc_log2_h4_h3", "is_flipped", "right_gene_id"])
PROC_ROUND = PP + ["coloc_h4_h3", "coloc_log2_h4_h3"]


@query("coloc_processed", with_adapters(
    rounded_sql(f"SELECT {', '.join(PROC_COLS)} FROM {_proc}", PROC_COLS, PROC_ROUND), _proc))
def q_coloc_processed(spark, d):
    return rounded(jobs.coloc_processed(spark, d, MV).select(*PROC_COLS), PROC_ROUND)


# ============================================================================
# helpers
# ============================================================================
from ..functions.stats import eaf_to_maf, eaf_to_maf_sql, log_abf_sql, z_from_pval_sql  # noqa: E402
from ..functions.variants import parse_variant_id, swap_separators, variant_id  # noqa: E402
from ..operators import betas as bt, conditional as cd, features as ft, ld as ldm  # noqa: E402
from ..operators import logs as lg, manifest as mf, releases as rl, sumstats as sm  # noqa: E402
from ..operators.windows import keep_first  # noqa: E402
from ..sources import io  # noqa: E402
from .adapters_sql import register  # noqa: E402

RATIO_ROUND = PP + ["coloc_h4_h3", "coloc_log2_h4_h3"]
SS_COLS = ["type", "study_id", "phenotype_id", "bio_feature", "chrom", "pos", "ref", "alt", "beta", "se",
           "pval", "n_total", "n_cases", "eaf", "is_cc"]
CS_COLS = ["type", "study_id", "phenotype_id", "bio_feature", "lead_chrom", "lead_pos", "lead_ref", "lead_alt",
           "tag_chrom", "tag_pos", "tag_ref", "tag_alt", "is95_credset", "is99_credset", "multisignal_method"]
TL_COLS = ["study_id", "phenotype_id", "bio_feature", "chrom", "pos", "ref", "alt", "variant_id", "pval"]


def S(body: str, *views: str) -> str:
    return with_adapters(body, *views)


def _ratio(spark, d):
    return rs.add_ratios(rs.rename_raw(jobs.coloc_raw(spark, d)))


def _sym(spark, d):
    return rs.make_symmetric(rs.filter_min_vars(_ratio(spark, d), MV))


def _read_back(df, name, writer):
    path = io.scratch_path(df.sparkSession, name)
    writer(df, path)
    return path


# ============================================================================
# 2.1 scans and sinks
# ============================================================================

@query("credset_scan", S(f"SELECT {', '.join(CS_COLS)} FROM credset", "credset"))
def q_credset_scan(spark, d):
    """JSON lines written without NULL fields, read back with the declared schema."""
    path = _read_back(A.credset(spark, d), "credset_json", lambda df, p: df.write.mode("overwrite").json(p))
    return io.read_credset(spark, path)


@query("sumstats_scan", S(f"""SELECT study_id, phenotype_id, bio_feature, chrom, pos, ref, alt, beta, se, pval,
  n_total, n_cases, eaf, is_cc, concat_ws(':', chrom, CAST(pos AS VARCHAR), ref, alt) AS variant_id
FROM sumstats WHERE chrom = '1' AND ({eaf_to_maf_sql('eaf')} >= 0.01 OR eaf IS NULL OR isnan(eaf))""", "sumstats"))
def q_sumstats_scan(spark, d):
    """S2 + S13: hive-partitioned Parquet, read with a chromosome predicate (partition
    pruning) and the MAF filter."""
    path = _read_back(A.sumstats(spark, d).drop("type"), "sumstats_pq",
                      lambda df, p: io.partition_sumstats(df, p, mode="overwrite"))
    df = spark.read.option("basePath", path).parquet(path)
    return io.sumstats_region(df, chrom="1", min_maf=0.01)


@query("toploci_scan", S(f"SELECT {', '.join(TL_COLS)} FROM toploci WHERE chrom = '1'", "toploci"))
def q_toploci_scan(spark, d):
    """S7 + S15: top loci partitioned by chromosome, one chromosome read back."""
    path = _read_back(A.toploci(spark, d), "toploci_json", io.partition_toploci)
    return io.read_toploci(spark, path, chrom="1").select(*TL_COLS)


@query("pheno_gene_map", S("""SELECT phenotype_id, max(gene_id) AS gene_id FROM pheno_gene
WHERE starts_with(gene_id, 'ENSG') GROUP BY phenotype_id""", "pheno_gene"))
def q_pheno_gene_map(spark, d):
    """TSV with header in another column order, ENSG filter, one gene per phenotype."""
    path = _read_back(A.pheno_gene(spark, d).select("gene_id", "phenotype_id"), "pheno_gene_tsv",
                      lambda df, p: df.write.mode("overwrite").csv(p, sep="\t", header=True, compression="gzip"))
    return io.read_pheno_gene(spark, path)


@query("ld_scan")
def q_ld_scan(spark, d):
    """LD text TSV.gz read with the explicit schema."""
    pairs = ldm.ld_pairs(A.genotypes(spark, d), jobs.toploci_leads(spark, d), A.genotype_samples(spark, d), min_r2=ldm.MIN_R2)
    path = _read_back(ldm.ld_as_text(ldm.ld_r2_filter(pairs)), "ld_tsv",
                      lambda df, p: df.write.mode("overwrite").csv(p, sep="\t", header=True, compression="gzip"))
    return io.read_ld_tsv(spark, path)


@query("results_scan_partitioned", S(rounded_sql("SELECT * FROM coloc_raw_v", RAW_COLS, PP), "coloc_raw_v"))
def q_results_scan_partitioned(spark, d):
    """S3: JSON results under hive directories (NULL ids as default partition), read
    with basePath; ids restored from the paths."""
    part = ["left_study", "left_type", "right_study", "right_type", "right_phenotype"]
    raw = jobs.coloc_raw(spark, d).select(*RAW_COLS)
    path = _read_back(raw, "results_json", lambda df, p: df.hint("rebalance").write.mode("overwrite").partitionBy(*part).json(p))
    return rounded(io.read_results_dir(spark, path, raw.schema).select(*RAW_COLS), PP)


@query("overlap_write_json", S(f"SELECT {', '.join(O.OVERLAP_COLS)} FROM overlap_v", "overlap_v"))
def q_overlap_write_json(spark, d):
    """Overlap table as gzip JSON lines (distributed write; one file only on request)."""
    table = jobs.overlap_table(spark, d).select(*O.OVERLAP_COLS)
    return spark.read.schema(table.schema).json(_read_back(table, "overlap_json", io.write_json))


@query("compact_results", S(rounded_sql("SELECT * FROM coloc_raw_v", RAW_COLS, PP), "coloc_raw_v"))
def q_compact_results(spark, d):
    """Results compacted to Parquet files of the advisory size."""
    path = _read_back(jobs.coloc_raw(spark, d), "raw_compact", io.write_compacted)
    return rounded(spark.read.parquet(path).select(*RAW_COLS), PP)


@query("range_sorted_layout", S(rounded_sql(f"SELECT * FROM coloc_processed_{MV}", PROC_COLS, PROC_ROUND), f"coloc_processed_{MV}"))
def q_range_sorted_layout(spark, d):
    """Processed table range-partitioned and sorted by (left_chrom, left_pos)."""
    path = _read_back(jobs.coloc_processed(spark, d, MV), "processed_sorted", io.write_range_sorted)
    return rounded(spark.read.parquet(path).select(*PROC_COLS), PROC_ROUND)


@query("partition_sumstats", S(f"SELECT {', '.join(SS_COLS[1:])} FROM sumstats", "sumstats"))
def q_partition_sumstats(spark, d):
    """Full sumstats in the hive layout, read back whole."""
    path = _read_back(A.sumstats(spark, d).drop("type"), "sumstats_pq2",
                      lambda df, p: io.partition_sumstats(df, p, mode="overwrite"))
    return spark.read.schema(A.sumstats(spark, d).drop("type").schema).parquet(path).select(*SS_COLS[1:])


@query("partition_credset", S(f"SELECT {', '.join(CS_COLS)} FROM credset", "credset"))
def q_partition_credset(spark, d):
    """Credible sets as gzip JSON by study / feature / lead chromosome."""
    path = _read_back(A.credset(spark, d), "credset_part", io.partition_credset)
    return io.read_credset(spark, path)


@query("partition_toploci", S(f"SELECT {', '.join(TL_COLS)} FROM toploci", "toploci"))
def q_partition_toploci(spark, d):
    """Top loci by chromosome, read back whole."""
    path = _read_back(A.toploci(spark, d), "toploci_part", io.partition_toploci)
    return io.read_toploci(spark, path).select(*TL_COLS)


_CONCAT_SQL = ", ".join("CASE WHEN left_lead_pos % 2 = 0 THEN right_num_tags END AS right_num_tags" if c == "right_num_tags" else c
                        for c in O.OVERLAP_COLS)


@query("concat_json", S(f"SELECT {_CONCAT_SQL} FROM overlap_v", "overlap_v"))
def q_concat_json(spark, d):
    """Two JSON-lines parts (different columns) concatenated by name."""
    ov_ = jobs.overlap_table(spark, d)
    p1 = _read_back(ov_.filter(F.col("left_lead_pos") % 2 == 0), "cj1", lambda df, p: df.write.mode("overwrite").json(p))
    p2 = _read_back(ov_.filter(F.col("left_lead_pos") % 2 == 1).drop("right_num_tags"), "cj2",
                    lambda df, p: df.write.mode("overwrite").json(p))
    return io.concat_json(spark, [p1, p2]).select(*O.OVERLAP_COLS)


SIGSTAT_COLS = LOCUS_COLS + sm.STAT_COLS


def _signal_stats_named(spark, d, window_kb=sm.COLOC_WINDOW_KB):
    sig = abf.signals_with_ids(jobs.tests(spark, d))
    return sm.signal_stats(sig, A.sumstats(spark, d), window_kb, named=True).select(*SIGSTAT_COLS)


@query("signal_stats", S(f"SELECT {', '.join(SIGSTAT_COLS)} FROM sig_stats_v", "sig_stats_v"))
def q_signal_stats(spark, d):
    """S18 / M4 (no LD): prepared statistics per signal, coloc window around its own lead."""
    return _signal_stats_named(spark, d)


register("sig_stats_cond_v", ("signals_v", "sumstats"), f"""
SELECT {', '.join('g.' + c for c in LOCUS_COLS)}, s.chrom, s.pos, s.ref, s.alt, s.beta, s.se, s.pval,
       s.n_total, s.n_cases, s.eaf, s.is_cc
FROM signals_v g JOIN sumstats s
  ON s.study_id = g.study_id AND s.phenotype_id IS NOT DISTINCT FROM g.phenotype_id
 AND s.bio_feature IS NOT DISTINCT FROM g.bio_feature AND s.chrom = g.lead_chrom
 AND abs(CAST(s.pos AS BIGINT) - CAST(g.lead_pos AS BIGINT)) <= 1000000
WHERE ({eaf_to_maf_sql('s.eaf')} >= 0.01 OR s.eaf IS NULL OR isnan(s.eaf))""")


@query("signal_sumstats_join", S(f"SELECT {', '.join(SIGSTAT_COLS)} FROM sig_stats_cond_v", "sig_stats_cond_v"))
def q_signal_sumstats_join(spark, d):
    """Signals x sumstats range join, conditioning window (+-1000 kb)."""
    return _signal_stats_named(spark, d, sm.COND_WINDOW_KB)


# ============================================================================
# 2.2 projections and filters
# ============================================================================

@query("credset_filter_level", S(f"SELECT {', '.join(CS_COLS)} FROM credset WHERE is99_credset", "credset"))
def q_credset_filter_level(spark, d):
    return ov.filter_credset_level(A.credset(spark, d), "99")


@query("credset_filter_method", S(f"SELECT {', '.join(CS_COLS)} FROM credset WHERE multisignal_method = 'conditional'",
                                  "credset"))
def q_credset_filter_method(spark, d):
    return ov.filter_credset_method(A.credset(spark, d), "conditional")


@query("study_locus_key", S(f"SELECT DISTINCT {O.key_sql()} AS key, {', '.join(LOCUS_COLS)} FROM credset", "credset"))
def q_study_locus_key(spark, d):
    return A.credset(spark, d).select(ov.study_locus_key().alias("key"), *LOCUS_COLS).distinct()


@query("variant_id", S("""SELECT study_id, phenotype_id, bio_feature,
  concat_ws(':', chrom, CAST(pos AS VARCHAR), ref, alt) AS variant_id FROM sumstats""", "sumstats"))
def q_variant_id(spark, d):
    return A.sumstats(spark, d).select("study_id", "phenotype_id", "bio_feature", variant_id().alias("variant_id"))


_vid_text = ("CASE WHEN pos % 7 = 0 THEN concat('chr', chrom, '_x', CAST(pos AS VARCHAR)) "
             "ELSE translate(concat_ws(':', chrom, CAST(pos AS VARCHAR), ref, alt), ':_', '_:') END")


@query("parse_variant_id", S(f"""SELECT vid AS index_variant_id,
  string_split(vid, '_')[1] AS lead_chrom, TRY_CAST(string_split(vid, '_')[2] AS BIGINT) AS lead_pos,
  string_split(vid, '_')[3] AS lead_ref, string_split(vid, '_')[4] AS lead_alt
FROM (SELECT DISTINCT {_vid_text} AS vid FROM sumstats) t""", "sumstats"))
def q_parse_variant_id(spark, d):
    """P6 + P7: ':' <-> '_' swap, split, ANSI-safe int cast (malformed ids -> NULL parts)."""
    ss = A.sumstats(spark, d).select("chrom", "pos", "ref", "alt")
    v = ss.select(F.when(F.col("pos") % 7 == 0,
                         F.concat(F.lit("chr"), F.col("chrom"), F.lit("_x"), F.col("pos").cast("string")))
                  .otherwise(F.translate(variant_id(), ":_", "_:")).alias("index_variant_id")).distinct()
    return v.select("index_variant_id", *parse_variant_id("index_variant_id", "lead"))


@query("eaf_to_maf", S(f"SELECT study_id, phenotype_id, bio_feature, chrom, pos, ref, alt, eaf, "
                       f"{eaf_to_maf_sql('eaf')} AS maf FROM sumstats", "sumstats"))
def q_eaf_to_maf(spark, d):
    return A.sumstats(spark, d).select("study_id", "phenotype_id", "bio_feature", "chrom", "pos", "ref", "alt",
                                       "eaf", eaf_to_maf(F.col("eaf")).alias("maf"))


@query("maf_filter", S(f"SELECT {', '.join(SS_COLS)} FROM sumstats WHERE "
                       f"({eaf_to_maf_sql('eaf')} >= 0.05 OR eaf IS NULL OR isnan(eaf))", "sumstats"))
def q_maf_filter(spark, d):
    return sm.maf_filter(A.sumstats(spark, d), 0.05)


@query("sumstats_region_filter", S(f"""SELECT {', '.join(SS_COLS)} FROM sumstats
WHERE study_id = 'S3' AND chrom = '2' AND pos >= 100000 AND pos <= 2000000""", "sumstats"))
def q_sumstats_region_filter(spark, d):
    """P10: phenotype / feature are None -> no predicate on them."""
    return sm.region_filter(A.sumstats(spark, d), "S3", None, None, "2", 100000, 2000000)


@query("extract_window", S(f"SELECT {', '.join(SS_COLS)} FROM sumstats WHERE chrom = '3' "
                           f"AND pos >= 200000 - 100000 AND pos <= 200000 + 100000", "sumstats"))
def q_extract_window(spark, d):
    return sm.extract_window(A.sumstats(spark, d), "3", 200_000, 100)


@query("manifest_filter_overlap", S(f"SELECT {', '.join(O.OVERLAP_COLS)} FROM overlap_v "
                                    f"WHERE greatest(left_overlap_prop, right_overlap_prop) >= 0.5", "overlap_v"))
def q_manifest_filter_overlap(spark, d):
    return mf.filter_overlap_prop(jobs.overlap_table(spark, d), 0.5)


@query("manifest_filter_credset_size", S(f"SELECT {', '.join(O.OVERLAP_COLS)} FROM overlap_v "
                                         f"WHERE greatest(left_num_tags, right_num_tags) <= 40", "overlap_v"))
def q_manifest_filter_credset_size(spark, d):
    return mf.filter_credset_size(jobs.overlap_table(spark, d), 40)


_custom_sql = "SELECT DISTINCT study_id FROM ss_st WHERE st % 4 = 1"


@query("manifest_custom_studies", S(f"""SELECT {', '.join(O.OVERLAP_COLS)} FROM overlap_v
WHERE left_study_id IN ({_custom_sql}) OR right_study_id IN ({_custom_sql})""", "overlap_v", "ss_st"))
def q_manifest_custom_studies(spark, d):
    studies = A._sumstats_with_st(spark, d).filter(F.col("st") % 4 == 1).select("study_id")
    return mf.filter_custom_studies(jobs.overlap_table(spark, d), studies)


@query("manifest_dataset", S("""SELECT left_study_id, left_type,
  CASE WHEN left_type = 'gwas' THEN 'gwas' ELSE 'molecular_trait' END AS left_dataset,
  right_study_id, right_type, CASE WHEN right_type = 'gwas' THEN 'gwas' ELSE 'molecular_trait' END AS right_dataset
FROM overlap_v""", "overlap_v"))
def q_manifest_dataset(spark, d):
    o = jobs.overlap_table(spark, d)
    return o.select("left_study_id", "left_type", mf.dataset_class(F.col("left_type")).alias("left_dataset"),
                    "right_study_id", "right_type", mf.dataset_class(F.col("right_type")).alias("right_dataset"))


@query("manifest_ld_reference", S(f"""SELECT sid AS study_id, lead_chrom,
  CASE WHEN starts_with(sid, 'FINNGEN') THEN CAST(NULL AS VARCHAR)
       ELSE '/data/ld/panel_chr' || lead_chrom || '' END AS ld
FROM (SELECT DISTINCT study_id AS sid, lead_chrom FROM credset) t""", "credset"))
def q_manifest_ld_reference(spark, d):
    """P16 on study loci, one study of which has no reference."""
    x = A.credset(spark, d).select("study_id", "lead_chrom").distinct()
    return x.select("study_id", "lead_chrom", mf.ld_reference(F.col("study_id"), F.col("lead_chrom"), "/data/ld").alias("ld"))


@query("manifest_partition_path", S(f"SELECT {', '.join(O.LOC16)}, {O._partition_path_sql()} AS path FROM overlap_v",
                                    "overlap_v"))
def q_manifest_partition_path(spark, d):
    return jobs.overlap_table(spark, d).select(*O.LOC16, mf.partition_path().alias("path"))


_RAT_COLS = O.RATIO_COLS


@query("coloc_rename", S(rounded_sql("SELECT * EXCLUDE (coloc_h4_h3, coloc_log2_h4_h3) FROM coloc_ratio_v",
                                     [c for c in _RAT_COLS if c not in ("coloc_h4_h3", "coloc_log2_h4_h3")], PP),
                         "coloc_ratio_v"))
def q_coloc_rename(spark, d):
    return rounded(rs.rename_raw(jobs.coloc_raw(spark, d)), PP)


@query("coloc_ratio", S(rounded_sql("SELECT * FROM coloc_ratio_v", _RAT_COLS, RATIO_ROUND), "coloc_ratio_v"))
def q_coloc_ratio(spark, d):
    return rounded(_ratio(spark, d).select(*_RAT_COLS), RATIO_ROUND)


@query("filter_min_vars", S(rounded_sql(f"SELECT * FROM coloc_minvars_{MV}", _RAT_COLS, RATIO_ROUND),
                            f"coloc_minvars_{MV}"))
def q_filter_min_vars(spark, d):
    return rounded(rs.filter_min_vars(_ratio(spark, d), MV).select(*_RAT_COLS), RATIO_ROUND)


@query("filter_left_gwas", S(rounded_sql(f"SELECT * FROM coloc_sym_{MV} WHERE left_type = 'gwas'",
                                         _RAT_COLS + ["is_flipped"], RATIO_ROUND), f"coloc_sym_{MV}"))
def q_filter_left_gwas(spark, d):
    return rounded(rs.filter_left_gwas(_sym(spark, d)).select(*_RAT_COLS, "is_flipped"), RATIO_ROUND)


_GENE_SQL = """SELECT {ids}, is_flipped,
  CASE WHEN starts_with(coalesce(gl.gene_id, s.left_phenotype), 'ENSG') THEN coalesce(gl.gene_id, s.left_phenotype) END AS left_gene_id,
  CASE WHEN starts_with(coalesce(gr.gene_id, s.right_phenotype), 'ENSG') THEN coalesce(gr.gene_id, s.right_phenotype) END AS right_gene_id
FROM coloc_sym_{mv} s
LEFT JOIN (SELECT phenotype_id, max(gene_id) AS gene_id FROM pheno_gene WHERE starts_with(gene_id, 'ENSG') GROUP BY phenotype_id) gl
  ON s.left_phenotype = gl.phenotype_id
LEFT JOIN (SELECT phenotype_id, max(gene_id) AS gene_id FROM pheno_gene WHERE starts_with(gene_id, 'ENSG') GROUP BY phenotype_id) gr
  ON s.right_phenotype = gr.phenotype_id"""


@query("map_gene_id", S(_GENE_SQL.format(ids=", ".join("s." + c for c in O.RES16), mv=MV),
                        f"coloc_sym_{MV}", "pheno_gene"))
def q_map_gene_id(spark, d):
    """LUT left join + fallback to the phenotype, both sides."""
    return rs.map_gene_id(_sym(spark, d), A.pheno_gene(spark, d)).select(*O.RES16, "is_flipped",
                                                                          "left_gene_id", "right_gene_id")


@query("gene_id_clean", S(f"SELECT right_phenotype, right_gene_id FROM ({_GENE_SQL.format(ids='s.right_phenotype', mv=MV)}) q",
                          f"coloc_sym_{MV}", "pheno_gene"))
def q_gene_id_clean(spark, d):
    """Gene id kept only when it starts with ENSG."""
    return rs.map_gene_id(_sym(spark, d), A.pheno_gene(spark, d), ("right",)).select("right_phenotype", "right_gene_id")


@query("drop_null_stats", S(rounded_sql(f"""SELECT * FROM coloc_ratio_v WHERE coloc_h3 IS NOT NULL AND NOT isnan(coloc_h3)
  AND coloc_h4 IS NOT NULL AND NOT isnan(coloc_h4) AND coloc_log2_h4_h3 IS NOT NULL AND NOT isnan(coloc_log2_h4_h3)""",
                                        _RAT_COLS, RATIO_ROUND), "coloc_ratio_v"))
def q_drop_null_stats(spark, d):
    return rounded(rs.drop_null_stats(_ratio(spark, d)).select(*_RAT_COLS), RATIO_ROUND)


@query("fill_none", S(f"""SELECT {', '.join(f"coalesce({c}, 'None') AS {c}" if c.split('_', 1)[1] in
                                  ('type', 'study', 'phenotype', 'bio_feature', 'chrom', 'ref', 'alt') else c
                                  for c in O.RES16)}, nsnps FROM coloc_raw_v""", "coloc_raw_v"))
def q_fill_none(spark, d):
    """String NULLs -> 'None' (boundary convention)."""
    return io.fill_none(jobs.coloc_raw(spark, d).select(*O.RES16, "nsnps"))


@query("pair_scalar_features", S("""SELECT left_study, left_pos, right_study, right_pos,
  abs(left_pos - right_pos) AS abs_distance,
  CASE WHEN left_type = 'gwas' THEN 1 ELSE 0 END AS left_is_gwas,
  CASE WHEN right_type = 'gwas' THEN 1 ELSE 0 END AS right_is_gwas FROM coloc_raw_v""", "coloc_raw_v"))
def q_pair_scalar_features(spark, d):
    return ft.pair_scalar_features(jobs.coloc_raw(spark, d)).select(
        "left_study", "left_pos", "right_study", "right_pos", "abs_distance", "left_is_gwas", "right_is_gwas")


@query("neg_log_pval", S(rounded_sql(f"""SELECT study_id, phenotype_id, bio_feature, chrom, pos, ref, alt,
  coalesce(-(CASE WHEN pval > 0 THEN log10(pval) END), {ft.NEG_LOG10_MIN_DOUBLE!r}) AS log_pval FROM toploci""",
                                     ["study_id", "phenotype_id", "bio_feature", "chrom", "pos", "ref", "alt", "log_pval"],
                                     ["log_pval"]), "toploci"))
def q_neg_log_pval(spark, d):
    return rounded(ft.lead_log_pvals(A.toploci(spark, d)), ["log_pval"])


@query("cojo_input", S(f"""SELECT concat_ws(':', chrom, CAST(pos AS VARCHAR), ref, alt) AS SNP, alt AS A1, ref AS A2,
  eaf AS freq, beta AS b, se, pval AS p, n_total AS N FROM sig_stats_v WHERE pval <= 0.05""", "sig_stats_v"))
def q_cojo_input(spark, d):
    return cd.cojo_input(_signal_stats_named(spark, d), 0.05)

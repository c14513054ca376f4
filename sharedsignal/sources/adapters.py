"""Adapter views: derive the genetics schemas from the driver's TPC-H-style tables.

The driver ships ``lineitem``/``orders`` parquet, not genetics data, so every
registered query derives its inputs from them (FIXTURES.md section B).  The
derivations are plain aggregates, windows and joins, so their cost grows with
the tables.  Study number ``st = l_suppkey % 12``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sumstats import window_join
from ..operators.windows import top_k_per_group
from .io import read_table

# --- Fixed values of the adapter definition ---------------------------------
N_STUDIES = 12
N_CHROMS = 22
CREDSET_WINDOW = 500_000
CREDSET_P95 = 1e-3
CREDSET_P99 = 1e-2
LEAD_BIN = 150_000
LEAD_P = 1e-2
LD_DECAY = 50_000.0
NO_LD_STUDY = 6  # a study without an LD reference, so it is never conditioned


def _st(col: str = "l_suppkey"):
    return F.col(col) % N_STUDIES


def _sumstats_with_st(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_discount", "l_tax", "l_extendedprice", "l_quantity")
    agg = (li.groupBy(_st().alias("st"), F.col("l_partkey").alias("pk"))
             .agg(F.min("l_discount").alias("min_disc"), F.min("l_tax").alias("min_tax"),
                  F.min("l_extendedprice").alias("min_price"), F.min("l_quantity").alias("min_qty")))
    st, pk = F.col("st"), F.col("pk")
    st_s = st.cast("string")
    kind = st % 3
    n_total = (F.lit(1000) + F.lit(10) * st).cast("int")
    return agg.select(
        st,
        F.when(kind == 0, "gwas").when(kind == 1, "eqtl").otherwise("pqtl").alias("type"),
        F.when(st == NO_LD_STUDY, F.concat(F.lit("FINNGEN_S"), st_s)).otherwise(F.concat(F.lit("S"), st_s)).alias("study_id"),
        F.when(kind == 0, F.lit(None).cast("string"))
         .when(kind == 1, F.concat(F.lit("ENSG"), F.lpad(st_s, 11, "0")))
         .otherwise(F.concat(F.lit("PROT_"), st_s)).alias("phenotype_id"),
        F.when(kind == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("TISSUE_"), (st % 5).cast("string"))).alias("bio_feature"),
        (pk % N_CHROMS + 1).cast("string").alias("chrom"),
        (pk * 200).cast("bigint").alias("pos"),
        F.expr("substr('ACGT', CAST(pk % 4 + 1 AS INT), 1)").alias("ref"),
        F.expr("substr('CGTA', CAST(pk % 4 + 1 AS INT), 1)").alias("alt"),
        (F.col("min_disc") - F.lit(0.05)).cast("double").alias("beta"),
        (F.lit(0.01) + F.col("min_tax")).cast("double").alias("se"),
        # float32-rounded so that both engines' pow() give bit-identical adapter values
        F.pow(F.lit(10.0), -F.col("min_price") / F.lit(10000)).cast("float").cast("double").alias("pval"),
        n_total.alias("n_total"),
        F.when(st % 2 == 0, F.floor(n_total / F.lit(4)).cast("int")).alias("n_cases"),
        (F.col("min_qty") / F.lit(51)).cast("double").alias("eaf"),
        (st % 2 == 0).alias("is_cc"),
    )


SUMSTATS_COLS = ["type", "study_id", "phenotype_id", "bio_feature", "chrom", "pos", "ref", "alt",
                 "beta", "se", "pval", "n_total", "n_cases", "eaf", "is_cc"]


def sumstats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary statistics, one row per (study, variant)."""
    return _sumstats_with_st(spark, sf_dir).select(*SUMSTATS_COLS)


def toploci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best variant with p <= LEAD_P per study x phenotype x feature x chromosome x LEAD_BIN bases.

    The number of leads grows with the variants; a study has several per window, so
    conditioning lists hold more than one variant.
    """
    ss = sumstats(spark, sf_dir).filter(F.col("pval") <= LEAD_P).withColumn("__bin", F.floor(F.col("pos") / LEAD_BIN))
    top = top_k_per_group(ss, ["study_id", "phenotype_id", "bio_feature", "chrom", "__bin"],
                          [F.col("pval").asc(), F.col("pos").asc()], 1)
    return top.select(
        "study_id", "phenotype_id", "bio_feature", "chrom", "pos", "ref", "alt",
        F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt").alias("variant_id"),
        "pval")


def credset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credible sets: sumstats rows with p <= 1e-2 within 500 kb of a top locus."""
    ss = _sumstats_with_st(spark, sf_dir).filter(F.col("pval") <= CREDSET_P99)
    leads = toploci(spark, sf_dir).select(
        "study_id", "phenotype_id", "bio_feature",
        F.col("chrom").alias("lead_chrom"), F.col("pos").alias("lead_pos"),
        F.col("ref").alias("lead_ref"), F.col("alt").alias("lead_alt"))
    j = window_join(leads, ss, ["study_id", "phenotype_id", "bio_feature"],
                    "lead_chrom", "lead_pos", "chrom", "pos", CREDSET_WINDOW)
    return j.select(
        "type", "study_id", "phenotype_id", "bio_feature",
        "lead_chrom", "lead_pos", "lead_ref", "lead_alt",
        F.col("chrom").alias("tag_chrom"), F.col("pos").alias("tag_pos"),
        F.col("ref").alias("tag_ref"), F.col("alt").alias("tag_alt"),
        (F.col("pval") <= CREDSET_P95).alias("is95_credset"),
        (F.col("pval") <= CREDSET_P99).alias("is99_credset"),
        F.when(F.col("st") % 4 == 3, "distance").otherwise("conditional").alias("multisignal_method"))


def _carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a dosage above 0 and their orders; the others cannot raise a maximum that is above 0."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").filter(F.col("l_linenumber") % 3 > 0)
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long dosage table over every chromosome: (sample_id, chrom, pos, ref, alt, dosage>0).

    FIXTURES.md kept one chromosome (a modulo filter); here every lineitem row
    contributes, so LD and conditioning cover all signals.
    """
    pk = F.col("l_partkey")
    g = (_carriers(spark, sf_dir).groupBy(F.col("o_custkey").alias("sample_id"), pk.alias("pk"))
          .agg(F.max(F.col("l_linenumber") % 3).cast("int").alias("dosage")))
    return g.select(
        "sample_id",
        (F.col("pk") % N_CHROMS + 1).cast("string").alias("chrom"),
        (F.col("pk") * 200).cast("bigint").alias("pos"),
        F.expr("substr('ACGT', CAST(pk % 4 + 1 AS INT), 1)").alias("ref"),
        F.expr("substr('CGTA', CAST(pk % 4 + 1 AS INT), 1)").alias("alt"),
        "dosage")


def genotype_samples(spark: SparkSession, sf_dir: str) -> int:
    """Number of samples with a genotype."""
    return _carriers(spark, sf_dir).agg(F.count_distinct("o_custkey")).first()[0]


def pheno_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """phenotype -> gene look-up for the protein studies (plus a non-ENSG row per study)."""
    st = _sumstats_with_st(spark, sf_dir).select("st").distinct().filter(F.col("st") % 3 == 2)
    ensg = st.select(F.concat(F.lit("PROT_"), F.col("st").cast("string")).alias("phenotype_id"),
                     F.concat(F.lit("ENSG"), F.lpad((F.lit(100) + F.col("st")).cast("string"), 11, "0"))
                      .alias("gene_id"))
    junk = st.select(F.concat(F.lit("PROT_"), F.col("st").cast("string")).alias("phenotype_id"),
                     F.concat(F.lit("NOTGENE_"), F.col("st").cast("string")).alias("gene_id"))
    return ensg.unionByName(junk)


def ld_model(variants: DataFrame, leads: DataFrame, window: int = CREDSET_WINDOW) -> DataFrame:
    """Synthetic LD for features: R = exp(-|d| / 50 kb) between a lead and every
    variant within ``window`` on its chromosome (the lead itself included)."""
    tags = variants.select(F.col("chrom").alias("tag_chrom"), F.col("pos").alias("tag_pos"),
                           F.col("ref").alias("tag_ref"), F.col("alt").alias("tag_alt"))
    j = window_join(leads, tags, [], "lead_chrom", "lead_pos", "tag_chrom", "tag_pos", window)
    r = F.exp(-F.abs(F.col("tag_pos") - F.col("lead_pos")).cast("double") / F.lit(LD_DECAY))
    return j.select("lead_chrom", "lead_pos", "lead_ref", "lead_alt",
                    "tag_chrom", "tag_pos", "tag_ref", "tag_alt",
                    r.alias("R_EUR"), (r * r).alias("R2_EUR"))

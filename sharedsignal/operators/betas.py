"""Effect sizes of the left variant in the right study."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import materialize

BETA_COLS = {"beta": "left_var_right_study_beta", "se": "left_var_right_study_se",
             "pval": "left_var_right_study_pval", "is_cc": "left_var_right_isCC"}


def join_betas(coloc: DataFrame, sumstats: DataFrame) -> DataFrame:
    """M8: left outer join of sumstats on (left variant, right study/phenotype/feature).

    Keys: chrom, pos, ref, alt, study equal; phenotype and feature null-safe.
    A sort-merge join on all seven keys (null-safe keys hash as value + null
    flag), so no single study or variant becomes one task.
    """
    # written once: its (study, chromosome) pairs and the join both read it
    coloc = materialize(coloc, "coloc-for-betas")
    # Only (study, chromosome) combinations that occur in the coloc table are read:
    # a semi-join on a key set bounded by studies x chromosomes (AQE broadcasts it
    # once measured; on a study/chrom-partitioned table it also prunes files).
    keys = coloc.select(F.col("right_study").alias("study_id"), F.col("left_chrom").alias("chrom")).distinct()
    sumstats = sumstats.join(keys, ["study_id", "chrom"], "left_semi")
    ss = sumstats.select(
        F.col("chrom").alias("__chrom"), F.col("pos").alias("__pos"), F.col("ref").alias("__ref"),
        F.col("alt").alias("__alt"), F.col("study_id").alias("__study"),
        F.col("phenotype_id").alias("__phen"), F.col("bio_feature").alias("__feat"),
        *[F.col(k).alias(v) for k, v in BETA_COLS.items()])
    cond = ((F.col("left_chrom") == F.col("__chrom")) & (F.col("left_pos") == F.col("__pos"))
            & (F.col("left_ref") == F.col("__ref")) & (F.col("left_alt") == F.col("__alt"))
            & (F.col("right_study") == F.col("__study"))
            & F.col("right_phenotype").eqNullSafe(F.col("__phen"))
            & F.col("right_bio_feature").eqNullSafe(F.col("__feat")))
    out = coloc.join(ss, cond, "left")
    return out.drop("__chrom", "__pos", "__ref", "__alt", "__study", "__phen", "__feat")

"""Post-processing of raw coloc results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import keep_first

RAW_RENAMES = {"PP.H0.abf": "coloc_h0", "PP.H1.abf": "coloc_h1", "PP.H2.abf": "coloc_h2",
               "PP.H3.abf": "coloc_h3", "PP.H4.abf": "coloc_h4", "nsnps": "coloc_n_vars"}

MIN_OVERLAPPING_VARS = 100

DEDUP_SUBSET = ["left_type", "left_study", "left_phenotype", "left_bio_feature", "left_chrom",
                "left_pos", "left_ref", "left_alt", "right_type", "right_study",
                "right_bio_feature", "right_phenotype"]
DEDUP_TIEBREAK = ["right_chrom", "right_pos", "right_ref", "right_alt", "is_flipped"]


def rename_raw(df: DataFrame) -> DataFrame:
    """PP.Hk.abf -> coloc_hk, nsnps -> coloc_n_vars (names already final are kept)."""
    return df.withColumnsRenamed({k: v for k, v in RAW_RENAMES.items() if k in df.columns})


def add_ratios(df: DataFrame) -> DataFrame:
    """P20: h4/h3 (NULL when h3 = 0) and its log2 (NULL unless the ratio is > 0)."""
    ratio = F.try_divide(F.col("coloc_h4"), F.col("coloc_h3"))
    return (df.withColumn("coloc_h4_h3", ratio)
              .withColumn("coloc_log2_h4_h3",
                          F.when(F.col("coloc_h4_h3") > 0, F.log2("coloc_h4_h3"))))


def filter_min_vars(df: DataFrame, min_vars: int | None = MIN_OVERLAPPING_VARS,
                    strict: bool = False) -> DataFrame:
    """Keep tests with >= min_vars overlapping variants (> when ``strict``)."""
    if min_vars is None:
        return df
    c = F.col("coloc_n_vars")
    return df.filter(c > min_vars if strict else c >= min_vars)


def make_symmetric(df: DataFrame) -> DataFrame:
    """Union with left_/right_ swapped; ``is_flipped`` marks the swapped copy."""
    swap = {}
    for c in df.columns:
        if c.startswith("left_"):
            swap["right_" + c[5:]] = F.col(c)
        elif c.startswith("right_"):
            swap["left_" + c[6:]] = F.col(c)
    # both copies from one scan of the input
    copies = F.array(*[F.struct(*[(swap.get(c, F.col(c)) if flip else F.col(c)).alias(c) for c in df.columns],
                                F.lit(flip).alias("is_flipped")) for flip in (False, True)])
    return df.select(F.explode(copies).alias("__r")).select("__r.*")


def filter_left_gwas(df: DataFrame) -> DataFrame:
    """P22."""
    return df.filter(F.col("left_type") == "gwas")


def dedup_right(df: DataFrame, order_digits: int | None = None) -> DataFrame:
    """Best right locus (max coloc_h4, compared exactly) per left locus x right dataset.

    ``order_digits`` compares rounded values: only for comparing two engines, whose
    sums differ in their last bits, so that equal posteriors are ties in both.
    """
    return keep_first(df, DEDUP_SUBSET, "coloc_h4", ascending=False, tiebreak=DEDUP_TIEBREAK,
                      order_digits=order_digits)


def clean_pheno_gene(lut: DataFrame) -> DataFrame:
    """S6 rules: keep gene ids starting ENSG; one gene per phenotype (max on duplicates)."""
    return (lut.filter(F.col("gene_id").startswith("ENSG"))
               .groupBy("phenotype_id").agg(F.max("gene_id").alias("gene_id")))


def map_gene_id(df: DataFrame, lut: DataFrame, sides=("left", "right")) -> DataFrame:
    """J11 + P23: {side}_gene_id = LUT gene of the phenotype, else the phenotype
    itself, and NULL unless it starts with ENSG.  A left join, no Python UDF;
    the LUT is small and AQE broadcasts it once its size is measured."""
    g = clean_pheno_gene(lut)
    out = df
    for s in sides:
        m = g.select(F.col("phenotype_id").alias(f"__p_{s}"), F.col("gene_id").alias(f"__g_{s}"))
        out = out.join(m, out[f"{s}_phenotype"] == m[f"__p_{s}"], "left")
        gene = F.coalesce(F.col(f"__g_{s}"), F.col(f"{s}_phenotype"))
        out = (out.withColumn(f"{s}_gene_id", F.when(gene.startswith("ENSG"), gene))
                  .drop(f"__p_{s}", f"__g_{s}"))
    return out


def drop_null_stats(df: DataFrame) -> DataFrame:
    """P25: drop rows with NULL or NaN h3, h4 or log2(h4/h3)."""
    return df.dropna(how="any", subset=["coloc_h3", "coloc_h4", "coloc_log2_h4_h3"])


def process_results(raw: DataFrame, lut: DataFrame, make_symmetric_: bool = True,
                    left_gwas_only: bool = True, deduplicate_right: bool = True,
                    min_overlapping_vars: int | None = MIN_OVERLAPPING_VARS,
                    drop_left_ids: bool = True, order_digits: int | None = None) -> DataFrame:
    """M6: the processed coloc table (order of steps as in the legacy job:
    the NA filter runs after de-duplication)."""
    df = add_ratios(rename_raw(raw))
    df = filter_min_vars(df, min_overlapping_vars)
    if make_symmetric_:
        df = make_symmetric(df)
    if left_gwas_only:
        df = filter_left_gwas(df)
    if deduplicate_right:
        if "is_flipped" not in df.columns:
            df = df.withColumn("is_flipped", F.lit(False))
        df = dedup_right(df, order_digits)
    df = map_gene_id(df, lut)
    df = df.drop("left_sumstat", "right_sumstat")
    if left_gwas_only and drop_left_ids:
        df = df.drop("left_gene_id", "left_bio_feature", "left_phenotype")  # P24
    return drop_null_stats(df)


AUDIT_STAGES = ["0_loaded", "1_min_vars", "2_symmetric", "3_left_gwas", "4_dedup_right", "5_non_null"]


def _first_key(order_digits: int | None):
    """The order of ``dedup_right`` as a struct whose least value is the kept row (NULLs last, NaN above all numbers)."""
    h4 = F.col("coloc_h4") if order_digits is None else F.round("coloc_h4", order_digits)
    ties = [x for c in DEDUP_TIEBREAK for x in (F.col(c).isNull(), F.col(c))]
    return F.struct(*[x.alias(f"k{i}") for i, x in enumerate([h4.isNull(), ~F.isnan(h4), -h4, *ties])])


def stage_audit(raw: DataFrame, min_overlapping_vars: int | None = MIN_OVERLAPPING_VARS,
                order_digits: int | None = None) -> DataFrame:
    """Rows after each processing step, as one (stage, n_rows) table.

    One scan and one aggregation: every row carries the steps that it passes, and the
    groups of the de-duplication count them.  A group keeps one row, so its steps 4 and 5
    need only its first row in order, which a least struct finds before the shuffle;
    no window sorts whole rows.  The gene join keeps every row once and is left out.
    Observed metrics of the processing job would count a task's rows again when a lost
    executor makes it run twice; an aggregation does not.
    """
    narrow = [*DEDUP_SUBSET, *DEDUP_TIEBREAK[:-1], "coloc_h3", "coloc_h4", "coloc_log2_h4_h3"]
    base = add_ratios(rename_raw(raw))
    enough = F.lit(True) if min_overlapping_vars is None else F.coalesce(F.col("coloc_n_vars") >= min_overlapping_vars, F.lit(False))
    rows = make_symmetric(base.select(*narrow, enough.alias("__enough"))).filter("__enough OR NOT is_flipped")
    rows = rows.withColumn("__gwas", F.col("__enough") & F.coalesce(F.col("left_type") == "gwas", F.lit(False)))
    known = F.lit(True)
    for c in ("coloc_h3", "coloc_h4", "coloc_log2_h4_h3"):
        known = known & F.col(c).isNotNull() & ~F.isnan(c)
    # rows that stop before the de-duplication share one group, which partial sums keep small
    keys = [F.when(F.col("__gwas"), F.col(c)).alias(c) for c in DEDUP_SUBSET]
    groups = rows.select(*keys, "__gwas", "__enough", "is_flipped", F.struct(_first_key(order_digits).alias("key"), known.alias("known")).alias("__row"))
    counts = groups.groupBy("__gwas", *DEDUP_SUBSET).agg(
        F.count_if(~F.col("is_flipped")).alias("n0"), F.count_if(F.col("__enough") & ~F.col("is_flipped")).alias("n1"),
        F.count_if("__enough").alias("n2"), F.count_if("__gwas").alias("n3"), F.min("__row").alias("first"))
    totals = counts.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(4)],
                        F.count_if("__gwas").alias("n4"), F.count_if(F.col("__gwas") & F.col("first.known")).alias("n5"))
    return totals.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"n{i}").alias("n_rows"))
                                             for i, s in enumerate(AUDIT_STAGES)])).alias("r")).select("r.*")

"""Table of tests.

The legacy job looped over JSON records in one Python process; here every
rule is a column expression or a (semi/anti) join over the whole overlap table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import COMPLETED_ID_COLS, LOCUS_COLS, MANIFEST_TO_RESULT
from ..sources.io import none_to_null

MIN_OVERLAP_PROP = 0.01
LD_PANEL = "panel_chr{chrom}"  # file name of one chromosome's LD reference, without a suffix
SIDES = ("left", "right")

# Order of the hive partition directories (results naming).
PARTITION_ORDER = [("study", "study_id"), ("type", "type"), ("phenotype", "phenotype_id"),
                   ("bio_feature", "bio_feature"), ("chrom", "lead_chrom"), ("pos", "lead_pos"),
                   ("ref", "lead_ref"), ("alt", "lead_alt")]


def filter_overlap_prop(df: DataFrame, threshold: float | None = MIN_OVERLAP_PROP) -> DataFrame:
    """Keep if max(left_prop, right_prop) >= threshold."""
    if threshold is None:
        return df
    return df.filter(F.greatest("left_overlap_prop", "right_overlap_prop") >= threshold)


def filter_credset_size(df: DataFrame, max_size: int | None = None) -> DataFrame:
    """Keep if the larger credible set has <= max_size tags (off when None)."""
    if max_size is None:
        return df
    return df.filter(F.greatest("left_num_tags", "right_num_tags") <= max_size)


def filter_custom_studies(df: DataFrame, studies: DataFrame | None) -> DataFrame:
    """Keep tests whose left *or* right study is listed.

    Two semi-join flags instead of an ``IN`` list collected to the driver; the
    study list is de-duplicated first (A13).
    """
    if studies is None:
        return df
    s = studies.select(F.col("study_id").alias("__sid")).distinct()
    flagged = (df.join(s.withColumn("__l", F.lit(True)),
                       F.col("left_study_id") == F.col("__sid"), "left").drop("__sid")
                 .join(s.withColumn("__r", F.lit(True)),
                       F.col("right_study_id") == F.col("__sid"), "left").drop("__sid"))
    return flagged.filter(F.col("__l").isNotNull() | F.col("__r").isNotNull()).drop("__l", "__r")


def dataset_class(type_col: Column) -> Column:
    """P15: 'gwas' stays, any other type is a 'molecular_trait'."""
    return F.when(type_col == "gwas", "gwas").otherwise("molecular_trait")


def ld_reference(study_col: Column, chrom_col: Column, root: str, panel: str = LD_PANEL) -> Column:
    """LD reference per chromosome; NULL (do not condition) for FINNGEN studies."""
    before, after = panel.split("{chrom}")
    path = F.concat(F.lit(f"{root}/{before}"), chrom_col.cast("string"), F.lit(after))
    return F.when(study_col.startswith("FINNGEN"), F.lit(None).cast("string")).otherwise(path)


def partition_path() -> Column:
    """Hive path from the 16 id fields; NULL is written as the text 'None'."""
    parts = []
    for side in SIDES:
        for name, col in PARTITION_ORDER:
            v = F.coalesce(F.col(f"{side}_{col}").cast("string"), F.lit("None"))
            parts.append(F.concat(F.lit(f"{side}_{name}="), v))
    return F.concat_ws("/", *parts)


def make_manifest(overlap: DataFrame, min_prop: float | None = MIN_OVERLAP_PROP,
                  max_size: int | None = None, custom_studies: DataFrame | None = None,
                  sumstats_root: str = "/data/sumstats", ld_root: str = "/data/ld",
                  out_root: str = "/output") -> DataFrame:
    """M2: filter the overlap table and add input/output locations per test."""
    df = filter_custom_studies(overlap, custom_studies)
    df = filter_credset_size(filter_overlap_prop(df, min_prop), max_size)
    cols = []
    for side in SIDES:
        cols.append(F.concat(F.lit(f"{sumstats_root}/"), dataset_class(F.col(f"{side}_type")),
                             F.lit("/"), F.col(f"{side}_study_id"), F.lit(".parquet"))
                    .alias(f"{side}_sumstats"))
        cols.append(ld_reference(F.col(f"{side}_study_id"), F.col(f"{side}_lead_chrom"), ld_root)
                    .alias(f"{side}_ld"))
        cols += [F.col(f"{side}_{c}") for c in LOCUS_COLS]
    p = partition_path()
    cols += [
        F.lit("conditional").alias("method"),  # P18
        F.concat(F.lit(f"{out_root}/data/"), p, F.lit("/coloc_res.json.gz")).alias("out"),
        F.concat(F.lit(f"{out_root}/logs/"), p, F.lit("/log_file.txt")).alias("log"),
        F.concat(F.lit(f"{out_root}/tmp/"), p).alias("tmpdir"),
        F.concat(F.lit(f"{out_root}/plot/"), p, F.lit("/plot.png")).alias("plot"),
    ]
    return df.select(*cols)


def _completed_keys(completed: DataFrame) -> DataFrame:
    """Results-named id columns -> manifest names, de-duplicated."""
    m = {f"{s}_{MANIFEST_TO_RESULT[c]}": f"{s}_{c}" for s in SIDES for c in LOCUS_COLS
         if MANIFEST_TO_RESULT[c] in COMPLETED_ID_COLS}
    return completed.select(*[F.col(k).alias(v) for k, v in m.items()]).distinct()


def manifest_id_cols() -> list[str]:
    return [f"{s}_{c}" for s in SIDES for c in LOCUS_COLS if c != "type"]


def anti_join_null_safe(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    o = other.select(*[F.col(c).alias(f"__o_{c}") for c in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"__o_{c}"))
        cond = e if cond is None else cond & e
    return df.join(o, cond, "left_anti")


def semi_join_null_safe(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    o = other.select(*[F.col(c).alias(f"__o_{c}") for c in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"__o_{c}"))
        cond = e if cond is None else cond & e
    return df.join(o, cond, "left_semi")


def filter_manifest(manifest: DataFrame, completed: DataFrame | None) -> DataFrame:
    """Drop tests already present in the completed results (14 ids, NULL = NULL).

    The text 'None' in the manifest's phenotype / feature is read as NULL first.
    """
    if completed is None:
        return manifest
    m = none_to_null(manifest, [f"{s}_{c}" for s in SIDES for c in ("phenotype_id", "bio_feature")])
    return anti_join_null_safe(m, _completed_keys(completed), manifest_id_cols())


def tests_todo(tests: DataFrame, results: DataFrame) -> DataFrame:
    """Tests without a result row."""
    return anti_join_null_safe(tests, _completed_keys(results), manifest_id_cols())


def tests_done(tests: DataFrame, results: DataFrame) -> DataFrame:
    """Tests with a result row."""
    return semi_join_null_safe(tests, _completed_keys(results), manifest_id_cols())


def missing_inputs(manifest: DataFrame, catalog: DataFrame) -> DataFrame:
    """Referenced inputs absent from ``catalog(path)``; one row per (column, path), from one pass over the tests.

    LD references are PLINK prefixes: their '.bed' file is looked up.
    """
    refs = []
    for side in SIDES:
        for kind in ("sumstats", "ld"):
            c = F.col(f"{side}_{kind}")
            refs.append(F.struct(F.lit(f"{side}_{kind}").alias("column"),
                                 (F.concat(c, F.lit(".bed")) if kind == "ld" else c).alias("path")))
    refs = manifest.select(F.explode(F.array(*refs)).alias("ref")).select("ref.*").filter(F.col("path").isNotNull()).distinct()
    return refs.join(catalog.select("path").distinct(), "path", "left_anti").select("column", "path")


def signals_to_prepare(manifest: DataFrame, type_filter: str | None = None) -> DataFrame:
    """Distinct signals of both sides (+ their LD reference), optional type filter, from one pass over the tests."""
    sides = []
    for side in SIDES:
        ld = F.col(f"{side}_ld") if f"{side}_ld" in manifest.columns else F.lit(None).cast("string")
        sides.append(F.struct(*[F.col(f"{side}_{c}").alias(c) for c in LOCUS_COLS], ld.alias("ld")))
    out = manifest.select(F.explode(F.array(*sides)).alias("signal")).select("signal.*")
    return (out if type_filter is None else out.filter(F.col("type") == type_filter)).distinct()


def coloc_tests(manifest: DataFrame, prepared: DataFrame) -> DataFrame:
    """Distinct tests whose two signals are both prepared.

    ``prepared`` holds the 8 locus columns of every signal with statistics.
    """
    tests = manifest.select(*[f"{s}_{c}" for s in SIDES for c in LOCUS_COLS]).distinct()
    for side in SIDES:
        p = prepared.select(*[F.col(c).alias(f"{side}_{c}") for c in LOCUS_COLS])
        tests = semi_join_null_safe(tests, p, [f"{side}_{c}" for c in LOCUS_COLS])
    return tests

"""Fixed StructTypes of the data model."""

from pyspark.sql import types as T

S, I, D, B, L = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.LongType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CREDSET = _st(("type", S), ("study_id", S), ("phenotype_id", S), ("bio_feature", S),
              ("lead_chrom", S), ("lead_pos", L), ("lead_ref", S), ("lead_alt", S),
              ("tag_chrom", S), ("tag_pos", L), ("tag_ref", S), ("tag_alt", S),
              ("is95_credset", B), ("is99_credset", B), ("multisignal_method", S))

SUMSTATS_COLS = ["study_id", "phenotype_id", "bio_feature", "chrom", "pos", "ref", "alt",
                 "beta", "se", "pval", "n_total", "n_cases", "eaf", "is_cc"]

SUMSTATS = _st(("study_id", S), ("phenotype_id", S), ("bio_feature", S), ("chrom", S), ("pos", L),
               ("ref", S), ("alt", S), ("beta", D), ("se", D), ("pval", D), ("n_total", I),
               ("n_cases", I), ("eaf", D), ("is_cc", B))

TOPLOCI = _st(("study_id", S), ("phenotype_id", S), ("bio_feature", S), ("chrom", S), ("pos", L),
              ("ref", S), ("alt", S), ("variant_id", S), ("pval", D))

LD_TEXT = _st(("index_variant_id", S), ("tag_variant_id", S), ("R_EUR", D), ("R2_EUR", D))

LD = _st(("lead_chrom", S), ("lead_pos", L), ("lead_ref", S), ("lead_alt", S),
         ("tag_chrom", S), ("tag_pos", L), ("tag_ref", S), ("tag_alt", S),
         ("R_EUR", D), ("R2_EUR", D))

GENOTYPES = _st(("sample_id", L), ("chrom", S), ("pos", L), ("ref", S), ("alt", S), ("dosage", I))

# Study-locus identity, as named in the overlap table / manifest.
LOCUS_COLS = ["type", "study_id", "phenotype_id", "bio_feature",
              "lead_chrom", "lead_pos", "lead_ref", "lead_alt"]

# Study-locus identity, as named in coloc results (hive partition names).
RESULT_ID_COLS = ["type", "study", "phenotype", "bio_feature", "chrom", "pos", "ref", "alt"]

# manifest column -> results column
MANIFEST_TO_RESULT = dict(zip(LOCUS_COLS, RESULT_ID_COLS))

COLOC_STATS = ["coloc_h0", "coloc_h1", "coloc_h2", "coloc_h3", "coloc_h4"]

# 14 id columns matched when removing already-completed tests (type excluded).
COMPLETED_ID_COLS = ["study", "phenotype", "bio_feature", "chrom", "pos", "ref", "alt"]

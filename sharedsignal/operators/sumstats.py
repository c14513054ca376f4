"""Summary-statistic selection.

The per-signal window extraction of the legacy job (one process per signal,
one Parquet scan each) becomes a single range join between the distinct
signals and the summary statistics.  The range predicate is made equi-joinable
by binning positions: each signal is replicated to the few bins its window
touches, summary statistics are not replicated at all, and the exact window
test runs as a residual.  Keys stay (study, phenotype, feature, chrom, bin),
so one huge study is spread over its many bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import eaf_to_maf

COLOC_WINDOW_KB = 500
COND_WINDOW_KB = 1000
MIN_MAF = 0.01


def maf_filter(df: DataFrame, min_maf: float = MIN_MAF, eaf_col: str = "eaf") -> DataFrame:
    """Drop MAF < min_maf; NULL / NaN frequencies are kept (legacy behaviour)."""
    maf = eaf_to_maf(F.col(eaf_col))
    return df.filter((maf >= min_maf) | F.col(eaf_col).isNull() | F.isnan(eaf_col))


def region_filter(df: DataFrame, study_id=None, phenotype_id=None, bio_feature=None,
                  chrom=None, start=None, end=None) -> DataFrame:
    """P10: literal signal filter; a ``None`` argument means no predicate."""
    out = df
    for c, v in (("study_id", study_id), ("phenotype_id", phenotype_id),
                 ("bio_feature", bio_feature), ("chrom", chrom)):
        if v is not None:
            out = out.filter(F.col(c) == str(v))
    if start is not None:
        out = out.filter(F.col("pos") >= start)
    if end is not None:
        out = out.filter(F.col("pos") <= end)
    return out


def extract_window(df: DataFrame, chrom: str, pos: int, window_kb: int,
                   chrom_col: str = "chrom", pos_col: str = "pos") -> DataFrame:
    """Closed window of +-window_kb kb around one position."""
    w = 1000 * window_kb
    return df.filter((F.col(chrom_col) == str(chrom)) & (F.col(pos_col) >= pos - w)
                     & (F.col(pos_col) <= pos + w))


def _null_safe_eq(cols: Sequence[str], left: str, right: str) -> Column | None:
    cond = None
    for c in cols:
        e = F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        cond = e if cond is None else cond & e
    return cond


def window_join(left: DataFrame, right: DataFrame, eq_keys: Sequence[str],
                left_chrom: str, left_pos: str, right_chrom: str, right_pos: str,
                window: int, bin_size: int | None = None, how: str = "inner") -> DataFrame:
    """Range join: rows of ``right`` within +-``window`` of each ``left`` position.

    ``eq_keys`` (present in both inputs) are matched null-safe; the output keeps
    the left copy.  Other column names must be distinct between inputs.
    Bin size defaults to window/2, so every left row is replicated to 5 bins and
    the equi-join reads at most 1.25x the rows of the exact window.
    """
    b = int(bin_size or max(window // 2, 1))
    lpos = F.col(left_pos).cast("long")
    lbin = F.explode(F.sequence(F.floor((lpos - window) / b), F.floor((lpos + window) / b)))
    lft = left.withColumn("__bin", lbin)
    rgt = right.withColumn("__bin", F.floor(F.col(right_pos).cast("long") / b))
    for k in eq_keys:
        rgt = rgt.withColumnRenamed(k, f"__r_{k}")
    cond = (F.col("l.__bin") == F.col("r.__bin")) & (F.col(f"l.{left_chrom}") == F.col(f"r.{right_chrom}"))
    for k in eq_keys:
        cond = cond & F.col(f"l.{k}").eqNullSafe(F.col(f"r.__r_{k}"))
    cond = cond & (F.abs(F.col(f"r.{right_pos}").cast("long") - F.col(f"l.{left_pos}").cast("long")) <= window)
    j = lft.alias("l").join(rgt.alias("r"), cond, how)
    keep = [F.col(f"l.{c}") for c in left.columns] + \
           [F.col(f"r.{c}") for c in right.columns if c not in eq_keys]
    return j.select(*keep)


def top_locus_stats(sumstats: DataFrame, toploci: DataFrame) -> DataFrame:
    """The statistics of variants that are top loci of their own study, phenotype (null-safe) and feature (null-safe)."""
    keys, var = ["study_id", "phenotype_id", "bio_feature"], ["chrom", "pos", "ref", "alt"]
    t = toploci.select(*[F.col(c).alias(f"__t_{c}") for c in keys + var])
    cond = F.lit(True)
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__t_{c}"))
    for c in var:
        cond = cond & (F.col(c) == F.col(f"__t_{c}"))
    return sumstats.join(t, cond, "left_semi")


SIGNAL_COLS = ["type", "study_id", "phenotype_id", "bio_feature",
               "lead_chrom", "lead_pos", "lead_ref", "lead_alt"]

STAT_COLS = ["chrom", "pos", "ref", "alt", "beta", "se", "pval", "n_total", "n_cases", "eaf", "is_cc"]


def signal_sumstats_join(signals: DataFrame, sumstats: DataFrame, window_kb: int = COLOC_WINDOW_KB,
                         min_maf: float | None = MIN_MAF) -> DataFrame:
    """Every MAF-passing summary statistic within +-window_kb of each signal's lead.

    Study equal, phenotype / feature null-safe equal, chrom equal, closed window.
    Returns the signal columns plus ``STAT_COLS``.
    """
    ss = sumstats.select("study_id", "phenotype_id", "bio_feature", *STAT_COLS)
    if min_maf is not None:
        ss = maf_filter(ss, min_maf)
    # one shuffle: on the range join's own keys, whose bins spread a large study
    return window_join(signals, ss, ["study_id", "phenotype_id", "bio_feature"],
                       "lead_chrom", "lead_pos", "chrom", "pos", 1000 * window_kb)


def signals_with_stats(signals: DataFrame, sumstats: DataFrame, window_kb: int = COLOC_WINDOW_KB, min_maf: float | None = MIN_MAF) -> DataFrame:
    """The signals with at least one row in ``signal_sumstats_join``, without making those rows.

    Statistics are reduced to the first and last position per study, phenotype, feature and half a window of a chromosome:
    a window that touches such a stretch holds one of its rows unless all of them lie beyond one end of the window.
    """
    keys, window = ["study_id", "phenotype_id", "bio_feature"], 1000 * window_kb
    size = max(window // 2, 1)
    ss = sumstats if min_maf is None else maf_filter(sumstats, min_maf)
    pos = F.col("pos").cast("long")
    there = ss.groupBy(*keys, "chrom", F.floor(pos / size).alias("__r_bin")).agg(F.min(pos).alias("__first"), F.max(pos).alias("__last"))
    there = there.withColumnsRenamed({k: f"__r_{k}" for k in [*keys, "chrom"]})
    lead = F.col("lead_pos").cast("long")
    x = signals.withColumn("__bin", F.explode(F.sequence(F.floor((lead - window) / size), F.floor((lead + window) / size))))
    cond = (F.col("__bin") == F.col("__r_bin")) & (F.col("lead_chrom") == F.col("__r_chrom")) & (F.col("__first") <= lead + window) & (F.col("__last") >= lead - window)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return x.join(there, cond, "left_semi").select(*signals.columns).distinct()


def signal_stats(signals: DataFrame, sumstats: DataFrame, window_kb: int = COLOC_WINDOW_KB,
                 min_maf: float | None = MIN_MAF, named: bool = False) -> DataFrame:
    """S18 / M4 (no-LD branch): prepared statistics keyed by ``signal_id``.

    ``signals`` must carry ``signal_id`` plus the signal columns.  Each signal's
    window is cut around its own lead.  ``named`` keeps the signal columns, so that
    no join of the statistics has to bring them back.
    """
    j = signal_sumstats_join(signals.select("signal_id", *SIGNAL_COLS), sumstats, window_kb, min_maf)
    return j.select("signal_id", *(SIGNAL_COLS if named else []), *STAT_COLS)

"""Credible-set filters and the overlap self-join.

Plan shape: the self-join on tag variant is rewritten as GWAS-side x all, so
molecular x molecular pairs are never produced; it joins narrow rows
(locus id, key, type, study, lead position, tag) and counts per locus pair;
descriptive columns are re-attached afterwards from a locus dimension, and
tag totals from a per-key count.  Loci are numbered by a written dictionary,
so no two of them can share an id, and the numbered tag rows are written once
for all branches that read them.  Tag rows are dealt by blocks of the chromosome,
so the hits of a pair of loci lie in one or two tasks and are counted there; what is
shuffled grows with the pairs, not with their hits.  Shuffles: the numbering, the tag
join, the pair count, and one dimension join per side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LOCUS_COLS
from ..sources.io import materialize
from .dictionary import dictionary, encode

MAX_DIST = 500_000
#: Bases of a chromosome whose tag rows meet in one task; about a credible set's width.
TAG_BLOCK = 1_000_000
TAG_COLS = ["tag_chrom", "tag_pos", "tag_ref", "tag_alt"]


def filter_credset_level(df: DataFrame, which_set: str | int = "95") -> DataFrame:
    """Keep rows of the 95 % or 99 % credible set."""
    which = str(which_set)
    if which not in ("95", "99"):
        raise ValueError("which_set must be 95 or 99")
    return df.filter(F.col(f"is{which}_credset"))


def filter_credset_method(df: DataFrame, which_method: str = "all") -> DataFrame:
    """Keep one multisignal method (all / conditional / distance)."""
    if which_method not in ("all", "conditional", "distance"):
        raise ValueError("which_method must be all, conditional or distance")
    return df if which_method == "all" else df.filter(F.col("multisignal_method") == which_method)


def study_locus_key(prefix: str = "") -> Column:
    """The 8 locus fields joined by '_' (NULLs skipped, as concat_ws does)."""
    return F.concat_ws("_", *[F.col(prefix + c).cast("string") for c in LOCUS_COLS])


def locus_id(prefix: str = "", cols=LOCUS_COLS) -> Column:
    """Order-preserving, NULL-aware 64-bit id of a study locus (join accelerator)."""
    parts = []
    for c in cols:
        x = F.col(prefix + c)
        parts += [F.coalesce(x.cast("string"), F.lit("")), x.isNull()]
    return F.xxhash64(*parts)


def prefix_columns(df: DataFrame, prefix: str, cols) -> DataFrame:
    """Rename ``cols`` to ``prefix + col``."""
    return df.withColumnsRenamed({c: prefix + c for c in cols})


def prepare_credset(credset: DataFrame, which_set="95", which_method="all") -> DataFrame:
    df = filter_credset_method(filter_credset_level(credset, which_set), which_method)
    return df.select(*LOCUS_COLS, *TAG_COLS).withColumn("key", study_locus_key())


def number_loci(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the rows with ``id``, the loci: id and its 8 columns): ids are dense numbers, NULL equals NULL.

    The rows are written first: the dictionary and the numbering both read them.
    """
    prepared = materialize(prepared, "credset")
    loci = dictionary(prepared, LOCUS_COLS, "id")
    rows = encode(prepared, loci, {c: c for c in LOCUS_COLS}, "id")
    return materialize(rows, "numbered-credset"), loci


def tag_counts(prepared: DataFrame) -> DataFrame:
    """A2: number of tag rows per locus key."""
    return prepared.groupBy("key").agg(F.count("tag_chrom").alias("num_tags"))


def overlap_pairs(numbered: DataFrame, max_dist: int | None = MAX_DIST) -> DataFrame:
    """J1 + J2: one row per shared tag hit, oriented so that left_key > right_key.

    ``numbered`` are the rows of ``number_loci``.
    Columns: left_id, right_id, left_key, right_key.  Multiplicity equals the
    legacy inner self-join (duplicate tags multiply).  Rows are dealt by the tag's block,
    so all hits of a block come from one task: a join on the tag would deal them by tag.
    """
    parts = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = ["tag_chrom", "__block"]
    narrow = (numbered.select("id", "key", "type", "study_id", "lead_pos", *TAG_COLS).na.drop("any", subset=TAG_COLS)
              .withColumn("__block", F.floor(F.col("tag_pos") / TAG_BLOCK)).repartition(parts, *block))
    tags = narrow.groupBy(*block, *TAG_COLS[1:]).agg(
        F.collect_list(F.struct("id", "key", "type", "study_id", "lead_pos")).alias("loci"))
    gwas = F.filter("loci", lambda x: x["type"] == "gwas")
    hits = tags.select(F.explode(gwas).alias("g"), "loci").select("g", F.explode("loci").alias("a"))
    a_is_gwas = F.coalesce(F.col("a.type") == "gwas", F.lit(False))
    c = (F.col("g.study_id") != F.col("a.study_id")) & (~a_is_gwas | (F.col("g.key") > F.col("a.key")))
    if max_dist is not None:
        c = c & (F.abs(F.col("g.lead_pos") - F.col("a.lead_pos")) <= max_dist)
    hits = hits.filter(c)
    g_left = F.col("g.key") > F.col("a.key")
    return hits.select(
        F.when(g_left, F.col("g.id")).otherwise(F.col("a.id")).alias("left_id"),
        F.when(g_left, F.col("a.id")).otherwise(F.col("g.id")).alias("right_id"),
        F.when(g_left, F.col("g.key")).otherwise(F.col("a.key")).alias("left_key"),
        F.when(g_left, F.col("a.key")).otherwise(F.col("g.key")).alias("right_key"))


def overlap_counts(pairs: DataFrame) -> DataFrame:
    """A1: overlapping tag rows per oriented locus pair (left_id, right_id), counted in the tasks of the tag join."""
    return pairs.groupBy("left_id", "right_id").agg(F.count(F.lit(1)).alias("num_overlapping"))


def find_overlaps(credset: DataFrame, which_set="95", which_method="all",
                  max_dist: int | None = MAX_DIST, keep_keys: bool = False) -> DataFrame:
    """M1: the overlap table.

    Output: left_/right_ x 8 locus columns, num_overlapping, left_num_tags,
    right_num_tags, left_overlap_prop, right_overlap_prop.
    """
    numbered, dim = number_loci(prepare_credset(credset, which_set, which_method))
    counts = overlap_counts(overlap_pairs(numbered, max_dist))
    # one row per locus with all that a pair needs of it: the pairs meet it once per side
    loci = dim.withColumn("key", study_locus_key()).join(tag_counts(numbered), "key")
    out = counts
    for side in ("left_", "right_"):
        out = out.join(prefix_columns(loci, side, loci.columns), f"{side}id")
    out = (out.withColumn("left_overlap_prop", F.col("num_overlapping") / F.col("left_num_tags"))
              .withColumn("right_overlap_prop", F.col("num_overlapping") / F.col("right_num_tags")))
    cols = [f"{s}_{c}" for s in ("left", "right") for c in LOCUS_COLS] + [
        "num_overlapping", "left_num_tags", "right_num_tags", "left_overlap_prop", "right_overlap_prop"]
    if keep_keys:
        cols = ["left_key", "right_key"] + cols
    return out.select(*cols)

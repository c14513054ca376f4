"""LD-overlap features for predicting coloc.

Identity joins are null-safe (the legacy job filled NULL with the text
'None' to make '==' match; that is the same relation).

Overlap counts depend on the two lead variants alone, so they are made once per distinct
*pair of lead variants*: each lead keeps its tags once, as a sorted array of dense tag
ids with a code 0-14, the number of thresholds that R2 reaches.  A pair's arrays are
merged, one histogram of min(left code, right code) is taken, and its suffix sums are the
counts of all thresholds.  Tested pairs go to the group of their region once, with all their
columns, and meet there their loci and the tags of their leads, each sent once per group;
they leave it with their features, so no join has to bring the two together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dictionary import dictionary, encode
from .regions import GROUP_SIGNALS, REGION, SHARED_SIGNALS, add_groups, code_parts, variant_code, with_groups
from ..functions.stats import NEG_LOG10_MIN_DOUBLE
from ..schemas import RESULT_ID_COLS
from ..sources.io import materialize

# --- Fixed values: LD thresholds of the overlap-proportion features ----------
R2_THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.975, 1.0)
MIN_VARS_EXCLUSIVE = 200

SIDES = ("left", "right")
ID16 = [f"{s}_{c}" for s in SIDES for c in RESULT_ID_COLS]
TAG_COLS = ["tag_chrom", "tag_pos", "tag_ref", "tag_alt"]
FEATURE_COLS = (["total_overlap"] + [f"prop_overlap_{t}" for t in R2_THRESHOLDS]
                + ["left_num_tags", "right_num_tags", "left_prop_total_overlap",
                   "right_prop_total_overlap", "abs_distance", "left_log_pval", "right_log_pval",
                   "left_is_gwas", "right_is_gwas"])
LEAD_KEY = ("chrom", "pos", "ref", "alt")
#: What a locus' top-locus rows and number of tags depend on: its ids without the type.
LOCUS_KEY = ("study", "phenotype", "bio_feature", *LEAD_KEY)
FEATURE_COLS_ESCAPED = [f"`{c}`" for c in FEATURE_COLS]


def join_null_safe(df: DataFrame, other: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` with NULL = NULL; keeps one copy of the key columns."""
    o = other.withColumnsRenamed({c: f"__o_{c}" for c in cols})
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"__o_{c}"))
        cond = e if cond is None else cond & e
    out = df.join(o, cond, how)
    if how in ("full", "outer", "full_outer", "right"):
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__o_{c}")) for c in cols})
    return out.drop(*[f"__o_{c}" for c in cols])


def coloc_for_features(coloc: DataFrame, min_vars_exclusive: int = MIN_VARS_EXCLUSIVE) -> DataFrame:
    """Input filter: coloc_n_vars > threshold and left_type = gwas."""
    return coloc.filter((F.col("coloc_n_vars") > min_vars_exclusive) & (F.col("left_type") == "gwas"))


def locus_ld_tags(coloc: DataFrame, ld: DataFrame, side: str) -> DataFrame:
    """Distinct study loci of one side x LD rows of their lead variant."""
    ids = [f"{side}_{c}" for c in RESULT_ID_COLS]
    l = ld.select(*[F.col(f"lead_{c}").alias(f"{side}_{c}") for c in ("chrom", "pos", "ref", "alt")],
                  *TAG_COLS, F.col("R2_EUR").alias(f"{side}_R2_EUR"))
    return coloc.select(*ids).distinct().join(l, [f"{side}_{c}" for c in ("chrom", "pos", "ref", "alt")])


def ld_tag_intersection(left: DataFrame, right: DataFrame, pairs: DataFrame | None) -> DataFrame:
    """LD tags that the left and right locus of a pair share.

    ``pairs`` (16 ids) meet the left tags and then the right tags on dense ids of loci and
    tags, so rows grow with the pairs and are narrow until the end.  ``None`` is the legacy
    join of all loci on the tag, whose rows grow with the square of a region's loci.
    """
    if pairs is None:
        return left.join(right, TAG_COLS)
    tags = dictionary(left.select(*TAG_COLS).union(right.select(*TAG_COLS)).na.drop("any"), TAG_COLS, "__tag")
    narrow, loci = {}, {}
    for side, table in (("left", left), ("right", right)):
        ids = [f"{side}_{c}" for c in RESULT_ID_COLS]
        loci[side] = dictionary(table, ids, f"__{side}")
        x = encode(encode(table, loci[side], dict(zip(ids, ids)), f"__{side}"), tags, dict(zip(TAG_COLS, TAG_COLS)), "__tag")
        narrow[side] = x.select(f"__{side}", "__tag", f"{side}_R2_EUR")
        pairs = encode(pairs.select(*ID16).distinct() if side == "left" else pairs, loci[side], dict(zip(ids, ids)), f"__{side}")
    shared = (pairs.select("__left", "__right").join(narrow["left"], "__left").join(narrow["right"], ["__right", "__tag"]))
    return (shared.join(loci["left"], "__left").join(loci["right"], "__right").join(tags, "__tag")
            .drop("__left", "__right", "__tag"))


def _group_tags(rows: pa.Table, leads: pa.Table, keep: Sequence[str], rows_at_once: int = 256) -> pa.Table:
    """``rows`` (pairs) whose leads share a tag, with lists of the shared tags and both sides' R2."""
    names = [*keep, *TAG_COLS, "left_R2_EUR", "right_R2_EUR"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    out = [pa.table([*rows.select(keep).slice(0, 0).columns, *[pa.array([], pa.list_(k)) for k in kinds]], names=names)]
    if not (rows.num_rows and leads.num_rows):
        return out[0]
    leads = leads.combine_chunks()
    whole = lambda t, p: [t.column(p + c).cast(pa.int64()) if pa.types.is_integer(t.column(p + c).type) else t.column(p + c) for c in LEAD_KEY]
    *asked, held = _numbers(*[whole(rows, f"{s}_") for s in SIDES], whole(leads, ""))
    at = [_places(x, held) for x in asked]
    pairs = np.flatnonzero((at[0] >= 0) & (at[1] >= 0))
    pos, code, r2 = (leads.column(c).combine_chunks() for c in ("tag_pos", "tag_code", "codes"))
    size = np.asarray(pos.value_lengths()).astype(np.int64)
    first = np.cumsum(size) - size
    pos, code, r2 = (x.flatten() for x in (pos, code, r2))
    number, = _numbers([pos, code])
    order = np.lexsort((number, np.repeat(np.arange(len(size)), size)))
    number, width = number[order], int(number.max(initial=0)) + 1
    coded = code.dictionary_encode()
    parts = [pa.array(x, pa.string()) for x in zip(*code_parts(coded.dictionary.to_pylist()))] if len(coded.dictionary) else [pa.array([], pa.string())] * 3
    for k in range(0, len(pairs), rows_at_once):
        own = pairs[k:k + rows_at_once]
        key, row = [], []
        for a in at:
            n = size[a[own]]
            pair = np.repeat(np.arange(len(own)), n)
            row.append(np.arange(len(pair)) + np.repeat(first[a[own]] - (np.cumsum(n) - n), n))
            key.append(pair * width + number[row[-1]])
        lo, hi = np.searchsorted(key[0], key[1], "left"), np.searchsorted(key[0], key[1], "right")
        times = hi - lo  # over one only where a table repeats a lead's tag
        r = np.repeat(np.arange(len(times)), times)
        l = lo[r] + np.arange(len(r)) - np.repeat(np.cumsum(times) - times, times)
        shared = np.bincount(key[1][r] // width, minlength=len(own))
        offsets = pa.array(np.concatenate([[0], np.cumsum(shared[shared > 0])]).astype(np.int32))
        left, right = order[row[0][l]], order[row[1][r]]
        name = pa.array(np.asarray(coded.indices)[left])
        chrom, ref, alt = (x.take(name) for x in parts)
        flat = [chrom, pos.take(pa.array(left)), ref, alt, r2.take(pa.array(left)).cast(pa.float64()), r2.take(pa.array(right)).cast(pa.float64())]
        out.append(pa.table([*rows.select(keep).take(pa.array(own[shared > 0])).columns, *[pa.ListArray.from_arrays(offsets, x) for x in flat]], names=names))
    return pa.concat_tables(out)


def pair_tag_intersection(c: DataFrame, ld: DataFrame, group_signals: int = SHARED_SIGNALS) -> DataFrame:
    """J14 of the distinct pairs of ``c``: 16 ids, tag and both sides' R2, one row per tag that the leads of a pair share.

    The rows of ``ld_tag_intersection`` on ``locus_ld_tags`` of both sides.  Pairs meet the tags of their leads in the group of
    their region and leave it with lists, which are unfolded where they arrive: no row per pair and tag is sent.
    """
    name = lambda s: [F.col(f"{s}_{x}") for x in LEAD_KEY]
    pairs = c.select(*ID16).distinct().na.drop("any", subset=[f"{s}_{x}" for s in SIDES for x in LEAD_KEY])
    t = add_groups(pairs.withColumns({**{f"{s}_signal_id": F.xxhash64(*name(s)) for s in SIDES}, "left_lead_chrom": F.col("left_chrom"), "left_lead_pos": F.col("left_pos")}), group_signals)
    sides = F.array(*[F.struct(*[col.alias(x) for col, x in zip(name(s), LEAD_KEY)]) for s in SIDES])
    to = materialize(t.select(F.explode(sides).alias("x"), F.col("group").alias("to")).select("x.*", "to").distinct(), "pair-leads")
    leads = lead_tag_lists(ld, to.select(*LEAD_KEY).distinct(), F.col("R2_EUR")).join(to, list(LEAD_KEY)).drop("num_tags")
    arrays = [*TAG_COLS, "left_R2_EUR", "right_R2_EUR"]
    kinds = [T.StructField(x, T.ArrayType(k)) for x, k in zip(arrays, (T.StringType(), T.LongType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()))]
    keep = pairs.columns
    lists = t.select("group", *keep).groupBy("group").cogroup(leads.groupBy("to")).applyInArrow(lambda a, b: _group_tags(a, b, keep), T.StructType([*pairs.schema.fields, *kinds]))
    x = lists.select(*keep, F.inline(F.arrays_zip(*arrays)))
    return x.withColumn("tag_pos", F.col("tag_pos").cast(ld.schema["tag_pos"].dataType))


def threshold_code(r2: Column) -> Column:
    """How many of the ascending thresholds R2 reaches (0-14); -1 for NULL."""
    return F.when(r2.isNull(), -1).otherwise(sum((F.when(r2 >= t, 1).otherwise(0) for t in R2_THRESHOLDS), F.lit(0)))


def lead_tags(ld: DataFrame, leads: DataFrame) -> DataFrame:
    """Per lead variant (``leads``: chrom, pos, ref, alt, lead) its tags once: sorted dense ids, codes and their number."""
    key = ["chrom", "pos", "ref", "alt"]
    x = encode(ld, leads, {f"lead_{c}": c for c in key}, "lead")
    ids = dictionary(x.na.drop("any", subset=TAG_COLS), TAG_COLS, "tag")
    x = encode(x, ids, {c: c for c in TAG_COLS}, "tag", how="left")
    known = F.col("tag").isNotNull()
    return (x.select("lead", "tag", F.col("tag_chrom").isNotNull().cast("int").alias("counts"), threshold_code(F.col("R2_EUR")).alias("code"))
             .groupBy("lead").agg(F.sum("counts").alias("num_tags"),
                                  F.sort_array(F.collect_list(F.when(known, F.struct("tag", "code")))).alias("x"))
             .select("lead", "num_tags", F.transform("x", lambda e: e["tag"]).alias("tags"), F.transform("x", lambda e: e["code"]).alias("codes")))


def lead_tag_lists(ld: DataFrame, leads: DataFrame, value: Column | None = None) -> DataFrame:
    """Per lead variant (``leads``: chrom, pos, ref, alt) its tags once: positions, names and codes (or ``value`` of
    R2_EUR in their place), and the number of tags.

    A tag stays the variant that it is; whoever compares tags numbers them, so none is shuffled to get an id.
    """
    x = ld.withColumnsRenamed({f"lead_{c}": c for c in LEAD_KEY}).join(leads, list(LEAD_KEY), "left_semi")
    x = x.select(*LEAD_KEY, *[F.col(f"tag_{c}").alias(f"__{c}") for c in LEAD_KEY],
                 (threshold_code(F.col("R2_EUR")).cast("tinyint") if value is None else value).alias("code"))
    known = F.col("__chrom").isNotNull() & F.col("__pos").isNotNull() & F.col("__ref").isNotNull() & F.col("__alt").isNotNull()
    tag = F.struct(F.col("__pos").cast("bigint").alias("pos"), variant_code("__").alias("name"), F.col("code"))
    # in order of position, so that neighbours look alike to the shuffle's compression
    x = x.groupBy(*LEAD_KEY).agg(F.count("__chrom").alias("num_tags"), F.sort_array(F.collect_list(F.when(known, tag))).alias("x"))
    return x.select(*LEAD_KEY, "num_tags", F.col("x.pos").alias("tag_pos"), F.col("x.name").alias("tag_code"), F.col("x.code").alias("codes"))


def _merged(left_tags, left_codes, right_tags, right_codes):
    """(total, [counts per threshold], left counts, rows) per pair from list columns of sorted ids and codes."""
    n = len(left_tags)
    sizes = [np.asarray(x.value_lengths()) for x in (left_tags, right_tags)]
    owner = [np.repeat(np.arange(n), k) for k in sizes]
    codes = [np.asarray(x.flatten()) for x in (left_codes, right_codes)]
    tags = np.concatenate([np.asarray(x.flatten()) for x in (left_tags, right_tags)])
    unique, rank = np.unique(tags, return_inverse=True)
    key = [o * len(unique) + r for o, r in zip(owner, np.split(rank, [len(owner[0])]))]  # both ascending
    lo, hi = np.searchsorted(key[0], key[1], "left"), np.searchsorted(key[0], key[1], "right")
    times = hi - lo  # over one only where a table repeats a lead's tag
    r = np.repeat(np.arange(len(times)), times)
    at = np.arange(len(r)) - np.repeat(np.cumsum(times) - times, times) + lo[r]
    a, z, pair = codes[0][at], codes[1][r], owner[1][r]
    levels = len(R2_THRESHOLDS) + 2
    histogram = np.bincount(pair * levels + np.minimum(a, z) + 1, minlength=n * levels).reshape(n, levels)
    reached = np.cumsum(histogram[:, :0:-1], 1)[:, ::-1]  # [pair, code]: shared tags with at least that code on both sides
    return reached, np.bincount(pair[a >= 0], minlength=n), np.bincount(pair, minlength=n)


def pair_overlaps(pairs: DataFrame, tags: DataFrame, rows_at_once: int = 1000) -> DataFrame:
    """(left_lead, right_lead, total_overlap, prop_overlap_*) of distinct pairs of leads that share a tag.

    ``pairs`` also carry the left lead's chromosome and position: pairs of one region meet
    their leads' tags in one group, which holds each lead once, however many pairs name it.
    """
    named = pairs.select(F.lit(0).alias("test_id"), F.col("left_lead").alias("left_signal_id"), F.col("right_lead").alias("right_signal_id"),
                         F.col("left_chrom").alias("left_lead_chrom"), F.col("left_pos").alias("left_lead_pos")).distinct()
    x = with_groups(named).select(F.col("left_signal_id").alias("left_lead"), F.col("right_signal_id").alias("right_lead"), "group")
    sent = tags.select("lead", "tags", "codes").join(
        x.select(F.explode(F.array("left_lead", "right_lead")).alias("lead"), F.col("group").alias("to")).distinct(), "lead")
    props = [f"prop_overlap_{t}" for t in R2_THRESHOLDS]
    names = ["left_lead", "right_lead", "total_overlap", *props]

    def run(asked: pa.Table, leads: pa.Table) -> pa.Table:
        out = [pa.table([pa.array([], pa.int64())] * 3 + [pa.array([], pa.float64())] * len(props), names=names)]
        leads = leads.combine_chunks()
        ids = np.asarray(leads.column("lead"))
        order = np.argsort(ids)
        wanted = [np.asarray(asked.column(f"{s}_lead")) for s in SIDES]
        if not len(ids) or not asked.num_rows:
            return out[0]
        at = [order[np.minimum(np.searchsorted(ids, w, sorter=order), len(ids) - 1)] for w in wanted]
        both = np.flatnonzero((ids[at[0]] == wanted[0]) & (ids[at[1]] == wanted[1]))
        for k in range(0, len(both), rows_at_once):
            some = both[k:k + rows_at_once]
            lists = [leads.column(c).combine_chunks().take(pa.array(at[side][some])) for side in (0, 1) for c in ("tags", "codes")]
            reached, base, rows = _merged(*lists)
            keep = np.flatnonzero(rows)
            share = np.divide(reached, base[:, None], out=np.zeros(reached.shape), where=base[:, None] > 0)[keep]
            empty = base[keep] == 0
            out.append(pa.table([pa.array(w[some][keep], pa.int64()) for w in wanted] + [pa.array(reached[keep, 0].astype(np.int64))]
                                + [pa.array(share[:, j + 1], mask=empty) for j in range(len(props))], names=names))
        return pa.concat_tables(out)

    return x.groupBy("group").cogroup(sent.groupBy("to")).applyInArrow(
        run, "left_lead bigint, right_lead bigint, total_overlap bigint, " + ", ".join(f"`{c}` double" for c in props))


def ld_overlap_features(intersection: DataFrame) -> DataFrame:
    """Total overlap and the 14 thresholded overlap proportions per locus pair."""
    l, r = F.col("left_R2_EUR"), F.col("right_R2_EUR")
    aggs = [F.count(F.when((l >= 0) & (r >= 0), F.lit(1))).alias("total_overlap")]
    for t in R2_THRESHOLDS:
        aggs.append((F.count(F.when((l >= t) & (r >= t), F.lit(1))) / F.count(l)).alias(f"prop_overlap_{t}"))
    return intersection.groupBy(*ID16).agg(*aggs)


def ld_num_tags(tags: DataFrame, side: str) -> DataFrame:
    """LD tags per locus (type excluded from the key, as in the legacy job)."""
    cols = [f"{side}_{c}" for c in RESULT_ID_COLS if c != "type"]
    return tags.groupBy(*cols).agg(F.count("tag_chrom").alias(f"{side}_num_tags"))


def lead_log_pvals(toploci: DataFrame) -> DataFrame:
    """-log10(p) of each top locus; p = 0 (NULL log) gets -log10(min double)."""
    return toploci.select("study_id", "phenotype_id", "bio_feature", "chrom", "pos", "ref", "alt",
                          F.coalesce(-F.log10("pval"), F.lit(NEG_LOG10_MIN_DOUBLE)).alias("log_pval"))


def attach_lead_pvals(features: DataFrame, toploci: DataFrame) -> DataFrame:
    """Inner joins (7 columns, null-safe) of lead -log10 p to both sides."""
    pv = lead_log_pvals(toploci)
    out = features
    for s in SIDES:
        p = pv.select(F.col("study_id").alias(f"{s}_study"), F.col("phenotype_id").alias(f"{s}_phenotype"),
                      F.col("bio_feature").alias(f"{s}_bio_feature"),
                      *[F.col(c).alias(f"{s}_{c}") for c in ("chrom", "pos", "ref", "alt")],
                      F.col("log_pval").alias(f"{s}_log_pval"))
        out = join_null_safe(out, p, [f"{s}_{c}" for c in RESULT_ID_COLS if c != "type"])
    return out


def pair_scalar_features(df: DataFrame) -> DataFrame:
    """Abs lead distance and is_gwas flags."""
    return df.withColumns({
        "abs_distance": F.abs(F.col("left_pos") - F.col("right_pos")),
        "left_is_gwas": F.when(F.col("left_type") == "gwas", 1).otherwise(0),
        "right_is_gwas": F.when(F.col("right_type") == "gwas", 1).otherwise(0)})


def _numbers(*tables: Sequence) -> list[np.ndarray]:
    """A number per row of each table (its key columns): equal keys, NULL = NULL, have equal numbers."""
    key = None
    for parts in zip(*tables):
        whole = pa.chunked_array([a for x in parts for a in (x.chunks if isinstance(x, pa.ChunkedArray) else [x])], parts[0].type).combine_chunks()
        code = np.asarray(whole.dictionary_encode(null_encoding="encode").indices).astype(np.int64)
        key = code if key is None else np.unique(key * (code.max(initial=0) + 1) + code, return_inverse=True)[1]
    return np.split(key, np.cumsum([len(t[0]) for t in tables])[:-1])


def _places(wanted: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Row of each wanted number among the held ones, which are distinct; -1 for none."""
    place = np.full(max(wanted.max(initial=-1), held.max(initial=-1)) + 1, -1)
    place[held] = np.arange(len(held))
    return place[wanted]


def _lead_lists(leads: pa.Table) -> tuple[pa.ListArray, pa.ListArray]:
    """Per lead its tags as ascending numbers and their codes."""
    pos, names, codes = (leads.column(c).combine_chunks() for c in ("tag_pos", "tag_code", "codes"))
    size = np.asarray(pos.value_lengths())
    number, = _numbers([pos.flatten(), names.flatten()])
    order = np.lexsort((number, np.repeat(np.arange(len(size)), size)))
    offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
    return tuple(pa.ListArray.from_arrays(offsets, pa.array(np.asarray(x)[order])) for x in (number, codes.flatten()))


def _group_features(rows: pa.Table, sent: pa.Table, keep: Sequence[str], rows_at_once: int) -> pa.Table:
    """``rows`` with the overlap, the numbers of tags and the top-locus rows of their pairs; NULL where a pair has none."""
    props = [f"prop_overlap_{t}" for t in R2_THRESHOLDS]
    is_lead = np.asarray(sent.column("is_lead"))
    leads, loci = sent.filter(pa.array(is_lead)), sent.filter(pa.array(~is_lead))
    whole = lambda c: c.cast(pa.int64()) if pa.types.is_integer(c.type) else c
    named = lambda t, p, cols: [whole(t.column(p + c)) for c in cols]
    *asked, held = _numbers(*[named(rows, f"{s}_", LOCUS_KEY) for s in SIDES], named(loci, "", LOCUS_KEY))
    of_locus, of_lead = _numbers(named(loci, "", LEAD_KEY), named(leads, "", LEAD_KEY))
    at = [_places(x, held) for x in asked]  # row of loci
    lead = np.append(_places(of_locus, of_lead), -1)
    pairs = np.flatnonzero((lead[at[0]] >= 0) & (lead[at[1]] >= 0))
    met, pair = np.unique(lead[at[0][pairs]] * max(leads.num_rows, 1) + lead[at[1][pairs]], return_inverse=True)
    lists = _lead_lists(leads)
    reached, base, shared = np.zeros((len(met), len(props) + 1), np.int64), np.zeros(len(met), np.int64), np.zeros(len(met), np.int64)
    for k in range(0, len(met), rows_at_once):
        some = met[k:k + rows_at_once]
        sides = [pa.array(x) for x in np.divmod(some, leads.num_rows)]
        reached[k:k + len(some)], base[k:k + len(some)], shared[k:k + len(some)] = _merged(*[x.take(side) for side in sides for x in lists])
    # each row stands once per pair of top-locus rows of its sides
    pvals = loci.column("log_pvals").combine_chunks()
    n_pvals = np.asarray(pvals.value_lengths()).astype(np.int64)
    first, pvals = np.cumsum(n_pvals) - n_pvals, pvals.flatten()
    found = shared[pair] > 0
    pairs, pair = pairs[found], pair[found]
    l, r = at[0][pairs], at[1][pairs]
    times = n_pvals[l] * n_pvals[r]
    row = np.repeat(np.arange(len(pairs)), times)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    l, r, pair, pairs = l[row], r[row], pair[row], pairs[row]
    rest = np.setdiff1d(np.arange(rows.num_rows), pairs)
    missing = np.arange(len(pairs) + len(rest)) >= len(pairs)

    def column(values, none=False):
        return pa.array(np.concatenate([values, np.zeros(len(rest), values.dtype)]), mask=missing | np.concatenate([np.broadcast_to(none, len(pairs)), missing[len(pairs):]]))

    total, empty = reached[pair, 0], base[pair] == 0
    out = rows.select(keep).take(pa.array(np.concatenate([pairs, rest])))
    fields = [("total_overlap", column(total))]
    share = np.divide(reached[pair], base[pair][:, None], out=np.zeros((len(pair), len(props) + 1)), where=~empty[:, None])
    fields += [(p, column(share[:, k + 1], empty)) for k, p in enumerate(props)]
    counts = np.asarray(leads.column("num_tags"))
    for s, x, p in (("left", l, nth // np.maximum(n_pvals[r], 1)), ("right", r, nth % np.maximum(n_pvals[r], 1))):
        fields.append((f"{s}_num_tags", column(counts[lead[x]] * np.asarray(loci.column(f"{s}_types"))[x])))
        fields.append((f"{s}_log_pval", column(np.asarray(pvals.take(pa.array(first[x] + p)), float))))
    for name, values in fields:
        out = out.append_column(name, values)
    return out


def with_pair_features(c: DataFrame, ld: DataFrame, toploci: DataFrame | None, group_signals: int = GROUP_SIGNALS,
                       rows_at_once: int = 1000) -> DataFrame:
    """The rows of ``c`` with all features of their pair (J14, J15, A7-A9, P28): NULL unless its leads share a tag.

    A pair whose sides have several top-locus rows stands once per pair of them, one without any has no features.  Without
    ``toploci`` every locus counts as having one.
    """
    name = lambda s: [F.col(f"{s}_{x}") for x in LOCUS_KEY]
    t = add_groups(c.withColumns({"left_signal_id": F.xxhash64(*name("left")), "right_signal_id": F.xxhash64(*name("right")),
                                  "left_lead_chrom": F.col("left_chrom"), "left_lead_pos": F.col("left_pos")}), group_signals)
    kind = lambda s: F.coalesce(F.concat(F.lit("="), f"{s}_type"), F.lit(""))
    none = F.lit(None).cast("string")
    sides = F.array(*[F.struct(*[col.alias(x) for col, x in zip(name(s), LOCUS_KEY)], *[(kind(s) if s == k else none).alias(f"{k}_type") for k in SIDES])
                      for s in SIDES])
    types = [f"{k}_type" for k in SIDES]
    asked = t.select(F.explode(sides).alias("x"), F.col("group").alias("to")).select("x.*", "to").na.drop("any", subset=list(LEAD_KEY)).distinct()
    asked = materialize(asked, "feature-loci")
    loci = asked.select(*LOCUS_KEY, *types).distinct().groupBy(*LOCUS_KEY).agg(*[F.count(x).alias(f"{x}s") for x in types])
    asked = asked.select("to", *LOCUS_KEY).distinct()
    if toploci is None:
        loci = loci.withColumn("log_pvals", F.array(F.lit(0.0)))
    else:
        pv = lead_log_pvals(toploci)
        pv = pv.toDF(*["study" if x == "study_id" else "phenotype" if x == "phenotype_id" else x for x in pv.columns])
        loci = join_null_safe(loci, pv.groupBy(*LOCUS_KEY).agg(F.collect_list("log_pval").alias("log_pvals")), LOCUS_KEY)
    loci = join_null_safe(asked, loci, LOCUS_KEY)
    to = asked.select("to", *LEAD_KEY).distinct()
    leads = lead_tag_lists(ld, to.select(*LEAD_KEY).distinct()).join(to, list(LEAD_KEY))
    sent = loci.withColumn("is_lead", F.lit(False)).unionByName(leads.withColumn("is_lead", F.lit(True)), allowMissingColumns=True)
    kinds = [*[T.StructField("total_overlap", T.LongType())], *[T.StructField(f"prop_overlap_{x}", T.DoubleType()) for x in R2_THRESHOLDS],
             *[T.StructField(f"{s}_{x}", k) for s in SIDES for x, k in (("num_tags", T.LongType()), ("log_pval", T.DoubleType()))]]
    keep = c.columns
    x = t.select("group", *keep).groupBy("group").cogroup(sent.groupBy("to")).applyInArrow(
        lambda a, b: _group_features(a, b, keep, rows_at_once), T.StructType([*c.schema.fields, *kinds]))
    x = pair_scalar_features(x.withColumns({f"{s}_prop_total_overlap": F.col("total_overlap") / F.col(f"{s}_num_tags") for s in SIDES}))
    return x.withColumns({k: F.when(F.col("total_overlap").isNotNull(), F.col(k)) for k in ("abs_distance", "left_is_gwas", "right_is_gwas")})


def pair_features(c: DataFrame, ld: DataFrame, toploci: DataFrame) -> DataFrame:
    """``with_pair_features`` of the distinct tested pairs of ``c`` that have any."""
    return with_pair_features(c.select(*ID16).distinct(), ld, toploci).filter(F.col("total_overlap").isNotNull())


def locus_pair_overlaps(c: DataFrame, ld: DataFrame) -> DataFrame:
    """A7 of the distinct tested pairs: 16 ids, total overlap and the 14 thresholded proportions."""
    x = with_pair_features(c.select(*ID16).distinct(), ld, None).filter(F.col("total_overlap").isNotNull())
    return x.select(*ID16, "total_overlap", *[F.col(f"`prop_overlap_{t}`") for t in R2_THRESHOLDS])


def build_features(ld: DataFrame, coloc: DataFrame, toploci: DataFrame,
                   min_vars_exclusive: int = MIN_VARS_EXCLUSIVE, all_pairs: bool = False) -> DataFrame:
    """M9: features x coloc outcomes, full outer on the 16 ids (J16): of the tested pairs, or of all loci.

    Features of tested pairs have a row of ``coloc`` each, so there the rows of ``coloc`` get them without a join.
    """
    c = coloc_for_features(coloc, min_vars_exclusive)
    keep = c.select(*[x for x in c.columns if x not in ("coloc_h0", "coloc_h1", "coloc_h2", "coloc_h4_h3", "coloc_n_vars", "is_flipped",
                                                        "left_sumstat", "right_sumstat")])
    if not all_pairs:
        out = with_pair_features(keep, ld, toploci)
        return out.select(*ID16, *FEATURE_COLS_ESCAPED, *[x for x in keep.columns if x not in ID16])
    left, right = locus_ld_tags(c, ld, "left"), locus_ld_tags(c, ld, "right")
    f = ld_overlap_features(ld_tag_intersection(left, right, None))
    for s, t in (("left", left), ("right", right)):
        f = join_null_safe(f, ld_num_tags(t, s), [f"{s}_{x}" for x in RESULT_ID_COLS if x != "type"])
    f = f.withColumns({"left_prop_total_overlap": F.col("total_overlap") / F.col("left_num_tags"),
                       "right_prop_total_overlap": F.col("total_overlap") / F.col("right_num_tags")})
    f = pair_scalar_features(attach_lead_pvals(f, toploci))
    return join_null_safe(f, keep, ID16, "full")


def _shared_weights(t: pa.Table, leads_at_once: int = 256) -> int:
    """Sum of left_rows x right_rows over the left and the right leads of a group that share a tag."""
    t = t.combine_chunks()
    sides = [t.filter(t.column(f"is_{s}")) for s in SIDES]
    if not (sides[0].num_rows and sides[1].num_rows):
        return 0
    flat = [[x.column(c).combine_chunks().flatten() for c in ("tag_pos", "tag_code")] for x in sides]
    numbers = _numbers(*flat)
    both = np.intersect1d(*numbers)  # tags of one side alone join nothing
    holds = []
    for x, number in zip(sides, numbers):
        owner = np.repeat(np.arange(x.num_rows), np.asarray(x.column("tag_pos").combine_chunks().value_lengths()))
        at = np.minimum(np.searchsorted(both, number), max(len(both) - 1, 0))
        known = np.flatnonzero(both[at] == number) if len(both) else np.empty(0, np.int64)
        holds.append((owner[known], at[known]))
    right = np.zeros((sides[1].num_rows, len(both)), np.float32)
    right[holds[1]] = 1
    weight = [np.asarray(x.column(f"{s}_rows")) for s, x in zip(SIDES, sides)]
    total = 0
    for k in range(0, sides[0].num_rows, leads_at_once):
        some = (holds[0][0] >= k) & (holds[0][0] < k + leads_at_once)
        left = np.zeros((min(leads_at_once, sides[0].num_rows - k), len(both)), np.float32)
        left[holds[0][0][some] - k, holds[0][1][some]] = 1
        total += int(weight[0][k:k + len(left)] @ ((left @ right.T > 0) @ weight[1]))
    return total


def linked_rows(ld: DataFrame, weights: DataFrame, group_leads: int = GROUP_SIGNALS) -> DataFrame:
    """(pairs): sum of left_rows x right_rows over all pairs of leads that share a tag, one row.

    ``weights``: chrom, pos, ref, alt, left_rows, right_rows.  Left leads of a region meet the right leads that have tags in
    the same stretches of a chromosome; pairs exist inside a task only.
    """
    tags = lead_tag_lists(ld, weights.select(*LEAD_KEY)).join(weights, list(LEAD_KEY)).drop("codes", "num_tags")
    known = ld.na.drop("any", subset=TAG_COLS).select(*[F.col(f"lead_{c}").alias(c) for c in LEAD_KEY],
                                                      F.xxhash64("tag_chrom", F.floor(F.col("tag_pos") / REGION)).alias("block")).distinct()
    blocks = materialize(known.join(weights, list(LEAD_KEY)), "lead-blocks")
    group = F.xxhash64("chrom", F.floor(F.col("pos") / REGION))
    lefts = weights.filter("left_rows > 0").select(*LEAD_KEY, group.alias("__region"))
    shares = lefts.groupBy("__region").agg(F.ceil(F.count(F.lit(1)) / group_leads).cast("bigint").alias("__shares"))
    lefts = materialize(lefts.join(materialize(shares, "region-sizes"), "__region").select(
        *LEAD_KEY, F.xxhash64("__region", F.pmod(F.xxhash64(*LEAD_KEY), F.col("__shares"))).alias("to")), "left-leads")
    touched = blocks.join(lefts, list(LEAD_KEY)).select("block", "to").distinct()
    rights = blocks.filter("right_rows > 0").select(*LEAD_KEY, "block").join(touched, "block").select(*LEAD_KEY, "to").distinct()
    to = (lefts.select(*LEAD_KEY, "to", F.lit(True).alias("is_left"), F.lit(False).alias("is_right"))
          .union(rights.select(*LEAD_KEY, "to", F.lit(False), F.lit(True))))
    sent = tags.join(to, list(LEAD_KEY)).select("to", "is_left", "is_right", "left_rows", "right_rows", "tag_pos", "tag_code")
    return (sent.groupBy("to").applyInArrow(lambda t: pa.table([pa.array([_shared_weights(t)], pa.int64())], names=["pairs"]), "pairs bigint")
            .agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs")))


def match_counts(ld: DataFrame, coloc: DataFrame, toploci: DataFrame, min_vars_exclusive: int = MIN_VARS_EXCLUSIVE) -> DataFrame:
    """A10 over all loci that share an LD tag: LD only / coloc only / both, without building their pairs.

    Loci are counted per lead variant first, and a pair of lead variants that share a tag stands for the product of its
    sides' loci.  Only tested pairs are built; they carry their outcomes to their features.
    """
    c = coloc_for_features(coloc, min_vars_exclusive)
    seven = ["study", "phenotype", "bio_feature", *LEAD_KEY]
    tops = toploci.toDF(*["study" if x == "study_id" else "phenotype" if x == "phenotype_id" else x for x in toploci.columns])
    tops = tops.groupBy(*seven).agg(F.count(F.lit(1)).alias("tops"))
    weight = None
    for s in SIDES:
        loci = c.select(*[F.col(f"{s}_{x}").alias(x) for x in ("type", *seven)]).distinct().na.drop("any", subset=list(LEAD_KEY))
        rows = [F.sum("tops").alias(f"{x}_rows") if x == s else F.lit(0).cast("bigint").alias(f"{x}_rows") for x in SIDES]
        own = join_null_safe(loci, tops, seven).groupBy(*LEAD_KEY).agg(rows[SIDES.index(s)]).select(
            *LEAD_KEY, *[F.col(f"{x}_rows") if x == s else rows[k] for k, x in enumerate(SIDES)])
        weight = own if weight is None else weight.unionByName(own)
    weight = materialize(weight.groupBy(*LEAD_KEY).agg(*[F.sum(f"{s}_rows").alias(f"{s}_rows") for s in SIDES]), "lead-weights")
    known = F.col("coloc_log2_h4_h3").isNotNull()
    outcome = c.groupBy(*ID16).agg(F.count_if(known).alias("__known"), F.count_if(~known).alias("__none"))
    x, there = with_pair_features(outcome, ld, toploci), F.col("total_overlap").isNotNull()
    total = lambda col, when: F.coalesce(F.sum(F.when(when, F.col(col))), F.lit(0))
    counts = x.agg(F.count_if(there).alias("tested"), total("__none", there).alias("tested_ld_only"), total("__known", ~there).alias("coloc_only"), total("__known", there).alias("both"))
    one = counts.crossJoin(linked_rows(ld, weight))  # two one-row tables
    return one.select((F.col("pairs") - F.col("tested") + F.col("tested_ld_only")).alias("ld_only"), "coloc_only", "both")


def feature_match_counts(features: DataFrame) -> DataFrame:
    """A10: rows with LD only / coloc only / both, one aggregate."""
    ld, co = F.col("total_overlap").isNotNull(), F.col("coloc_log2_h4_h3").isNotNull()
    return features.agg(F.count_if(ld & ~co).alias("ld_only"), F.count_if(~ld & co).alias("coloc_only"),
                        F.count_if(ld & co).alias("both"))


def feature_subset(features: DataFrame, right_type: str = "all") -> DataFrame:
    """All / gwas / molecular_trait (right_type != gwas)."""
    if right_type == "all":
        return features
    if right_type == "gwas":
        return features.filter(F.col("right_type") == "gwas")
    if right_type == "molecular_trait":
        return features.filter(F.col("right_type") != "gwas")
    raise ValueError(right_type)

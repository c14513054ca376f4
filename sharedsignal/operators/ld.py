"""Linkage disequilibrium from genotypes.

Re-aimed from PLINK: genotypes are a long table (sample_id, variant, dosage),
absent rows meaning dosage 0.  r for a (lead, tag) pair comes from per-variant
moments and one cross moment:

  r = (N Sxy - Sx Sy) / sqrt((N Sxx - Sx^2)(N Syy - Sy^2))

Cross moments are blocked products of bit planes: a variant's carriers of dosage 1
and of dosage 2 are bits in 64-sample lanes, and only lanes with a carrier are
stored.  Leads of a bin of the
chromosome meet the variants of the neighbouring bins, one block of lanes at a time,
and Sxy = sum of dosage products is four AND-and-count passes over the planes.  Pairs
without a common carrier are kept with Sxy = 0.  No shuffle is keyed by the sample and no row is made per sample and pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variants import parse_variant_id, variant_id
from ..sources.io import materialize
from .dictionary import dictionary, encode

LD_WINDOW_KB = 500
MIN_R2 = 0.05
#: Lanes of 64 samples that one block of the products covers (65,536 samples).
BLOCK_LANES = 1024
#: Words of two planes that are multiplied at once.
_WORDS_AT_ONCE = 1 << 22
VCOLS = ["chrom", "pos", "ref", "alt"]


def distinct_lead_variants(results: DataFrame, sides=("left", "right")) -> DataFrame:
    """Distinct lead variants of results (lead_chrom/pos/ref/alt)."""
    out = None
    for s in sides:
        x = results.select(*[F.col(f"{s}_{c}").alias(f"lead_{c}") for c in VCOLS])
        out = x if out is None else out.unionByName(x)
    return out.distinct()


def variant_planes(genotypes: DataFrame, block_lanes: int = BLOCK_LANES) -> DataFrame:
    """(chrom, pos, ref, alt, block, sx, sxx, lanes: array of (lane, ones, twos)): bits of carriers with dosage 1 and 2.

    ``genotypes`` has one row per (sample, variant).  A whole-number sample id is its
    place in the planes; others are numbered by a dictionary.  Carriers are merged into
    lanes in every task before the shuffle.  sx and sxx are sums over the block's carriers.
    """
    if dict(genotypes.dtypes)["sample_id"] in ("tinyint", "smallint", "int", "bigint"):
        x = genotypes.withColumn("__s", F.col("sample_id").cast("bigint"))
    else:
        x = encode(genotypes, dictionary(genotypes, ["sample_id"], "__s"), {"sample_id": "sample_id"}, "__s")
    bit = F.expr("shiftleft(1L, cast(__s & 63 as int))")
    none = F.lit(0).cast("bigint")
    lanes = (x.groupBy(*VCOLS, F.shiftright("__s", 6).alias("lane"))
              .agg(F.coalesce(F.bit_or(F.when(F.col("dosage") == 1, bit)), none).alias("ones"),
                   F.coalesce(F.bit_or(F.when(F.col("dosage") == 2, bit)), none).alias("twos")))
    one, two = F.bit_count("ones").cast("double"), F.bit_count("twos").cast("double")
    return (lanes.groupBy(*VCOLS, F.floor(F.col("lane") / block_lanes).alias("block"))
                 .agg(F.sum(one + 2 * two).alias("sx"), F.sum(one + 4 * two).alias("sxx"),
                      F.collect_list(F.struct(F.pmod("lane", F.lit(block_lanes)).cast("int").alias("lane"), "ones", "twos")).alias("lanes")))


def _planes(table: pa.Table, lanes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense planes (variants x lanes) of the lanes that occur, or of the given ascending ones."""
    column = table.column("lanes").combine_chunks()
    row = np.repeat(np.arange(len(column)), np.asarray(column.value_lengths()))
    flat = column.flatten()
    lane = np.asarray(flat.field("lane"))
    lanes = np.unique(lane) if lanes is None else lanes
    at = np.searchsorted(lanes, lane)
    inside = np.flatnonzero(lanes[np.minimum(at, len(lanes) - 1)] == lane)
    out = np.zeros((2, len(column), len(lanes)), np.uint64)
    for k, plane in enumerate(("ones", "twos")):
        out[k, row[inside], at[inside]] = np.asarray(flat.field(plane))[inside].view(np.uint64)
    return lanes, out[0], out[1]


def _r2(n: float, sxy, lead, tag):
    """(r^2, denominator) of pairs from their moments (sx, sxx) and cross moments, in the steps of ``ld_pairs``."""
    with np.errstate(all="ignore"):
        den = np.sqrt((n * lead[1] - lead[0] * lead[0]) * (n * tag[1] - tag[0] * tag[0]))
        r = (n * sxy - lead[0] * tag[0]) / den
        return r * r, den


def cross_moments(planes: DataFrame, leads: DataFrame, window: int, n_samples: int = 0, min_r2: float | None = None) -> DataFrame:
    """(lead, tag, sxy) of every lead and every variant within +-``window``; ids of variants.

    With ``min_r2``, pairs whose r^2 is lower are left out where the task knows it: their number would grow with the
    window.  A pair with a common carrier in one of several blocks of lanes is kept, its r^2 is known by the sum alone.

    ``planes``: (variant, chrom, pos, block, sx, sxx, lanes), written.  Bins are as wide as the
    window, so a lead's partners lie in three bins: tags are sent to their own bin and both
    neighbours.  A group is the variants of three bins in one block of lanes, whatever the
    number of samples.  Every variant takes part once in block -1, without lanes, which
    gives the pairs that share no carrier.
    """
    all_blocks = planes.select("variant", "chrom", "pos", "block", "sx", "sxx", "lanes")
    every = (planes.groupBy("variant", "chrom", "pos").agg(F.sum("sx").alias("sx"), F.sum("sxx").alias("sxx"))
             .select("variant", "chrom", "pos", F.lit(-1).cast("bigint").alias("block"), "sx", "sxx", F.array().cast(planes.schema["lanes"].dataType).alias("lanes")))
    low, high = planes.agg(F.min("block"), F.max("block")).first()
    if low != high:
        all_blocks = all_blocks.withColumn("block", F.col("block") - F.lit(low)).union(every)
    binned = all_blocks.withColumn("bin", F.floor(F.col("pos") / window))
    lead = binned.join(leads.select("variant").distinct(), "variant", "left_semi")
    tag = binned.withColumn("bin", F.explode(F.array(*[F.col("bin") + k for k in (-1, 0, 1)])))
    tag = tag.toDF(*tag.columns)  # both sides read one table; new column ids keep them apart
    keys = ["chrom", "bin", "block"]
    several = low != high

    def block(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            complete = not several or b.column("block")[0].as_py() < 0  # this block gives every pair
            lanes, a1, a2 = _planes(a)
            _, b1, b2 = _planes(b, lanes)
            apos, bpos = (np.asarray(t.column("pos")) for t in (a, b))
            aid, bid = (np.asarray(t.column("variant")) for t in (a, b))
            order = np.argsort(bpos, kind="stable")
            bpos, bid, b1, b2 = bpos[order], bid[order], b1[order], b2[order]
            amom, bmom = (np.stack([np.asarray(t.column(c)) for c in ("sx", "sxx")]) for t in (a, b))
            bmom = bmom[:, order]
            step = max(1, _WORDS_AT_ONCE // max(1, len(lanes)))
            for k in range(len(aid)):
                lo, hi = np.searchsorted(bpos, [apos[k] - window, apos[k] + window + 1])
                own = np.flatnonzero(a1[k] | a2[k])  # lanes in which the lead has a carrier
                x1, x2 = a1[k, own], a2[k, own]
                for at in range(lo, hi, step):
                    y1, y2 = b1[at:min(hi, at + step)][:, own], b2[at:min(hi, at + step)][:, own]
                    count = lambda m: np.bitwise_count(m).sum(1, dtype=np.int64)
                    sxy = count(x1 & y1) + 2 * (count(x1 & y2) + count(x2 & y1)) + 4 * count(x2 & y2)
                    if not complete:
                        hit = np.flatnonzero(sxy)
                    elif min_r2 is None:
                        hit = np.arange(len(sxy))
                    else:  # a hair below the limit, which is applied to what is returned
                        r2, den = _r2(float(n_samples), sxy, amom[:, k], bmom[:, at:at + len(sxy)])
                        hit = np.flatnonzero(~((r2 < min_r2 * (1 - 1e-9)) | (den == 0)))
                    out.append((np.full(len(hit), aid[k]), bid[at + hit], sxy[hit]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["lead", "tag", "sxy"])

    found = lead.groupBy(*keys).cogroup(tag.groupBy(*keys)).applyInArrow(block, "lead bigint, tag bigint, sxy bigint")
    return found.groupBy("lead", "tag").agg(F.sum("sxy").alias("sxy")) if several else found


def pair_r(planes: pa.Table, variant: np.ndarray, leads: np.ndarray, tags: np.ndarray, n_samples: float):
    """(r, r without a common carrier, whether they exist) of pairs of variants, ordered by lead; ``variant`` numbers the rows of
    ``planes`` (one per block of lanes; rows without a block share no carrier)."""
    count = int(variant.max(initial=-1)) + 1
    sx, sxx = (np.bincount(variant, np.asarray(planes.column(c)), count) for c in ("sx", "sxx"))
    sxy = np.zeros(len(leads), np.int64)
    blocks = planes.column("block").to_numpy()  # NaN where a block is missing
    for block in np.unique(blocks[blocks == blocks]):
        rows = np.flatnonzero(blocks == block)
        lanes, ones, twos = _planes(planes.take(pa.array(rows)))
        at = np.full(count, -1, np.int64)
        at[variant[rows]] = np.arange(len(rows))
        here = np.flatnonzero((at[leads] >= 0) & (at[tags] >= 0))
        start = np.flatnonzero(np.diff(leads[here], prepend=-1))
        for some in np.split(here, start[1:]):
            if not len(some):
                continue
            lead = at[leads[some[0]]]
            own = np.flatnonzero(ones[lead] | twos[lead])
            x1, x2 = ones[lead, own], twos[lead, own]
            step = max(1, _WORDS_AT_ONCE // max(1, len(own)))
            for k in range(0, len(some), step):
                part = some[k:k + step]
                y1, y2 = (plane[np.ix_(at[tags[part]], own)] for plane in (ones, twos))
                total = lambda m: np.bitwise_count(m).sum(1, dtype=np.int64)
                sxy[part] += total(x1 & y1) + 2 * (total(x1 & y2) + total(x2 & y1)) + 4 * total(x2 & y2)
    with np.errstate(all="ignore"):
        den = np.sqrt((n_samples * sxx[leads] - sx[leads] * sx[leads]) * (n_samples * sxx[tags] - sx[tags] * sx[tags]))
        return (n_samples * sxy - sx[leads] * sx[tags]) / den, -(sx[leads] * sx[tags]) / den, ~(den == 0)


def ld_pairs(genotypes: DataFrame, leads: DataFrame, n_samples: int,
             window_kb: int = LD_WINDOW_KB, block_lanes: int = BLOCK_LANES, min_r2: float | None = None) -> DataFrame:
    """R and r^2 between every genotyped lead and every variant within
    +-window_kb (the lead itself included).  Leads absent from the genotypes
    give no rows (PLINK: no valid --ld-snp).  ``min_r2``: pairs that a later
    ``ld_r2_filter`` with it would drop may be missing."""
    planes = materialize(variant_planes(genotypes, block_lanes), "planes")
    variants = dictionary(planes, VCOLS, "variant")
    planes = materialize(encode(planes, variants, {c: c for c in VCOLS}, "variant"), "planes")
    mom = materialize(planes.groupBy("variant", *VCOLS).agg(F.sum("sx").alias("sx"), F.sum("sxx").alias("sxx")), "moments")
    asked = encode(leads, mom, {f"lead_{c}": c for c in VCOLS}, "variant")
    cross = cross_moments(planes, asked, 1000 * window_kb, n_samples, min_r2)
    j = cross
    for s, k in (("lead", "l"), ("tag", "t")):
        j = j.join(mom.select(F.col("variant").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in VCOLS],
                              F.col("sx").alias(f"{k}sx"), F.col("sxx").alias(f"{k}sxx")), s)
    n, sxy = F.lit(float(n_samples)), F.col("sxy").cast("double")
    j = j.withColumn("__num", n * sxy - F.col("lsx") * F.col("tsx"))
    j = j.withColumn("__den", F.sqrt((n * F.col("lsxx") - F.col("lsx") * F.col("lsx"))
                                     * (n * F.col("tsxx") - F.col("tsx") * F.col("tsx"))))
    r = F.when(F.col("__den") > 0, F.col("__num") / F.col("__den"))
    keys = [f"lead_{c}" for c in VCOLS] + [f"tag_{c}" for c in VCOLS]
    return j.select(*keys, r.alias("R_EUR")).withColumn("R2_EUR", F.col("R_EUR") * F.col("R_EUR"))


def ld_r2_filter(df: DataFrame, min_r2: float = MIN_R2) -> DataFrame:
    """Keep R2 >= min_r2 (R2 already computed as R^2)."""
    return df.filter(F.col("R2_EUR") >= min_r2)


def ld_as_text(df: DataFrame) -> DataFrame:
    """Text form of the LD tool output: c_p_r_a ids + R, R2."""
    return df.select(variant_id("lead_chrom", "lead_pos", "lead_ref", "lead_alt", "_").alias("index_variant_id"),
                     variant_id("tag_chrom", "tag_pos", "tag_ref", "tag_alt", "_").alias("tag_variant_id"),
                     "R_EUR", "R2_EUR")


def parse_ld_text(df: DataFrame) -> DataFrame:
    """LD text -> typed lead_/tag_ columns (malformed ids give NULL parts)."""
    return df.select(*parse_variant_id("index_variant_id", "lead"), *parse_variant_id("tag_variant_id", "tag"),
                     "R_EUR", "R2_EUR")


def ld_table(genotypes: DataFrame, results: DataFrame, n_samples: int,
             window_kb: int = LD_WINDOW_KB, min_r2: float = MIN_R2) -> DataFrame:
    """L1: distinct result leads -> pairwise LD -> R2 filter -> text -> parsed table."""
    pairs = ld_r2_filter(ld_pairs(genotypes, distinct_lead_variants(results), n_samples, window_kb, min_r2=min_r2), min_r2)
    return parse_ld_text(ld_as_text(pairs))

"""Conditional analysis of summary statistics.

Re-aimed from an external tool to summary-level COJO (Yang et al. 2012):
given marginal b, se, allele frequency f and N per variant and LD r between
variants, the effect of variant j conditional on the set K is

  D_j = 2 f_j (1 - f_j) N_j,  C_jk = min(N_j, N_k) 2 sqrt(f_j(1-f_j) f_k(1-f_k)) r_jk
  b_K* = B^-1 D_K b_K  (B = [C_kk'] with D_k on the diagonal)
  b_j|K = b_j - C_jK b_K* / D_j
  var(b_j|K) = s2 (D_j - C_jK B^-1 C_Kj) / D_j^2
  s2 = (y'y - b_K*' D_K b_K - D_j b_j b_j|K) / (N_j - |K| - 1),
  y'y = median_j (D_j se_j^2 (N_j - 1) + D_j b_j^2)

k = 1 is closed-form Column arithmetic (``cojo_single``); any k runs one k x k NumPy
solve per signal (``cojo_solve``) over rows made by Spark, one per window variant with
the array of its r to the numbered conditioning variants; a signal's window is bounded,
so no group grows with the data.  Variants without LD information, the conditioning
variants themselves and variants collinear with K (R^2 > 0.9) are dropped, as the tool
does.  Conditioning variants without genotypes are left out, and of collinear ones a
pivoted Cholesky factorisation of their LD matrix keeps those that add to the others;
what was left out is a status row of the same pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import regions as rg
from .ld import ld_pairs, pair_r, variant_planes
from .regions import variant_code
from ..sources.io import materialize
from .sumstats import COND_WINDOW_KB, MIN_MAF, SIGNAL_COLS, STAT_COLS, maf_filter, signal_sumstats_join, top_locus_stats, window_join

COLLINEAR_R2 = 0.9

# --- Fixed values: complementary error function, Chebyshev fit with fractional
# error < 1.2e-7 (Press et al., Numerical Recipes, erfcc) ---------------------
ERFC_COEFS = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807,
              -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def _erfc_terms(x):
    t = 1.0 / (1.0 + 0.5 * x)
    acc = ERFC_COEFS[-1]
    for c in reversed(ERFC_COEFS[:-1]):
        acc = acc * t + c
    return t, acc


def with_pval_from_z(df: DataFrame, z: str, out: str) -> DataFrame:
    """Two-sided p = erfc(|z| / sqrt 2) (fractional error < 1.2e-7)."""
    x = f"__{out}_x"
    t = f"__{out}_t"
    df = df.withColumn(x, F.abs(F.col(z)) / F.lit(math.sqrt(2.0)))
    df = df.withColumn(t, F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * F.col(x)))
    acc = F.lit(ERFC_COEFS[-1])
    for c in reversed(ERFC_COEFS[:-1]):
        acc = acc * F.col(t) + F.lit(c)
    return df.withColumn(out, F.col(t) * F.exp(-F.col(x) * F.col(x) + acc)).drop(x, t)


def pval_from_z_np(z):
    x = np.abs(z) / math.sqrt(2.0)
    t, acc = _erfc_terms(x)
    return t * np.exp(-x * x + acc)


def condition_list(signals: DataFrame, window_stats: DataFrame, toploci: DataFrame,
                   window_kb: int = COND_WINDOW_KB) -> DataFrame:
    """(window variants of the signal) n (top loci of the same study /
    phenotype / feature / chromosome) minus the index variant.

    ``signals``: signal_id + locus columns; ``window_stats``: signal_id +
    chrom/pos/ref/alt.  Output: signal_id, cond_chrom/pos/ref/alt.
    """
    keys = ["study_id", "phenotype_id", "bio_feature"]
    tl = toploci.select(*keys, *[F.col(c).alias(f"cond_{c}") for c in ("chrom", "pos", "ref", "alt")])
    c = window_join(signals.select("signal_id", *keys, *[f"lead_{c}" for c in ("chrom", "pos", "ref", "alt")]), tl, keys,
                    "lead_chrom", "lead_pos", "cond_chrom", "cond_pos", 1000 * window_kb)
    c = c.filter(~((F.col("cond_pos") == F.col("lead_pos")) & (F.col("cond_ref") == F.col("lead_ref"))
                   & (F.col("cond_alt") == F.col("lead_alt"))))
    w = window_stats.select("signal_id", F.col("chrom").alias("cond_chrom"), F.col("pos").alias("cond_pos"),
                            F.col("ref").alias("cond_ref"), F.col("alt").alias("cond_alt"))
    return (c.select("signal_id", "cond_chrom", "cond_pos", "cond_ref", "cond_alt")
             .join(w, ["signal_id", "cond_chrom", "cond_pos", "cond_ref", "cond_alt"], "left_semi")
             .distinct())


def cojo_input(stats: DataFrame, p_threshold: float | None = None) -> DataFrame:
    """The tool's input projection SNP, A1 = alt, A2 = ref, freq, b, se, p, N."""
    out = stats.select(F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt").alias("SNP"),
                       F.col("alt").alias("A1"), F.col("ref").alias("A2"), F.col("eaf").alias("freq"),
                       F.col("beta").alias("b"), "se", F.col("pval").alias("p"), F.col("n_total").alias("N"))
    return out if p_threshold is None else out.filter(F.col("p") <= p_threshold)


#: About how many signals with one conditioning variant a group of one region may hold.
GROUP_SIGNALS = 256
VAR = ["chrom", "pos", "ref", "alt"]
CONDS = [f"cond_{c}" for c in VAR]
GROUP = ["__bin", "__share"]


def single_conditions(conds: DataFrame, window_kb: int = 2 * COND_WINDOW_KB, group_signals: int = GROUP_SIGNALS) -> DataFrame:
    """The signals with one conditioning variant, that variant and the group of its region (``GROUP``)."""
    one = conds.groupBy("signal_id").agg(F.count(F.lit(1)).alias("k"), *[F.first(c).alias(c) for c in CONDS]).filter("k = 1").drop("k")
    one = one.na.drop("any").withColumn("__bin", F.floor(F.col("cond_pos") / (1000 * window_kb)))
    shares = one.groupBy("cond_chrom", "__bin").agg(F.ceil(F.count(F.lit(1)) / group_signals).cast("bigint").alias("__shares"))
    return (one.join(shares, ["cond_chrom", "__bin"]).withColumn("__share", F.pmod(F.xxhash64("signal_id"), F.col("__shares")))
               .select("signal_id", *CONDS, *GROUP))


def _places(names: list, t: pa.Table, known: pa.Array | None = None):
    """Texts of the variants named by two columns (position, code), or their places in ``known`` (-1: not there)."""
    text = pc.binary_join_element_wise(t.column(names[0]).cast(pa.string()), t.column(names[1]), "|")
    text = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
    return text if known is None else pc.fill_null(pc.index_in(text, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _single_group(x: pa.Table, planes: pa.Table, n_samples: float, window: int, kept: list) -> pa.Table:
    """Rows of ``x`` with their r to the signal's conditioning variant, that variant's own values and the signal's median y'y."""
    known = pc.unique(_places(["pos", "code"], planes)) if planes.num_rows else pa.array([], pa.string())
    j, k = _places(["pos", "code"], x, known), _places(["cond_pos", "cond_code"], x, known)
    pos, cond = (np.asarray(x.column(c)) for c in ("pos", "cond_pos"))
    signal = np.unique(np.asarray(x.column("signal_id")), return_inverse=True)[1]
    own = pc.and_(pc.equal(x.column("pos"), x.column("cond_pos")), pc.equal(x.column("code"), x.column("cond_code")))
    own = np.asarray(pc.fill_null(own, False)).astype(bool)
    rows = np.flatnonzero((j >= 0) & (k >= 0) & (np.abs(pos - cond) <= window))
    pairs, pair = np.unique(k[rows] * max(len(known), 1) + j[rows], return_inverse=True)
    variant, lead, tag = _places(["pos", "code"], planes, known), pairs // max(len(known), 1), pairs % max(len(known), 1)
    r, apart, known_r = pair_r(planes, variant, lead, tag, n_samples)
    # carriers without a sample id make a block of their own, which gives a pair of its own, as in ``ld_pairs``
    nameless = np.asarray(planes.column("block").is_null())
    held = [np.isin(np.arange(len(known)), variant[nameless == x]) for x in (False, True)]
    parts = [np.flatnonzero((h[lead] & h[tag])[pair]) for h in held]
    rows, r, known_r = (np.concatenate([v[p] for v, p in zip(both, parts)]) for both in ((rows, rows), (r[pair], apart[pair]), (known_r[pair], known_r[pair])))
    number = {c: x.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("beta", "se", "eaf", "n_total")}
    missing = np.zeros(x.num_rows, bool)
    for c in number:
        missing |= np.asarray(x.column(c).is_null())
    d = 2.0 * (number["eaf"] * (1.0 - number["eaf"])) * number["n_total"]
    yy_j = d * number["se"] * number["se"] * (number["n_total"] - 1.0) + d * number["beta"] * number["beta"]
    some = rows[~missing[rows]]
    some = some[np.lexsort((yy_j[some], signal[some]))]
    at = np.flatnonzero(np.diff(signal[some], prepend=-1))
    size = np.diff(at, append=len(some))
    yy = np.full(signal.max(initial=-1) + 1, np.nan)
    yy[signal[some[at]]] = (yy_j[some[at + (size - 1) // 2]] + yy_j[some[at + size // 2]]) / 2
    has = np.zeros(len(yy), bool)
    has[signal[some[at]]] = True
    ks = np.flatnonzero(own)  # a variant that the statistics repeat gives every row once for each
    ks = ks[np.argsort(signal[ks], kind="stable")]
    times = np.bincount(signal[ks], minlength=len(yy))
    first = np.cumsum(times) - times
    again = times[signal[rows]]
    of = np.repeat(np.arange(len(rows)), again)
    k_row = ks[first[signal[rows[of]]] + np.arange(len(of)) - np.repeat(np.cumsum(again) - again, again)]
    out = x.select(["signal_id", *VAR, "beta", "se", "eaf", "n_total", *kept]).take(pa.array(rows[of]))
    values = [pa.array(r[of], mask=~known_r[of])] + [x.column(c).take(pa.array(k_row)).cast(pa.float64()) for c in ("beta", "eaf", "n_total")]
    values += [pa.array(yy[signal[rows[of]]], mask=~has[signal[rows[of]]]), pa.array(own[rows[of]])]
    return pa.table([*out.columns, *values], names=[*out.column_names, "r", "b_k", "f_k", "n_k", "yy", "is_k"])


def with_single_r(rows: DataFrame, groups: DataFrame, genotypes: DataFrame, n_samples: int, window_kb: int, kept: Sequence[str] = ()) -> DataFrame:
    """Window rows that carry the columns of ``single_conditions`` (``groups``) meet the carriers of their region's variants.

    Rows are sent once, to the group of their conditioning variant's region; planes to the groups of their own and both
    neighbouring regions.  r is made inside the group, so no row per pair of variants is sent.  Variants without genotypes
    are dropped, as by an inner join.
    """
    window = 1000 * window_kb
    typed = rows.schema
    rows = rows.select("signal_id", *VAR, "beta", "se", "eaf", "n_total", *kept, *CONDS, *GROUP)
    code = variant_code()
    cond_code = F.concat(F.length("cond_chrom").cast("string"), F.lit(":"), "cond_chrom", F.length("cond_ref").cast("string"), F.lit(":"), "cond_ref", "cond_alt")
    rows = rows.withColumns({"code": code, "cond_code": cond_code, "pos": F.col("pos").cast("bigint"), "cond_pos": F.col("cond_pos").cast("bigint")})
    planes = materialize(variant_planes(genotypes).na.drop("any", subset=VAR), "planes").withColumn("code", code)
    planes = planes.withColumn("to_bin", F.explode(F.array(*[F.floor(F.col("pos") / window) + i for i in (-1, 0, 1)])))
    named = groups.select(F.col("cond_chrom").alias("chrom"), F.col("__bin").alias("to_bin"), F.col("__share").alias("to_share")).distinct()
    planes = planes.join(named, ["chrom", "to_bin"]).select("chrom", "to_bin", "to_share", F.col("pos").cast("bigint").alias("pos"), "code", "block", "sx", "sxx", "lanes")
    kinds = [("signal_id", "bigint"), *[(c, "bigint" if c == "pos" else "string") for c in VAR], *[(c, typed[c].dataType.simpleString()) for c in ("beta", "se", "eaf", "n_total", *kept)],
             *[(c, "double") for c in ("r", "b_k", "f_k", "n_k", "yy")], ("is_k", "boolean")]
    kept = list(kept)
    out = rows.groupBy("cond_chrom", *GROUP).cogroup(planes.groupBy("chrom", "to_bin", "to_share")).applyInArrow(
        lambda x, p: _single_group(x, p, float(n_samples), window, kept), ", ".join(f"`{c}` {t}" for c, t in kinds))
    return out.withColumn("pos", F.col("pos").cast(typed["pos"].dataType))


def cojo_single(window_stats: DataFrame, conds: DataFrame, genotypes: DataFrame, n_samples: int,
                window_kb: int = 2 * COND_WINDOW_KB) -> DataFrame:
    """C1, k = 1: closed-form conditional b, se, p for signals with one
    conditioning variant.  Output: signal_id, chrom, pos, ref, alt, beta_cond,
    se_cond, pval_cond, z_cond."""
    c1 = single_conditions(conds, window_kb)
    return cojo_single_rows(window_stats.join(c1, "signal_id"), c1, genotypes, n_samples, window_kb)


def cojo_single_rows(rows: DataFrame, groups: DataFrame, genotypes: DataFrame, n_samples: int,
                     window_kb: int = 2 * COND_WINDOW_KB, kept: Sequence[str] = ()) -> DataFrame:
    """``cojo_single`` of window rows that carry the columns of ``single_conditions`` already; ``kept`` columns stay."""
    x = with_single_r(rows, groups, genotypes, n_samples, window_kb, kept)
    x = x.withColumns({"n_j": F.col("n_total").cast("double"),
                       "v_j": F.col("eaf") * (F.lit(1.0) - F.col("eaf")),
                       "v_k": F.col("f_k") * (F.lit(1.0) - F.col("f_k"))})
    x = x.withColumns({"d_j": F.lit(2.0) * F.col("v_j") * F.col("n_j"),
                       "d_k": F.lit(2.0) * F.col("v_k") * F.col("n_k"),
                       "c_jk": F.least("n_j", "n_k") * F.lit(2.0) * F.sqrt(F.col("v_j") * F.col("v_k")) * F.col("r")})
    # a frequency of 0 or 1 leaves no variance: neither to condition on nor to condition
    x = x.filter(~F.col("is_k") & (F.col("r") * F.col("r") <= COLLINEAR_R2) & (F.col("d_j") > 0) & (F.col("d_k") > 0))
    x = x.withColumn("beta_cond", F.col("beta") - F.col("c_jk") / F.col("d_j") * F.col("b_k"))
    x = x.withColumn("s2", (F.col("yy") - F.col("d_k") * F.col("b_k") * F.col("b_k")
                            - F.col("d_j") * F.col("beta") * F.col("beta_cond")) / (F.col("n_j") - F.lit(2.0)))
    x = x.withColumn("var_cond", F.col("s2") * (F.col("d_j") - F.col("c_jk") * F.col("c_jk") / F.col("d_k"))
                     / (F.col("d_j") * F.col("d_j")))
    x = x.withColumn("se_cond", F.when(F.col("var_cond") > 0, F.sqrt("var_cond")))
    x = x.withColumn("z_cond", F.col("beta_cond") / F.col("se_cond"))
    x = with_pval_from_z(x, "z_cond", "pval_cond")
    return x.select("signal_id", *kept, "chrom", "pos", "ref", "alt", "beta_cond", "se_cond", "pval_cond", "z_cond")


COJO_COLS = ["signal_id", "chrom", "pos", "ref", "alt", "beta_cond", "se_cond", "pval_cond", "z_cond"]
STATUS_COLS = ["n_requested", "n_genotyped", "n_used", "reason"]
_SOLVED = ("signal_id bigint, chrom string, pos bigint, ref string, alt string, beta_cond double, se_cond double, pval_cond double, "
           "z_cond double, n_requested int, n_genotyped int, n_used int, reason string")


def pivoted_choice(r: np.ndarray, limit: float = COLLINEAR_R2) -> list[int]:
    """Rows of a correlation matrix picked by a pivoted Cholesky factorisation, in ascending order.

    The next pivot is the row with the largest variance not explained by those before it
    (the first of equals); it stops where less than 1 - ``limit`` of every row is left.
    """
    left, chosen, factors = np.array(np.diag(r), float), [], np.zeros(r.shape)
    for step in range(len(r)):
        open_ = np.where(np.isin(np.arange(len(r)), chosen), -np.inf, left)
        k = int(np.argmax(open_ > open_.max() - 1e-9))
        if not open_[k] >= 1 - limit:
            break
        factors[:, step] = (r[:, k] - factors[:, :step] @ factors[k, :step]) / math.sqrt(left[k])
        left = left - factors[:, step] ** 2
        chosen.append(k)
    return sorted(chosen)


def _cojo(R: np.ndarray, own: np.ndarray, f: np.ndarray, n: np.ndarray, b: np.ndarray, se: np.ndarray):
    """One signal: (genotyped variants, used ones, reason, rows with a result, [beta, se, p, z] of those rows).

    ``R``: r of the window variants (rows) to conditioning variants 0 .. k-1 (NaN: none), ``own`` the number of the
    conditioning variant that a row itself is (or -1).
    """
    requested = R.shape[1]
    place = {int(k): i for i, k in enumerate(own) if k >= 0}
    genotyped = [k for k in range(requested) if k in place and not np.isnan(R[place[k], k])]
    at = np.array([place[k] for k in genotyped], int)
    chosen = pivoted_choice(R[np.ix_(at, genotyped)]) if genotyped else []
    K, at = [genotyped[i] for i in chosen], at[chosen]
    reason = ("no genotypes" if not genotyped else "no usable variant" if not K else "collinear variants left out" if len(K) < len(genotyped)
              else "variants without genotypes left out" if len(K) < requested else None)
    rows = np.flatnonzero(~np.isnan(R[:, K]).any(1)) if K else np.empty(0, int)
    cols = [np.empty(0)] * 4
    keep = np.empty(0, int)
    if K:
        R = R[:, K]
        v = f * (1 - f)
        d = 2 * v * n
        yy = float(np.median((d * se * se * (n - 1) + d * b * b)[rows]))
        nk, vk, dk, bk = n[at], v[at], d[at], b[at]
        B = np.minimum.outer(nk, nk) * 2 * np.sqrt(np.outer(vk, vk)) * R[at]
        np.fill_diagonal(B, dk)
        try:
            Binv, Rinv = np.linalg.inv(B), np.linalg.inv(R[at])
        except np.linalg.LinAlgError:  # a frequency of 0 or 1: no variance to condition on
            reason, K = "singular", []
    if K:
        with np.errstate(divide="ignore", invalid="ignore"):
            bstar = Binv @ (dk * bk)
            C = np.minimum.outer(n, nk) * 2 * np.sqrt(np.outer(v, vk)) * R
            bc = b - (C @ bstar) / d
            s2 = (yy - float(bstar @ (dk * bk)) - d * b * bc) / (n - len(K) - 1)
            var = s2 * (d - ((C @ Binv) * C).sum(1)) / (d * d)
            sec = np.where(var > 0, np.sqrt(np.where(var > 0, var, 1.0)), np.nan)
            z = bc / sec
        r2 = ((R @ Rinv) * R).sum(1)
        dropped = np.zeros(len(b), bool)
        dropped[[i for i in place.values()]] = True  # every conditioning variant, used or not
        keep = rows[(r2[rows] <= COLLINEAR_R2) & ~dropped[rows] & (d[rows] > 0)]
        cols = [x[keep] for x in (bc, sec, pval_from_z_np(z), z)]
    return len(genotyped), len(K), reason, keep, cols


def _cojo_group(t: pa.Table) -> pa.Table:
    """``_cojo`` of one signal: rows = window variants with ``r``, ``own`` and the statistics."""
    signal, requested = t.column("signal_id")[0].as_py(), t.column("k")[0].as_py()
    R = np.array(t.column("r").combine_chunks().flatten(), float).reshape(t.num_rows, requested)
    n_genotyped, n_used, reason, keep, cols = _cojo(R, np.asarray(t.column("own")), *[np.asarray(t.column(c)).astype(float) for c in ("eaf", "n_total", "beta", "se")])
    m = len(keep)
    stats = t.select(["signal_id", "chrom", "pos", "ref", "alt"]).take(pa.array(keep, pa.int64()))
    status = [pa.array([x], pa.int32()) for x in (requested, n_genotyped, n_used)] + [pa.array([reason], pa.string())]
    both = [pa.concat_arrays([c.combine_chunks().cast(k) if hasattr(c, "combine_chunks") else c, pa.nulls(1, k)])
            for c, k in zip(stats.columns, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()))]
    both[0] = pa.array(both[0].to_pylist()[:m] + [signal], pa.int64())
    both += [pa.concat_arrays([pa.array(c, pa.float64()), pa.nulls(1, pa.float64())]) for c in cols]
    both += [pa.concat_arrays([pa.nulls(m, c.type), c]) for c in status]
    return pa.table(both, names=[x.split()[0] for x in _SOLVED.split(", ")])


def cojo_solve(window_stats: DataFrame, conds: DataFrame, genotypes: DataFrame, n_samples: int,
               window_kb: int = 2 * COND_WINDOW_KB) -> DataFrame:
    """C1 + C2 in one pass: conditional statistics (``COJO_COLS``) and one status row per signal with a list.

    A status row has NULL in the variant columns and ``STATUS_COLS`` filled: how many
    conditioning variants were asked for, have genotypes and were used, and why some or
    all were not (NULL: all were used).
    """
    var = ["chrom", "pos", "ref", "alt"]
    number = Window.partitionBy("signal_id").orderBy("cond_pos", "cond_ref", "cond_alt", "cond_chrom")
    listed = conds.withColumns({"k": F.row_number().over(number) - 1})
    r = ld_pairs(genotypes, conds.select(*[F.col(f"cond_{c}").alias(f"lead_{c}") for c in var]).distinct(), n_samples, window_kb).select(
        *[F.col(f"lead_{c}").alias(f"cond_{c}") for c in var], *[F.col(f"tag_{c}").alias(c) for c in var], F.col("R_EUR").alias("r"))
    x = window_stats.join(listed, "signal_id").join(r, [f"cond_{c}" for c in var] + var, "left")
    itself = F.lit(True)
    for c in var:
        itself = itself & (F.col(c) == F.col(f"cond_{c}"))
    x = (x.groupBy("signal_id", *var).agg(
            *[F.first(c).alias(c) for c in ("beta", "se", "eaf", "n_total")], F.max(F.when(itself, F.col("k")).otherwise(-1)).alias("own"),
            F.count(F.lit(1)).cast("int").alias("k"),
            F.transform(F.sort_array(F.collect_list(F.struct("k", F.coalesce("r", F.lit(float("nan"))).alias("r")))), lambda e: e["r"]).alias("r")))
    return x.groupBy("signal_id").applyInArrow(_cojo_group, _SOLVED)


def cojo_multi(window_stats: DataFrame, conds: DataFrame, genotypes: DataFrame, n_samples: int,
               window_kb: int = 2 * COND_WINDOW_KB) -> DataFrame:
    """C1, any k >= 1: the statistics of ``cojo_solve``."""
    return cojo_solve(window_stats, conds, genotypes, n_samples, window_kb).filter("chrom is not null").select(*COJO_COLS)


#: About how many signals of one region a group of ``solve_windows`` may hold.
WINDOW_SIGNALS = 128
_VALUES = ("beta", "se", "pval", "n_total", "n_cases", "eaf", "is_cc")


def window_conditions(signals: DataFrame, sumstats: DataFrame, toploci: DataFrame, window_kb: int = COND_WINDOW_KB,
                      min_maf: float | None = MIN_MAF) -> tuple[DataFrame, DataFrame]:
    """J8 from the statistics of top loci alone, which a condition list is made of: (list, those statistics)."""
    tops = top_locus_stats(sumstats, toploci)
    near = signal_sumstats_join(signals.select("signal_id", *SIGNAL_COLS), tops, window_kb, min_maf)
    return condition_list(signals, near, toploci, window_kb), tops


def _solve_group(asked: pa.Table, sent: pa.Table, n_samples: float, window: int, ld_window: int, kept_window: int, rows_too: bool, schema: pa.Schema) -> pa.Table:
    """The signals of ``asked`` on the blocks of statistics and planes of carriers in ``sent``; one status row per signal with a list."""
    out = [schema.empty_table()]
    is_plane = np.asarray(sent.column("lanes").is_valid())
    blocks, planes = sent.filter(pa.array(~is_plane)).combine_chunks(), sent.filter(pa.array(is_plane)).combine_chunks()
    if not (blocks.num_rows and asked.num_rows):
        return out[0]
    asked = asked.combine_chunks()
    lists = {c: blocks.column(c).combine_chunks() for c in ("pos", "code", *_VALUES)}
    size = np.asarray(lists["pos"].value_lengths()).astype(np.int64)
    flat = {c: x.flatten() for c, x in lists.items()}
    pos = np.asarray(flat["pos"])
    inside, count, rows = rg._window_places(blocks, asked, window, size, pos)
    # variants by number: of statistics, of the conditioning variants, of the planes
    conds = {c: asked.column(f"cond_{c}").combine_chunks() for c in ("pos", "code")}
    k_of = np.asarray(pc.fill_null(conds["pos"].value_lengths(), 0)).astype(np.int64)
    first = np.cumsum(k_of) - k_of
    cond_table = pa.table([x.flatten() for x in conds.values()], names=["pos", "code"])
    plane_table = pa.table([planes.column(c) for c in ("plane_pos", "plane_code")], names=["pos", "code"])
    texts = [_places(["pos", "code"], t) for t in (plane_table, pa.table([flat["pos"], flat["code"]], names=["pos", "code"]), cond_table)]
    known = pc.unique(texts[0])
    number = lambda x, of: pc.fill_null(pc.index_in(x, value_set=of), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    variant, tag, lead = (number(x, known) for x in texts)
    named = pc.unique(texts[1])
    variant_of, cond_of = number(texts[1], named), number(texts[2], named)
    # r of every conditioning variant to the planes within the window; the last row and column stand for variants without planes
    leads = np.unique(lead[lead >= 0])
    r_of = np.full((len(leads) + 1, len(known) + 1), np.nan)
    if len(leads):
        at = np.empty(len(known), np.int64)
        at[variant] = np.asarray(planes.column("plane_pos"))
        near, to = np.nonzero(np.abs(at[leads][:, None] - at[None, :]) <= ld_window)
        r, _, has = pair_r(planes, variant, leads[near], to, n_samples)
        r_of[near[has], to[has]] = r[has]
    lead_row = np.where(lead >= 0, np.searchsorted(leads, lead), len(leads))
    f, n, b, se = (flat[c].cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("eaf", "n_total", "beta", "se"))
    codes, code_at = np.unique(np.array(flat["code"].to_pylist(), object), return_inverse=True)
    parts = [pa.array(x, pa.string()) for x in zip(*rg.code_parts(codes))]
    ids, centre = np.asarray(asked.column("signal_id")), np.asarray(asked.column("centre"))
    ends = np.cumsum(count)
    taken, owner, values, status = [], [], [], []
    for s, own_rows in zip(inside, np.split(rows, ends[:-1])):
        if not k_of[s]:
            if rows_too:
                part = own_rows[np.abs(pos[own_rows] - centre[s]) <= kept_window]
                taken.append(part), owner.append(np.full(len(part), s)), values.append(None)
            continue
        mine = slice(first[s], first[s] + k_of[s])
        own = np.full(len(own_rows), -1)
        for k, c in enumerate(cond_of[mine]):
            if c >= 0:
                own[variant_of[own_rows] == c] = k
        R = r_of[np.ix_(lead_row[mine], tag[own_rows])].T
        n_genotyped, n_used, reason, keep, cols = _cojo(R, own, f[own_rows], n[own_rows], b[own_rows], se[own_rows])
        status.append((int(ids[s]), int(k_of[s]), n_genotyped, n_used, reason))
        if rows_too:
            near = np.abs(pos[own_rows[keep]] - centre[s]) <= kept_window
            part = own_rows[keep][near]
            taken.append(part), owner.append(np.full(len(part), s)), values.append([x[near] for x in cols])
    if taken:
        row, s = np.concatenate(taken), np.concatenate(owner)
        given = np.concatenate([np.full(len(t), v is not None) for t, v in zip(taken, values)])
        cond = [np.concatenate([v[k] if v is not None else np.zeros(len(t)) for t, v in zip(taken, values)]) for k in range(4)]
        at, given = pa.array(row), pa.array(given)
        col = {c: flat[c].take(at) for c in _VALUES}
        for c, x in zip(("beta", "se", "pval"), cond):
            col[c] = pc.if_else(given, pa.array(x), col[c].cast(pa.float64()))
        col |= {"signal_id": pa.array(ids[s]), "pos": flat["pos"].take(at), "z_cond": pc.if_else(given, pa.array(cond[3]), pa.scalar(None, pa.float64()))}
        col |= {c: x.take(pa.array(code_at[row])) for c, x in zip(("chrom", "ref", "alt"), parts)}
        out.append(pa.table([(col[x.name].cast(x.type) if x.name in col else pa.nulls(len(row), x.type)) for x in schema], schema=schema))
    if status:
        col = dict(zip(("signal_id", *STATUS_COLS), zip(*status)))
        out.append(pa.table([pa.array(col[x.name], x.type) if x.name in col else pa.nulls(len(status), x.type) for x in schema], schema=schema))
    return pa.concat_tables(out)


def solve_windows(signals: DataFrame, conds: DataFrame, sumstats: DataFrame, genotypes: DataFrame, n_samples: int, window_kb: int = COND_WINDOW_KB,
                  min_maf: float | None = MIN_MAF, kept_window_kb: int | None = None, plain: bool = False, rows: bool = True,
                  group_signals: int = WINDOW_SIGNALS) -> DataFrame:
    """``merge_conditional`` of ``cojo_solve`` on the windows of ``signals`` (signal_id and locus columns), region by region.

    A group gets its signals with their lists, the blocks of statistics that their windows touch and the carriers of the
    variants there, each once; windows, r and the solves are made inside, so no row per window variant and conditioning
    variant is sent.  Output: signal_id, ``STAT_COLS``, z_cond of the variants within ``kept_window_kb`` of the lead, and one
    status row (chrom NULL, ``STATUS_COLS``) per signal with a list.  ``plain`` also gives the signals without a list, with
    their marginal statistics; ``rows=False`` gives the status rows alone.
    """
    window = 1000 * window_kb
    kept = 1000 * (window_kb if kept_window_kb is None else kept_window_kb)
    lists = (conds.distinct().withColumn("cond_code", F.concat(F.length("cond_chrom").cast("string"), F.lit(":"), "cond_chrom", F.length("cond_ref").cast("string"), F.lit(":"), "cond_ref", "cond_alt"))
             .groupBy("signal_id").agg(F.sort_array(F.collect_list(F.struct(F.col("cond_pos").cast("bigint").alias("pos"), "cond_ref", "cond_alt", "cond_chrom", F.col("cond_code").alias("code")))).alias("x"))
             .select("signal_id", F.col("x.pos").alias("cond_pos"), F.col("x.code").alias("cond_code")))
    lists = materialize(lists, "condition-lists")
    signals = signals if plain else signals.join(lists.select("signal_id"), "signal_id", "left_semi")
    signals = signals.filter(F.col("lead_chrom").isNotNull() & F.col("lead_pos").isNotNull())
    region = signals.select("signal_id", "lead_chrom", "lead_pos", F.xxhash64("lead_chrom", F.floor(F.col("lead_pos") / rg.REGION)).alias("__region"))
    sizes = materialize(region.groupBy("__region").agg(F.ceil(F.count(F.lit(1)) / group_signals).cast("bigint").alias("__shares")), "region-sizes")
    named = region.join(sizes, "__region").select("signal_id", "lead_chrom", "lead_pos", F.xxhash64("__region", F.pmod(F.xxhash64("signal_id"), F.col("__shares"))).alias("to"))
    ss = sumstats if min_maf is None else maf_filter(sumstats, min_maf)
    blocks, members = rg.sent_windows(named.select("signal_id", "to").distinct(), signals, lambda tracks, size: rg.value_blocks(ss, tracks, size, _VALUES), window)
    touched = F.sequence(F.floor((F.col("lead_pos") - window) / window), F.floor((F.col("lead_pos") + window) / window))
    places = named.select("to", F.col("lead_chrom").alias("chrom"), F.explode(touched).alias("__bin")).distinct()
    if not rows:  # then only conditioning variants meet each other
        genotypes = genotypes.join(conds.select(*[F.col(f"cond_{c}").alias(c) for c in VAR]).distinct(), VAR, "left_semi")
    planes = variant_planes(genotypes).na.drop("any", subset=VAR).withColumn("__bin", F.floor(F.col("pos") / window)).join(places, ["chrom", "__bin"])
    planes = planes.select("to", F.col("pos").cast("bigint").alias("plane_pos"), variant_code().alias("plane_code"), F.col("block").alias("plane_block"), "sx", "sxx", "lanes")
    sent = blocks.drop("block").unionByName(planes, allowMissingColumns=True).withColumnRenamed("plane_block", "block")
    asked = members.join(lists, "signal_id", "left").withColumnRenamed("to", "group")
    kinds = dict(sumstats.dtypes)
    double = {"beta", "se", "pval"}
    fields = [("signal_id", "bigint"), *[(c, "bigint" if c == "pos" else "string") for c in VAR], *[(c, "double" if c in double else kinds[c]) for c in _VALUES],
              ("z_cond", "double"), *[(c, "int") for c in STATUS_COLS[:3]], ("reason", "string")]
    typed = T._parse_datatype_string(", ".join(f"{c} {k}" for c, k in fields))
    arrow = to_arrow_schema(typed)
    out = asked.groupBy("group").cogroup(sent.groupBy("to")).applyInArrow(
        lambda a, x: _solve_group(a, x, float(n_samples), window, 2 * window, kept, rows, arrow), typed)
    return out.withColumn("pos", F.col("pos").cast(kinds["pos"])).select("signal_id", *STAT_COLS, "z_cond", *STATUS_COLS)


def solved_rows(solved: DataFrame) -> DataFrame:
    """The statistics of ``solve_windows``, without its status rows."""
    return solved.filter("chrom is not null").drop(*STATUS_COLS)


def merge_conditional(window_stats: DataFrame, cond: DataFrame) -> DataFrame:
    """Inner merge on the variant; beta/se/pval replaced by the conditional values."""
    j = window_stats.join(cond, ["signal_id", "chrom", "pos", "ref", "alt"])
    return j.drop("beta", "se", "pval").withColumnsRenamed(
        {"beta_cond": "beta", "se_cond": "se", "pval_cond": "pval"})


def conditioning_status(signals: DataFrame, solved: DataFrame) -> DataFrame:
    """The signals with a conditioning list and what became of it, from the rows of ``cojo_solve``."""
    return signals.join(solved.filter("chrom is null").select("signal_id", *STATUS_COLS), "signal_id")


def conditioning_failures(signals: DataFrame, solved: DataFrame) -> DataFrame:
    """Signals that could not be conditioned at all, with the reason."""
    return conditioning_status(signals, solved).filter("n_used = 0")


def conditionable(signals: DataFrame) -> Column:
    """Whether a signal is conditioned: it has an LD reference and its method is not 'distance'.

    Columns that ``signals`` lacks (``ld``, ``method``) rule nothing out.
    """
    ok = F.lit(True)
    if "ld" in signals.columns:
        ok = ok & F.col("ld").isNotNull()
    if "method" in signals.columns:
        ok = ok & (F.coalesce("method", F.lit("conditional")) != "distance")
    return ok


def prepare_signals_conditional(signals: DataFrame, sumstats: DataFrame, toploci: DataFrame,
                                genotypes: DataFrame, n_samples: int, coloc_window_kb: int = 500,
                                cond_window_kb: int = COND_WINDOW_KB, min_maf: float = MIN_MAF) -> DataFrame:
    """M4 with LD: condition window -> condition list -> COJO -> coloc window.

    Signals without an LD reference or of method 'distance', and those with an empty
    condition list, keep their marginal statistics.  ``z_cond`` is the conditional z
    (NULL for marginal rows); a signal whose conditioning fails has no rows.
    """
    routed = signals.withColumn("__c", conditionable(signals))
    conds, _ = window_conditions(routed.filter("__c"), sumstats, toploci, cond_window_kb, min_maf)
    return solved_rows(solve_windows(routed, conds, sumstats, genotypes, n_samples, cond_window_kb, min_maf, coloc_window_kb, plain=True))


def method_switch(credset_or_tests: DataFrame, method_col: str = "multisignal_method") -> dict:
    """Split by method; 'distance' rows skip conditioning."""
    return {"conditional": credset_or_tests.filter(F.col(method_col) == "conditional"),
            "distance": credset_or_tests.filter(F.col(method_col) == "distance")}

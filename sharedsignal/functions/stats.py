"""Column-expression statistics: normal quantile, approximate Bayes factors,
log-sum-exp helpers.

Everything here is built from Column expressions, so it runs inside whole-stage
codegen on the executors; no Python worker is involved.  Multi-step formulas are
``with_*(df, ...)`` helpers that stage every reused intermediate as its own
column: Catalyst then keeps them as separate projections instead of inlining a
large sub-expression into each of its uses.  Each expression also
has a SQL-text twin (``*_sql``) built from the same coefficients, used by the
DuckDB oracle so both engines evaluate the same arithmetic tree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: Wichura (1988) algorithm AS241, PPND16 -------------------
# Rational approximations of the standard normal quantile, coefficients in
# ascending powers.  Central region |q| <= 0.425 uses A/B with r = 0.180625 - q^2;
# tail region uses C/D for r = sqrt(-ln p) <= 5 (after r - 1.6) and E/F beyond
# (after r - 5).
AS241_A = (3.3871328727963666080e0, 1.3314166789178437745e+2, 1.9715909503065514427e+3,
           1.3731693765509461125e+4, 4.5921953931549871457e+4, 6.7265770927008700853e+4,
           3.3430575583588128105e+4, 2.5090809287301226727e+3)
AS241_B = (1.0, 4.2313330701600911252e+1, 6.8718700749205790830e+2, 5.3941960214247511077e+3,
           2.1213794301586595867e+4, 3.9307895800092710610e+4, 2.8729085735721942674e+4,
           5.2264952788528545610e+3)
AS241_C = (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
           3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
           2.27238449892691845833e-2, 7.74545014278341407640e-4)
AS241_D = (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
           1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
           1.05075007164441684324e-9)
AS241_E = (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
           2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
           2.71155556874348757815e-5, 2.01033439929228813265e-7)
AS241_F = (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
           7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
           2.04426310338993978564e-15)

# --- Fixed values: coloc.abf defaults (Giambartolomei et al. 2014) ----------
PRIOR_P1 = 1e-4
PRIOR_P2 = 1e-4
PRIOR_P12 = 1e-5
PRIOR_SD_QUANT = 0.15
PRIOR_SD_CC = 0.20

# -log10 of the smallest positive normal double, used for p = 0.
NEG_LOG10_MIN_DOUBLE = -math.log10(2.2250738585072014e-308)


def _horner(coefs, r: Column) -> Column:
    acc = F.lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        acc = acc * r + F.lit(c)
    return acc


def _horner_sql(coefs, r: str) -> str:
    acc = repr(float(coefs[-1]))
    for c in reversed(coefs[:-1]):
        acc = f"(({acc}) * {r} + {float(c)!r})"
    return acc


def with_z_from_pval(df: DataFrame, p_col: str, out: str) -> DataFrame:
    """Add ``out`` = Phi^-1(1 - p/2) (two-sided z), computed as -Phi^-1(p/2) so the
    tail stays exact (AS241).  NULL unless 0 < p < 2 and not NaN.

    Built in stages: every intermediate is its own column, so the optimizer never
    inlines a non-trivial sub-expression into the repeated polynomial terms.
    """
    t = f"__{out}"
    p = F.col(p_col) / F.lit(2.0)
    df = df.withColumn(f"{t}_p", p).withColumn(f"{t}_q", F.col(f"{t}_p") - F.lit(0.5))
    df = (df.withColumn(f"{t}_rc", F.lit(0.180625) - F.col(f"{t}_q") * F.col(f"{t}_q"))
            .withColumn(f"{t}_rt", F.sqrt(-F.log(F.least(F.col(f"{t}_p"), F.lit(1.0) - F.col(f"{t}_p"))))))
    df = (df.withColumn(f"{t}_r1", F.col(f"{t}_rt") - F.lit(1.6))
            .withColumn(f"{t}_r5", F.col(f"{t}_rt") - F.lit(5.0)))
    rc, r1, r5, q, pp = (F.col(f"{t}_rc"), F.col(f"{t}_r1"), F.col(f"{t}_r5"), F.col(f"{t}_q"),
                         F.col(f"{t}_p"))
    central = q * _horner(AS241_A, rc) / _horner(AS241_B, rc)
    tail = F.when(F.col(f"{t}_rt") <= 5.0, _horner(AS241_C, r1) / _horner(AS241_D, r1)) \
            .otherwise(_horner(AS241_E, r5) / _horner(AS241_F, r5))
    tail = F.when(q < 0, -tail).otherwise(tail)
    quant = (F.when((pp <= 0) | (pp >= 1) | F.isnan(pp), F.lit(None).cast("double"))
              .when(F.abs(q) <= 0.425, central).otherwise(tail))
    return df.withColumn(out, -quant).drop(*[f"{t}_{x}" for x in ("p", "q", "rc", "rt", "r1", "r5")])


def normal_lower_quantile_sql(p: str) -> str:
    q = f"({p} - 0.5)"
    rc = f"(0.180625 - {q} * {q})"
    central = f"({q} * {_horner_sql(AS241_A, rc)} / {_horner_sql(AS241_B, rc)})"
    rt = f"sqrt(-ln(least({p}, 1.0 - {p})))"
    rt1, rt5 = f"({rt} - 1.6)", f"({rt} - 5.0)"
    tail_c = f"({_horner_sql(AS241_C, rt1)} / {_horner_sql(AS241_D, rt1)})"
    tail_e = f"({_horner_sql(AS241_E, rt5)} / {_horner_sql(AS241_F, rt5)})"
    tail = f"(CASE WHEN {rt} <= 5.0 THEN {tail_c} ELSE {tail_e} END)"
    tail = f"(CASE WHEN {q} < 0 THEN -{tail} ELSE {tail} END)"
    return (f"(CASE WHEN {p} <= 0 OR {p} >= 1 OR isnan({p}) THEN CAST(NULL AS DOUBLE) "
            f"WHEN abs({q}) <= 0.425 THEN {central} ELSE {tail} END)")


def z_from_pval_sql(p: str) -> str:
    return f"(-{normal_lower_quantile_sql(f'({p} / 2.0)')})"


def eaf_to_maf(eaf: Column) -> Column:
    """MAF = eaf if eaf <= 0.5 else 1 - eaf (NaN/NULL pass through)."""
    return F.when(eaf <= 0.5, eaf).otherwise(F.lit(1.0) - eaf)


def eaf_to_maf_sql(eaf: str) -> str:
    return f"(CASE WHEN {eaf} <= 0.5 THEN {eaf} ELSE 1.0 - {eaf} END)"


def with_log_abf(df: DataFrame, z: str, maf: str, n: str, is_cc: str, s: str, out: str) -> DataFrame:
    """Add ``out``: Wakefield approximate log Bayes factor for one variant.

    V = 1 / (2 N f (1-f) [s (1-s)]), W = prior sd^2, r = W / (W + V),
    lABF = (ln(1 - r) + r z^2) / 2.
    """
    t = f"__{out}"
    base = F.lit(2.0) * F.col(n) * F.col(maf) * (F.lit(1.0) - F.col(maf))
    cc = F.col(is_cc)
    df = df.withColumn(f"{t}_v", F.when(cc, F.try_divide(F.lit(1.0), base * F.col(s) * (F.lit(1.0) - F.col(s))))
                       .otherwise(F.try_divide(F.lit(1.0), base)))
    w = F.when(cc, F.lit(PRIOR_SD_CC ** 2)).otherwise(F.lit(PRIOR_SD_QUANT ** 2))
    df = df.withColumn(f"{t}_w", w)
    df = df.withColumn(f"{t}_r", F.col(f"{t}_w") / (F.col(f"{t}_w") + F.col(f"{t}_v")))
    r = F.col(f"{t}_r")
    return (df.withColumn(out, F.lit(0.5) * (F.log(F.lit(1.0) - r) + r * F.col(z) * F.col(z)))
              .drop(f"{t}_v", f"{t}_w", f"{t}_r"))


def log_abf_sql(z: str, maf: str, n: str, is_cc: str, s: str) -> str:
    base = f"(2.0 * {n} * {maf} * (1.0 - {maf}))"
    v = f"(CASE WHEN {is_cc} THEN 1.0 / ({base} * {s} * (1.0 - {s})) ELSE 1.0 / {base} END)"
    w = f"(CASE WHEN {is_cc} THEN {PRIOR_SD_CC ** 2!r} ELSE {PRIOR_SD_QUANT ** 2!r} END)"
    r = f"({w} / ({w} + {v}))"
    return f"(0.5 * (ln(1.0 - {r}) + {r} * {z} * {z}))"


NEG_INF = float("-inf")


def with_log_diff(df: DataFrame, x: str, y: str, out: str) -> DataFrame:
    """Add ``out`` = ln(exp(x) - exp(y)) with a max shift; -Infinity when the
    difference is <= 0 (Spark's ln(0) would be NULL)."""
    t = f"__{out}"
    df = df.withColumn(f"{t}_m", F.greatest(F.col(x), F.col(y)))
    df = df.withColumn(f"{t}_d", F.exp(F.col(x) - F.col(f"{t}_m")) - F.exp(F.col(y) - F.col(f"{t}_m")))
    return (df.withColumn(out, F.when(F.col(f"{t}_d") > 0, F.col(f"{t}_m") + F.log(F.col(f"{t}_d")))
                          .otherwise(F.lit(NEG_INF)))
              .drop(f"{t}_m", f"{t}_d"))


def log_diff_sql(x: str, y: str) -> str:
    m = f"greatest({x}, {y})"
    d = f"(exp({x} - {m}) - exp({y} - {m}))"
    return f"(CASE WHEN {d} > 0 THEN {m} + ln({d}) ELSE CAST('-Infinity' AS DOUBLE) END)"


def with_log_sum_exp(df: DataFrame, cols, out: str) -> DataFrame:
    """Add ``out`` = ln(sum(exp(c))) over a fixed list of columns (row-wise)."""
    t = f"__{out}_m"
    df = df.withColumn(t, F.greatest(*[F.col(c) for c in cols]))
    total = None
    for c in cols:
        e = F.exp(F.col(c) - F.col(t))
        total = e if total is None else total + e
    return df.withColumn(out, F.col(t) + F.log(total)).drop(t)


def log_sum_exp_sql(*xs: str) -> str:
    m = f"greatest({', '.join(xs)})"
    total = " + ".join(f"exp({x} - {m})" for x in xs)
    return f"({m} + ln({total}))"

"""P-values as Catalyst expressions: log-gamma, log-beta, regularised
incomplete beta.

Spark SQL has no beta or gamma function and a Python UDF would leave the
JVM, so the continued fraction for the incomplete beta (modified Lentz
method) is written with the higher-order ``aggregate`` function over a fixed
sequence of term indices.  Where both parameters are large and the statistic
lies near the middle, the density is integrated instead.  Either runs once
per *result* row (a test statistic), never per input row.

All tests in ``operators.stats`` reduce to one shape: with a ratio r >= 0,

    p = I_x(a, b),  x = 1 / (1 + r),  1 - x = r / (1 + r)

* F test with (d1, d2) degrees of freedom: a = d2/2, b = d1/2, r = d1 F / d2
* two-sided t test with df: a = df/2, b = 1/2, r = t^2 / df

so ``p_from_ratio`` takes r and forms log x and log(1 - x) with ``log1p``,
which keeps the prefactor accurate when the degrees of freedom are huge.
A fraction that does not end gives NULL, never an unfinished number.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most steps of the continued fraction; each is a few multiplications and
# converged steps leave the accumulator unchanged.  A fraction that does not
# end within CF_TERMS gives NULL.
CF_TERMS = 1000
# Near the peak of large parameters the fraction converges slowly (with the
# inverse square of the distance in widths), and the density there is smooth.
LARGE = 1e5
NEAR_PEAK = 6.0
PEAK_REACH = 12.0
SIMPSON_STEPS = 4000
_TINY = 1e-300
_EPS = 1e-15
_LN_SQRT_2PI = 0.5 * math.log(2 * math.pi)
_SHIFT = 8


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def _stirling_tail(w: Column) -> Column:
    """Asymptotic series of log-gamma beyond the Stirling terms (w >= 8)."""
    w2 = w * w
    return (1 / (12 * w) - 1 / (360 * w * w2) + 1 / (1260 * w * w2 * w2)
            - 1 / (1680 * w * w2 * w2 * w2) + 1 / (1188 * w * w2 * w2 * w2 * w2))


def log_gamma(z: Column) -> Column:
    """ln Gamma(z) for z > 0: Stirling series after shifting z up by 8."""
    w = z + _SHIFT
    shift = sum((F.log(z + i) for i in range(1, _SHIFT)), F.log(z))
    return (w - 0.5) * F.log(w) - w + _LN_SQRT_2PI + _stirling_tail(w) - shift


def _log_gamma_drop(big: Column, s: Column) -> Column:
    """ln Gamma(big) - ln Gamma(big + s) without cancelling large terms."""
    stirling = (-(big - 0.5) * F.log1p(s / big) - s * F.log(big + s) + s
                + _stirling_tail(big) - _stirling_tail(big + s))
    return F.when(big >= _SHIFT, stirling).otherwise(log_gamma(big) - log_gamma(big + s))


def log_beta(a: Column, b: Column) -> Column:
    """ln B(a, b) = ln Gamma(a) + ln Gamma(b) - ln Gamma(a + b)."""
    big, small = F.greatest(a, b), F.least(a, b)
    return log_gamma(small) + _log_gamma_drop(big, small)


def _fix(v: Column) -> Column:
    return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)


def _continued_fraction(a: Column, b: Column, x: Column, y: Column, ahead: Column, terms: int) -> Column:
    """Front factor over I_x(a, b): the contracted continued fraction by Lentz's method.

    ``y`` is 1 - x and ``ahead`` is a - (a + b) x, both given by the caller: formed
    from x here they would lose their digits when x is near 1.  The state
    carries the parameters so that the lambda body only reads struct fields,
    and it keeps the running product ``h`` *without* the latest factor
    ``d * c``; the factor is folded in at the next step, so no sub-expression
    is repeated.
    """
    first = a / (a + 1) * (ahead + 1)
    init = F.struct(_fix(first).alias("c"), F.lit(0.0).alias("d"), first.alias("h"), a.alias("a"),
                    b.alias("b"), x.alias("x"), y.alias("y"), ahead.alias("ahead"), F.lit(False).alias("done"))

    def step(acc: Column, k: Column) -> Column:
        a_, b_, x_, n = acc["a"], acc["b"], acc["x"], k.cast("double")
        odd = a_ + 2 * n - 1
        weight = n * (b_ - n) * x_ / odd
        over = (a_ + n - 1) * (a_ + b_ + n - 1) / odd * x_ * weight
        under = n + weight + (a_ + n) / (odd + 2) * (acc["ahead"] + 1 + n * (1 + acc["y"]))
        factor = F.when(k == 1, 1.0).otherwise(acc["d"] * acc["c"])
        frozen = acc["done"]
        return F.struct(
            F.when(frozen, acc["c"]).otherwise(_fix(under + over / acc["c"])).alias("c"),
            F.when(frozen, acc["d"]).otherwise(1 / _fix(under + over * acc["d"])).alias("d"),
            (acc["h"] * F.when(frozen, F.lit(1.0)).otherwise(factor)).alias("h"),
            a_.alias("a"), b_.alias("b"), x_.alias("x"), acc["y"].alias("y"), acc["ahead"].alias("ahead"),
            (frozen | ((k > 1) & (F.abs(factor - 1) < _EPS))).alias("done"))

    def finish(acc: Column) -> Column:
        # An unfinished fraction is no number: NULL, which stays NULL in the result.
        return F.when(acc["done"], acc["h"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(terms)), init, step, finish)


def _density_sum(a: Column, b: Column, low: Column, high: Column) -> Column:
    """Simpson sum of the density of log-odds, relative to its peak, between two distances from the
    peak in units of the peak's width."""
    n = a + b
    init = F.struct(F.lit(0.0).alias("sum"), a.alias("a"), n.alias("n"), F.sqrt(n / a / b).alias("width"),
                    low.alias("low"), ((high - low) / SIMPSON_STEPS).alias("h"))

    def step(acc: Column, k: Column) -> Column:
        d = acc["width"] * (acc["low"] + k * acc["h"])
        height = F.exp(acc["a"] * d - acc["n"] * F.log1p(acc["a"] / acc["n"] * F.expm1(d)))
        share = F.when((k == 0) | (k == SIMPSON_STEPS), 1.0).when(k % 2 == 1, 4.0).otherwise(2.0)
        return acc.withField("sum", acc["sum"] + share * height)

    return F.aggregate(F.sequence(F.lit(0), F.lit(SIMPSON_STEPS)), init, step, lambda acc: acc["sum"] * acc["h"])


def _integral(a: Column, b: Column, cut: Column) -> Column:
    """I_x(a, b) for large a and b by integrating the density; ``cut``: widths from the peak to x."""
    low, high = F.lit(-PEAK_REACH), F.lit(PEAK_REACH)
    left, right = _density_sum(a, b, low, cut), _density_sum(a, b, cut, high)
    return F.transform(F.array(F.struct(left.alias("left"), right.alias("right"))),
                       lambda s: s["left"] / (s["left"] + s["right"]))[0]


def p_from_ratio(a, b, r, terms: int = CF_TERMS) -> Column:
    """I_x(a, b) with x = 1 / (1 + r); NULL if any input is NULL or a, b <= 0."""
    a, b, r = _lit(a).cast("double"), _lit(b).cast("double"), _lit(r).cast("double")
    front = F.exp(-a * F.log1p(r) - b * F.log1p(1 / F.nullif(r, F.lit(0.0))) - log_beta(a, b))
    return _chosen(a, b, r, front, terms)


def _chosen(a: Column, b: Column, r: Column, front: Column, terms: int) -> Column:
    # Only one branch is evaluated for a row: the integral near the peak of large parameters,
    # else the fraction on the side where it converges fast.
    x, y = 1 / (1 + r), r / (1 + r)
    ahead = F.when(y < x, (a + b) * y - b).otherwise(a - (a + b) * x)
    cut = -F.log(r * a / b) / F.sqrt((a + b) / a / b)
    p = F.when((F.least(a, b) > LARGE) & (F.abs(cut) < NEAR_PEAK), _integral(a, b, cut)) \
         .when(x < (a + 1) / (a + b + 2), front / _continued_fraction(a, b, x, y, ahead, terms)) \
         .otherwise(1 - front / _continued_fraction(b, a, y, x, -ahead, terms))
    # Bound as a lambda variable: the large expression is there once, and NULL stays NULL.
    clamped = F.transform(F.array(p), lambda v: F.when(v < 0, 0.0).when(v > 1, 1.0).otherwise(v))[0]
    return (F.when(a.isNull() | b.isNull() | r.isNull() | (a <= 0) | (b <= 0) | (r < 0),
                   F.lit(None).cast("double"))
             .when(r == 0, F.lit(1.0))
             .when(r == float("inf"), F.lit(0.0))
             .otherwise(clamped))


def with_p_value(df: DataFrame, a, b, r, out: str = "p_value",
                 terms: int = CF_TERMS) -> DataFrame:
    """``df`` plus ``out`` = I_x(a, b), x = 1 / (1 + r), in staged projections.

    Same value as ``p_from_ratio``; each stage refers to the previous one's
    columns, so the expression Catalyst analyses stays small (the staged
    columns are not inlined again: they feed a higher-order function).
    """
    stage1, stage2 = _staged_p_columns(df.sparkSession.sparkContext.applicationId, terms)
    staged = df.withColumns({"_pa": _lit(a).cast("double"), "_pb": _lit(b).cast("double"),
                             "_pr": _lit(r).cast("double")})
    staged = staged.withColumns(stage1)
    keep = [F.col(c) for c in df.columns]
    return staged.select(*keep, stage2.alias(out))


@functools.lru_cache(maxsize=8)
def _staged_p_columns(app_id: str, terms: int) -> tuple[dict[str, Column], Column]:
    """The p-value expressions over the staged columns ``_pa, _pb, _pr``.

    Building them issues about a thousand JVM calls, so they are built once
    per application and reused (a Column is a plan-independent expression).
    """
    del app_id  # part of the cache key only
    pa, pb, pr = F.col("_pa"), F.col("_pb"), F.col("_pr")
    stage1 = {"_pfront": F.exp(-pa * F.log1p(pr) - pb * F.log1p(1 / F.nullif(pr, F.lit(0.0))) - log_beta(pa, pb))}
    return stage1, _chosen(pa, pb, pr, F.col("_pfront"), terms)


def with_f_test_p(df: DataFrame, f_stat: str, df1: str, df2: str,
                  out: str = "p_value") -> DataFrame:
    """Upper tail of the F distribution for columns f_stat, df1, df2."""
    d1, d2 = F.col(df1).cast("double"), F.col(df2).cast("double")
    return with_p_value(df, d2 / 2, d1 / 2, F.col(f_stat) * d1 / d2, out)


def with_t_test_p(df: DataFrame, t2_over_df: Column, dfree: Column,
                  out: str = "p_value") -> DataFrame:
    """Two-sided Student t tail, given t^2 / df and df."""
    return with_p_value(df, dfree.cast("double") / 2, F.lit(0.5), t2_over_df, out)


def f_test_p(f_stat, df1, df2) -> Column:
    """Upper tail of the F distribution."""
    df1, df2 = _lit(df1).cast("double"), _lit(df2).cast("double")
    return p_from_ratio(df2 / 2, df1 / 2, _lit(f_stat) * df1 / df2)


def t_test_p(t_stat, df) -> Column:
    """Two-sided tail of Student's t distribution."""
    df = _lit(df).cast("double")
    t = _lit(t_stat)
    return p_from_ratio(df / 2, F.lit(0.5), t * t / df)

"""DuckDB twins of the significance tests and the forecast.

The p-value is the same regularised incomplete beta, written as a DuckDB
``list_reduce`` continued fraction with a Stirling log-gamma.  Both engines
round the reported statistics (F and t to 6 places, p to 9, shares to 10).
"""

from __future__ import annotations

import math

from tillroll.oracle.sql import rdiv, with_base

TERMS = 1000
_LN_SQRT_2PI = repr(0.5 * math.log(2 * math.pi))


def _log1p(v: str) -> str:
    return f"(CASE WHEN 1 + ({v}) = 1 THEN ({v}) ELSE ln(1 + ({v})) * ({v}) / ((1 + ({v})) - 1) END)"


def _tail(w: str) -> str:
    return (f"(1 / (12 * {w}) - 1 / (360 * {w}^3) + 1 / (1260 * {w}^5) - 1 / (1680 * {w}^7) "
            f"+ 1 / (1188 * {w}^9))")


def _lgamma(z: str) -> str:
    w = f"(({z}) + 8)"
    shift = " + ".join(f"ln(({z}) + {i})" for i in range(8))
    return f"((({w}) - 0.5) * ln({w}) - {w} + {_LN_SQRT_2PI} + {_tail(w)} - ({shift}))"


def _log_beta(a: str, b: str) -> str:
    big, small = f"greatest({a}, {b})", f"least({a}, {b})"
    drop = (f"(CASE WHEN {big} >= 8 THEN -({big} - 0.5) * {_log1p(f'{small} / {big}')} "
            f"- {small} * ln({big} + {small}) + {small} + {_tail(big)} - {_tail(f'({big} + {small})')} "
            f"ELSE {_lgamma(big)} - {_lgamma(f'({big} + {small})')} END)")
    return f"({_lgamma(small)} + {drop})"


def _fix(v: str) -> str:
    return f"(CASE WHEN abs({v}) < 1e-300 THEN 1e-300 ELSE {v} END)"


def _cf(a: str, b: str, x: str) -> str:
    d0 = f"(1 / {_fix(f'(1 - ({a} + {b}) * {x} / ({a} + 1))')})"
    init = (f"{{'c': 1.0::DOUBLE, 'd': {d0}::DOUBLE, 'h': 1.0::DOUBLE, 'a': ({a})::DOUBLE, "
            f"'b': ({b})::DOUBLE, 'x': ({x})::DOUBLE, 'done': false}}")
    m = "ceil(k / 2)::DOUBLE"
    coef = (f"(CASE WHEN k % 2 = 1 THEN {m} * (s.b - {m}) * s.x / ((s.a - 1 + 2 * {m}) * (s.a + 2 * {m})) "
            f"ELSE -(s.a + {m}) * (s.a + s.b + {m}) * s.x / ((s.a + 2 * {m}) * (s.a + 1 + 2 * {m})) END)")
    step = (f"{{'c': CASE WHEN s.done THEN s.c ELSE {_fix(f'(1 + {coef} / s.c)')} END, "
            f"'d': CASE WHEN s.done THEN s.d ELSE 1 / {_fix(f'(1 + {coef} * s.d)')} END, "
            f"'h': s.h * CASE WHEN s.done THEN 1.0 ELSE s.d * s.c END, "
            f"'a': s.a, 'b': s.b, 'x': s.x, "
            f"'done': s.done OR (k % 2 = 1 AND k > 1 AND abs(s.d * s.c - 1) < 1e-16)}}")
    red = f"list_reduce(range(1, {2 * TERMS + 1}), lambda s, k: {step}, {init})"
    return f"(CASE WHEN ({red}).done THEN ({red}).h END)"


def p_from_ratio(a: str, b: str, r: str) -> str:
    """I_x(a, b) with x = 1/(1+r); a, b, r must be plain column names."""
    ln1p = _log1p(r)
    x, y = f"(1 / (1 + {r}))", f"({r} / (1 + {r}))"
    front = f"exp({a} * (-{ln1p}) + {b} * (ln({r}) - {ln1p}) - {_log_beta(a, b)})"
    direct = f"({front} * {_cf(a, b, x)} / {a})"
    mirrored = f"(1 - {front} * {_cf(b, a, y)} / {b})"
    return (f"(CASE WHEN {a} IS NULL OR {b} IS NULL OR {r} IS NULL OR {a} <= 0 OR {b} <= 0 "
            f"OR {r} < 0 THEN NULL WHEN {r} = 0 THEN 1.0 WHEN isinf({r}) THEN 0.0 "
            f"WHEN {x} < ({a} + 1) / ({a} + {b} + 2) THEN greatest(least({direct}, 1.0), 0.0) "
            f"ELSE greatest(least({mirrored}, 1.0), 0.0) END)")


def _nlog(p: str) -> str:
    return f"round(CASE WHEN {p} > 0 THEN -log10({p}) WHEN {p} = 0 THEN 'inf'::DOUBLE END, 4)"


def _verdict(p: str) -> str:
    return f"CASE WHEN {p} < 0.05 THEN 'SIGNIFICANT' ELSE 'NOT significant' END"


def _effect(e: str) -> str:
    return (f"CASE WHEN {e} IS NULL THEN NULL WHEN {e} < 0.01 THEN 'negligible' "
            f"WHEN {e} < 0.06 THEN 'small' WHEN {e} < 0.14 THEN 'medium' ELSE 'large' END")


def _anova_ctes(prefix: str, factor: str, src: str) -> list[str]:
    return [
        f"""{prefix}g AS (SELECT {factor} AS lvl, COUNT(v) AS n, AVG(v) AS mean, VAR_POP(v) AS vp
  FROM (SELECT {factor}, CAST(revenue AS DOUBLE) AS v FROM {src})
  WHERE {factor} IS NOT NULL AND v IS NOT NULL GROUP BY {factor})""",
        f"""{prefix}s AS (SELECT COUNT(*) AS groups, SUM(n) AS n,
         SUM(n * (mean - (SELECT SUM(n * mean) / SUM(n) FROM {prefix}g))
               * (mean - (SELECT SUM(n * mean) / SUM(n) FROM {prefix}g))) AS ssb,
         SUM(n * vp) AS ssw FROM {prefix}g)""",
        f"""{prefix}f AS (SELECT groups, n, groups - 1 AS df_between, n - groups AS df_within, ssb, ssw,
         CASE WHEN groups < 2 OR n - groups <= 0 THEN NULL
              WHEN ssw = 0 THEN CASE WHEN ssb = 0 THEN NULL ELSE 'inf'::DOUBLE END
              ELSE (ssb / (groups - 1)) / (ssw / (n - groups)) END AS f_stat,
         CASE WHEN groups < 2 OR ssb + ssw = 0 THEN NULL ELSE ssb / (ssb + ssw) END AS eta_squared,
         (n - groups) / 2.0 AS pa, (groups - 1) / 2.0 AS pb,
         CASE WHEN groups < 2 OR n - groups <= 0 OR ssw = 0 AND ssb = 0 THEN NULL
              WHEN ssw = 0 THEN 'inf'::DOUBLE
              ELSE (groups - 1) * ((ssb / (groups - 1)) / (ssw / (n - groups))) / (n - groups) END AS pr
  FROM {prefix}s)""",
        f"""{prefix}p AS (SELECT *, {p_from_ratio('pa', 'pb', 'pr')} AS p_value FROM {prefix}f)""",
    ]


_FACTORS = {
    "anova_region": ("region", "(SELECT * FROM kept WHERE region <> 'Unknown Region')"),
    "anova_salesperson": ("salesperson", "kept"),
    "anova_discount": ("discount_pct", "kept"),
}


def _anova_select(prefix: str, label: str | None = None) -> str:
    lead = f"'{label}' AS factor, " if label else ""
    return (f"SELECT {lead}groups, CAST(n AS BIGINT) AS n, df_between, "
            f"CAST(df_within AS BIGINT) AS df_within, round(f_stat, 6) AS f_stat, "
            f"round(p_value, 9) AS p_value, {_nlog('p_value')} AS neg_log10_p, "
            f"round(eta_squared, 10) AS eta_squared, "
            f"{_effect('eta_squared')} AS effect, {_verdict('p_value')} AS verdict FROM {prefix}p")


CORR = """
cr AS (SELECT COUNT(*) AS n, CORR(CAST(discount_pct AS DOUBLE), CAST(quantity AS DOUBLE)) AS r
       FROM kept WHERE discount_pct IS NOT NULL AND quantity IS NOT NULL),
cp AS (SELECT n, r, r * r AS r_squared, (n - 2) / 2.0 AS pa, 0.5 AS pb,
              CASE WHEN abs(r) >= 1 THEN 'inf'::DOUBLE ELSE r * r / (1 - r * r) END AS pr FROM cr),
cq AS (SELECT *, CASE WHEN n - 2 <= 0 THEN NULL ELSE """ + p_from_ratio("pa", "pb", "pr") + """ END
              AS p_value FROM cp)"""

WELCH = """
wm AS (SELECT COUNT(v) FILTER (WHERE return_flag = 'Yes') AS n1, AVG(v) FILTER (WHERE return_flag = 'Yes') AS m1,
              VAR_SAMP(v) FILTER (WHERE return_flag = 'Yes') AS v1,
              COUNT(v) FILTER (WHERE return_flag = 'No') AS n2, AVG(v) FILTER (WHERE return_flag = 'No') AS m2,
              VAR_SAMP(v) FILTER (WHERE return_flag = 'No') AS v2
       FROM (SELECT return_flag, CAST(revenue AS DOUBLE) AS v FROM dedup)),
wt AS (SELECT n1, n2, m1, m2, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t_stat,
              (v1 / n1 + v2 / n2) * (v1 / n1 + v2 / n2)
                / ((v1 / n1) * (v1 / n1) / (n1 - 1) + (v2 / n2) * (v2 / n2) / (n2 - 1)) AS df FROM wm),
wp AS (SELECT *, df / 2.0 AS pa, 0.5 AS pb, t_stat * t_stat / df AS pr FROM wt),
wq AS (SELECT *, """ + p_from_ratio("pa", "pb", "pr") + """ AS p_value FROM wp)"""

TREND = """
dy AS (SELECT order_date, CAST(SUM(revenue) AS DOUBLE) AS y,
              CAST(ROW_NUMBER() OVER (ORDER BY order_date) - 1 AS DOUBLE) AS x
       FROM kept WHERE order_date IS NOT NULL GROUP BY order_date),
tr AS (SELECT COUNT(*) AS days, REGR_SLOPE(y, x) AS slope, REGR_INTERCEPT(y, x) AS intercept,
              CORR(x, y) AS r, REGR_SXX(y, x) AS sxx, REGR_SYY(y, x) AS syy FROM dy),
tp AS (SELECT *, r * r AS r_squared, (days - 2) / 2.0 AS pa, 0.5 AS pb,
              CASE WHEN abs(r) >= 1 THEN 'inf'::DOUBLE ELSE r * r / (1 - r * r) END AS pr,
              CASE WHEN days - 2 > 0 THEN sqrt((1 - r * r) * syy / sxx / (days - 2)) END AS stderr FROM tr),
tq AS (SELECT *, CASE WHEN days - 2 <= 0 THEN NULL ELSE """ + p_from_ratio("pa", "pb", "pr") + """ END
              AS p_value FROM tp)"""

SQL: dict[str, tuple[str, ...]] = {}
for _key, (_factor, _src) in _FACTORS.items():
    SQL[_key] = (_anova_select("av_"), *_anova_ctes("av_", _factor, _src))

SQL["corr_discount_quantity"] = ("""
SELECT n, round(r, 10) AS r, round(r_squared, 10) AS r_squared, round(p_value, 9) AS p_value,
       """ + _nlog("p_value") + """ AS neg_log10_p, """
                                 + _verdict("p_value") + " AS verdict FROM cq", CORR)
SQL["ttest_returns"] = ("""
SELECT n1, n2, round(m1, 6) AS mean_first, round(m2, 6) AS mean_second, round(t_stat, 6) AS t_stat,
       round(df, 4) AS df, round(p_value, 9) AS p_value, """ + _nlog("p_value") + """ AS neg_log10_p,
       """ + _verdict("p_value") + """ AS verdict
FROM wq""", WELCH)
SQL["linear_trend"] = ("""
SELECT days, round(slope, 6) AS slope, round(intercept, 4) AS intercept,
       round(r_squared, 10) AS r_squared, round(p_value, 9) AS p_value,
       """ + _nlog("p_value") + """ AS neg_log10_p, round(stderr, 6) AS stderr,
       r_squared < 0.3 AS low_r_squared
FROM tq""", TREND)
SQL["forecast_next_day"] = (f"""
SELECT MAX(order_date) AS last_date, MAX(order_date) + 1 AS next_date,
       dayname(MAX(order_date) + 1) AS weekday, COUNT(*) AS days,
       (SELECT {rdiv('SUM(r)', 'COUNT(*)', 2, 4, 0)} FROM
          (SELECT SUM(revenue) AS r FROM kept WHERE order_date IS NOT NULL
           GROUP BY order_date ORDER BY order_date DESC LIMIT 3)) AS moving_average,
       round(STDDEV_SAMP(y), 4) AS daily_std
FROM (SELECT order_date, CAST(SUM(revenue) AS DOUBLE) AS y FROM kept
      WHERE order_date IS NOT NULL GROUP BY order_date)""",)

_ALL_ANOVA = [c for key, (f, src) in _FACTORS.items() for c in _anova_ctes(key[6:9], f, src)]
SQL["eta_squared"] = ("\nUNION ALL ".join(
    f"SELECT '{f}' AS factor, round(eta_squared, 10) AS eta_squared, "
    f"{_effect('eta_squared')} AS effect FROM {key[6:9]}p"
    for key, (f, _src) in _FACTORS.items()), *_ALL_ANOVA)
SQL["stat_verdicts"] = ("""
SELECT 1 AS position, 'anova_region' AS test, round(f_stat, 6) AS statistic, round(p_value, 9) AS p_value,
       """ + _verdict("p_value") + """ AS verdict FROM regp
UNION ALL SELECT 2, 'anova_salesperson', round(f_stat, 6), round(p_value, 9), """ + _verdict("p_value") + """ FROM salp
UNION ALL SELECT 3, 'corr_discount_quantity', round(r, 10), round(p_value, 9), """ + _verdict("p_value") + """ FROM cq
UNION ALL SELECT 4, 'anova_discount', round(f_stat, 6), round(p_value, 9), """ + _verdict("p_value") + """ FROM disp
UNION ALL SELECT 5, 'ttest_returns', round(t_stat, 6), round(p_value, 9), """ + _verdict("p_value") + """ FROM wq""",
                        *_ALL_ANOVA, CORR, WELCH)

ORACLE = {k: with_base(v[0], *v[1:]) for k, v in SQL.items()}

"""Significance tests and a naive forecast from distributed aggregates.

No group of values is ever collected: each test reduces the rows to
per-group moments (count, mean, population variance) with one hash
aggregation, combines those group rows with a second aggregation into a
single row, and evaluates the test statistic and its p-value
(``functions.betainc``) on that row.

* one-way ANOVA: SSB = sum n (mean - grand)^2, SSW = sum n var_pop,
  F = (SSB/(k-1)) / (SSW/(N-k)), eta^2 = SSB / (SSB + SSW);
* Pearson correlation: ``corr`` with a t test on n - 2 df;
* Welch's t test: per-group count, mean and sample variance, with the
  Welch-Satterthwaite degrees of freedom;
* linear trend: ordinary least squares of daily revenue on the day's
  ordinal (0, 1, ...; gaps in the calendar do not count) with ``regr_*``;
* forecast: mean of the last three days and the sample deviation of all days.

Edge cases: fewer than two groups gives NULL; zero within-group variance
gives F = +infinity and p = 0 (NULL if the groups do not differ either).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.betainc import with_f_test_p, with_t_test_p
from tillroll.functions.money import ratio
from tillroll.operators.clean import drop_unknown_region
from tillroll.plans.ordering import grouped_totals, with_sequence
from tillroll.schema import (EFFECT_LABELS, ETA_BANDS, KEPT_FLAG, LOW_R2, NOT_SIGNIFICANT,
                             RETURN_FLAG, SIGNIFICANCE_ALPHA, SIGNIFICANT, UNKNOWN_REGION)


def _null() -> Column:
    return F.lit(None).cast("double")


def effect_label(eta2: Column) -> Column:
    """Rough bands for eta squared."""
    out = F.when(eta2.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(ETA_BANDS, EFFECT_LABELS):
        out = out.when(eta2 < bound, label)
    return out.otherwise(EFFECT_LABELS[-1])


def verdict(p: Column, alpha: float = SIGNIFICANCE_ALPHA) -> Column:
    """Strictly below alpha is significant (NULL p is not)."""
    return F.when(p < alpha, SIGNIFICANT).otherwise(NOT_SIGNIFICANT)


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, n, mean, var_pop) per non-null level (pandas drops NULL keys)."""
    v = F.col(value).cast("double")
    return (df.filter(F.col(group).isNotNull() & v.isNotNull())
              .groupBy(group)
              .agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("vp")))


def anova_oneway(df: DataFrame, group: str, value: str = "revenue") -> DataFrame:
    """One row: groups, n, df_between, df_within, ssb, ssw, f_stat, p_value,
    eta_squared, effect, verdict."""
    g = group_moments(df, group, value)
    g = g.withColumn("nm", F.col("n") * F.col("mean"))
    sums = grouped_totals(g, "n", "nm")
    dev = g.select("n", "vp", (F.col("mean") - sums["nm"] / sums["n"]).alias("dev"))
    one = dev.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"),
                  F.sum(F.col("n") * F.col("dev") * F.col("dev")).alias("ssb"),
                  F.sum(F.col("n") * F.col("vp")).alias("ssw"))
    return _anova_tail(one, [])


def anova_factors(df: DataFrame, factors: dict[str, Column],
                  value: str = "revenue") -> DataFrame:
    """One-way ANOVA of ``value`` for several factors in one pass.

    ``factors`` maps a factor name to its level expression (NULL levels are
    left out, so a factor can exclude rows, e.g. an unknown bucket).  Each
    row is expanded into one (factor, level) pair per factor, the moments of
    every level come from ONE aggregation, and the per-factor grand means
    (one row per factor, a fixed, small table) are broadcast back.  Output:
    one row per factor with the columns of ``anova_oneway``.
    """
    v = F.col(value).cast("double")
    pairs = F.array(*[F.struct(F.lit(name).alias("factor"),
                               level.cast("string").alias("level"))
                      for name, level in factors.items()])
    tagged = (df.select(v.alias("_v"), F.explode(pairs).alias("_f"))
                .filter(F.col("_f.level").isNotNull() & F.col("_v").isNotNull())
                .select(F.col("_f.factor").alias("factor"), F.col("_f.level").alias("level"), "_v"))
    g = tagged.groupBy("factor", "level").agg(
        F.count("_v").alias("n"), F.avg("_v").alias("mean"), F.var_pop("_v").alias("vp"))
    return anova_of_levels(g)


def anova_of_levels(g: DataFrame) -> DataFrame:
    """One row per factor from the moments (factor, level, n, mean, vp) of its levels."""
    g.persist(StorageLevel.MEMORY_AND_DISK)      # one row per level, read by both branches
    grand = g.groupBy("factor").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_grand"))
    dev = (g.join(F.broadcast(grand), "factor")
            .select("factor", "n", "vp", (F.col("mean") - F.col("_grand")).alias("dev")))
    one = dev.groupBy("factor").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("dev") * F.col("dev")).alias("ssb"),
        F.sum(F.col("n") * F.col("vp")).alias("ssw"))
    return _anova_tail(one, ["factor"])


def _anova_tail(one: DataFrame, keys: list[str]) -> DataFrame:
    """F, eta squared, p-value and labels from (groups, n, ssb, ssw)."""
    df1 = F.col("groups") - 1
    df2 = F.col("n") - F.col("groups")
    f = (F.when((F.col("groups") < 2) | (df2 <= 0), _null())
          .when(F.col("ssw") == 0,
                F.when(F.col("ssb") == 0, _null()).otherwise(F.lit(float("inf"))))
          .otherwise((F.col("ssb") / df1) / (F.col("ssw") / df2)))
    stats = one.select(
        *keys, "groups", "n", df1.alias("df_between"), df2.alias("df_within"), "ssb", "ssw",
        f.alias("f_stat"),
        F.when(F.col("groups") < 2, _null())
         .otherwise(F.try_divide(F.col("ssb"), F.col("ssb") + F.col("ssw"))).alias("eta_squared"))
    with_p = with_f_test_p(stats, "f_stat", "df_between", "df_within")
    return with_p.withColumns({"effect": effect_label(F.col("eta_squared")),
                               "verdict": verdict(F.col("p_value"))})


def standard_factors() -> dict[str, Column]:
    """The three factors of the original tests: region (known regions only),
    salesperson and discount tier."""
    return {"region": F.when(F.col("region") != UNKNOWN_REGION, F.col("region")),
            "salesperson": F.col("salesperson"),
            "discount_pct": F.col("discount_pct")}


def anova_region(kept: DataFrame) -> DataFrame:
    return anova_oneway(drop_unknown_region(kept), "region")


def anova_salesperson(kept: DataFrame) -> DataFrame:
    return anova_oneway(kept, "salesperson")


def anova_discount(kept: DataFrame) -> DataFrame:
    return anova_oneway(kept, "discount_pct")


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, r, r_squared, t-test p_value (n - 2 df), verdict."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return correlation_test(pairs.agg(F.count(F.lit(1)).alias("n"),
                                      F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r")))


def correlation_test(one: DataFrame) -> DataFrame:
    """n, r, r_squared, p_value, verdict from (n, r)."""
    r = F.col("r")
    dfree = (F.col("n") - 2).cast("double")
    t_ratio = F.when(F.abs(r) >= 1, F.lit(float("inf"))).otherwise(r * r / (1 - r * r))
    stats = one.select("n", "r", (r * r).alias("r_squared"), dfree.alias("_df"),
                       t_ratio.alias("_t2"))
    with_p = with_t_test_p(stats, F.when(F.col("_df") > 0, F.col("_t2")), F.col("_df"))
    return with_p.select("n", "r", "r_squared", "p_value", verdict(F.col("p_value")).alias("verdict"))


def corr_discount_quantity(kept: DataFrame) -> DataFrame:
    return pearson(kept, "discount_pct", "quantity")


def welch_t(df: DataFrame, group: str, first, second, value: str = "revenue") -> DataFrame:
    """Welch's unequal-variance t test of ``value`` between two levels."""
    v = F.col(value).cast("double")
    a, b = F.col(group) == first, F.col(group) == second
    one = df.agg(F.count(F.when(a, v)).alias("n1"), F.avg(F.when(a, v)).alias("m1"),
                 F.var_samp(F.when(a, v)).alias("v1"),
                 F.count(F.when(b, v)).alias("n2"), F.avg(F.when(b, v)).alias("m2"),
                 F.var_samp(F.when(b, v)).alias("v2"))
    return welch_test(one)


def welch_test(one: DataFrame) -> DataFrame:
    """Welch's test from the moments (n1, m1, v1, n2, m2, v2) of two levels."""
    s1 = F.try_divide(F.col("v1"), F.col("n1"))
    s2 = F.try_divide(F.col("v2"), F.col("n2"))
    se2 = s1 + s2
    dfree = F.try_divide(se2 * se2, F.try_divide(s1 * s1, F.col("n1") - 1)
                         + F.try_divide(s2 * s2, F.col("n2") - 1))
    t = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(se2))
    stats = one.select("n1", "n2", F.col("m1").alias("mean_first"),
                       F.col("m2").alias("mean_second"), t.alias("t_stat"), dfree.alias("df"))
    t2 = F.try_divide(F.col("t_stat") * F.col("t_stat"), F.col("df"))
    return with_t_test_p(stats, t2, F.col("df")).withColumn("verdict", verdict(F.col("p_value")))


def ttest_returns(dedup: DataFrame) -> DataFrame:
    """Revenue of returned against kept orders (returned first)."""
    return welch_t(dedup, "return_flag", "Yes", "No")


def kept_corr_and_return_ttest(dedup: DataFrame) -> DataFrame:
    """``corr_discount_quantity`` (kept orders) and ``ttest_returns`` from ONE
    aggregation over the deduplicated rows: conditional aggregates replace
    the two separate scans.  Columns: n, r, corr_p, n1, n2, mean_first,
    mean_second, t_stat, df, t_p."""
    kept = F.col("return_flag") == KEPT_FLAG
    ret = F.col("return_flag") == RETURN_FLAG
    x, y = F.col("discount_pct").cast("double"), F.col("quantity").cast("double")
    v = F.col("revenue").cast("double")
    pair = kept & x.isNotNull() & y.isNotNull()
    one = dedup.agg(
        F.count_if(pair).alias("n"), F.corr(F.when(pair, x), F.when(pair, y)).alias("r"),
        F.count(F.when(ret, v)).alias("n1"), F.avg(F.when(ret, v)).alias("m1"),
        F.var_samp(F.when(ret, v)).alias("v1"),
        F.count(F.when(kept, v)).alias("n2"), F.avg(F.when(kept, v)).alias("m2"),
        F.var_samp(F.when(kept, v)).alias("v2"))
    r = F.col("r")
    cdf = (F.col("n") - 2).cast("double")
    s1 = F.try_divide(F.col("v1"), F.col("n1"))
    s2 = F.try_divide(F.col("v2"), F.col("n2"))
    se2 = s1 + s2
    tdf = F.try_divide(se2 * se2, F.try_divide(s1 * s1, F.col("n1") - 1)
                       + F.try_divide(s2 * s2, F.col("n2") - 1))
    t = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(se2))
    stats = one.select(
        "n", "r", cdf.alias("_cdf"),
        F.when(cdf > 0, F.when(F.abs(r) >= 1, F.lit(float("inf"))).otherwise(r * r / (1 - r * r)))
         .alias("_ct2"),
        "n1", "n2", F.col("m1").alias("mean_first"), F.col("m2").alias("mean_second"),
        t.alias("t_stat"), tdf.alias("df"))
    with_cp = with_t_test_p(stats, F.col("_ct2"), F.col("_cdf"), out="corr_p")
    t2 = F.try_divide(F.col("t_stat") * F.col("t_stat"), F.col("df"))
    return with_t_test_p(with_cp, t2, F.col("df"), out="t_p").drop("_cdf", "_ct2")


def daily_revenue(kept: DataFrame) -> DataFrame:
    """(order_date, exact revenue) per day."""
    return (kept.filter(F.col("order_date").isNotNull())
                .groupBy("order_date").agg(F.sum("revenue").alias("day_revenue")))


def linear_trend(kept: DataFrame) -> DataFrame:
    """OLS of daily revenue on the day ordinal: slope, intercept, R^2, p, stderr."""
    daily = daily_revenue(kept)
    return trend_of_days(with_sequence(daily, "order_date", "day_revenue", index="day_index"))


def trend_of_days(seq: DataFrame) -> DataFrame:
    """The trend of (day_index, day_revenue) rows."""
    x, y = F.col("day_index").cast("double"), F.col("day_revenue").cast("double")
    one = seq.agg(F.count(F.lit(1)).alias("days"), F.regr_slope(y, x).alias("slope"),
                  F.regr_intercept(y, x).alias("intercept"), F.corr(x, y).alias("r"),
                  F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"))
    r = F.col("r")
    dfree = (F.col("days") - 2).cast("double")
    stats = one.select(
        "days", "slope", "intercept", (r * r).alias("r_squared"), dfree.alias("_df"),
        F.when(F.abs(r) >= 1, F.lit(float("inf"))).otherwise(r * r / (1 - r * r)).alias("_t2"),
        F.when(dfree > 0, F.sqrt((1 - r * r) * F.col("syy") / F.col("sxx") / dfree))
         .alias("stderr"))
    with_p = with_t_test_p(stats, F.when(F.col("_df") > 0, F.col("_t2")), F.col("_df"))
    return with_p.select("days", "slope", "intercept", "r_squared", "p_value", "stderr",
                         (F.col("r_squared") < LOW_R2).alias("low_r_squared"))


def forecast_next_day(kept: DataFrame, trailing_days: int = 3) -> DataFrame:
    """Next calendar day after the last one, its weekday, the mean revenue of
    the last ``trailing_days`` days and the sample deviation of all days."""
    daily = daily_revenue(kept)
    tail = daily.orderBy(F.desc("order_date")).limit(trailing_days)
    tail_mean = tail.agg(ratio(F.sum("day_revenue"), F.count(F.lit(1)), 2)).scalar()
    one = daily.agg(F.max("order_date").alias("last_date"), F.count(F.lit(1)).alias("days"),
                    F.stddev_samp(F.col("day_revenue").cast("double")).alias("daily_std"))
    nxt = F.date_add(F.col("last_date"), 1)
    return one.select("last_date", nxt.alias("next_date"),
                      F.date_format(nxt, "EEEE").alias("weekday"), "days",
                      tail_mean.alias("moving_average"), "daily_std")

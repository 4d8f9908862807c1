"""Exploratory tables, KPIs, executive measures and chart data (kept orders).

Semantics follow the pandas analyses they replace:

* ``groupby`` drops NULL keys, so every key column is filtered non-null;
* ``.round(k)`` is half-to-even (``bround``) on exact decimal sums;
* derived ratios (AOV, shares) are computed from the *rounded* sums, as the
  analyses do, and rounded again;
* "first" among ties is the smallest key (pandas leaves ties open).

Every table is one ``groupBy`` (partial + final hash aggregation); whole-
table totals are scalar subqueries over the grouped rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import ratio, rounded, to_double
from tillroll.operators.clean import drop_unknown_region, product_label
from tillroll.plans.ordering import grouped_totals
from tillroll.schema import KEPT_FLAG, KPI_CARD_LABELS, MONEY, RETURN_FLAG, Params

_R2 = "decimal(38,2)"


def _r2(c: str | Column) -> Column:
    """pandas ``.round(2)`` of an exact sum, kept as DECIMAL."""
    return F.bround(F.col(c) if isinstance(c, str) else c, 2).cast(_R2)


def _grouped(kept: DataFrame, keys: list[str], extra: list[Column] = ()) -> DataFrame:
    """orders (non-null order_id), units, revenue rounded to 2 places."""
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return (kept.filter(cond).groupBy(*keys)
                .agg(F.count("order_id").alias("orders"),
                     F.sum("quantity").alias("units"),
                     F.sum("revenue").alias("_rev"), *extra)
                .withColumn("_rev_r", _r2("_rev")))


def _aov(rev_r: str = "_rev_r", orders: str = "orders") -> Column:
    return ratio(rev_r, orders, 2, half_even=True)


def _share(g: DataFrame, rev_r: str = "_rev_r") -> Column:
    return ratio(F.col(rev_r) * 100, grouped_totals(g, rev_r)[rev_r], 1, half_even=True)


def eda_category(kept: DataFrame, with_discount: bool = False) -> DataFrame:
    extra = [F.sum("discount_pct").alias("_disc"), F.count("discount_pct").alias("_ndisc")]
    g = _grouped(kept, ["category"], extra if with_discount else [])
    cols = ["category", "orders", "units", to_double("_rev_r").alias("revenue")]
    if with_discount:
        cols.append(ratio("_disc", "_ndisc", 2, half_even=True).alias("avg_discount_pct"))
    cols += [_aov().alias("avg_order_value"), _share(g).alias("pct_of_revenue")]
    return g.select(*cols).orderBy(F.desc("revenue"), "category")


def eda_daily(kept: DataFrame, with_aov: bool = False) -> DataFrame:
    g = _grouped(kept, ["order_date"])
    cols = ["order_date", "orders", "units", to_double("_rev_r").alias("daily_revenue")]
    if with_aov:
        cols.append(_aov().alias("avg_order_value"))
    return g.select(*cols).orderBy("order_date")


def eda_region(kept: DataFrame, with_salespeople: bool = False, met: DataFrame | None = None) -> DataFrame:
    """``met``: distinct counts kept as bitmaps (see ``questions.with_met``)."""
    if met is None:
        g = _grouped(kept, ["region"], [F.count_distinct("customer_id").alias("customers"),
                                        *([F.count_distinct("salesperson").alias("salespeople")] if with_salespeople else [])])
    else:
        counts = met.select(F.col("key").alias("region"), "customers", "salespeople")
        g = _grouped(kept, ["region"]).join(counts, "region", "left").fillna(0, ["customers", "salespeople"])
    cols = ["region", "orders", "customers"]
    if with_salespeople:
        cols.append("salespeople")
    cols += [to_double("_rev_r").alias("revenue"), _aov().alias("avg_order_value")]
    if with_salespeople:
        cols.append(ratio("_rev_r", "salespeople", 2, half_even=True)
                    .alias("revenue_per_salesperson"))
    return g.select(*cols).orderBy(F.desc("revenue"), "region")


def eda_region_efficiency(kept: DataFrame, team_size: int = Params.team_size) -> DataFrame:
    """Revenue per salesperson with a fixed head count per region."""
    g = _grouped(kept, ["region"])
    return (g.select("region", to_double("_rev_r").alias("revenue"),
                     F.lit(team_size).alias("team_size"),
                     ratio("_rev_r", F.lit(team_size), 3).alias("revenue_per_salesperson"))
             .orderBy(F.desc("revenue"), "region"))


_PRODUCT = ["product_name", "sku_id", "category"]


def eda_products(kept: DataFrame, with_aov: bool = False) -> DataFrame:
    g = _grouped(kept, _PRODUCT)
    cols = [*_PRODUCT, "orders", "units", to_double("_rev_r").alias("revenue")]
    if with_aov:
        cols.append(_aov().alias("avg_order_value"))
    return g.select(*cols).orderBy(F.desc("revenue"), *_PRODUCT)


def eda_top_products(kept: DataFrame, n: int = Params.top_n) -> DataFrame:
    """Top ``n`` by revenue (distributed top-k), then listed ascending."""
    top = eda_products(kept).limit(n)
    return top.orderBy("revenue", *[F.desc(c) for c in _PRODUCT])


def eda_discount(kept: DataFrame, with_gross: bool = False) -> DataFrame:
    extra = [F.sum("gross_revenue").alias("_gross")] if with_gross else []
    g = _grouped(kept, ["discount_pct"], extra)
    cols = ["discount_pct", "orders", "units", to_double("_rev_r").alias("net_revenue")]
    if with_gross:
        cols += [to_double(_r2("_gross")).alias("gross_revenue"),
                 to_double(_r2("_gross") - F.col("_rev_r")).alias("discount_lost")]
    cols.append(_aov().alias("avg_order_value"))
    return g.select(*cols).orderBy("discount_pct")


def discount_tier_units(kept: DataFrame) -> DataFrame:
    """Mean units per order by tier, one place."""
    return (kept.filter(F.col("discount_pct").isNotNull()).groupBy("discount_pct")
                .agg(ratio(F.sum("quantity"), F.count("quantity"), 1, half_even=True)
                     .alias("avg_units"))
                .orderBy("discount_pct"))


# --- KPIs ----------------------------------------------------------------------

def _split_totals(dedup: DataFrame) -> DataFrame:
    """One pass over deduplicated rows: kept and returned counts and sums."""
    kept = F.col("return_flag") == KEPT_FLAG
    ret = F.col("return_flag") == RETURN_FLAG
    return dedup.agg(
        F.count(F.lit(1)).alias("dedup_rows"),
        F.count_if(kept).alias("total_orders"),
        F.sum(F.when(kept, F.col("revenue"))).alias("_rev"),
        F.count_if(ret).alias("return_orders"),
        F.coalesce(F.sum(F.when(ret, F.col("revenue"))), F.lit(0).cast(MONEY)).alias("_loss"))


def kpi_summary(dedup: DataFrame) -> DataFrame:
    t = _split_totals(dedup)
    return t.select("total_orders",
                    rounded("_rev", 2, half_even=True).alias("total_revenue"),
                    ratio("_rev", "total_orders", 2, half_even=True).alias("avg_order_value"),
                    rounded("_loss", 2, half_even=True).alias("return_loss"))


def kpi_returns(dedup: DataFrame) -> DataFrame:
    """Returns, their share of cleaned orders, the loss, and "net revenue"
    computed as the original report did: kept revenue minus returned revenue, although
    kept revenue already excludes returns."""
    t = _split_totals(dedup)
    return t.select("return_orders",
                    ratio(F.col("return_orders") * 100, "dedup_rows", 1, half_even=True)
                    .alias("return_rate_pct"),
                    rounded("_loss", 2, half_even=True).alias("return_loss"),
                    rounded(F.col("_rev") - F.col("_loss"), 2, half_even=True).alias("net_revenue"),
                    ratio(F.col("_loss") * 100, "_rev", 1, half_even=True)
                    .alias("loss_pct_of_revenue"))


def kpi_dashboard(dedup: DataFrame) -> DataFrame:
    """Dashboard cards as (position, kpi, value)."""
    t = _split_totals(dedup)
    cards = t.select(
        rounded("_rev", 2, half_even=True).alias("total_revenue"),
        rounded(F.col("_rev") - F.col("_loss"), 2, half_even=True).alias("net_revenue"),
        F.col("total_orders").cast("double").alias("total_orders"),
        ratio("_rev", "total_orders", 2, half_even=True).alias("avg_order_value"),
        ratio(F.col("return_orders") * 100, "dedup_rows", 1, half_even=True).alias("return_rate"))
    cols = ["total_revenue", "net_revenue", "total_orders", "avg_order_value", "return_rate"]
    stacked = ", ".join(f"{i + 1}, '{label}', {c}" for i, (label, c)
                        in enumerate(zip(KPI_CARD_LABELS, cols)))
    return (cards.selectExpr(f"stack({len(cols)}, {stacked}) AS (position, kpi, value)")
            .withColumn("position", F.col("position").cast("int")).orderBy("position"))


def kpi_daily_average(kept: DataFrame, period_days: int = Params.period_days) -> DataFrame:
    """Revenue per day over a stated period length and over observed days."""
    t = kept.agg(F.sum("revenue").alias("_rev"),
                 F.count_distinct("order_date").alias("days_observed"))
    return t.select(rounded("_rev", 2, half_even=True).alias("total_revenue"),
                    F.lit(period_days).alias("period_days"),
                    ratio("_rev", F.lit(period_days), 2, half_even=True).alias("daily_average"),
                    "days_observed",
                    ratio("_rev", "days_observed", 2, half_even=True)
                    .alias("daily_average_observed"))


# --- executive measures ----------------------------------------------------------

def exec_best_worst_region(kept: DataFrame) -> DataFrame:
    """Best and worst known region by (rounded) revenue, gap and gap %."""
    g = _grouped(drop_unknown_region(kept), ["region"])
    best = F.min(F.struct((-F.col("_rev_r")).alias("k"), F.col("region").alias("r")))
    worst = F.min(F.struct(F.col("_rev_r").alias("k"), F.col("region").alias("r")))
    one = g.agg(best.alias("b"), worst.alias("w"))
    best_rev, worst_rev = -F.col("b.k"), F.col("w.k")
    gap = best_rev - worst_rev
    return one.select(F.col("b.r").alias("best_region"), to_double(best_rev).alias("best_revenue"),
                      F.col("w.r").alias("worst_region"), to_double(worst_rev).alias("worst_revenue"),
                      to_double(gap).alias("gap"),
                      ratio(gap * 100, worst_rev, 1, half_even=True).alias("gap_pct"))


def exec_peak_weak_day(kept: DataFrame) -> DataFrame:
    """Highest and lowest revenue day (earliest date on ties)."""
    g = _grouped(kept, ["order_date"])
    one = g.agg(F.min(F.struct((-F.col("_rev_r")).alias("k"), F.col("order_date").alias("d"))).alias("p"),
                F.min(F.struct(F.col("_rev_r").alias("k"), F.col("order_date").alias("d"))).alias("w"))
    return one.select(F.col("p.d").alias("peak_day"), to_double(-F.col("p.k")).alias("peak_revenue"),
                      F.col("w.d").alias("weak_day"), to_double(F.col("w.k")).alias("weak_revenue"))


def exec_discount_share(kept: DataFrame, base_tier: int = Params.base_tier) -> DataFrame:
    """Share of revenue sold without discount, the rest, and money given away."""
    base = F.col("discount_pct") == base_tier
    t = kept.agg(F.sum("revenue").alias("_rev"),
                 F.sum(F.when(base, F.col("revenue"))).alias("_base"),
                 F.sum("discount_amount").alias("_given"))
    base_r = _r2("_base")
    return t.select(to_double(base_r).alias("base_tier_revenue"),
                    ratio(base_r * 100, "_rev", 1, half_even=True).alias("base_tier_pct"),
                    ratio((F.col("_rev") - base_r) * 100, "_rev", 1, half_even=True)
                    .alias("discounted_pct"),
                    rounded("_given", 2, half_even=True).alias("total_discount_given"))


def exec_volume_lift(kept: DataFrame, base_tier: int = Params.base_tier,
                     deep_tier: int = Params.deep_tier) -> DataFrame:
    """Units per order at the deep tier against the base tier, in percent.

    lift = (U_d/O_d - U_b/O_b) / (U_b/O_b) * 100 from the two means with 18
    decimals, whose size does not grow with the rows.  A missing tier gives
    NULL.
    """
    b, d = F.col("discount_pct") == base_tier, F.col("discount_pct") == deep_tier
    t = kept.agg(F.sum(F.when(b, F.col("quantity"))).alias("ub"), F.count_if(b).alias("ob"),
                 F.sum(F.when(d, F.col("quantity"))).alias("ud"), F.count_if(d).alias("od"))
    mean = lambda u, o: F.try_divide(F.col(u).cast("decimal(38,18)"), F.col(o)).cast("decimal(38,18)")
    t = t.select(mean("ub", "ob").alias("base"), mean("ud", "od").alias("deep"))
    return t.select(F.lit(base_tier).alias("base_tier"), F.lit(deep_tier).alias("deep_tier"),
                    rounded("base", 2, half_even=True).alias("base_units_per_order"),
                    rounded("deep", 2, half_even=True).alias("deep_units_per_order"),
                    ratio((F.col("deep") - F.col("base")) * 100, F.nullif(F.col("base"), F.lit(0)), 1,
                          half_even=True).alias("volume_lift_pct"))


def exec_top2_share(kept: DataFrame) -> DataFrame:
    """The two leading categories and their summed share of revenue."""
    cat = eda_category(kept)
    top2 = cat.limit(2)
    return top2.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("revenue")).alias("k"),
                                             F.col("category").alias("c")))).alias("t"),
        F.sum(F.col("pct_of_revenue").cast("decimal(10,1)")).alias("_share")
    ).select(F.get("t", F.lit(0))["c"].alias("first_category"),
             F.get("t", F.lit(1))["c"].alias("second_category"),
             to_double("_share").alias("top2_share_pct"))


def exec_named_category_share(kept: DataFrame,
                              names: tuple[str, ...] = Params.named_categories) -> DataFrame:
    """Share and revenue of named categories; share 0 and revenue NULL if absent."""
    cat = eda_category(kept)
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(n).alias("category"))
            for i, n in enumerate(names)]
    wanted = kept.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return (wanted.join(cat, "category", "left")
                  .select("position", "category",
                          F.coalesce(F.col("pct_of_revenue"), F.lit(0.0)).alias("pct_of_revenue"),
                          "revenue")
                  .orderBy("position"))


# --- chart data ---------------------------------------------------------------

def _k(c: str | Column, places: int = 5) -> Column:
    """Exact value in thousands."""
    col = F.col(c) if isinstance(c, str) else c
    return ratio(col, F.lit(1000), places)


def chart_category(kept: DataFrame) -> DataFrame:
    g = _grouped(kept, ["category"])
    return (g.select("category", _k("_rev_r").alias("revenue_k"), _share(g).alias("share_pct"))
             .orderBy("revenue_k", "category"))


def chart_daily(kept: DataFrame) -> DataFrame:
    g = _grouped(kept, ["order_date"])
    return (g.select("order_date", _k("_rev_r").alias("revenue_k"), "orders",
                     ratio("units", F.lit(100), 2).alias("units_hundreds"))
             .orderBy("order_date"))


def chart_region(kept: DataFrame, team_size: int = Params.team_size) -> DataFrame:
    g = _grouped(kept, ["region"], [F.count_distinct("salesperson").alias("salespeople")])
    per_rep = F.try_divide(F.col("_rev_r").cast("decimal(38,18)"), F.col("salespeople"))
    return (g.select("region", _k("_rev_r").alias("revenue_k"), "orders",
                     _aov().alias("avg_order_value"),
                     _k(F.col("_rev_r") / team_size, 6).alias("per_rep_k_fixed_team"),
                     _k(F.bround(per_rep, 2), 6).alias("per_rep_k"))
             .orderBy("revenue_k", "region"))


def chart_top_products(kept: DataFrame, n: int = Params.top_n) -> DataFrame:
    top = product_label(eda_top_products(kept, n))
    return (top.select("label", "category", _k(F.col("revenue").cast(_R2)).alias("revenue_k"))
               .orderBy("revenue_k", F.desc("label")))


def chart_discount(kept: DataFrame) -> DataFrame:
    g = _grouped(kept, ["discount_pct"], [F.sum("gross_revenue").alias("_gross")])
    return (g.select("discount_pct", "orders", _aov().alias("avg_order_value"),
                     _k("_rev_r").alias("net_revenue_k"),
                     _k(_r2("_gross")).alias("gross_revenue_k"))
             .orderBy("discount_pct"))

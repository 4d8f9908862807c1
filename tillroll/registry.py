"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame, and
key -> DuckDB oracle SQL.  ``__spark_entry__`` exposes both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import clean as C
from tillroll.operators import explore as X
from tillroll.operators import quality as DQ
from tillroll.operators import questions as Q
from tillroll.operators import stats as S
from tillroll.oracle import explore as OX
from tillroll.oracle import io as OIO
from tillroll.oracle import quality as ODQ
from tillroll.oracle import questions as OQ
from tillroll.oracle import stats as OS
from tillroll.plans.catalog import read_query, register_views
from tillroll.plans.materialize import load
from tillroll.plans.summaries import Summaries, met_counts
from tillroll.schema import ROW_SEQ, SALES_COLUMNS
from tillroll.session import scratch_path, stable_path
from tillroll.sources.daily_csv import read_daily_drop
from tillroll.sources.lines import DIALECT
from tillroll.sources.sinks import by_day, by_range, write_clean_csv, write_daily_drop, write_raw_table
from tillroll.streaming.firsts import FirstCopies
from tillroll.streaming.increments import ingest_available
from tillroll.workspace import Drop, as_output

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[Drop], DataFrame]) -> Callable[[Drop], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(load(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --- 2.1 / 2.4 / 2.5: the view, the dimension, the nine questions -------------

@register("sales_clean", OQ.ORACLE["sales_clean"])
def _sales_clean(d: Drop) -> DataFrame:
    return as_output(d.clean.select(*SALES_COLUMNS, "revenue"))


@register("targets_dim", OQ.ORACLE["targets_dim"])
def _targets(d: Drop) -> DataFrame:
    return d.targets


_QUESTIONS = {
    "q1_salesperson_rank": Q.q1_salesperson_rank,
    "q2_category": Q.q2_category,
    "q4_daily_trend": Q.q4_daily_trend,
    "q5_top_products": Q.q5_top_products,
    "q6_discount": Q.q6_discount,
    "q7_payment": Q.q7_payment,
}
for _name, _fn in _QUESTIONS.items():
    register(_name, OQ.ORACLE[_name])(lambda d, _fn=_fn: _fn(d.clean))


@register("q3_region", OQ.ORACLE["q3_region"])
def _q3(d: Drop) -> DataFrame:
    return Q.q3_region(d.clean, met_counts(d.visits, "clean", "region"))


@register("q8_channel", OQ.ORACLE["q8_channel"])
def _q8(d: Drop) -> DataFrame:
    return Q.q8_channel(d.clean, met_counts(d.visits, "clean", "channel"))


@register("q9_target_attainment", OQ.ORACLE["q9_target_attainment"])
def _q9(d: Drop) -> DataFrame:
    return Q.q9_target_attainment(d.clean, d.targets)


# --- 2.1 / 2.2: overview, profile, data quality --------------------------------


def _raw_out(df: DataFrame) -> DataFrame:
    return as_output(df.drop(ROW_SEQ))


register("dataset_overview", ODQ.ORACLE["dataset_overview"])(
    lambda d: DQ.dataset_overview(d.raw))
register("column_profile", ODQ.ORACLE["column_profile"])(lambda d: DQ.column_profile(d.raw))
register("preview_head", ODQ.ORACLE["preview_head"])(lambda d: as_output(DQ.preview_head(d.rows)))
register("dq_report", ODQ.ORACLE["dq_report"])(lambda d: DQ.dq_report(d.raw))
for _issue in ["missing_names", "missing_region", "negative_qty", "duplicates", "returns"]:
    register(f"dq_{_issue}", ODQ.ORACLE[f"dq_{_issue}"])(
        lambda d, _issue=_issue: DQ.dq_measure(d.raw, _issue))
register("dq_rows_removed", ODQ.ORACLE["dq_rows_removed"])(
    lambda d: DQ.dq_rows_removed(d.raw, d.dedup))

# --- 2.3: row-level cleaning steps ------------------------------------------------

register("fill_defaults", ODQ.ORACLE["fill_defaults"])(lambda d: _raw_out(C.fill_defaults(d.rows)))
register("abs_quantity", ODQ.ORACLE["abs_quantity"])(lambda d: _raw_out(C.abs_quantity(d.rows)))
register("derive_revenue", ODQ.ORACLE["derive_revenue"])(
    lambda d: _raw_out(C.derive_revenue(C.abs_quantity(C.fill_defaults(d.raw)))))
register("derive_gross_discount", ODQ.ORACLE["derive_gross_discount"])(
    lambda d: _raw_out(C.derive_gross_discount(
        C.derive_revenue(C.abs_quantity(C.fill_defaults(d.raw))))))
register("dedup_filter_first", ODQ.ORACLE["dedup_filter_first"])(
    lambda d: _raw_out(d.first_kept_rows))
register("dedup_keep_first", ODQ.ORACLE["dedup_keep_first"])(
    lambda d: _raw_out(d.first_rows))
register("split_kept", ODQ.ORACLE["split_kept"])(lambda d: as_output(d.kept))
register("split_returns", ODQ.ORACLE["split_returns"])(lambda d: as_output(d.returns))
register("drop_unknown_region", ODQ.ORACLE["drop_unknown_region"])(
    lambda d: as_output(C.drop_unknown_region(d.kept)))
register("product_label", ODQ.ORACLE["product_label"])(
    lambda d: C.product_label(d.raw.select("sku_id", "product_name").distinct()))

# --- 2.6: exploratory tables, KPIs, executive measures, chart data ---------------

_EDA = {
    "eda_category": lambda d: X.eda_category(d.kept),
    "eda_category_discount": lambda d: X.eda_category(d.kept, with_discount=True),
    "eda_daily": lambda d: X.eda_daily(d.kept),
    "eda_daily_aov": lambda d: X.eda_daily(d.kept, with_aov=True),
    "eda_region": lambda d: X.eda_region(d.kept),
    "eda_region_salespeople": lambda d: X.eda_region(d.kept, with_salespeople=True,
                                                     met=met_counts(d.visits, "kept", "region")),
    "eda_region_efficiency": lambda d: X.eda_region_efficiency(d.kept, d.params.team_size),
    "eda_products": lambda d: X.eda_products(d.kept),
    "eda_products_aov": lambda d: X.eda_products(d.kept, with_aov=True),
    "eda_top10_products": lambda d: X.eda_top_products(d.kept, d.params.top_n),
    "eda_discount": lambda d: X.eda_discount(d.kept),
    "eda_discount_gross": lambda d: X.eda_discount(d.kept, with_gross=True),
    "discount_tier_units": lambda d: X.discount_tier_units(d.kept),
    "kpi_summary": lambda d: X.kpi_summary(d.dedup),
    "kpi_returns": lambda d: X.kpi_returns(d.dedup),
    "kpi_dashboard": lambda d: X.kpi_dashboard(d.dedup),
    "kpi_daily_average": lambda d: X.kpi_daily_average(d.kept, d.params.period_days),
    "exec_best_worst_region": lambda d: X.exec_best_worst_region(d.kept),
    "exec_peak_weak_day": lambda d: X.exec_peak_weak_day(d.kept),
    "exec_discount_share": lambda d: X.exec_discount_share(d.kept, d.params.base_tier),
    "exec_volume_lift": lambda d: X.exec_volume_lift(d.kept, d.params.base_tier,
                                                     d.params.deep_tier),
    "exec_top2_share": lambda d: X.exec_top2_share(d.kept),
    "exec_named_category_share": lambda d: X.exec_named_category_share(
        d.kept, d.params.named_categories),
    "chart_category": lambda d: X.chart_category(d.kept),
    "chart_daily": lambda d: X.chart_daily(d.kept),
    "chart_region": lambda d: X.chart_region(d.kept, d.params.team_size),
    "chart_top_products": lambda d: X.chart_top_products(d.kept, d.params.top_n),
    "chart_discount": lambda d: X.chart_discount(d.kept),
}
for _name, _fn in _EDA.items():
    register(_name, OX.ORACLE[_name])(_fn)


# --- 2.7: significance tests and forecast ---------------------------------------


def _neg_log10(p: str = "p_value"):
    return F.round(F.when(F.col(p) > 0, -F.log10(F.col(p)))
                    .when(F.col(p) == 0, F.lit(float("inf"))), 4).alias("neg_log10_p")


def anova_report(df: DataFrame) -> DataFrame:
    """Reported precision: F 6 places, p 9, eta^2 10 (full values stay in
    ``S.anova_oneway``)."""
    return df.select("groups", "n", "df_between", "df_within",
                     F.round("f_stat", 6).alias("f_stat"), F.round("p_value", 9).alias("p_value"),
                     _neg_log10(), F.round("eta_squared", 10).alias("eta_squared"),
                     "effect", "verdict")


register("anova_region", OS.ORACLE["anova_region"])(lambda d: anova_report(S.anova_region(d.kept)))
register("anova_salesperson", OS.ORACLE["anova_salesperson"])(
    lambda d: anova_report(S.anova_salesperson(d.kept)))
register("anova_discount", OS.ORACLE["anova_discount"])(
    lambda d: anova_report(S.anova_discount(d.kept)))


@register("corr_discount_quantity", OS.ORACLE["corr_discount_quantity"])
def _corr(d: Drop) -> DataFrame:
    return S.corr_discount_quantity(d.kept).select(
        "n", F.round("r", 10).alias("r"), F.round("r_squared", 10).alias("r_squared"),
        F.round("p_value", 9).alias("p_value"), _neg_log10(), "verdict")


@register("ttest_returns", OS.ORACLE["ttest_returns"])
def _ttest(d: Drop) -> DataFrame:
    return S.ttest_returns(d.dedup).select(
        "n1", "n2", F.round("mean_first", 6).alias("mean_first"),
        F.round("mean_second", 6).alias("mean_second"), F.round("t_stat", 6).alias("t_stat"),
        F.round("df", 4).alias("df"), F.round("p_value", 9).alias("p_value"), _neg_log10(),
        "verdict")


@register("linear_trend", OS.ORACLE["linear_trend"])
def _trend(d: Drop) -> DataFrame:
    return trend_report(S.linear_trend(d.kept))


def trend_report(trend: DataFrame) -> DataFrame:
    return trend.select(
        "days", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round("r_squared", 10).alias("r_squared"), F.round("p_value", 9).alias("p_value"),
        _neg_log10(), F.round("stderr", 6).alias("stderr"), "low_r_squared")


@register("forecast_next_day", OS.ORACLE["forecast_next_day"])
def _forecast(d: Drop) -> DataFrame:
    return S.forecast_next_day(d.kept, d.params.trailing_days).select(
        "last_date", "next_date", "weekday", "days", "moving_average",
        F.round("daily_std", 4).alias("daily_std"))


@register("eta_squared", OS.ORACLE["eta_squared"])
def _eta(d: Drop) -> DataFrame:
    """Effect sizes of the three factors from one pass over kept orders."""
    a = S.anova_factors(d.kept, S.standard_factors())
    return a.select("factor", F.round("eta_squared", 10).alias("eta_squared"), "effect")


def _anova_rows(a: DataFrame) -> DataFrame:
    factor = F.col("factor")
    return a.select(
        F.when(factor == "region", 1).when(factor == "salesperson", 2).otherwise(4)
         .alias("position"),
        F.concat(F.lit("anova_"), F.when(factor == "discount_pct", F.lit("discount"))
                 .otherwise(factor)).alias("test"),
        F.round("f_stat", 6).alias("statistic"), F.round("p_value", 9).alias("p_value"),
        "verdict")


@register("stat_verdicts", OS.ORACLE["stat_verdicts"])
def _verdicts(d: Drop) -> DataFrame:
    """The five tests with their verdicts; the three ANOVAs share one pass."""
    anovas = _anova_rows(S.anova_factors(d.kept, S.standard_factors()))
    # One row with both tests, one pass; unfolded into two rows, not read twice.
    pair = S.kept_corr_and_return_ttest(d.dedup).select(F.inline(F.array(
        F.struct(F.lit(3).alias("position"), F.lit("corr_discount_quantity").alias("test"),
                 F.round("r", 10).alias("statistic"), F.round("corr_p", 9).alias("p_value"),
                 S.verdict(F.col("corr_p")).alias("verdict")),
        F.struct(F.lit(5).alias("position"), F.lit("ttest_returns").alias("test"),
                 F.round("t_stat", 6).alias("statistic"), F.round("t_p", 9).alias("p_value"),
                 S.verdict(F.col("t_p")).alias("verdict")))))
    return anovas.unionByName(pair)


# --- 2.1 sources and sinks, 2.9 incremental ingestion -----------------------------


def _drop_schema(raw: DataFrame) -> T.StructType:
    return T.StructType([f for f in raw.schema.fields if f.name != ROW_SEQ])


_WRITTEN: set[str] = set()


def _drop_dir(d: Drop) -> str:
    """The raw rows written once as a CSV drop in the shared folder: an
    input of the CSV keys, like a landing zone (one per loaded Drop).  They
    need no raw table for it, which would shuffle and write all rows once more.
    Its files are compressed: as plain text they are the largest thing on disk."""
    path = stable_path(d.spark, f"drop-{d.key}")
    if path not in _WRITTEN:
        write_daily_drop(d.dealt(by_range), path, dealt=True, compression="gzip")
        _WRITTEN.add(path)
    return path


def _csv_drop(d: Drop) -> DataFrame:
    """Scan the CSV drop of ``d``."""
    return read_daily_drop(d.spark, _drop_dir(d), _drop_schema(d.rows))


@register("scan_daily_csv", OIO.ORACLE["scan_daily_csv"])
def _scan_daily_csv(d: Drop) -> DataFrame:
    return _raw_out(_csv_drop(d))


@register("csv_sales_clean", OQ.ORACLE["sales_clean"])
def _csv_sales_clean(d: Drop) -> DataFrame:
    """The cleaning view over a scanned CSV drop: first copies by file order."""
    return as_output(C.sales_clean(_csv_drop(d)))


@register("write_raw_table", OIO.ORACLE["write_raw_table"])
def _write_raw(d: Drop) -> DataFrame:
    path = write_raw_table(d.dealt(by_day), stable_path(d.spark, f"sales-{d.key}"), dealt=True)
    return _raw_out(d.spark.read.parquet(path))


@register("write_clean_csv", ODQ.ORACLE["split_kept"])
def _write_clean_csv(d: Drop) -> DataFrame:
    path = write_clean_csv(d.kept, stable_path(d.spark, f"clean-{d.key}"))
    back = d.spark.read.schema(d.kept.schema).options(**DIALECT).option("header", True).csv(path)
    return as_output(back)


# A query as a user would type it, over several registered views.
READ_QUERY_SQL = """
WITH per_city AS (
  SELECT salesperson, city, COUNT(*) AS orders, SUM(revenue) AS sold
  FROM sales_kept GROUP BY salesperson, city)
SELECT c.city, COUNT(*) AS reps, SUM(c.orders) AS orders,
       CAST(SUM(c.sold) AS DOUBLE) AS sold,
       COUNT(CASE WHEN c.sold * 25 >= t.weekly_target THEN 1 END) AS reps_on_pace
FROM per_city c JOIN targets t ON t.salesperson = c.salesperson
GROUP BY c.city
HAVING SUM(c.orders) >= 10
"""


@register("read_query", OIO.ORACLE["read_query"])
def _read_query(d: Drop) -> DataFrame:
    register_views(d.spark, d)
    return read_query(d.spark, READ_QUERY_SQL)


@register("stream_ingest_first_copies", OIO.ORACLE["stream_ingest_first_copies"])
def _stream(d: Drop) -> DataFrame:
    """Drop folder -> availableNow stream of files -> raw table and merged first copies -> cleaned."""
    firsts = FirstCopies(d.spark, scratch_path(d.spark, "stream_firsts"), buckets=8)
    q = ingest_available(d.spark, _drop_dir(d), scratch_path(d.spark, "stream_table"),
                         scratch_path(d.spark, "stream_ckpt"), _drop_schema(d.rows), firsts=firsts)
    q.awaitTermination()
    return as_output(C.dedup_clean_from_firsts(firsts.read()))


# --- summaries that late days update ----------------------------------------------


def _summaries(d: Drop, *tables: str) -> Summaries:
    """Summaries of ``d`` that were first filled when only odd days of each month were there, then with the others.

    ``tables``: those that the question reads.
    """
    kept = Summaries(d.spark, stable_path(d.spark, f"summaries-{'-'.join(tables)}-{d.key}"))
    odd = F.day("order_date") % 2 == 1
    if not kept.store.numbers():
        kept.refresh(d.firsts.filter(odd), commit="odd days", tables=tables)
        late = [r[0] for r in d.firsts.filter(~F.coalesce(odd, F.lit(False))).select("order_date").distinct().collect()]
        kept.refresh(d.firsts, late, commit="late days", tables=tables)
    return kept


@register("summary_daily_trend", OQ.ORACLE["q4_daily_trend"])
def _summary_trend(d: Drop) -> DataFrame:
    """Q4 from the stored prefix sums over dates."""
    return Q.trend_table(_summaries(d, "days", "months").running_days("clean").withColumnRenamed("revenue", "_rev"))


@register("summary_linear_trend", OS.ORACLE["linear_trend"])
def _summary_linear(d: Drop) -> DataFrame:
    """The trend from the stored days."""
    days = _summaries(d, "days", "months").running_days("kept").filter("order_date is not null")
    return trend_report(S.trend_of_days(days.select(F.col("_idx").alias("day_index"), F.col("revenue").alias("day_revenue"))))


@register("summary_verdicts", OS.ORACLE["stat_verdicts"])
def _summary_verdicts(d: Drop) -> DataFrame:
    """The five tests from stored moments."""
    kept = _summaries(d, "moments", "pairs")
    anovas = _anova_rows(S.anova_of_levels(kept.level_moments().filter("factor <> 'return_flag'")))
    corr = S.correlation_test(kept.pair()).select(
        F.lit(3).alias("position"), F.lit("corr_discount_quantity").alias("test"), F.round("r", 10).alias("statistic"),
        F.round("p_value", 9).alias("p_value"), "verdict")
    welch = S.welch_test(kept.return_moments()).select(
        F.lit(5).alias("position"), F.lit("ttest_returns").alias("test"), F.round("t_stat", 6).alias("statistic"),
        F.round("p_value", 9).alias("p_value"), "verdict")
    return anovas.unionByName(corr).unionByName(welch)

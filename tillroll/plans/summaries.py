"""Summaries per day and month that new and corrected days update.

A store (``versions.py``) holds, for each month, small tables that questions
are answered from without the facts of old days:

* ``days``     orders and exact revenue of each day, of the cleaning view and of
               the kept orders of the EDA;
* ``months``   the same of the whole month, with its last day: with ``days``
               the two levels of a prefix-sum tree over dates;
* ``moments``  (n, mean, m2) of revenue per day, factor and level, and of
               returned against kept orders;
* ``pairs``    (n, means, m2 of both, co-moment) of discount and quantity per day;
* ``visits``   bitmaps of the customers and salespeople met per region and
               channel, over dense ids that ``ids`` gives each value once.

``refresh`` takes the days whose first copies changed (``FirstCopies.merge``
names them).  It reads the facts of these days, and of their months for
``visits``, writes these months' parts anew and switches to them; the parts of
other months stay.  A corrected day's old state is gone with its row, so
nothing has to be subtracted from sums of floating-point numbers.

States are combined by the parallel update: means weighted by n, and m2 plus
n times the squared distance from the combined mean.  Distinct counts are bits
of OR-ed bitmaps.  Running values add the months before, a row each, to the
days before in the month, so a changed day changes its own month's rows alone
and the value before it is looked up in the month or at the end of an
earlier one.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.operators.clean import dedup_clean_from_firsts, sales_clean_from_firsts
from tillroll.operators.stats import standard_factors
from tillroll.plans.ordering import with_sequence
from tillroll.plans.versions import Store
from tillroll.schema import KEPT_FLAG, RETURN_FLAG

UNDATED = "none"                 # the month of rows without a date
BITS = 32768                     # of one of Spark's bitmaps
_TABLES = ("days", "months", "moments", "pairs", "visits")
_PER_DAY = ("days", "moments", "pairs")


def month_of(day: Column | str) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))


def _in_months(df: DataFrame, months: Iterable[str] | None) -> DataFrame:
    """Rows of some months, as date ranges that reach the scan."""
    if months is None:
        return df
    cond = F.lit(False)
    for m in sorted(months):
        first = F.lit(f"{m}-01").cast("date")
        cond = cond | (F.col("order_date").isNull() if m == UNDATED else
                       F.col("order_date").between(first, F.last_day(first)))
    return df.filter(cond)


def _on(days: list[date | None]) -> Column:
    """Whether a row's order_date is one of ``days``."""
    undated = F.col("order_date").isNull()
    dated = ~undated & F.col("order_date").isin([d for d in days if d is not None])
    return dated | undated if None in days else dated


def _on_days(df: DataFrame, days: list[date | None] | None) -> DataFrame:
    return df if days is None else df.filter(_on(days))


# --- states of facts ---------------------------------------------------------


def day_sums(**views: DataFrame) -> DataFrame:
    """view, order_date, orders, revenue and month of cleaned rows."""
    found = [df.groupBy("order_date").agg(F.count("order_id").alias("orders"), F.sum("revenue").alias("revenue"))
             .select(F.lit(view).alias("view"), "*", month_of("order_date").alias("month")) for view, df in views.items()]
    return reduce(DataFrame.unionByName, found)


def day_moments(dedup: DataFrame) -> DataFrame:
    """(n, mean, m2) of revenue per day, factor and level; factors of kept orders, and ``return_flag`` of all."""
    kept, value = F.col("return_flag") == KEPT_FLAG, F.col("revenue").cast("double")
    levels = [F.struct(F.lit(name).alias("factor"), F.when(kept, level.cast("string")).alias("level"))
              for name, level in standard_factors().items()]
    levels.append(F.struct(F.lit("return_flag").alias("factor"), F.col("return_flag").alias("level")))
    return dedup.select("order_date", value.alias("v"), F.explode(F.array(*levels)).alias("f")) \
        .filter(F.col("f.level").isNotNull() & F.col("v").isNotNull()) \
        .groupBy("order_date", F.col("f.factor").alias("factor"), F.col("f.level").alias("level")) \
        .agg(F.count("v").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("v")).alias("m2")) \
        .withColumn("month", month_of("order_date"))


def day_pairs(kept: DataFrame) -> DataFrame:
    """(n, mean_x, mean_y, m2_x, m2_y, c) of discount (x) and quantity (y) per day."""
    x, y = F.col("discount_pct").cast("double"), F.col("quantity").cast("double")
    n = F.count(F.lit(1))
    return kept.filter(x.isNotNull() & y.isNotNull()).groupBy("order_date").agg(
        n.alias("n"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"), (F.var_pop(x) * n).alias("m2_x"),
        (F.var_pop(y) * n).alias("m2_y"), (F.covar_pop(x, y) * n).alias("c")).withColumn("month", month_of("order_date"))


def month_sums(days: DataFrame) -> DataFrame:
    """The months' nodes over their days: orders, revenue, number of days, last day's revenue."""
    last = F.when(F.col("month") == UNDATED, F.max("revenue")).otherwise(F.max_by("revenue", "order_date"))
    return days.groupBy("view", "month").agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("days"),
        last.alias("last_revenue"), F.max("order_date").alias("last_day"))


_MET = {"salesperson": "salesperson", "customer_id": "customer"}


def month_visits(clean: DataFrame, dedup: DataFrame, ids: DataFrame) -> DataFrame:
    """month, view, dimension, key, what, bucket, map: who was met where, one bitmap per bucket of ids.

    Ids are dealt out by bitmap first, so a task makes its own bitmaps whole:
    no task holds, and no shuffle moves, a part of every bitmap.
    """
    def met(df: DataFrame, view: str, dimensions: list[str], column: str, what: str) -> DataFrame:
        found = df.select(month_of("order_date").alias("month"), *dimensions, F.col(column).cast("string").alias("value"))
        mine = ids.filter(F.col("what") == what).select("value", "id")
        keys = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("key")) for d in dimensions]
        return found.filter("value is not null").distinct().join(mine, "value").select(
            "month", F.lit(view).alias("view"), F.lit(what).alias("what"), (F.col("id") + 1).alias("id"),
            F.inline(F.array(*keys)))
    kept = dedup.filter(F.col("return_flag") == KEPT_FLAG)
    every = reduce(DataFrame.unionByName, [met(df, view, dimensions, column, what) for df, view, dimensions in (
        (clean, "clean", ["region", "channel"]), (kept, "kept", ["region"])) for column, what in _MET.items()])
    bitmap = ["month", "view", "dimension", "key", "what", "bucket"]
    return every.withColumn("bucket", F.bitmap_bucket_number("id")).repartition(*bitmap).groupBy(*bitmap) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("map"))


# --- combining states ---------------------------------------------------------


def combined_moments(states: DataFrame, *keys: str) -> DataFrame:
    """(n, mean, vp) per key of any number of (n, mean, m2) states."""
    means = states.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    apart = F.col("mean") - F.col("_mean")
    return states.join(means, list(keys)).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.first("_mean").alias("mean"),
        (F.sum(F.col("m2") + F.col("n") * apart * apart) / F.sum("n")).alias("vp"))


def combined_pairs(states: DataFrame) -> DataFrame:
    """One row (n, r) of any number of pair states."""
    states = states.withColumn("_all", F.lit(1))
    means = states.groupBy("_all").agg(*[(F.sum(F.col("n") * F.col(f"mean_{v}")) / F.sum("n")).alias(f"_{v}") for v in "xy"])
    dx, dy = F.col("mean_x") - F.col("_x"), F.col("mean_y") - F.col("_y")
    n = F.col("n")
    one = states.join(means, "_all").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum(F.col("m2_x") + n * dx * dx).alias("m2_x"),
        F.sum(F.col("m2_y") + n * dy * dy).alias("m2_y"), F.sum(F.col("c") + n * dx * dy).alias("c"))
    return one.select("n", F.try_divide(F.col("c"), F.sqrt("m2_x") * F.sqrt("m2_y")).alias("r"))


def met_counts(visits: DataFrame, view: str, dimension: str) -> DataFrame:
    """key, salespeople, customers: exact distinct counts from the bitmaps of all months."""
    ored = visits.filter((F.col("view") == view) & (F.col("dimension") == dimension)) \
        .groupBy("key", "what", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("map")).alias("n"))
    of = lambda what: F.coalesce(F.sum(F.when(F.col("what") == what, F.col("n"))), F.lit(0))
    return ored.groupBy("key").agg(of("salesperson").alias("salespeople"), of("customer").alias("customers"))


# --- the store ----------------------------------------------------------------


class Summaries:
    """The summaries of one drop, in a store of their own."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.store = spark, Store(spark, folder)

    def read(self, table: str) -> DataFrame:
        return self.store.read(table)

    def _known_ids(self) -> DataFrame:
        tables = self.store.version()["tables"]
        return self.store.read("ids") if tables.get("ids") else self.spark.createDataFrame([], "what string, value string, id long")

    def _add_ids(self, facts: DataFrame) -> dict[str, str]:
        """Give values that have no id yet the next ids; the parts of ``ids`` by their number."""
        known = self._known_ids()
        parts = dict(self.store.version()["tables"].get("ids", {}))
        values = facts.select(F.inline(F.array(*[F.struct(F.lit(w).alias("what"), F.col(c).cast("string").alias("value"))
                                                 for c, w in _MET.items()])))
        new = values.filter("value is not null").distinct().join(known, ["what", "value"], "left_anti")
        base = {r.what: r.n for r in known.groupBy("what").agg(F.count(F.lit(1)).alias("n")).collect()}
        for what in _MET.values():
            mine = with_sequence(new.filter(F.col("what") == what).select("value"), "value", "value", index="at")
            folder = self.store.new_folder("ids")
            mine.select(F.lit(what).alias("what"), "value", (F.col("at") + base.get(what, 0)).cast("long").alias("id")) \
                .write.parquet(folder)
            parts[str(len(parts))] = folder
        return parts

    def refresh(self, firsts: DataFrame, days: Iterable[date | None] | None = None, commit: str | None = None,
                tables: tuple[str, ...] = _TABLES) -> None:
        """Bring the summaries up to date with ``firsts`` (``clean.first_copies``).

        ``days``: those whose rows changed, None for all.  ``tables`` limits
        what is kept to some of the summaries.
        """
        if commit is not None and self.store.version()["commit"] == commit:
            return
        days = None if days is None else sorted(set(days), key=str)
        months = None if days is None else {UNDATED if d is None else f"{d:%Y-%m}" for d in days}
        held = self.store.version()["tables"]
        clean, dedup = sales_clean_from_firsts(firsts), dedup_clean_from_firsts(firsts)
        new: dict[str, dict] = {}
        if "visits" in tables:
            some, others = _in_months(clean, months), _in_months(dedup, months)
            new["ids"] = self._add_ids(_in_months(firsts, months))       # both views are filters over it
            ids = self.spark.read.parquet(*new["ids"].values())
            new["visits"] = self._write("visits", month_visits(some, others, ids), held, months)
        kept = dedup.filter(F.col("return_flag") == KEPT_FLAG)
        states = {"days": lambda: day_sums(clean=_on_days(clean, days), kept=_on_days(kept, days)), "moments": lambda: day_moments(_on_days(dedup, days)),
                  "pairs": lambda: day_pairs(_on_days(kept, days))}
        for name in _PER_DAY:
            if name in tables:
                rows = states[name]()
                old = [held[name][m] for m in months or () if m in held.get(name, {})]
                if old:                          # the other days of these months
                    rows = rows.unionByName(self._months(name, old).filter(~_on(days)))
                new[name] = self._write(name, rows, held, months)
        if "days" in tables and "months" in tables:
            changed = [new["days"][m] for m in new["days"] if months is None or m in months]
            new["months"] = self._write("months", month_sums(self._months("days", changed)), held, months) if changed else {
                m: f for m, f in held.get("months", {}).items() if m not in (months or ())}
        self.store.commit(new, commit)

    def _months(self, name: str, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*sorted(folders)).withColumn("month", F.regexp_extract(
            F.col("_metadata.file_path"), r"/part=([^/]+)/", 1)) if folders else None

    def _write(self, name: str, rows: DataFrame, held: dict, months: set[str] | None) -> dict[str, str]:
        """Write months' parts; month -> folder of all months afterwards."""
        folder = self.store.new_folder(name)
        rows.withColumn("part", F.col("month")).drop("month").hint("rebalance", "part").write.partitionBy("part").parquet(folder)
        written = {n.split("=")[1]: f"{folder}/{n}" for n in self.store.names(folder) if n.startswith("part=")}
        stay = {} if months is None else {m: f for m, f in held.get(name, {}).items() if m not in months}
        return {**stay, **written}

    def table(self, name: str) -> DataFrame:
        """A summary table with its ``month``."""
        return self._months(name, list(self.store.version()["tables"][name].values()))

    # --- answers ---

    def running_days(self, view: str) -> DataFrame:
        """order_date, orders, revenue, _idx, _cum, _prev: every day with what lies before it.

        The window over months has at most 12 rows a year of the calendar,
        those over days at most 31.
        """
        mine = F.col("view") == view
        months = self.table("months").filter(mine)
        by_month = Window.orderBy(F.col("month") != UNDATED, "month").rowsBetween(Window.unboundedPreceding, -1)
        before = months.select("month", F.coalesce(F.sum("days").over(by_month), F.lit(0)).alias("_days"),
                               F.coalesce(F.sum("revenue").over(by_month), F.lit(0)).alias("_revenue"),
                               F.last("last_revenue").over(by_month).alias("_last"))
        in_month = Window.partitionBy("month").orderBy("order_date")
        until = in_month.rowsBetween(Window.unboundedPreceding, 0)
        days = self.table("days").filter(mine).join(F.broadcast(before), "month")
        first = F.row_number().over(in_month) == 1
        return days.select("order_date", "orders", "revenue",
                           (F.col("_days") + F.row_number().over(in_month) - 1).alias("_idx"),
                           (F.col("_revenue") + F.coalesce(F.sum("revenue").over(until), F.lit(0))).alias("_cum"),
                           F.when(first, F.col("_last")).otherwise(F.lag("revenue").over(in_month)).alias("_prev"))

    def level_moments(self) -> DataFrame:
        """factor, level, n, mean, vp over all days."""
        return combined_moments(self.table("moments"), "factor", "level")

    def pair(self) -> DataFrame:
        return combined_pairs(self.table("pairs"))

    def return_moments(self) -> DataFrame:
        """One row of the moments of returned (1) and kept (2) orders' revenue, variances of samples."""
        two = self.level_moments().filter("factor = 'return_flag'")
        def of(flag: str, k: int) -> list[Column]:
            mine = F.col("level") == flag
            n = F.coalesce(F.max(F.when(mine, F.col("n"))), F.lit(0))
            return [n.alias(f"n{k}"), F.max(F.when(mine, F.col("mean"))).alias(f"m{k}"),
                    F.max(F.when(mine & (F.col("n") > 1), F.col("vp") * F.col("n") / (F.col("n") - 1))).alias(f"v{k}")]
        return two.agg(*of(RETURN_FLAG, 1), *of(KEPT_FLAG, 2))

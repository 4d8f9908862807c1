"""Summaries after any corrections against a rescan of all facts."""

import math
import os
import random
import tempfile
from datetime import date, timedelta

import pytest

from tests.fixtures import make_raw
from tillroll.operators import clean as C
from tillroll.operators import explore as X
from tillroll.operators import questions as Q
from tillroll.operators import stats as S
from tillroll.plans import summaries as M
from tillroll.plans.summaries import Summaries, met_counts


def _folder():
    return tempfile.mkdtemp(prefix="tillroll-test-")


def _rows(rng, n, days):
    return [dict(order_id=f"O{rng.random()}", order_date=rng.choice(days), unit_price=round(rng.uniform(1, 5000), 2),
                 quantity=rng.choice([1, 2, 3, -4]), discount_pct=rng.choice([0, 5, 10, None]), salesperson=f"S{rng.randrange(7)}",
                 region=rng.choice(["North", "South", "", None]), customer_id=rng.choice([None, *range(40)]),
                 channel=rng.choice(["Online", "Shop", None]), return_flag=rng.choice(["No"] * 8 + ["Yes", "?"])) for _ in range(n)]


def _firsts(spark, rows):
    return C.first_copies(make_raw(spark, rows))


def _close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12))


def _same(got, want):
    got, want = got.collect(), want.collect()
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=str), sorted(want, key=str)):
        assert a.asDict().keys() == b.asDict().keys()
        for k, v in a.asDict().items():
            assert _close(v, b[k]) if isinstance(v, float) else v == b[k], (k, v, b[k])


def _check(spark, kept, firsts):
    clean, dedup = C.sales_clean_from_firsts(firsts), C.dedup_clean_from_firsts(firsts)
    orders = C.split_kept(dedup)
    trend = kept.running_days("clean").withColumnRenamed("revenue", "_rev")
    assert [tuple(r) for r in Q.trend_table(trend).collect()] == [tuple(r) for r in Q.q4_daily_trend(clean).collect()]
    levels = kept.level_moments().filter("factor <> 'return_flag'")
    _same(S.anova_of_levels(levels).drop("p_value"), S.anova_factors(orders, S.standard_factors()).drop("p_value"))
    _same(S.correlation_test(kept.pair()).select("n", "r"), S.corr_discount_quantity(orders).select("n", "r"))
    _same(S.welch_test(kept.return_moments()).select("n1", "n2", "mean_first", "t_stat", "df"),
          S.ttest_returns(dedup).select("n1", "n2", "mean_first", "t_stat", "df"))
    visits = kept.table("visits")
    _same(Q.q3_region(clean, met_counts(visits, "clean", "region")), Q.q3_region(clean))
    _same(Q.q8_channel(clean, met_counts(visits, "clean", "channel")), Q.q8_channel(clean))
    _same(X.eda_region(orders, True, met_counts(visits, "kept", "region")), X.eda_region(orders, True))


@pytest.mark.parametrize("seed", [1])
def test_random_corrections_equal_a_rescan(spark, seed):
    rng = random.Random(seed)
    every = [date(2025, 11, 20) + timedelta(d) for d in range(0, 100, 3)] + [None]
    rows = _rows(rng, 300, every[::2])
    kept = Summaries(spark, _folder())
    kept.refresh(_firsts(spark, rows), commit="first")
    _check(spark, kept, _firsts(spark, rows))
    # Late days between old ones, a day that goes, one that changes, and new values.
    gone, changed = every[4], every[6]
    later = [r for r in rows if r["order_date"] not in (gone, changed)] + _rows(rng, 60, every[1::4]) + _rows(rng, 9, [changed])
    later += [dict(order_id="new", order_date=every[1], salesperson="someone", customer_id=999, region="West")]
    kept.refresh(_firsts(spark, later), [gone, changed, *every[1::4]], commit="second")
    _check(spark, kept, _firsts(spark, later))
    last = [r for r in later if r["order_date"] is not None]
    kept.refresh(_firsts(spark, last), [None], commit="third")
    _check(spark, kept, _firsts(spark, last))


def test_a_changed_day_reads_and_writes_its_month_alone(spark, monkeypatch):
    rng = random.Random(3)
    rows = _rows(rng, 200, [date(2026, m, d) for m in (1, 2, 3) for d in (1, 9, 28)])
    path = os.path.join(_folder(), "firsts")
    make = lambda: _firsts(spark, rows).repartitionByRange(6, "order_date").sortWithinPartitions("order_date") \
        .write.mode("overwrite").parquet(path)
    make()
    kept = Summaries(spark, _folder())
    kept.refresh(spark.read.parquet(path), commit="first")
    before = kept.store.version()["tables"]
    seen = []
    sums = M.day_moments
    monkeypatch.setattr(M, "day_moments", lambda dedup: seen.append(
        dedup._jdf.queryExecution().executedPlan().toString()) or sums(dedup))
    kept.refresh(spark.read.parquet(path), [date(2026, 2, 9)], commit="second")
    after = kept.store.version()["tables"]
    for name in ("days", "months", "moments", "pairs", "visits"):
        assert {m for m in after[name] if after[name][m] != before[name].get(m)} == {"2026-02"}
    assert "PushedFilters" in seen[0] and "2026-02-09" in seen[0][seen[0].index("PushedFilters"):]
    _check(spark, kept, spark.read.parquet(path))
    kept.refresh(spark.read.parquet(path), [date(2026, 2, 9)], commit="second")               # replayed
    assert kept.store.version()["number"] == 2


def test_distinct_counts_multiply_no_row(spark):
    rows = _rows(random.Random(4), 50, [date(2026, 1, 1)])
    firsts = _firsts(spark, rows)
    kept = Summaries(spark, _folder())
    kept.refresh(firsts, tables=("visits",))
    plan = Q.q3_region(C.sales_clean_from_firsts(firsts), met_counts(kept.table("visits"), "clean", "region")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert "Expand" in Q.q3_region(C.sales_clean_from_firsts(firsts))._jdf.queryExecution().executedPlan().toString()


def test_many_ids_go_over_several_bitmaps(spark):
    from pyspark.sql import functions as F
    n = 70_000
    raw = make_raw(spark, [dict(order_id="x")]).drop("order_id", "customer_id", "region", "row_seq") \
        .crossJoin(spark.range(n)).withColumns({"order_id": F.col("id").cast("string"), "customer_id": F.col("id") % 66_000,
                                                "region": F.concat(F.lit("R"), F.col("id") % 3),
                                                "row_seq": F.struct(F.col("id").alias("pos"))}).drop("id")
    kept = Summaries(spark, _folder())
    kept.refresh(C.first_copies(raw), tables=("visits",))
    got = {r.key: (r.salespeople, r.customers) for r in met_counts(kept.table("visits"), "clean", "region").collect()}
    want = {f"R{k}": (1, len({i % 66_000 for i in range(k, n, 3)})) for k in range(3)}
    assert got == want

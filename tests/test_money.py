"""Exact rounding helpers against Python's decimal module."""

from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.functions.money import line_revenue, pct, ratio

_cases = st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)),
                  min_size=1, max_size=40)


def _expected(n, d, k, mode):
    q = (Decimal(n) / Decimal(10**4)) / Decimal(d)
    return float(q.quantize(Decimal(1).scaleb(-k), rounding=mode))


@settings(max_examples=15, deadline=None)
@given(_cases)
def test_ratio_rounds_exactly(spark, cases):
    df = spark.createDataFrame(cases, "n long, d long").selectExpr(
        "n", "d", "CAST(n AS DECIMAL(28,0)) / 10000 AS num")
    rows = df.select("n", "d", ratio("num", "d", 2).alias("up"),
                     ratio("num", "d", 2, half_even=True).alias("even"),
                     pct("num", "d", 1).alias("p")).collect()
    for r in rows:
        assert r.up == _expected(r.n, r.d, 2, ROUND_HALF_UP)
        assert r.even == _expected(r.n, r.d, 2, ROUND_HALF_EVEN)
        assert r.p == _expected(r.n * 100, r.d, 1, ROUND_HALF_UP)


def test_ratio_by_zero_is_null(spark):
    r = spark.createDataFrame([(5, 0)], "n long, d long").select(ratio("n", "d", 2).alias("x")).collect()
    assert r[0].x is None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 99999), st.integers(-50, 50), st.integers(0, 15)),
                min_size=1, max_size=30))
def test_line_revenue_is_exact(spark, cases):
    df = spark.createDataFrame(cases, "cents int, qty int, pct int").selectExpr(
        "cents", "qty", "pct", "CAST(cents AS DECIMAL(12,2)) / 100 AS price")
    for r in df.select("cents", "qty", "pct",
                       line_revenue("price", "qty", "pct").alias("rev")).collect():
        exact = Decimal(r.cents) / 100 * r.qty * (100 - r.pct) / 100
        assert r.rev == exact

"""Statistics against values worked out by hand."""

import math
from datetime import date, timedelta

from pyspark.sql import functions as F

from tests.fixtures import make_raw
from tillroll.functions.betainc import with_f_test_p, with_t_test_p
from tillroll.operators import clean as C
from tillroll.operators import stats as S


def _groups(spark, groups):
    rows = [(str(g), float(v)) for g, vals in enumerate(groups) for v in vals]
    return spark.createDataFrame(rows, "g string, revenue double")


def test_anova_textbook(spark):
    r = S.anova_oneway(_groups(spark, [(1, 2, 3), (2, 3, 4), (5, 6, 7)]), "g").collect()[0]
    assert (r.df_between, r.df_within) == (2, 6)
    assert math.isclose(r.f_stat, 13.0, rel_tol=1e-12)
    assert math.isclose(r.eta_squared, 0.8125, rel_tol=1e-12)
    assert math.isclose(r.p_value, 27 / 4096, rel_tol=1e-10)   # F(2, 6) tail = (1 + F/3)^-3
    assert r.effect == "large" and r.verdict == "SIGNIFICANT"


def test_anova_edge_cases(spark):
    one = S.anova_oneway(_groups(spark, [(1, 2, 3)]), "g").collect()[0]
    assert one.f_stat is None and one.p_value is None
    flat = S.anova_oneway(_groups(spark, [(1, 1), (2, 2)]), "g").collect()[0]
    assert flat.f_stat == float("inf") and flat.p_value == 0.0
    same = S.anova_oneway(_groups(spark, [(1, 1), (1, 1)]), "g").collect()[0]
    assert same.f_stat is None


def test_linear_trend_textbook(spark):
    rows = [dict(order_id=f"O{i}", order_date=date(2026, 6, 22) + timedelta(days=2 * i),
                 unit_price=y) for i, y in enumerate([1, 2, 5])]
    r = S.linear_trend(C.kept_orders(make_raw(spark, rows))).collect()[0]
    assert math.isclose(r.slope, 2.0, rel_tol=1e-12)
    assert math.isclose(r.intercept, 2 / 3, rel_tol=1e-12)
    assert math.isclose(r.r_squared, 12 / 13, rel_tol=1e-12)
    # two-sided t test with 1 df is Cauchy: p = 1 - 2/pi * atan(|t|)
    t = math.sqrt(12 / 13 / (1 / 13))
    assert math.isclose(r.p_value, 1 - 2 / math.pi * math.atan(t), rel_tol=1e-9)
    # stderr = sqrt((1 - R^2) * Syy / Sxx / df) with Syy = 26/3, Sxx = 2
    assert math.isclose(r.stderr, math.sqrt((1 / 13) * (26 / 3) / 2 / 1), rel_tol=1e-12)


def test_forecast(spark):
    rows = [dict(order_id=f"O{i}", order_date=date(2026, 6, 22) + timedelta(days=i),
                 unit_price=y) for i, y in enumerate([10, 20, 30, 60])]
    r = S.forecast_next_day(C.kept_orders(make_raw(spark, rows))).collect()[0]
    assert r.next_date == date(2026, 6, 26) and r.weekday == "Friday"
    assert r.moving_average == round((20 + 30 + 60) / 3, 2)
    assert math.isclose(r.daily_std, 21.602468994692867, rel_tol=1e-12)


def test_welch_matches_hand_computation(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 8.0, 10.0]
    df = spark.createDataFrame([("x", v) for v in a] + [("y", v) for v in b], "g string, revenue double")
    r = S.welch_t(df, "g", "x", "y").collect()[0]
    ma, mb = sum(a) / 4, sum(b) / 5
    va = sum((v - ma) ** 2 for v in a) / 3
    vb = sum((v - mb) ** 2 for v in b) / 4
    t = (ma - mb) / math.sqrt(va / 4 + vb / 5)
    dof = (va / 4 + vb / 5) ** 2 / ((va / 4) ** 2 / 3 + (vb / 5) ** 2 / 4)
    assert math.isclose(r.t_stat, t, rel_tol=1e-12) and math.isclose(r.df, dof, rel_tol=1e-12)


def test_pearson(spark):
    xs, ys = [1, 2, 3, 4], [2, 4, 5, 4]
    df = spark.createDataFrame(list(zip(xs, ys)), "x int, y int")
    r = S.pearson(df, "x", "y").collect()[0]
    mx, my = 2.5, 3.75
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    rr = cov / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))
    assert math.isclose(r.r, rr, rel_tol=1e-12)
    # df = 2: p = 1 - |t| / sqrt(2 + t^2)
    t = rr * math.sqrt(2 / (1 - rr * rr))
    assert math.isclose(r.p_value, 1 - abs(t) / math.sqrt(2 + t * t), rel_tol=1e-9)


def test_p_values_closed_forms(spark):
    rows = [(f, d2) for d2 in [3.0, 40.0, 1e4, 6e6] for f in [0.05, 0.7, 1.3, 4.0, 25.0]]
    df = spark.createDataFrame(rows, "f double, d2 double").withColumn("d1", F.lit(2.0))
    for r in with_f_test_p(df, "f", "d1", "d2").collect():
        exact = math.exp(-r.d2 / 2 * math.log1p(2 * r.f / r.d2))
        assert math.isclose(r.p_value, exact, rel_tol=1e-9), (r.f, r.d2)
    tdf = spark.createDataFrame([(t,) for t in [0.0, 0.3, 1.0, 2.5, 12.0]], "t double")
    for r in with_t_test_p(tdf, F.col("t") * F.col("t"), F.lit(1.0)).collect():
        assert math.isclose(r.p_value, 1 - 2 / math.pi * math.atan(abs(r.t)), rel_tol=1e-9)


def test_anova_factors_equals_separate_anovas(spark):
    import random
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", "c", None]), rnd.choice(["x", "y"]), float(rnd.randint(1, 50)))
            for _ in range(600)]
    df = spark.createDataFrame(rows, "f1 string, f2 string, revenue double")
    both = {r.factor: r for r in S.anova_factors(
        df, {"f1": F.col("f1"), "f2": F.when(F.col("f1") != "c", F.col("f2"))}).collect()}
    one = S.anova_oneway(df, "f1").collect()[0]
    two = S.anova_oneway(df.filter(F.col("f1") != "c"), "f2").collect()[0]
    for got, ref in ((both["f1"], one), (both["f2"], two)):
        assert (got.groups, got.n) == (ref.groups, ref.n)
        assert math.isclose(got.f_stat, ref.f_stat, rel_tol=1e-9)
        assert math.isclose(got.p_value, ref.p_value, rel_tol=1e-9)


def test_one_pass_corr_and_ttest_equal_separate(spark):
    import random
    rnd = random.Random(9)
    rows = [dict(order_id=f"O{i}", discount_pct=rnd.choice([0, 5, 10]), quantity=rnd.randint(1, 9),
                 unit_price=rnd.randint(5, 500), return_flag=rnd.choice(["Yes", "No", "No", "Maybe"]))
            for i in range(400)]
    dedup = C.dedup_clean(make_raw(spark, rows))
    both = S.kept_corr_and_return_ttest(dedup).collect()[0]
    corr = S.corr_discount_quantity(C.split_kept(dedup)).collect()[0]
    tt = S.ttest_returns(dedup).collect()[0]
    assert both.n == corr.n and math.isclose(both.r, corr.r, rel_tol=1e-12)
    assert math.isclose(both.corr_p, corr.p_value, rel_tol=1e-9)
    assert (both.n1, both.n2) == (tt.n1, tt.n2)
    assert math.isclose(both.t_stat, tt.t_stat, rel_tol=1e-12)
    assert math.isclose(both.t_p, tt.p_value, rel_tol=1e-9)


def _beta_cdf(a, b, r):
    """I_x(a, b) by integrating the density over log-odds around its peak: no series, no fraction."""
    import math
    n, mode = a + b, math.log(a / b)
    width = math.sqrt(n / (a * b))
    upper = -math.log(r)

    def log_density(z):      # of log-odds z = log(x / (1 - x)), up to a constant
        d = z - mode
        soft = math.log1p(a / n * math.expm1(d))
        return a * d - n * soft

    def integral(low, high, steps=20000):
        h = (high - low) / steps
        return h / 3 * sum((1 if k in (0, steps) else 4 if k % 2 else 2) * math.exp(log_density(low + k * h))
                           for k in range(steps + 1))
    low, high = mode - 12 * width, mode + 12 * width
    cut = min(max(upper, low), high)
    left, right = integral(low, cut) if cut > low else 0.0, integral(cut, high) if cut < high else 0.0
    return left / (left + right)


def test_p_values_at_huge_degrees_of_freedom(spark):
    import math

    import pytest
    from pyspark.sql import functions as F

    from tillroll.functions.betainc import f_test_p, t_test_p
    cases = [(f, d1, d2) for d1 in (1e6, 1e8, 1e10) for d2 in (1e6, 1e8, 1e10) for f in (0.999, 1.0, 1.0005)]
    df = spark.createDataFrame(cases, "f double, d1 double, d2 double")
    for f, d1, d2, p in df.select("*", f_test_p(F.col("f"), F.col("d1"), F.col("d2")).alias("p")).collect():
        assert p == pytest.approx(_beta_cdf(d2 / 2, d1 / 2, f * d1 / d2), abs=1e-6), (f, d1, d2)
    closed = [(f, d2) for f in (0.5, 1.0, 4.0) for d2 in (1e6, 1e8, 1e10)]
    df = spark.createDataFrame(closed, "f double, d2 double")
    for f, d2, p in df.select("*", f_test_p(F.col("f"), F.lit(2.0), F.col("d2")).alias("p")).collect():
        assert p == pytest.approx(math.exp(-d2 / 2 * math.log1p(2 * f / d2)), rel=1e-9)
    df = spark.createDataFrame([(t, d) for t in (0.1, 1.0, 2.5, 6.0) for d in (1e6, 1e8, 1e10)], "t double, d double")
    for t, d, p in df.select("*", t_test_p(F.col("t"), F.col("d")).alias("p")).collect():
        assert p == pytest.approx(math.erfc(t / math.sqrt(2)), abs=1e-6)


def test_an_unfinished_fraction_is_no_number(spark):
    from pyspark.sql import functions as F

    from tillroll.functions.betainc import p_from_ratio
    row = spark.range(1).select(p_from_ratio(F.lit(15000.0), F.lit(15000.0), F.lit(1.0), terms=5).alias("p")).first()
    assert row.p is None

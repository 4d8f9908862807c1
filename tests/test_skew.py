"""Hot keys: one order_id with a third of all rows, one dominant salesperson."""

from tests.fixtures import make_raw
from tillroll.operators import clean as C
from tillroll.operators import questions as Q
from tillroll.operators import stats as S


def _skewed(spark):
    rows = []
    for i in range(3000):
        if i % 3 == 0:      # a third of all rows are copies of one order
            rows.append(dict(order_id="HOT", salesperson="S-HOT", quantity=i + 1,
                             return_flag="Yes" if i == 0 else "No"))
        else:
            rows.append(dict(order_id=f"O{i}", salesperson="S-HOT" if i % 3 == 1 else f"S{i % 7}",
                             quantity=1 + i % 5))
    return make_raw(spark, rows)


def test_hot_order_keeps_its_first_copy(spark):
    raw = _skewed(spark)
    dedup = {r.order_id: r.quantity for r in C.dedup_clean(raw).collect()}
    view = {r.order_id: r.quantity for r in C.sales_clean(raw).collect()}
    assert dedup["HOT"] == 1          # first copy over all rows (a return)
    assert view["HOT"] == 4           # first non-returned copy
    assert len(dedup) == 2001 and len(view) == 2001


def test_hot_salesperson_aggregates(spark):
    raw = _skewed(spark)
    clean = C.sales_clean(raw)
    q1 = {r.salesperson: r for r in Q.q1_salesperson_rank(clean).collect()}
    assert q1["S-HOT"].revenue_rank == 1
    assert q1["S-HOT"].total_orders == 1001
    a = S.anova_salesperson(C.kept_orders(raw)).collect()[0]
    assert a.groups == 8 and a.n == 2000


def test_dedup_plan_reduces_before_shuffle(spark):
    plan = C.sales_clean(_skewed(spark))._jdf.queryExecution().executedPlan().toString()
    partial = plan.find("WindowGroupLimit")
    exchange = plan.find("Exchange hashpartitioning(order_id")
    assert 0 <= exchange < plan.rfind("WindowGroupLimit") and partial >= 0


def test_first_copies_aggregation_equals_window_dedup(spark):
    import random
    rnd = random.Random(11)
    rows = [dict(order_id=rnd.choice(["HOT", "HOT", None] + [f"O{k}" for k in range(300)]),
                 quantity=rnd.randint(-5, 9), return_flag=rnd.choice(["Yes", "No", "No"]),
                 customer_name=rnd.choice(["", "C1", None]))
            for _ in range(2500)]
    raw = make_raw(spark, rows)
    from collections import Counter
    firsts = C.first_copies(raw)

    def bag(df):
        return Counter(tuple(r) for r in df.collect())
    assert bag(C.sales_clean(raw)) == bag(C.sales_clean_from_firsts(firsts))
    assert bag(C.dedup_clean(raw, True)) == bag(C.dedup_clean_from_firsts(firsts, True))

"""User SQL over registered views, and the cleaned-CSV sink."""

from tests.fixtures import make_raw
from tillroll.operators import clean as C
from tillroll.plans.catalog import read_query, register_views
from tillroll.session import scratch_path
from tillroll.sources.sinks import write_clean_csv
from tillroll.workspace import Drop


def _drop(spark):
    return Drop(spark, make_raw(spark, [
        dict(order_id="A", return_flag="Yes"), dict(order_id="A", quantity=2),
        dict(order_id="B", salesperson="S2", quantity=-3, unit_price="4.50"),
        dict(order_id="C", customer_name="", region=None)]))


def test_views_answer_user_sql(spark):
    d = _drop(spark)
    names = register_views(spark, d, prefix="t_")
    assert names == ["t_sales", "t_sales_clean", "t_targets", "t_sales_kept", "t_sales_returns"]
    r = read_query(spark, "SELECT COUNT(*) AS n, SUM(quantity) AS q FROM t_sales_clean").collect()[0]
    assert (r.n, r.q) == (3, 6)                     # A (kept copy), B (abs), C
    assert read_query(spark, "SELECT COUNT(*) AS n FROM t_sales").collect()[0].n == 4
    unknown = read_query(spark, "SELECT customer_name, region FROM t_sales_clean "
                                "WHERE order_id = 'C'").collect()[0]
    assert (unknown.customer_name, unknown.region) == ("Unknown Customer", "Unknown Region")


def test_clean_csv_round_trip(spark):
    d = _drop(spark)
    path = write_clean_csv(d.kept, scratch_path(spark, "clean-csv-test"))
    back = spark.read.schema(d.kept.schema).option("header", True).csv(path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in d.kept.collect())
    header = spark.read.text(path).filter("value LIKE 'order_id,%'").count()
    assert header >= 1

"""Hand-made raw rows (FIXTURES.md section 4)."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import types as T

from tillroll.schema import PRICE

RAW_TYPES = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("order_time", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("salesperson", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", PRICE),
    T.StructField("discount_pct", T.IntegerType()),
    T.StructField("return_flag", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("row_seq", T.StructType([T.StructField("pos", T.LongType())])),
])

DEFAULTS = dict(order_id="O1", order_date=date(2026, 6, 22), order_time="09:00:00", customer_id=1, customer_name="C1",
                region="North", city="X", salesperson="S1", category="Dairy",
                product_name="Milk", sku_id=1, quantity=1, unit_price=Decimal("10.00"),
                discount_pct=0, return_flag="No", payment_method="Cash", channel="Online")


def make_raw(spark, rows: list[dict]):
    data = []
    for i, r in enumerate(rows):
        full = {**DEFAULTS, **r}
        if not isinstance(full["unit_price"], Decimal) and full["unit_price"] is not None:
            full["unit_price"] = Decimal(str(full["unit_price"]))
        data.append(tuple(full[f.name] for f in RAW_TYPES.fields[:-1]) + ((i,),))
    return spark.createDataFrame(data, RAW_TYPES)

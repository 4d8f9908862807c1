"""Raw order lines derived from the driver's TPC-H-shaped parquet tables.

Each lineitem row becomes one raw order line (FIXTURES.md section 2).  The
star joins are inner and lossless.  nation and region are fixed-size TPC-H
tables (25 and 5 rows) and are broadcast explicitly; orders, customer,
supplier and part grow with the scale factor, so the join strategy for them
is left to Catalyst and AQE, which broadcast only below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffle-join.

Customers join the orders, which are fewer than their lines; nation and region
join last, where no shuffle follows; the lines meet the narrower dimension first
and their orders last, so that all lines of an
order lie together and their first copies are found without a further shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.clean import first_copies
from tillroll.schema import PRICE, ROW_SEQ

# Columns that fix the order of copies of one order_id.  They stand in for
# the file / line position of a real drop; equal values mean equal rows.
FIRST_COPY_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                    "l_linestatus"]


Deal = Callable[[DataFrame, list[str]], DataFrame]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` with the files that it has now."""
    return spark.read.parquet(table_path(sf_dir, name))


def _joined(spark: SparkSession, sf_dir: str, lines: DataFrame, deal: Deal | None = None) -> DataFrame:
    """Rows of lineitem with the columns of their order, customer, place, supplier and part, and ``order_date``.

    Rows are dealt by ``deal`` before the place, a fixed-size table, joins them.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("order_date"), "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")

    # 25 rows by the TPC-H definition: a proven bound, safe to broadcast.
    geo = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", "n_name", "r_name"))

    placed = orders.join(customer, orders.o_custkey == customer.c_custkey).drop("c_custkey")
    found = (lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
             .join(part, F.col("l_partkey") == part.p_partkey)
             .withColumn("l_partkey", F.col("p_partkey")).drop("p_partkey")
             .join(placed, F.col("l_orderkey") == F.col("o_orderkey")))
    if deal is not None:
        found = deal(found, FIRST_COPY_ORDER)
    return found.join(F.broadcast(geo), F.col("c_nationkey") == geo.n_nationkey)


def _return_flag() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.lit("Yes")).otherwise(F.lit("No"))


def _order_lines(joined: DataFrame, *more: str) -> DataFrame:
    qty = F.col("l_quantity")
    second = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 997) % 86400
    return joined.select(
        F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("order_id"),
        "order_date",
        # the tables have no time of day: a fixed one per order line
        F.format_string("%02d:%02d:%02d", F.floor(second / 3600), F.floor(second / 60) % 60, second % 60)
         .alias("order_time"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_custkey") % 50 == 0, F.lit("")).otherwise(F.col("c_name")).alias("customer_name"),
        F.when(F.col("l_partkey") % 100 == 7, F.lit("")).otherwise(F.col("r_name")).alias("region"),
        F.col("n_name").alias("city"),
        F.col("s_name").alias("salesperson"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("product_name"),
        F.col("l_partkey").alias("sku_id"),
        F.when((F.col("l_partkey") + F.col("l_suppkey")) % 100 == 3, -qty)
         .otherwise(qty).cast("int").alias("quantity"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        _return_flag().alias("return_flag"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("channel"),
        F.struct(*[F.col(c) for c in FIRST_COPY_ORDER]).alias(ROW_SEQ),
        *more,
    )


def raw_sales(spark: SparkSession, sf_dir: str, deal: Deal | None = None) -> DataFrame:
    """One raw order line per lineitem row, plus the hidden ``row_seq``.

    ``deal`` (rows, columns of their place) deals rows to tasks by ``order_date``
    and place; the columns that follow from others are made behind it.
    """
    return _order_lines(_joined(spark, sf_dir, read_table(spark, sf_dir, "lineitem"), deal))


def raw_first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clean.first_copies`` of ``raw_sales``, found where the last join has brought an order's lines together.

    An order_id is one (l_orderkey, l_linenumber).  Lines without a number have
    no order_id, which is one key over all orders, so they go by themselves.
    """
    lines = read_table(spark, sf_dir, "lineitem")
    numbered = _joined(spark, sf_dir, lines.filter("l_linenumber is not null")).withColumn("return_flag", _return_flag())
    found = _order_lines(first_copies(numbered, ["l_orderkey", "l_linenumber"], FIRST_COPY_ORDER), "is_first")
    unnumbered = lines.filter("l_linenumber is null")
    if unnumbered.isEmpty():
        return found
    return found.unionByName(first_copies(_order_lines(_joined(spark, sf_dir, unnumbered))))

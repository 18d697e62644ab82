"""Our feeds and tables as views over the driver's parquet tables.

Every view covers its whole source tables. Money is decimal, so that sums do
not depend on row order and compare exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.picks import pick_one

AS_OF = "2001-08-01"
INVENTORY_AS_OF = "2001-11-05"
RUN_TS = "2001-08-01 00:00:00"
FIRST_LOAD = "1995-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str):
    return F.col(column).cast("string")


def _price():
    return F.col("p_retailprice").cast("decimal(10,2)")


def _line_id():
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def order_lines(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """One row per (order, line number): the table repeats that pair.

    ``by_order`` deals the lines by their order alone, so that a join with the orders
    does not move them again.
    """
    order = [
        F.col("l_shipdate").desc(),
        F.col("l_partkey"),
        F.col("l_suppkey"),
        F.col("l_extendedprice"),
        F.col("l_quantity"),
    ]
    lines = table(spark, sf_dir, "lineitem")
    if by_order:
        lines = lines.repartition("l_orderkey")
    return pick_one(lines, ["l_orderkey", "l_linenumber"], order)


def raw_orders(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines as orders; unit price comes from the part."""
    lines = order_lines(spark, sf_dir, by_order=True) if lines is None else lines
    heads = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return (
        lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            _line_id().alias("order_id"),
            _text("o_custkey").alias("customer_id"),
            _text("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            _price().alias("unit_price"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("total_amount"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").cast("timestamp").alias("order_timestamp"),
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_orders(spark, sf_dir).withColumn(
        "processed_timestamp", F.lit(RUN_TS).cast("timestamp")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = (F.col("p_partkey") % 365).cast("int")
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("S"), F.col("p_size") % 3).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        (_price() * F.lit("0.6").cast("decimal(2,1)")).alias("cost_price"),
        (F.col("p_size") * 2).cast("double").alias("popularity_score"),
        F.date_sub(F.lit(AS_OF).cast("date"), age).alias("launch_date"),
        (F.col("p_partkey") % 4 != 0).alias("is_active"),
        F.lit(RUN_TS).cast("timestamp").alias("processed_timestamp"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenure = (F.col("c_custkey") % 1095).cast("int")
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat("c_name", F.lit("@x.test")).alias("email"),
        _text("c_nationkey").alias("city"),
        _text("c_nationkey").alias("state"),
        F.date_add(F.lit("1995-01-01").cast("date"), tenure).alias("signup_date"),
        F.col("c_mktsegment").alias("loyalty_tier"),
        F.concat(F.lit("P"), F.col("c_custkey") % 6).alias("preferred_category"),
        F.lit(RUN_TS).cast("timestamp").alias("processed_timestamp"),
    )


def raw_movements(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines as stock movements, typed by return flag and line status."""
    lines = order_lines(spark, sf_dir) if lines is None else lines
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    units = F.col("l_quantity").cast("int")
    kind = (
        F.when(flag == "R", "STOCK_IN")
        .when((flag == "A") & (status == "F"), "ADJUSTMENT")
        .when(flag == "A", "STOCK_OUT")
        .otherwise("SALE")
    )
    change = (
        F.when(flag == "R", units)
        .when((flag == "A") & (status == "F"), units % 21 - 10)
        .otherwise(-units)
    )
    return lines.select(
        _line_id().alias("inventory_event_id"),
        _text("l_partkey").alias("product_id"),
        (F.col("l_suppkey") % 4).cast("string").alias("warehouse_id"),
        kind.alias("movement_type"),
        change.alias("quantity_change"),
        F.col("l_shipdate").cast("timestamp").alias("event_timestamp"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as clicks; a session is a user's day."""
    kind = F.col("event_type")
    step = (
        F.when(kind == "view", "view_product")
        .when(kind == "click", "add_to_cart")
        .when(kind == "signup", "checkout")
        .when((kind == "purchase") & (F.col("value") >= 80), "purchase")
        .otherwise("remove_from_cart")
    )
    return table(spark, sf_dir, "events").select(
        F.concat("user_id", F.lit("_"), F.to_date("ts")).alias("session_id"),
        _text("user_id").alias("customer_id"),
        step.alias("event_type"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order line row, so a repeated line is paid in parts."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.lit("PAY"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
            "payment_id"
        ),
        _line_id().alias("order_id"),
        F.col("l_returnflag").alias("payment_method"),
        F.col("l_linestatus").alias("payment_status"),
        F.lit("INR").alias("currency"),
        F.col("l_shipdate").cast("timestamp").alias("payment_timestamp"),
    )


def first_product_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed of the first load: every part inserted, cells as text."""
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("S"), F.col("p_size") % 3).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        _text("p_retailprice").alias("price"),
        (_price() * F.lit("0.6").cast("decimal(2,1)")).cast("string").alias("cost_price"),
        _text("p_size").alias("popularity_score"),
        F.lit("1995-01-01").alias("launch_date"),
        F.lit("True").alias("is_active"),
        F.lit("I").alias("operation"),
        F.lit(FIRST_LOAD).alias("source_updated_at"),
    )


def product_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed with many events per product: each order line changes its part.

    The return flag decides the operation (N updates, A inserts, R deletes); the
    ship date is the event time. Text is padded and codes are lower case.
    """
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_brand")
    flag = F.col("l_returnflag")
    operation = F.when(flag == "N", " u").when(flag == "A", "i ").otherwise("d")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit(" "), _text("l_partkey")).alias("product_id"),
            F.concat("p_name", F.lit("  ")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("S"), F.col("p_size") % 3).alias("subcategory"),
            F.col("p_brand").alias("brand"),
            price.cast("string").alias("price"),
            (price * F.lit("0.6").cast("decimal(2,1)")).cast("string").alias("cost_price"),
            _text("l_quantity").alias("popularity_score"),
            F.lit("1995-01-01").alias("launch_date"),
            F.lit("True").alias("is_active"),
            operation.alias("operation"),
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("source_updated_at"),
        )
    )

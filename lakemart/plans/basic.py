"""Single-aggregate marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.guards import any_when, mean_of, sum_when


def sessions(clicks: DataFrame) -> DataFrame:
    """Per session and customer: events, first and last time, purchase flag, length."""
    grouped = clicks.groupBy("session_id", "customer_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        any_when(F.col("event_type") == "purchase").alias("purchased"),
    )
    seconds = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    return grouped.withColumn("session_duration_seconds", seconds)


def customer_metrics_basic(orders: DataFrame) -> DataFrame:
    """Per customer: orders, money spent, mean order value, units."""
    amount = F.col("total_amount")
    spent = F.sum(amount)
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        spent.cast("double").alias("total_spent"),
        mean_of(spent, F.count(amount)).alias("avg_order_value"),
        F.sum("quantity").alias("total_quantity_purchased"),
    )


def daily_sales_basic(orders: DataFrame) -> DataFrame:
    """Per order date: orders, revenue, mean order value, distinct customers."""
    amount = F.col("total_amount")
    revenue = F.sum(amount)
    return (
        orders.withColumn("order_date", F.to_date("order_timestamp"))
        .groupBy("order_date")
        .agg(
            F.count("order_id").alias("total_orders"),
            revenue.cast("double").alias("total_revenue"),
            mean_of(revenue, F.count(amount)).alias("avg_order_value"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )


def inventory_health_basic(movements: DataFrame) -> DataFrame:
    """Per product and warehouse: movements, net change, units in and out by sign."""
    change = F.col("quantity_change")
    return movements.groupBy("product_id", "warehouse_id").agg(
        F.count("inventory_event_id").alias("total_movements"),
        F.sum(change).alias("net_inventory_change"),
        sum_when(change > 0, change).alias("total_stock_in"),
        sum_when(change < 0, -change).alias("total_stock_out"),
    )


def top_products(orders: DataFrame) -> DataFrame:
    """Per product: orders, units, revenue, mean price. All products, unsorted."""
    price = F.col("unit_price")
    return orders.groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("total_amount").cast("double").alias("total_revenue"),
        mean_of(F.sum(price), F.count(price)).alias("avg_selling_price"),
    )

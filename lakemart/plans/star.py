"""Star schema and revenue reports. Build the fact first: the calendar reads it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart import schemas

CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "city", "state",
    "loyalty_tier", "signup_date", "processed_timestamp",
)
PRODUCT_COLUMNS = (
    "product_id", "product_name", "category", "brand", "price",
    "launch_date", "is_active", "processed_timestamp",
)


def fact_orders(orders: DataFrame) -> DataFrame:
    """The fact's ten columns, money as decimal(10,2); other columns are left behind.

    Serves the first build and every later load. An amount that does not fit
    stops the job.
    """
    return schemas.conform(orders, schemas.FACT_ORDERS, on_bad_value="fail")


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(*CUSTOMER_COLUMNS).distinct()


def dim_product(products: DataFrame) -> DataFrame:
    """Distinct product rows. A second load of a product has another
    ``processed_timestamp`` and stays a second row, so feed one version each."""
    return products.select(*PRODUCT_COLUMNS).distinct()


def dim_date(fact: DataFrame) -> DataFrame:
    """Calendar of the days with orders.

    Every attribute follows from the date, so only the date is made distinct.
    """
    day = F.col("full_date")
    return (
        fact.select(F.to_date("order_timestamp").alias("full_date"))
        .distinct()
        .select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.quarter(day).alias("quarter"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.date_format(day, "EEEE").alias("weekday_name"),
        )
    )


def revenue_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category, highest first.

    The fact is summed per product before the join: map-side sums leave one row
    per product and task, so neither a hot product nor the fact's size reaches
    the join.
    """
    per_product = fact.groupBy("product_id").agg(F.sum("total_amount").alias("revenue"))
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "category")
    )


def revenue_by_month_category(
    fact: DataFrame, products: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Revenue per year, month name and category, highest first.

    Summed per product and day first, for the same reason.
    """
    per_day = (
        fact.select("product_id", F.to_date("order_timestamp").alias("full_date"), "total_amount")
        .groupBy("product_id", "full_date")
        .agg(F.sum("total_amount").alias("revenue"))
    )
    return (
        per_day.join(calendar.select("full_date", "year", "month_name"), "full_date")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("year", "month_name", "category")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "year", "month_name", "category")
    )


ORDER_MONTH = "order_month"


def with_order_month(fact: DataFrame) -> DataFrame:
    """The fact with the month that a stored one is partitioned by; null without an order time."""
    return fact.withColumn(ORDER_MONTH, F.date_format("order_timestamp", "yyyy-MM"))


def revenue_of_period(
    fact_by_month: DataFrame, products: DataFrame, calendar: DataFrame, period: Column
) -> DataFrame:
    """Revenue per year, month name and category of the months that ``period`` picks from the calendar.

    ``period`` is a condition on year, quarter or month. The fact is stored by
    ``order_month`` and joins the calendar's months on it, so that only the folders
    of those months are opened, whatever the fact's size.
    """
    months = calendar.where(period).select(
        F.date_format("full_date", "yyyy-MM").alias(ORDER_MONTH), "year", "month_name").distinct()
    per_month = fact_by_month.groupBy("product_id", ORDER_MONTH).agg(F.sum("total_amount").alias("revenue"))
    return (
        per_month.join(months, ORDER_MONTH)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("year", "month_name", "category")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "year", "month_name", "category")
    )


def preview(table: DataFrame, n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows by ``order_by``, or any ``n`` rows without a full scan."""
    return (table.orderBy(*order_by) if order_by else table).limit(n)

"""The five gold marts.

Money columns may be double or decimal; means are taken from exact totals and
counts, and money leaves as double. ``products`` is always the current version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.functions import bands
from lakemart.functions.clock import AsOf, RunTs, as_of_date, stamp_run
from lakemart.functions.guards import (
    count_when,
    mean_of,
    ratio_or_null,
    ratio_or_zero,
    sum_when,
)
from lakemart.operators.derive import enrich_orders
from lakemart.session import settle, spread

NEW_PRODUCT_DAYS = 90


def _finish(df: DataFrame, schema, run_ts: RunTs) -> DataFrame:
    return schemas.conform(stamp_run(df, run_ts), schema, on_bad_value="fail")


def _movement(kind: str, sign: int = 1) -> Column:
    """Units moved by one movement type, outbound types counted positive."""
    units = F.col("quantity_change") * F.lit(sign)
    return sum_when(F.col("movement_type") == kind, units)


def _movement_totals() -> list[Column]:
    return [
        _movement("STOCK_IN").alias("stock_in"),
        _movement("STOCK_OUT", -1).alias("stock_out"),
        _movement("SALE", -1).alias("sales_inventory"),
        _movement("ADJUSTMENT").alias("adjustments"),
        F.sum("quantity_change").alias("net_inventory_change"),
    ]


# ---------------------------------------------------------------- daily sales


def _sales_by_group(orders: DataFrame, products: DataFrame, as_of: AsOf) -> DataFrame:
    """Everything but the customer count, per (sale_date, category, brand).

    All of it follows from per-day product totals, so orders shrink to one row
    per product and day, map-side first, before they meet the products.
    """
    per_product = orders.groupBy(F.to_date("order_timestamp").alias("sale_date"), "product_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("quantity").alias("units"),
        F.count("quantity").alias("unit_rows"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("amount_rows"),
    )
    age = F.datediff(as_of_date(as_of), F.col("launch_date"))
    # One row per product and group even if a product has several versions, so
    # distinct products can be counted by adding up.
    per_member = (
        # By product first: dealt as they are, the rows would stay in the tasks that just summed them.
        spread(enrich_orders(per_product, products), "product_id", "sale_date")
        .groupBy("sale_date", "category", "brand", "product_id")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("units").alias("units"),
            F.sum("unit_rows").alias("unit_rows"),
            F.sum("revenue").alias("revenue"),
            F.sum("amount_rows").alias("amount_rows"),
            F.sum(F.col("units") * F.col("cost_price")).alias("cost"),
            sum_when(age <= NEW_PRODUCT_DAYS, F.col("revenue")).alias("new_revenue"),
            F.max("is_active").alias("active"),
        )
    )
    known = F.col("product_id").isNotNull()
    return per_member.select(
        "sale_date",
        "category",
        "brand",
        "orders",
        "units",
        "unit_rows",
        "revenue",
        "amount_rows",
        "cost",
        "new_revenue",
        known.cast("int").alias("products"),
        (known & F.coalesce("active", F.lit(False))).cast("int").alias("active_products"),
        F.lit(0).alias("customers"),
    )


def _buyers_by_group(orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per customer seen in each (sale_date, category, brand)."""
    seen = enrich_orders(
        orders.where(F.col("customer_id").isNotNull()).select(
            F.to_date("order_timestamp").alias("sale_date"), "product_id", "customer_id"
        ),
        products,
        ("category", "brand"),
    )
    return (
        spread(seen.select("sale_date", "category", "brand", "customer_id"), "sale_date", "customer_id")
        .distinct()
        .select("sale_date", "category", "brand", F.lit(1).alias("customers"))
    )


def gold_daily_sales(
    orders: DataFrame, products: DataFrame, as_of: AsOf = None, run_ts: RunTs = None
) -> DataFrame:
    """Daily sales per category and brand, with profit, growth and trend.

    "Previous day" is the group's previous row, however long ago. New-product
    revenue goes by the product's age on ``as_of``, not on the sale date.
    """
    return _with_growth(sales_totals(orders, products, as_of), run_ts)


def sales_totals(orders: DataFrame, products: DataFrame, as_of: AsOf = None) -> DataFrame:
    """What a sale day's orders alone decide, per (sale_date, category, brand)."""
    group = ["sale_date", "category", "brand"]
    parts = _sales_by_group(orders, products, as_of).unionByName(
        _buyers_by_group(orders, products), allowMissingColumns=True
    )
    return parts.groupBy(*group).agg(
        F.sum("orders").alias("total_orders"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.sum("customers").alias("unique_customers"),
        F.sum("products").alias("unique_products"),
        mean_of(F.sum("revenue"), F.sum("amount_rows")).alias("average_order_value"),
        mean_of(F.sum("units"), F.sum("unit_rows")).alias("average_order_quantity"),
        F.sum("cost").cast("double").alias("estimated_cost"),
        F.sum("active_products").alias("active_products_sold"),
        F.sum("new_revenue").cast("double").alias("new_product_revenue"),
    )


def _with_growth(totals: DataFrame, run_ts: RunTs) -> DataFrame:
    by_day = Window.partitionBy("category", "brand").orderBy("sale_date")
    return sales_of(
        totals.withColumn("previous_day_revenue", F.lag("total_revenue").over(by_day)), run_ts)


def sales_of(totals: DataFrame, run_ts: RunTs = None) -> DataFrame:
    """The daily-sales rows of totals that know their group's previous revenue."""
    revenue, previous = F.col("total_revenue"), F.col("previous_day_revenue")
    out = (
        totals.withColumn("gross_profit", revenue - F.col("estimated_cost"))
        .withColumn("gross_margin_percent", ratio_or_zero(F.col("gross_profit"), revenue, 100))
        .withColumn("daily_growth_percent", ratio_or_null(revenue - previous, previous, 100))
        .withColumn("sales_trend", bands.sales_trend(F.col("daily_growth_percent")))
    )
    return _finish(out, schemas.GOLD_DAILY_SALES, run_ts)


# ----------------------------------------------------------- inventory health


def gold_inventory_health(
    movements: DataFrame, products: DataFrame, as_of: AsOf = None, run_ts: RunTs = None
) -> DataFrame:
    """Stock flow per product and warehouse, consumption ratio, status and rank.

    Ranks order a product's warehouses by number of events, ties by warehouse.
    """
    per_warehouse = movements.groupBy("product_id", "warehouse_id").agg(
        F.count(F.lit(1)).alias("total_inventory_events"),
        *_movement_totals(),
        F.max("event_timestamp").alias("last_inventory_event"),
    )
    named = products.select(
        "product_id", "product_name", "category", "subcategory", "brand", "is_active"
    )
    by_activity = Window.partitionBy("product_id").orderBy(
        F.col("total_inventory_events").desc(), F.col("warehouse_id").asc()
    )
    outbound = F.col("stock_out") + F.col("sales_inventory")
    out = (
        per_warehouse.join(named, "product_id", "left")
        .withColumns(
            {
                "days_since_last_inventory_event": F.datediff(
                    as_of_date(as_of), F.col("last_inventory_event")
                ),
                "total_outbound": outbound,
                "inventory_consumption_ratio": ratio_or_null(outbound, F.col("stock_in")),
                "warehouse_activity_rank": F.row_number().over(by_activity),
            }
        )
        .withColumn(
            "inventory_status", bands.inventory_status(F.col("inventory_consumption_ratio"))
        )
    )
    return _finish(out, schemas.GOLD_INVENTORY_HEALTH, run_ts)


# -------------------------------------------------------- product performance

_PRODUCT_FILLS = (
    "total_orders", "units_sold", "total_revenue", "average_order_quantity", "unique_customers",
    "stock_in", "stock_out", "adjustments", "sales_inventory", "net_inventory_change",
)


def _product_totals(products: DataFrame, orders: DataFrame, movements: DataFrame) -> DataFrame:
    """Every product with its sales and stock totals, zero-filled."""
    sales = orders.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("quantity").alias("units_sold"),
        F.sum("total_amount").alias("total_revenue"),
        mean_of(F.sum("quantity"), F.count("quantity")).alias("average_order_quantity"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.min("order_timestamp").alias("first_sale_date"),
        F.max("order_timestamp").alias("last_sale_date"),
    )
    stock = movements.groupBy("product_id").agg(*_movement_totals())
    return (
        products.join(sales, "product_id", "left")
        .join(stock, "product_id", "left")
        .fillna(dict.fromkeys(_PRODUCT_FILLS, 0))
    )


def gold_product_performance(
    products: DataFrame,
    orders: DataFrame,
    movements: DataFrame,
    as_of: AsOf = None,
    run_ts: RunTs = None,
    settle_totals: bool = False,
) -> DataFrame:
    """Every product with its sales, stock flow, profit and classification.

    Metrics of a product without sales or movements are 0 and count in the
    mean revenue; its sale dates stay NULL.

    The mean is a one-row subquery. It needs only revenue, so by default it
    scans two columns of the orders once more and shuffles one sum per product
    and task. With ``settle_totals`` the product totals (one row per product)
    are computed now into the checkpoint folder and the mean is read off them,
    so orders are scanned once.
    """
    totals = _product_totals(products, orders, movements)
    if settle_totals:
        totals = settle(totals)
    mean_revenue = totals.agg(mean_of(F.sum("total_revenue"), F.count("total_revenue"))).scalar()
    revenue, cost = F.col("total_revenue"), F.col("estimated_cost")
    out = (
        totals.withColumns(
            {
                "total_revenue": revenue.cast("double"),
                "days_since_last_sale": F.datediff(as_of_date(as_of), F.col("last_sale_date")),
                "estimated_cost": F.col("units_sold") * F.col("cost_price").cast("double"),
                "average_product_revenue": mean_revenue,
            }
        )
        .withColumn("gross_profit", revenue - cost)
        .withColumns(
            {
                "gross_margin_percent": ratio_or_zero(F.col("gross_profit"), revenue, 100),
                "product_status": bands.product_status(revenue, F.col("average_product_revenue")),
                "inventory_risk": bands.inventory_risk(F.col("net_inventory_change")),
                "sales_vs_popularity": bands.sales_vs_popularity(
                    F.col("units_sold"), F.col("popularity_score")
                ),
            }
        )
    )
    return _finish(out, schemas.GOLD_PRODUCT_PERFORMANCE, run_ts)


# ---------------------------------------------------------- conversion funnel


def gold_conversion_funnel(clicks: DataFrame, run_ts: RunTs = None) -> DataFrame:
    """Stage counts and conversion rates per product.

    Stages are counted independently: a rate may pass 100 and an abandonment
    may be negative. Removals from the cart are not a stage.
    """
    event = F.col("event_type")
    totals = (
        clicks.groupBy("product_id")
        .agg(
            count_when(event == "view_product").alias("product_views"),
            count_when(event == "add_to_cart").alias("cart_additions"),
            count_when(event == "checkout").alias("checkout_starts"),
            count_when(event == "purchase").alias("purchases"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_distinct("session_id").alias("unique_sessions"),
        )
    )
    return funnel_of(totals, run_ts)


def funnel_of(totals: DataFrame, run_ts: RunTs = None) -> DataFrame:
    """The funnel's rates and status from its stage and distinct counts per product."""
    views, carts = F.col("product_views"), F.col("cart_additions")
    checkouts, purchases = F.col("checkout_starts"), F.col("purchases")
    out = (
        totals.withColumns(
            {
                "view_to_cart_rate": ratio_or_zero(carts, views, 100),
                "cart_to_checkout_rate": ratio_or_zero(checkouts, carts, 100),
                "checkout_to_purchase_rate": ratio_or_zero(purchases, checkouts, 100),
                "overall_conversion_rate": ratio_or_zero(purchases, views, 100),
                "cart_abandonments": carts - checkouts,
                "checkout_abandonments": checkouts - purchases,
            }
        )
        .withColumn("funnel_status", bands.funnel_status(F.col("overall_conversion_rate")))
    )
    return _finish(out, schemas.GOLD_CONVERSION_FUNNEL, run_ts)


# ----------------------------------------------------------- customer metrics

_CUSTOMER_FILLS = (
    "total_orders", "total_quantity", "total_revenue", "average_order_value",
    "highest_order_value", "lowest_order_value", "average_order_quantity",
)


def _customer_profiles(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order metrics, favourites and latest purchase, one row per customer.

    Orders are summed per (customer, category, brand) first, which combines
    map-side and spreads even a hot customer. What is left of a customer, at
    most one row per category and brand of the catalogue, then moves once, and
    totals, both favourites and the latest purchase are read off that exchange.
    """
    bought = enrich_orders(
        orders.where(F.col("customer_id").isNotNull()), products, ("category", "brand")
    )
    cells = (
        spread(bought, "customer_id", "product_id").groupBy("customer_id", "category", "brand")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("quantity").alias("units"),
            F.count("quantity").alias("unit_rows"),
            F.sum("total_amount").alias("revenue"),
            F.count("total_amount").alias("amount_rows"),
            F.max("total_amount").alias("highest"),
            F.min("total_amount").alias("lowest"),
            F.min("order_timestamp").alias("first_at"),
            F.max("order_timestamp").alias("last_at"),
        )
        .repartition("customer_id")
    )
    in_category = Window.partitionBy("customer_id", "category")
    in_brand = Window.partitionBy("customer_id", "brand")
    counted = cells.withColumn("category_orders", F.sum("orders").over(in_category)).withColumn(
        "brand_orders", F.sum("orders").over(in_brand)
    )
    # Smallest struct = first in order: most orders, then name, NULL before any name.
    favorite_category = F.min(F.struct(-F.col("category_orders"), F.col("category")))
    favorite_brand = F.min(F.struct(-F.col("brand_orders"), F.col("brand")))
    # Latest time first, a missing time last; same-time orders by category, then brand.
    latest = F.min(
        F.struct(
            F.col("last_at").isNull(),
            -F.unix_micros("last_at"),
            F.col("category"),
            F.col("brand"),
            F.col("last_at"),
        )
    )
    return (
        counted.groupBy("customer_id")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("units").alias("total_quantity"),
            F.sum("revenue").cast("double").alias("total_revenue"),
            mean_of(F.sum("revenue"), F.sum("amount_rows")).alias("average_order_value"),
            F.max("highest").cast("double").alias("highest_order_value"),
            F.min("lowest").cast("double").alias("lowest_order_value"),
            mean_of(F.sum("units"), F.sum("unit_rows")).alias("average_order_quantity"),
            F.min("first_at").alias("first_purchase_date"),
            F.max("last_at").alias("last_purchase_date"),
            favorite_category.alias("c"),
            favorite_brand.alias("b"),
            latest.alias("l"),
        )
        .withColumns(
            {
                "favorite_category": F.col("c.category"),
                "favorite_brand": F.col("b.brand"),
                "most_recent_category": F.col("l.category"),
                "most_recent_brand": F.col("l.brand"),
                "most_recent_purchase_timestamp": F.col("l.last_at"),
            }
        )
        .drop("c", "b", "l")
    )


def gold_customer_metrics(
    customers: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    as_of: AsOf = None,
    run_ts: RunTs = None,
) -> DataFrame:
    """Every customer with order metrics, favourites, latest purchase and status."""
    today = as_of_date(as_of)
    last = F.col("last_purchase_date")
    out = (
        customers.join(_customer_profiles(orders, products), "customer_id", "left")
        .fillna(dict.fromkeys(_CUSTOMER_FILLS, 0))
        .withColumns(
            {
                "days_since_last_purchase": F.datediff(today, last),
                "customer_tenure_days": F.datediff(today, F.col("signup_date")),
            }
        )
        .withColumn(
            "customer_status", bands.customer_status(last, F.col("days_since_last_purchase"))
        )
    )
    return _finish(out, schemas.GOLD_CUSTOMER_METRICS, run_ts)

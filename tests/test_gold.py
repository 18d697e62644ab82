"""Marts on hand-written rows and against brute force, NULL and zero branches included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.checks import testdata as td
from lakemart.plans import basic, gold, star
from tests.helpers import frame, rows_by, ts

AS_OF, RUN = "2024-06-30", "2024-06-30 08:00:00"


def order(i, customer, product, qty, amount, at):
    return (i, customer, product, qty, 1, amount, "UPI", "Placed", at)


@pytest.fixture(scope="module")
def products(spark):
    def row(p, category, brand, cost, launched, active, popularity=10):
        return (p, f"name {p}", category, "sub", brand, cost, 2, popularity, launched, active)

    return frame(
        spark,
        schemas.PRODUCTS,
        [
            row("a1", "A", "x", 2, "2024-06-01", True),
            row("a2", "A", "x", 3, "2020-01-01", False),
            row("ay", "A", "y", 4, "2020-01-01", True),
            row("n", "N", "n", None, None, None),
            row("idle", "A", "y", 1, "2020-01-01", True, 0),
        ],
    )


@pytest.fixture(scope="module")
def orders(spark):
    return frame(
        spark,
        schemas.ORDERS,
        [
            order("1", "c1", "a1", 2, 10, "2024-06-01 10:00:00"),
            order("2", "c1", "a2", 1, 10, "2024-06-01 11:00:00"),
            order("3", "c2", "a1", 1, 4, "2024-06-01 12:00:00"),
            order("4", "c2", "a1", 1, 30, "2024-06-10 12:00:00"),
            order("5", "c1", "ay", 1, 0, "2024-06-01 12:00:00"),
            order("6", "c1", "ay", 1, 5, "2024-06-02 12:00:00"),
            order("7", "c1", "ay", 1, 4, "2024-06-03 12:00:00"),
            order("8", None, "n", None, None, "2024-06-01 12:00:00"),
            order("9", "c3", "unknown", 1, 7, "2024-06-01 12:00:00"),
            order("10", "c3", None, 1, 7, "2024-06-01 12:00:00"),
        ],
    )


def test_daily_sales(orders, products):
    mart = gold.gold_daily_sales(orders, products, AS_OF, RUN)
    assert mart.schema.names == schemas.GOLD_DAILY_SALES.names
    got = rows_by(mart, "sale_date", "category", "brand")
    first = got[dt.date(2024, 6, 1), "A", "x"]
    assert (first.total_orders, first.units_sold, first.total_revenue) == (3, 4, 24.0)
    assert (first.unique_customers, first.unique_products, first.active_products_sold) == (2, 2, 1)
    assert (first.average_order_value, first.average_order_quantity) == (8.0, 4 / 3)
    assert (first.estimated_cost, first.gross_profit) == (9.0, 15.0)
    assert first.gross_margin_percent == 15 / 24 * 100
    assert first.new_product_revenue == 14.0, "by the product's age on the run date"
    assert (first.previous_day_revenue, first.sales_trend) == (None, "New")
    later = got[dt.date(2024, 6, 10), "A", "x"]
    assert later.previous_day_revenue == 24.0, "previous row, nine days back"
    assert (later.daily_growth_percent, later.sales_trend) == (25.0, "High Growth")
    zero, after_zero, down = (got[dt.date(2024, 6, d), "A", "y"] for d in (1, 2, 3))
    assert (zero.total_revenue, zero.gross_profit, zero.gross_margin_percent) == (0.0, -4.0, 0.0)
    assert (after_zero.previous_day_revenue, after_zero.daily_growth_percent) == (0.0, None)
    assert after_zero.sales_trend == "New" and down.sales_trend == "Declining"
    blank = got[dt.date(2024, 6, 1), "N", "n"]
    assert (blank.total_orders, blank.units_sold, blank.total_revenue) == (1, None, None)
    assert (blank.unique_customers, blank.unique_products, blank.active_products_sold) == (0, 1, 0)
    assert (blank.estimated_cost, blank.gross_margin_percent) == (None, None)
    assert (blank.average_order_value, blank.new_product_revenue) == (None, 0.0)
    stray = got[dt.date(2024, 6, 1), None, None]
    assert (stray.total_orders, stray.unique_products, stray.unique_customers) == (2, 1, 1)
    assert (first.year, first.month, first.day) == (2024, 6, 30)


def test_daily_sales_keeps_row_grain_meaning_under_product_versions(spark, orders, products):
    """With several versions of a product, counts still equal the row-grain aggregate."""
    doubled = products.unionByName(products.where("product_id = 'a1'"))
    joined = orders.join(doubled, "product_id", "left")
    want = joined.groupBy(F.to_date("order_timestamp").alias("sale_date"), "category", "brand").agg(
        F.count("*").alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct(F.when(F.col("is_active"), F.col("product_id"))).alias("active_products_sold"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum(F.col("quantity") * F.col("cost_price")).alias("estimated_cost"),
    )
    got = gold.gold_daily_sales(orders, doubled, AS_OF, RUN).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_inventory_health(spark, products):
    def move(i, product, warehouse, kind, change, at="2024-06-20 00:00:00"):
        return (i, product, warehouse, kind, change, at)

    movements = frame(
        spark,
        schemas.INVENTORY,
        [
            move("1", "a1", "w1", "STOCK_IN", 10),
            move("2", "a1", "w1", "STOCK_OUT", -4, "2024-06-25 23:00:00"),
            move("3", "a1", "w1", "SALE", -3),
            move("4", "a1", "w1", "ADJUSTMENT", -2),
            move("5", "a1", "w3", "SALE", -3),
            move("6", "a1", "w2", "STOCK_IN", 3),
            move("7", "a1", "w4", "AUDIT", 9),
            move("8", "a1", "w4", "STOCK_IN", 1),
            move("9", "ghost", "w1", "STOCK_IN", 4),
            move("10", "ghost", "w1", "SALE", -4),
        ],
    )
    mart = gold.gold_inventory_health(movements, products, AS_OF, RUN)
    assert mart.schema.names == schemas.GOLD_INVENTORY_HEALTH.names
    got = rows_by(mart, "product_id", "warehouse_id")
    w1 = got["a1", "w1"]
    assert (w1.stock_in, w1.stock_out, w1.sales_inventory, w1.adjustments) == (10, 4, 3, -2)
    assert (w1.total_outbound, w1.net_inventory_change, w1.total_inventory_events) == (7, 1, 4)
    assert (w1.inventory_consumption_ratio, w1.inventory_status) == (0.7, "Watch")
    assert (w1.last_inventory_event, w1.days_since_last_inventory_event) == (ts("2024-06-25 23:00"), 5)
    assert got["a1", "w3"].inventory_status == "Unknown"
    assert got["a1", "w2"].inventory_status == "Healthy"
    w4 = got["a1", "w4"]
    assert (w4.net_inventory_change, w4.stock_in, w4.total_inventory_events) == (10, 1, 2)
    ranks = {w: got["a1", w].warehouse_activity_rank for w in ("w1", "w2", "w3", "w4")}
    assert ranks == {"w1": 1, "w4": 2, "w2": 3, "w3": 4}, "ties by warehouse"
    ghost = got["ghost", "w1"]
    assert (ghost.product_name, ghost.inventory_status) == (None, "Critical")
    signs = rows_by(basic.inventory_health_basic(movements), "product_id", "warehouse_id")
    assert (signs["a1", "w1"].total_stock_in, signs["a1", "w1"].total_stock_out) == (10, 9)
    assert signs["a1", "w4"].total_stock_in == 10, "by sign, whatever the type"


@pytest.mark.parametrize("settle_totals", [False, True])
def test_product_performance(spark, orders, products, settle_totals):
    movements = frame(
        spark,
        schemas.INVENTORY,
        [
            ("1", "a1", "w1", "STOCK_OUT", -101, "2024-06-20 00:00:00"),
            ("2", "ay", "w1", "SALE", -100, "2024-06-20 00:00:00"),
        ],
    )
    mart = gold.gold_product_performance(products, orders, movements, AS_OF, RUN, settle_totals)
    assert mart.schema.names == schemas.GOLD_PRODUCT_PERFORMANCE.names
    got = rows_by(mart, "product_id")
    assert set(got) == {"a1", "a2", "ay", "n", "idle"}
    mean = (44 + 10 + 9 + 0 + 0) / 5
    assert {r.average_product_revenue for r in got.values()} == {mean}, "unsold products count"
    a1 = got["a1"]
    assert (a1.total_orders, a1.units_sold, a1.total_revenue, a1.unique_customers) == (3, 4, 44.0, 2)
    assert (a1.estimated_cost, a1.gross_profit) == (8.0, 36.0)
    assert (a1.product_status, a1.inventory_risk) == ("Best Seller", "Low Stock Risk")
    assert a1.sales_vs_popularity == "Underperforming"
    assert (a1.first_sale_date, a1.days_since_last_sale) == (ts("2024-06-01 10:00"), 20)
    assert got["a2"].product_status == "Slow Moving"
    assert got["ay"].inventory_risk == "Healthy"
    idle = got["idle"]
    assert (idle.total_orders, idle.total_revenue, idle.gross_margin_percent) == (0, 0.0, 0.0)
    assert (idle.first_sale_date, idle.days_since_last_sale) == (None, None)
    assert idle.sales_vs_popularity == "On Track"
    blank = got["n"]
    assert (blank.total_orders, blank.units_sold, blank.total_revenue) == (1, 0, 0.0)
    assert (blank.estimated_cost, blank.gross_margin_percent) == (None, 0.0)


def test_product_status_good_performer(spark, products):
    sold = frame(
        spark,
        schemas.ORDERS,
        [
            order(str(i), "c", p, 1, amount, "2024-06-01")
            for i, (p, amount) in enumerate([("a1", 30), ("a2", 20), ("ay", 0), ("n", 0), ("idle", 50)])
        ],
    )
    empty = frame(spark, schemas.INVENTORY, [])
    got = rows_by(gold.gold_product_performance(products, sold, empty, AS_OF, RUN), "product_id")
    status = {k: r.product_status for k, r in got.items()}
    assert status == {
        "a1": "Best Seller", "a2": "Good Performer", "ay": "Slow Moving",
        "n": "Slow Moving", "idle": "Best Seller",
    }


def test_conversion_funnel(spark):
    def click(session, customer, kind, product):
        return (session, customer, kind, product, "2024-06-01 00:00:00")

    clicks = frame(
        spark,
        schemas.CLICKSTREAM,
        [
            *[click(f"s{i}", "c1", "view_product", "p") for i in range(4)],
            click("s1", "c2", "add_to_cart", "p"),
            click("s1", "c2", "remove_from_cart", "p"),
            click("s1", "c2", "checkout", "p"),
            click("s1", None, "purchase", "p"),
            click("s1", "c2", "purchase", "p"),
            click("s2", "c1", "add_to_cart", "noview"),
            click("s2", "c1", "purchase", "noview"),
        ],
    )
    mart = gold.gold_conversion_funnel(clicks, RUN)
    assert mart.schema.names == schemas.GOLD_CONVERSION_FUNNEL.names
    got = rows_by(mart, "product_id")
    p = got["p"]
    assert (p.product_views, p.cart_additions, p.checkout_starts, p.purchases) == (4, 1, 1, 2)
    assert (p.unique_customers, p.unique_sessions) == (2, 4)
    assert (p.view_to_cart_rate, p.checkout_to_purchase_rate) == (25.0, 200.0), "not capped"
    assert (p.cart_abandonments, p.checkout_abandonments) == (0, -1)
    assert (p.overall_conversion_rate, p.funnel_status) == (50.0, "Excellent")
    q = got["noview"]
    assert (q.view_to_cart_rate, q.overall_conversion_rate) == (0.0, 0.0)
    assert (q.cart_to_checkout_rate, q.funnel_status) == (0.0, "Needs Attention")


def test_customer_metrics(spark, products):
    def customer(c, signup="2024-01-01"):
        return (c, "f", "l", "e", "city", "state", signup, "Gold", "Books")

    customers = frame(spark, schemas.CUSTOMERS, [customer(c) for c in ("c1", "c2", "c3", "never")])
    orders = frame(
        spark,
        schemas.ORDERS,
        [
            order("1", "c1", "a1", 2, 10, "2024-06-01 10:00:00"),
            order("2", "c1", "ay", 1, 30, "2024-05-01 10:00:00"),
            order("3", "c1", "ay", 1, 20, "2024-06-01 10:00:00"),
            order("4", "c1", "unknown", 1, 40, "2024-01-01 10:00:00"),
            order("5", "c2", "unknown", 1, 1, "2024-04-01 00:00:00"),
            order("6", "c2", "ay", 3, 5, None),
            order("7", "c3", "ay", None, None, "2024-03-31 00:00:00"),
            order("8", None, "ay", 1, 1, "2024-06-01 00:00:00"),
            order("9", "nobody", "ay", 1, 1, "2024-06-01 00:00:00"),
        ],
    )
    mart = gold.gold_customer_metrics(customers, orders, products, AS_OF, RUN)
    assert mart.schema.names == schemas.GOLD_CUSTOMER_METRICS.names
    got = rows_by(mart, "customer_id")
    assert set(got) == {"c1", "c2", "c3", "never"}
    c1 = got["c1"]
    assert (c1.total_orders, c1.total_quantity, c1.total_revenue) == (4, 5, 100.0)
    assert (c1.average_order_value, c1.average_order_quantity) == (25.0, 1.25)
    assert (c1.highest_order_value, c1.lowest_order_value) == (40.0, 10.0)
    assert (c1.favorite_category, c1.favorite_brand) == ("A", "y")
    assert (c1.most_recent_category, c1.most_recent_brand) == ("A", "x"), "same time: by name"
    assert c1.first_purchase_date == ts("2024-01-01 10:00")
    assert (c1.days_since_last_purchase, c1.customer_status) == (29, "Active")
    assert c1.customer_tenure_days == 181
    c2 = got["c2"]
    assert (c2.favorite_category, c2.favorite_brand) == (None, None), "NULL sorts before a name"
    assert c2.most_recent_purchase_timestamp == ts("2024-04-01"), "a missing time is not the latest"
    assert (c2.days_since_last_purchase, c2.customer_status) == (90, "At Risk")
    c3 = got["c3"]
    assert (c3.total_orders, c3.total_revenue, c3.average_order_value) == (1, 0.0, 0.0)
    assert (c3.days_since_last_purchase, c3.customer_status) == (91, "Inactive")
    never = got["never"]
    assert (never.total_orders, never.total_revenue, never.favorite_brand) == (0, 0.0, None)
    assert (never.customer_status, never.days_since_last_purchase) == ("Never Purchased", None)


def test_basic_marts(spark, orders):
    day = rows_by(basic.daily_sales_basic(orders), "order_date")[dt.date(2024, 6, 1)]
    assert (day.total_orders, day.total_revenue, day.unique_customers) == (7, 38.0, 3)
    assert day.avg_order_value == 38 / 6, "an unknown amount is not averaged"
    c1 = rows_by(basic.customer_metrics_basic(orders), "customer_id")["c1"]
    assert (c1.total_orders, c1.total_spent, c1.total_quantity_purchased) == (5, 29.0, 6)
    a1 = rows_by(basic.top_products(orders), "product_id")["a1"]
    assert (a1.total_orders, a1.total_quantity_sold, a1.avg_selling_price) == (3, 4, 1.0)


def test_sessions(spark):
    clicks = frame(
        spark,
        schemas.CLICKSTREAM,
        [
            ("s", "c", "view_product", "p", "2024-06-01 00:00:00.9"),
            ("s", "c", "purchase", "p", "2024-06-01 00:01:01.1"),
            ("s", "d", "view_product", "p", "2024-06-01 00:00:00"),
            ("t", "c", "view_product", "p", None),
        ],
    )
    got = rows_by(basic.sessions(clicks), "session_id", "customer_id")
    assert (got["s", "c"].total_events, got["s", "c"].purchased) == (2, 1)
    assert got["s", "c"].session_duration_seconds == 61, "whole seconds of each end"
    assert got["s", "d"].purchased == 0 and got["s", "d"].session_duration_seconds == 0
    assert got["t", "c"].session_duration_seconds is None


def test_star(spark, orders, products):
    stamped = orders.withColumn("processed_timestamp", F.lit(RUN).cast("timestamp"))
    fact = star.fact_orders(stamped)
    assert fact.schema == schemas.FACT_ORDERS
    too_big = stamped.withColumn("total_amount", F.lit(1e9))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CANNOT_CHANGE_DECIMAL"):
        star.fact_orders(too_big).collect()
    twice = products.withColumn("processed_timestamp", F.lit(RUN).cast("timestamp"))
    assert star.dim_product(twice.unionByName(twice)).count() == 5
    reloaded = twice.unionByName(twice.withColumn("processed_timestamp", F.current_timestamp()))
    assert star.dim_product(reloaded).count() == 10, "a later load does not collapse"
    rows = [tuple(r) for r in star.revenue_by_category(fact, star.dim_product(twice)).collect()]
    assert [(c, None if v is None else float(v)) for c, v in rows] == [("A", 63.0), ("N", None)]
    double = star.revenue_by_category(fact, star.dim_product(reloaded)).first()
    assert float(double.revenue) == 126.0, "every version of a product adds its revenue"
    calendar = star.dim_date(fact)
    june = rows_by(calendar, "full_date")[dt.date(2024, 6, 10)]
    assert (june.year, june.month, june.day, june.quarter) == (2024, 6, 10, 2)
    assert (june.month_name, june.weekday_name) == ("June", "Monday")
    monthly = star.revenue_by_month_category(fact, star.dim_product(twice), calendar).first()
    assert (monthly.year, monthly.month_name, monthly.category) == (2024, "June", "A")
    assert [r.order_id for r in star.preview(fact, 2, ["order_id"]).collect()] == ["1", "10"]
    assert star.preview(fact, 3).count() == 3


def test_revenue_is_conserved(spark):
    sf = "/root/testdata/sf0.001"
    orders, products = td.orders(spark, sf), td.products(spark, sf)
    want = orders.agg(F.sum("total_amount").cast("double")).first()[0]
    daily = gold.gold_daily_sales(orders, products, td.AS_OF, td.RUN_TS)
    got = daily.agg(F.sum(F.col("total_revenue").cast("decimal(20,2)")).cast("double")).first()[0]
    assert got == want
    health = gold.gold_inventory_health(td.raw_movements(spark, sf), products, td.AS_OF, td.RUN_TS)
    off = health.where("net_inventory_change <> stock_in - stock_out - sales_inventory + adjustments")
    assert off.count() == 0

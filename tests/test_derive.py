import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.operators import derive
from tests.helpers import frame, rows_by, ts


@pytest.fixture
def orders(spark):
    return frame(
        spark,
        schemas.ORDERS,
        [
            ("o1", "c1", "p1", 3, 0, 0, "UPI", "Placed", "2024-05-06 00:02:00"),
            ("o2", "c2", "p2", -2, 0, 0, "UPI", "Placed", "2024-05-06 01:00:00"),
        ],
    )


@pytest.fixture
def products(spark):
    def row(p, price):
        return (p, p, "A", "s", "b", 1, price, 1, "2024-01-01", True)

    return frame(spark, schemas.PRODUCTS, [row("p1", "9.99"), row("p2", "0.1"), row("p3", "7")])


def test_sale_movements(orders):
    got = rows_by(derive.orders_to_sale_movements(orders), "inventory_event_id")
    assert set(got) == {"INV_o1", "INV_o2"}
    assert (got["INV_o1"].quantity_change, got["INV_o2"].quantity_change) == (-3, -2)
    assert got["INV_o1"].movement_type == "SALE"
    assert got["INV_o1"].event_timestamp == ts("2024-05-06 00:02")
    assert got["INV_o1"].warehouse_id in derive.WAREHOUSES
    again = rows_by(derive.orders_to_sale_movements(orders.repartition(3)), "inventory_event_id")
    assert again == got


def test_warehouses_are_all_used(spark):
    ids = spark.range(400).select(
        F.col("id").cast("string").alias("order_id"), F.lit("p").alias("product_id"),
        F.lit(1).alias("quantity"), F.current_timestamp().alias("order_timestamp"),
    )
    used = derive.orders_to_sale_movements(ids).groupBy("warehouse_id").count().collect()
    assert {r.warehouse_id for r in used} == set(derive.WAREHOUSES)
    assert min(r["count"] for r in used) > 50


def test_funnel_events(orders):
    got = derive.orders_to_funnel_events(orders).where("session_id = 'SESS_o1'").orderBy("event_timestamp")
    assert [(r.event_type, r.event_timestamp) for r in got.collect()] == [
        ("view_product", ts("2024-05-05 23:58")),
        ("add_to_cart", ts("2024-05-05 23:59")),
        ("checkout", ts("2024-05-06 00:00")),
        ("purchase", ts("2024-05-06 00:01")),
    ]


def test_unions_keep_repeats(orders):
    moves = derive.orders_to_sale_movements(orders)
    assert derive.combine_movements(moves, moves.select(*reversed(moves.columns))).count() == 4
    events = derive.orders_to_funnel_events(orders)
    assert derive.combine_events(events, events).count() == 16


def test_price_orders(spark, orders, products):
    got = rows_by(derive.price_orders(orders, products), "order_id")
    assert (got["o1"].unit_price, got["o1"].total_amount) == (9.99, 29.97)
    assert got["o2"].total_amount == -0.2
    stranger = orders.withColumn("product_id", F.lit("nobody"))
    with pytest.raises(Exception, match="no match for product_id nobody"):
        derive.price_orders(stranger, products).collect()
    null_key = orders.withColumn("product_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="no match for product_id NULL"):
        derive.price_orders(null_key, products).collect()
    kept = derive.price_orders(stranger, products, on_unmatched="null")
    assert [r.total_amount for r in kept.collect()] == [None, None]
    with pytest.raises(ValueError):
        derive.price_orders(orders, products, on_unmatched="drop")


def test_payment_amounts(spark, orders):
    priced = orders.withColumn("total_amount", F.lit(12.5))
    pays = frame(
        spark,
        schemas.PAYMENTS,
        [(f"pay{i}", o, "Wallet", "CAPTURED", None, "INR", "2024-05-06") for i, o in enumerate(["o1", "o1", "o2"])],
    )
    got = derive.order_amount_for_payments(pays, priced)
    assert sorted(got.columns) == sorted(schemas.PAYMENTS.names)
    assert [r.amount for r in got.collect()] == [12.5] * 3


def test_enrich_replaces_stale_attributes(orders, products):
    stale = orders.withColumn("category", F.lit("old"))
    got = rows_by(derive.enrich_orders(stale, products.where("product_id <> 'p2'")), "order_id")
    assert (got["o1"].category, got["o2"].category) == ("A", None)


def test_lookup_of_a_repeated_key(spark):
    facts = spark.createDataFrame([("k",)], "key string")
    twice = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z")], "key string, n int, t string")
    with pytest.raises(Exception, match="repeated key k"):
        derive.lookup(facts, twice, "key", ["n"]).collect()
    got = derive.lookup(facts, twice, "key", ["n", "t"], on_repeated="first").collect()
    assert [tuple(r) for r in got] == [("k", 1, "z")]


def test_fact_loaded_by_day_keeps_orders_without_a_time(spark, monkeypatch):
    from lakemart.checks import queries

    fact = spark.createDataFrame(
        [(1, "1997-12-31 00:00:00"), (2, "1998-01-01 00:00:00"), (3, None)], "order_id long, at string"
    ).select("order_id", F.col("at").cast("timestamp").alias("order_timestamp"))
    monkeypatch.setattr(queries, "_fact", lambda *_: fact)
    assert sorted(r.order_id for r in queries.fact_loaded_by_day(spark, "").collect()) == [1, 2, 3]

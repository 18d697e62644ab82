"""The jobs end to end: feeds land, tables are cleaned, marts and reports are built."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.checks import testdata as td
from lakemart.jobs import JOBS, Run, main
from lakemart.operators import derive, scd2
from lakemart.plans import gold, star
from lakemart.sources import readers, writers

SF = "/root/testdata/sf0.001"
DAYS = (dt.date(2001, 7, 31), dt.date(2001, 8, 1))
RUN_TS = "2001-08-02 03:00:00"


@pytest.fixture(scope="module")
def lake(spark):
    root = tempfile.mkdtemp(prefix="run-")
    orders, products = td.orders(spark, SF), td.products(spark, SF)

    def land(df, feed, fmt="csv", at=None):
        landed = writers.land_on(df, F.lit(DAYS[0]) if at is None else at)
        writers.publish_feed(landed, f"{root}/bronze/{feed}", fmt)

    halves = F.when(F.pmod(F.hash("order_id"), F.lit(2)) == 0, F.lit(DAYS[0])).otherwise(F.lit(DAYS[1]))
    land(orders.select(*schemas.ORDERS.names), "orders", at=halves)
    land(td.customers(spark, SF).select(*schemas.CUSTOMERS.names), "customers")
    moves = derive.combine_movements(
        td.raw_movements(spark, SF), derive.orders_to_sale_movements(orders)
    )
    land(moves, "inventory")
    clicks = derive.combine_events(td.clicks(spark, SF), derive.orders_to_funnel_events(orders))
    land(clicks, "clickstream", "json")
    feed = products.select(
        *[F.col(c) for c in schemas.PRODUCTS.names],
        F.lit("I").alias("operation"),
        F.lit("1995-01-01T00:00:00").alias("source_updated_at"),
    )
    land(feed, "products/0001")

    def run(name, **more):
        JOBS[name](Run(spark, root, "2001-08-01", RUN_TS, **more))

    for day in (*DAYS, DAYS[1]):
        run("silver-orders", day=day)
    for _ in range(2):
        run("silver-products", batch_id="0001")
    for name in JOBS:
        if name not in ("silver-orders", "silver-products", "warehouse-load"):
            run(name)
    for day in (*DAYS, DAYS[1]):
        run("warehouse-load", day=day)
    for name in JOBS:
        if name.startswith("gold"):
            run(name)
    return root


def close(left, right, keys):
    """Same rows; doubles may differ in the last digits, as their sums ran in another order."""
    left, right = (d.toPandas().sort_values(keys).reset_index(drop=True) for d in (left, right))
    import pandas as pd

    pd.testing.assert_frame_equal(left[right.columns], right, rtol=1e-9, check_dtype=False)


def silver_inputs(spark):
    as_double = {c: F.col(c).cast("double") for c in ("unit_price", "total_amount")}
    return td.orders(spark, SF).withColumns(as_double), td.products(spark, SF)


def mart(spark, lake, name):
    df = readers.read_table(spark, f"{lake}/gold/{name}")
    assert df.select("year", "month", "day").distinct().collect() == [(2001, 8, 2)]
    return df


def test_silver_tables(spark, lake):
    orders, _ = silver_inputs(spark)
    silver = readers.read_table(spark, f"{lake}/silver/orders")
    assert silver.count() == orders.count(), "a day run twice is there once"
    assert {tuple(r) for r in silver.select("year", "month", "day").distinct().collect()} == {
        (d.year, d.month, d.day) for d in DAYS
    }
    for name, schema in (("customers", schemas.CUSTOMERS), ("inventory", schemas.INVENTORY)):
        names = readers.read_table(spark, f"{lake}/silver/{name}").columns
        assert names == [*schema.names, "processed_timestamp", "year", "month", "day"]


def test_gold_marts_equal_the_direct_build(spark, lake):
    orders, products = silver_inputs(spark)
    want = gold.gold_daily_sales(orders, products, "2001-08-01", RUN_TS)
    close(mart(spark, lake, "daily_sales"), want, ["sale_date", "category", "brand"])
    want = gold.gold_customer_metrics(td.customers(spark, SF), orders, products, "2001-08-01", RUN_TS)
    close(mart(spark, lake, "customer_metrics"), want, ["customer_id"])
    moves = derive.combine_movements(
        td.raw_movements(spark, SF), derive.orders_to_sale_movements(orders)
    )
    want = gold.gold_product_performance(products, orders, moves, "2001-08-01", RUN_TS)
    close(mart(spark, lake, "product_performance"), want, ["product_id"])
    want = gold.gold_inventory_health(moves, products, "2001-08-01", RUN_TS)
    close(mart(spark, lake, "inventory_health"), want, ["product_id", "warehouse_id"])
    clicks = derive.combine_events(td.clicks(spark, SF), derive.orders_to_funnel_events(orders))
    want = gold.gold_conversion_funnel(clicks, RUN_TS)
    close(mart(spark, lake, "conversion_funnel"), want, ["product_id"])


def test_basic_marts_and_warehouse(spark, lake):
    orders, products = silver_inputs(spark)
    for name in ("clickstream_sessions", "customer_metrics_basic", "daily_sales_basic",
                 "inventory_health_basic", "top_products"):
        assert readers.read_table(spark, f"{lake}/gold/{name}").count() > 0
    fact, dim = (readers.read_table(spark, f"{lake}/warehouse/{n}") for n in ("fact_orders", "dim_product"))
    assert fact.schema == schemas.FACT_ORDERS
    got = star.revenue_by_category(fact, dim)
    want = star.revenue_by_category(star.fact_orders(td.orders(spark, SF)), products)
    assert got.collect() == want.collect()
    stored = readers.read_table(spark, f"{lake}/warehouse/revenue_by_category")
    assert sorted(stored.collect()) == sorted(want.collect())
    assert readers.read_table(spark, f"{lake}/warehouse/revenue_by_month_category").count() > 20


def test_jobs_ask_for_their_inputs(spark):
    for name in ("silver-orders", "silver-products"):
        with pytest.raises(ValueError, match="needs a"):
            JOBS[name](Run(spark, "/nowhere"))


def test_command_line(spark, lake):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        main(["basic-top-products", "--root", lake, "--shuffle-gb", "2"])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert readers.read_table(spark, f"{lake}/gold/top_products").count() > 0
    with pytest.raises(SystemExit):
        main(["no-such-job", "--root", lake])


def test_fact_by_day_equals_the_rebuilt_one(spark, lake):
    by_day = readers.read_table(spark, f"{lake}/warehouse/fact_orders_by_day")
    whole = readers.read_table(spark, f"{lake}/warehouse/fact_orders")
    rows = [sorted(map(str, d.select(*whole.columns).collect())) for d in (by_day, whole)]
    assert rows[0] == rows[1] and rows[0]
    one = by_day.where((F.col("year") == DAYS[0].year) & (F.col("month") == DAYS[0].month) & (F.col("day") == DAYS[0].day))
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()


def test_rerun_with_nothing_empties_its_partition_only(spark, tmp_path):
    path = str(tmp_path / "mart")
    rows = spark.createDataFrame([(1, 2024, 5, 6), (2, 2024, 5, 6)], "x int, year int, month int, day int")
    other = spark.createDataFrame([(3, 2024, 5, 7)], rows.schema)
    writers.write_gold(rows, path, dt.date(2024, 5, 6))
    writers.write_gold(other, path, dt.date(2024, 5, 7))
    writers.write_gold(rows.limit(0), path, dt.date(2024, 5, 6))
    assert [r.x for r in readers.read_table(spark, path).collect()] == [3]
    with pytest.raises(Exception, match="not of 2024-05-08"):
        writers.write_gold(other, path, dt.date(2024, 5, 8))


def test_two_current_products_stop_the_marts(spark, tmp_path):
    run = Run(spark, str(tmp_path), run_ts=RUN_TS)
    current = td.products(spark, SF).limit(1)
    stored = scd2.empty_history(spark).unionByName(
        current.select(
            *[F.col(f.name).cast(f.dataType) if f.name in current.columns else F.lit(None).cast(f.dataType).alias(f.name)
              for f in schemas.PRODUCT_HISTORY.fields]).withColumn("is_current", F.lit(True)))
    writers.write_table(stored.union(stored), str(tmp_path / "silver/products/batch=1"), "overwrite", ["is_current"])
    (tmp_path / "silver/products/_published").mkdir()
    (tmp_path / "silver/products/_published/1").touch()
    with pytest.raises(ValueError, match="several current versions"):
        run.products()

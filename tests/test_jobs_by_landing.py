"""Jobs that keep tables up by the landing give what the full runs give."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.checks import testdata as td
from lakemart.jobs import BY_LANDING, JOBS, Run
from lakemart.operators import landing, scd2
from lakemart.plans import gold, refresh
from lakemart.sources import readers, writers

SF = "/root/testdata/sf0.001"
DAYS = (dt.date(2001, 7, 30), dt.date(2001, 7, 31), dt.date(2001, 8, 1))
RUN_TS = "2001-08-02 03:00:00"


@pytest.fixture(scope="module")
def lake(spark):
    root = tempfile.mkdtemp(prefix="run-")

    def land(df, feed, key, fmt="csv"):
        third = F.pmod(F.hash(key), F.lit(3))
        day = F.when(third == 0, F.lit(DAYS[0])).when(third == 1, F.lit(DAYS[1])).otherwise(F.lit(DAYS[2]))
        writers.publish_feed(writers.land_on(df, day), f"{root}/bronze/{feed}", fmt)

    land(td.customers(spark, SF).select(*schemas.CUSTOMERS.names), "customers", "customer_id")
    lines = td.table(spark, SF, "lineitem")
    land(td.raw_movements(spark, SF, lines), "inventory", "quantity_change")
    land(td.clicks(spark, SF), "clickstream", "session_id", "json")
    land(td.orders(spark, SF).select(*schemas.ORDERS.names), "orders", "order_id")
    feed = td.first_product_load(spark, SF)
    for batch, part in (("0002", feed.where("product_id > '5'")), ("0001", feed.where("product_id <= '5'"))):
        part.write.option("header", "true").csv(f"{root}/bronze/products/{batch}")

    def run(name, **more):
        (JOBS | BY_LANDING)[name](Run(spark, root, "2001-08-01", RUN_TS, **more))

    return root, run


def rows(df):
    return sorted(map(str, df.collect()))


def test_customers_inventory_and_clicks(spark, lake):
    root, run = lake
    for name in ("silver-customers", "silver-inventory", "silver-clickstream", "gold-conversion-funnel"):
        run(name)
    for day in (DAYS[2], DAYS[0], DAYS[1], DAYS[0]):
        run("land-customers", day=day)
        run("land-inventory", day=day)
    for day in (DAYS[1], DAYS[0], DAYS[2]):
        run("land-clicks", day=day)
    run("gold-funnel-from-cells")
    for table in ("customers", "inventory"):
        want = readers.read_table(spark, f"{root}/silver/{table}")
        got = landing.read_landed(spark, f"{root}/silver/{table}_by_key").select(*want.columns)
        assert rows(got) == rows(want)
    want = readers.read_table(spark, f"{root}/gold/conversion_funnel")
    got = readers.read_table(spark, f"{root}/gold/conversion_funnel_by_cells")
    assert rows(got.select(*want.columns)) == rows(want)


def test_products_and_daily_sales(spark, lake):
    root, run = lake
    for batch in ("0002", "0001", "0002"):
        run("land-products", batch_id=batch)
    history = scd2.read_replayed(spark, f"{root}/silver/product_events")
    assert history.count() == td.table(spark, SF, "part").count() and history.where("is_current").count() == history.count()
    for batch in ("0001", "0002"):
        run("silver-products", batch_id=batch)
    for day in DAYS:
        run("silver-orders", day=day)
    orders = readers.read_table(spark, f"{root}/silver/orders")
    products = scd2.read_current(spark, f"{root}/silver/products")
    full = gold.gold_daily_sales(orders, products, "2001-08-01", RUN_TS)
    late = dt.date(1996, 5, 5)
    sold = orders.where(F.to_date("order_timestamp") != F.lit(late))
    store = f"{root}/gold/daily_sales_by_month"
    refresh.store_sales(gold.gold_daily_sales(sold, products, "2001-08-01", RUN_TS), store)
    run("refresh-daily-sales", day=late)
    got = refresh.read_sales(spark, store).drop(refresh.MONTH)
    keys = ["sale_date", "category", "brand", "total_orders", "unique_customers", "sales_trend"]
    assert rows(got.select(*keys)) == rows(full.select(*keys))


def test_a_job_without_its_day_stops(lake):
    _, run = lake
    for name in ("land-customers", "land-inventory", "land-clicks", "refresh-daily-sales"):
        with pytest.raises(ValueError, match="needs a day"):
            run(name)
    with pytest.raises(ValueError, match="batch id"):
        run("land-products")

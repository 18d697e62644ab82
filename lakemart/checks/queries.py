"""Registered queries: each runs a public operator over the driver's whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart import schemas
from lakemart.checks import testdata as td
from lakemart.operators import blocks, clean, derive, landing, scd2
from lakemart.plans import basic, gold, refresh, star
from lakemart.session import scratch_dir, settle
from lakemart.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Zone-free times and double money, as the SQL side returns them."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain(fn(spark, sf_dir))

    REGISTRY[fn.__name__] = run
    return run


# ------------------------------------------------------------------ star schema


def _fact(spark, sf_dir):
    return star.fact_orders(td.orders(spark, sf_dir))


def _dim_product(spark, sf_dir):
    return star.dim_product(td.products(spark, sf_dir))


@query
def revenue_by_category(spark, sf_dir):
    return star.revenue_by_category(_fact(spark, sf_dir), _dim_product(spark, sf_dir))


@query
def revenue_by_month_category(spark, sf_dir):
    """Fact and calendar stored first, as the warehouse job does: the lines are read once."""
    path = scratch_dir(spark) + "/fact_orders"
    writers.write_table(_fact(spark, sf_dir), path, "overwrite")
    fact = readers.read_table(spark, path)
    return star.revenue_by_month_category(fact, _dim_product(spark, sf_dir), star.dim_date(fact))


@query
def revenue_by_category_sql(spark, sf_dir):
    """The same report as SQL text over named views."""
    readers.name_for_sql(_fact(spark, sf_dir), "lakemart_fact_orders")
    readers.name_for_sql(_dim_product(spark, sf_dir), "lakemart_dim_product")
    return spark.sql(
        "SELECT category, sum(total_amount) AS revenue"
        " FROM lakemart_fact_orders JOIN lakemart_dim_product USING (product_id)"
        " GROUP BY category ORDER BY revenue DESC"
    )


@query
def fact_orders(spark, sf_dir):
    return _fact(spark, sf_dir)


@query
def fact_orders_loaded(spark, sf_dir):
    """The fact created empty, loaded from a day-partitioned table, read by name."""
    path = scratch_dir(spark) + "/fact_orders"
    writers.write_table(writers.empty_like(schemas.FACT_ORDERS, spark), path, "overwrite")
    silver = writers.land_on(td.orders(spark, sf_dir), F.to_date("order_timestamp"))
    writers.write_table(star.fact_orders(silver), path, "append")
    readers.name_for_sql(readers.read_table(spark, path), "lakemart_fact_loaded")
    return readers.read_catalog(spark, "lakemart_fact_loaded")


@query
def dim_product(spark, sf_dir):
    return _dim_product(spark, sf_dir)


@query
def dim_customer(spark, sf_dir):
    return star.dim_customer(td.customers(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return star.dim_date(_fact(spark, sf_dir))


@query
def preview_orders(spark, sf_dir):
    return star.preview(_fact(spark, sf_dir), 10, ["order_id"])


# ------------------------------------------------------------------ basic marts


@query
def sessions_basic(spark, sf_dir):
    return basic.sessions(td.clicks(spark, sf_dir))


@query
def customer_metrics_basic(spark, sf_dir):
    return basic.customer_metrics_basic(td.orders(spark, sf_dir))


@query
def daily_sales_basic(spark, sf_dir):
    return basic.daily_sales_basic(td.orders(spark, sf_dir))


@query
def inventory_health_basic(spark, sf_dir):
    return basic.inventory_health_basic(td.raw_movements(spark, sf_dir))


@query
def top_products_basic(spark, sf_dir):
    return basic.top_products(td.orders(spark, sf_dir))


# ------------------------------------------------------------------- gold marts


@query
def gold_daily_sales(spark, sf_dir):
    return gold.gold_daily_sales(
        td.orders(spark, sf_dir), td.products(spark, sf_dir), td.AS_OF, td.RUN_TS
    )


@query
def gold_inventory_health(spark, sf_dir):
    return gold.gold_inventory_health(
        td.raw_movements(spark, sf_dir), td.products(spark, sf_dir), td.INVENTORY_AS_OF, td.RUN_TS
    )


@query
def gold_product_performance(spark, sf_dir):
    """In the form that the job runs: the products' totals settled once."""
    return gold.gold_product_performance(
        td.products(spark, sf_dir),
        td.orders(spark, sf_dir),
        td.raw_movements(spark, sf_dir),
        td.AS_OF,
        td.RUN_TS,
        settle_totals=True,
    )


@query
def gold_conversion_funnel(spark, sf_dir):
    return gold.gold_conversion_funnel(td.clicks(spark, sf_dir), td.RUN_TS)


@query
def gold_customer_metrics(spark, sf_dir):
    return gold.gold_customer_metrics(
        td.customers(spark, sf_dir),
        td.orders(spark, sf_dir),
        td.products(spark, sf_dir),
        td.AS_OF,
        td.RUN_TS,
    )


# --------------------------------------------------------------------- cleaning


@query
def dedup_orders(spark, sf_dir):
    """Repeated order ids straight from the lines, one kept per id."""
    lines = td.table(spark, sf_dir, "lineitem")
    return clean.clean_orders(td.raw_orders(spark, sf_dir, lines), td.RUN_TS)


@query
def clean_product_changes(spark, sf_dir):
    return clean.clean_product_changes(td.product_changes(spark, sf_dir), td.RUN_TS)


def _history(spark, sf_dir, expire_on_insert=False):
    first = clean.clean_product_changes(td.first_product_load(spark, sf_dir), td.FIRST_LOAD)
    second = clean.clean_product_changes(td.product_changes(spark, sf_dir), td.RUN_TS)
    after_first = scd2.apply_scd2(scd2.empty_history(spark), first, expire_on_insert)
    return scd2.apply_scd2(after_first, second, expire_on_insert)


@query
def scd2_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def scd2_history_expiring(spark, sf_dir):
    return _history(spark, sf_dir, expire_on_insert=True)


@query
def scd2_current(spark, sf_dir):
    return scd2.current_version(_history(spark, sf_dir))


@query
def scd2_two_current(spark, sf_dir):
    return scd2.check_one_current(_history(spark, sf_dir))


@query
def scd2_published(spark, sf_dir):
    """The history built batch by batch in storage, the last batch sent twice."""
    root = scratch_dir(spark)
    first = clean.clean_product_changes(td.first_product_load(spark, sf_dir), td.FIRST_LOAD)
    second = clean.clean_product_changes(td.product_changes(spark, sf_dir), td.RUN_TS)
    for batch_id, batch in (("0001", first), ("0002", second), ("0002", second)):
        scd2.publish_batch(spark, root, batch_id, batch)
    return scd2.read_history(spark, root)


@query
def scd2_compacted(spark, sf_dir):
    """A batch, compaction, one more batch, and compaction again."""
    root = scratch_dir(spark)
    first = clean.clean_product_changes(td.first_product_load(spark, sf_dir), td.FIRST_LOAD)
    second = clean.clean_product_changes(td.product_changes(spark, sf_dir), td.RUN_TS)
    for batch_id, batch in (("0001", first), ("0002", second)):
        scd2.publish_batch(spark, root, batch_id, batch)
        scd2.compact(spark, root)
    return scd2.read_history(spark, root)


# ------------------------------------------------------------------ derivations


@query
def enriched_orders(spark, sf_dir):
    return derive.enrich_orders(td.orders(spark, sf_dir), td.products(spark, sf_dir))


@query
def sale_movements(spark, sf_dir):
    return derive.orders_to_sale_movements(td.orders(spark, sf_dir))


@query
def funnel_events(spark, sf_dir):
    return derive.orders_to_funnel_events(td.orders(spark, sf_dir))


@query
def combined_movements(spark, sf_dir):
    return derive.combine_movements(
        td.raw_movements(spark, sf_dir), derive.orders_to_sale_movements(td.orders(spark, sf_dir))
    )


@query
def combined_events(spark, sf_dir):
    return derive.combine_events(
        td.clicks(spark, sf_dir), derive.orders_to_funnel_events(td.orders(spark, sf_dir))
    )


@query
def priced_orders(spark, sf_dir):
    return derive.price_orders(td.orders(spark, sf_dir), td.products(spark, sf_dir))


@query
def payment_amounts(spark, sf_dir):
    return derive.order_amount_for_payments(td.payments(spark, sf_dir), td.orders(spark, sf_dir))


# -------------------------------------------------------------- feeds and tables


def _publish(df: DataFrame, path: str, landed: str, fmt: str = "csv") -> None:
    """Land a frame as a packed feed, by month of ``landed`` to keep the folder count modest."""
    month = F.to_date(F.date_trunc("month", F.col(landed)))
    writers.publish_feed(writers.land_on(df, month), path, fmt, compression="gzip")


@query
def csv_partition_roundtrip(spark, sf_dir):
    """Orders through a day-partitioned CSV feed and the cleaner."""
    feed = scratch_dir(spark) + "/orders"
    _publish(td.raw_orders(spark, sf_dir), feed, "order_timestamp")
    raw = readers.read_csv_feed(spark, feed, schemas.ORDERS)
    return clean.clean_orders(raw, td.RUN_TS, on_bad_value="fail")


@query
def clean_customers(spark, sf_dir):
    """Every customer lands twice through CSV; the later landing wins."""
    feed = scratch_dir(spark) + "/customers"
    first = td.customers(spark, sf_dir).select(*schemas.CUSTOMERS.names)
    moved = first.withColumn("city", F.concat(F.lit("moved from "), "city"))
    _publish(first, feed, "signup_date")
    landed = writers.land_on(moved, F.lit(td.AS_OF).cast("date"))
    writers.publish_feed(landed, feed)
    return clean.clean_customers(readers.read_csv_feed(spark, feed), td.RUN_TS)


@query
def clean_inventory(spark, sf_dir):
    """Movements with repeated ids through CSV, folders read back from file paths."""
    feed = scratch_dir(spark) + "/inventory"
    lines = td.table(spark, sf_dir, "lineitem")
    _publish(td.raw_movements(spark, sf_dir, lines), feed, "event_timestamp")
    raw = readers.read_csv_feed(spark, feed, schemas.INVENTORY, days_from_path=True)
    return clean.clean_inventory(raw, td.RUN_TS)


@query
def csv_text_roundtrip(spark, sf_dir):
    """Whole documents, line breaks and all, through a CSV feed."""
    feed = scratch_dir(spark) + "/documents"
    docs = td.table(spark, sf_dir, "documents")
    landed = writers.land_on(docs, F.lit(td.AS_OF).cast("date"))
    writers.publish_feed(landed, feed, escape_lines=True)
    raw = readers.read_csv_feed(spark, feed, escaped_lines=True)
    number = {c: F.col(c).cast("bigint") for c in ("doc_id", "n_chars")}
    return raw.drop(*readers.DAY_COLUMNS).withColumns(number)


@query
def orders_with_run_day(spark, sf_dir):
    """Orders from a feed without day folders: the run gives the day."""
    feed = scratch_dir(spark) + "/orders"
    td.raw_orders(spark, sf_dir).write.option("header", "true").csv(feed)
    raw = readers.with_run_day(
        readers.read_csv_feed(spark, feed, schemas.ORDERS), dt.date.fromisoformat(str(td.AS_OF)))
    return clean.clean_orders(raw, td.RUN_TS).drop(*readers.DAY_COLUMNS)


@query
def fact_loaded_by_day(spark, sf_dir):
    """The fact partitioned by day: all days but the last ones, then those appended."""
    path = scratch_dir(spark) + "/fact_by_day"
    fact = writers.land_on(_fact(spark, sf_dir), F.date_trunc("month", F.col("order_timestamp")))
    # Orders without a time are not late: a null condition would leave them out of both.
    late = F.coalesce(F.col("order_timestamp") >= F.lit("1998-01-01").cast("timestamp"), F.lit(False))
    writers.write_table(fact.where(~late), path, "append", writers.DAY_COLUMNS, rebalance=True)
    writers.write_table(fact.where(late), path, "append", writers.DAY_COLUMNS, rebalance=True)
    return readers.read_table(spark, path).drop(*writers.DAY_COLUMNS)


@query
def fact_as_table(spark, sf_dir):
    """The fact as a catalog table of its own, read by name and dropped again."""
    name = f"lakemart_fact_{uuid.uuid4().hex}"
    writers.create_table_as(_fact(spark, sf_dir), name)
    stored = settle(readers.read_catalog(spark, name))
    spark.sql(f"DROP TABLE {name}")
    return stored


@query
def json_roundtrip(spark, sf_dir):
    """Clicks through a day-partitioned JSON-lines feed and the cleaner."""
    feed = scratch_dir(spark) + "/clickstream"
    _publish(td.clicks(spark, sf_dir), feed, "event_timestamp", "json")
    raw = readers.read_json_feed(spark, feed, schemas.CLICKSTREAM)
    return clean.clean_clickstream(raw).select(*schemas.CLICKSTREAM.names)


@query
def dynamic_overwrite(spark, sf_dir):
    """All landed days written to a table, then one of them run again from its folder."""
    root = scratch_dir(spark)
    feed, silver = root + "/orders", root + "/silver"
    _publish(td.raw_orders(spark, sf_dir), feed, "order_timestamp")
    days = readers.DAY_COLUMNS
    every_day = clean.clean_orders(readers.read_csv_feed(spark, feed, schemas.ORDERS), td.RUN_TS)
    writers.write_table(every_day, silver, "dynamic", days, rebalance=True)
    one_day = readers.read_csv_day(spark, feed, dt.date(1998, 3, 1), schemas.ORDERS)
    writers.write_table(clean.clean_orders(one_day, td.RUN_TS), silver, "dynamic", days)
    return readers.read_table(spark, silver)


@query
def append_and_overwrite(spark, sf_dir):
    """A table replaced in full by one movement feed, then extended by the other."""
    path = scratch_dir(spark) + "/movements"
    sales = derive.orders_to_sale_movements(td.orders(spark, sf_dir))
    operational = td.raw_movements(spark, sf_dir)
    writers.write_table(sales, path, "overwrite")
    writers.write_table(operational, path, "overwrite")
    writers.write_table(sales, path, "append")
    return readers.read_table(spark, path)


@query
def gold_rerun(spark, sf_dir):
    """A mart written twice for the same run: the second write replaces the first."""
    path = scratch_dir(spark) + "/conversion_funnel"
    mart = gold.gold_conversion_funnel(td.clicks(spark, sf_dir), td.RUN_TS)
    writers.write_gold(mart, path)
    writers.write_gold(mart, path)
    return readers.read_table(spark, path)


@query
def audited_write(spark, sf_dir):
    """Row count observed by the write itself, next to the rows read back."""
    path = scratch_dir(spark) + "/sessions"
    watched, observation = writers.audit(basic.sessions(td.clicks(spark, sf_dir)))
    writers.write_table(watched, path, "overwrite")
    return readers.read_table(spark, path).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.lit(observation.get["rows"]).cast("bigint").alias("rows_written"),
    )


# ------------------------------------------------- tables kept up by the landing


@query
def customers_by_landing(spark, sf_dir):
    """The customers of ``clean_customers``, landing by landing, the newest first and one twice."""
    root = scratch_dir(spark)
    first = td.customers(spark, sf_dir).select(*schemas.CUSTOMERS.names)
    moved = first.withColumn("city", F.concat(F.lit("moved from "), "city"))
    _publish(first, root + "/bronze", "signup_date")
    writers.publish_feed(writers.land_on(moved, F.lit(td.AS_OF).cast("date")), root + "/bronze")
    raw = readers.read_csv_feed(spark, root + "/bronze")
    newest = F.col("year") == 2001
    for part in (newest, ~newest & (F.col("month") % 2 == 0), ~newest & (F.col("month") % 2 == 1), newest):
        cleaned = clean.clean_customers(raw.where(part), td.RUN_TS)
        landing.land(spark, root + "/silver", cleaned, "customer_id", buckets=16)
    return landing.read_landed(spark, root + "/silver")


@query
def inventory_by_landing(spark, sf_dir):
    """The movements of ``clean_inventory``, months out of order."""
    root = scratch_dir(spark)
    lines = td.table(spark, sf_dir, "lineitem")
    _publish(td.raw_movements(spark, sf_dir, lines), root + "/bronze", "event_timestamp")
    raw = readers.read_csv_feed(spark, root + "/bronze", schemas.INVENTORY)
    odd = F.coalesce(F.col("month") % 2 == 1, F.lit(False))
    for part in (odd, ~odd):
        cleaned = clean.clean_inventory(raw.where(part), td.RUN_TS)
        landing.land(spark, root + "/silver", cleaned, "inventory_event_id", ["event_timestamp"], buckets=16)
    return landing.read_landed(spark, root + "/silver")


@query
def scd2_replayed(spark, sf_dir):
    """The history that all change events lead to, with hot products cut along the time."""
    events = clean.type_product_changes(td.first_product_load(spark, sf_dir), td.FIRST_LOAD).unionByName(
        clean.type_product_changes(td.product_changes(spark, sf_dir), td.RUN_TS))
    return scd2.replay(events, limit=40)


@query
def scd2_late_batches(spark, sf_dir):
    """The same history from batches that land newest first, one of them twice."""
    root = scratch_dir(spark)
    late = clean.type_product_changes(td.product_changes(spark, sf_dir), td.RUN_TS)
    early = clean.type_product_changes(td.first_product_load(spark, sf_dir), td.FIRST_LOAD)
    newer = F.coalesce(F.col("source_updated_at") >= F.lit("1996-01-01").cast("timestamp"), F.lit(False))
    for batch in (late.where(newer), early, late.where(~newer), early):
        scd2.land_changes(spark, root, batch, buckets=8)
    return scd2.read_replayed(spark, root)


@query
def funnel_from_bitmaps(spark, sf_dir):
    """The funnel from day cells that two landings left, the later days first."""
    root = scratch_dir(spark)
    clicks = td.clicks(spark, sf_dir)
    late = F.coalesce(F.dayofmonth("event_timestamp") > 15, F.lit(False))
    for part in (late, ~late):
        refresh.land_clicks(spark, root, clicks.where(part))
    return refresh.funnel_between(readers.read_table(spark, root + "/cells"), run_ts=td.RUN_TS)


@query
def daily_sales_refreshed(spark, sf_dir):
    """Daily sales stored without three days, which then come one by one and out of order."""
    root = scratch_dir(spark)
    orders, products = settle(td.orders(spark, sf_dir)), td.products(spark, sf_dir)
    late = [dt.date(1995, 3, 15), dt.date(1994, 7, 1), dt.date(1995, 3, 14)]
    there = ~F.coalesce(F.to_date("order_timestamp").isin(late), F.lit(False))
    refresh.store_sales(gold.gold_daily_sales(orders.where(there), products, td.AS_OF, td.RUN_TS), root)
    for day in late:
        own = orders.where(F.to_date("order_timestamp") == F.lit(day))
        refresh.refresh_sales(spark, root, day, own, products, td.AS_OF, td.RUN_TS)
    return refresh.read_sales(spark, root).drop(refresh.MONTH)


@query
def customers_mixed_headers(spark, sf_dir):
    """One feed in three generations: as declared, reordered, and with other columns."""
    feed = scratch_dir(spark) + "/customers"
    every = td.customers(spark, sf_dir).select(*schemas.CUSTOMERS.names)
    group = F.col("customer_id").cast("bigint") % 3
    _publish(every.where(group == 0), feed, "signup_date")
    _publish(every.where(group == 1).select(*reversed(schemas.CUSTOMERS.names)), feed, "signup_date")
    third = every.where(group == 2).drop("preferred_category").withColumnRenamed("loyalty_tier", "tier")
    _publish(third.withColumn("newsletter", F.lit("yes")), feed, "signup_date")
    raw = readers.read_csv_generations(
        spark, feed, schemas.CUSTOMERS, required=("customer_id", "email"), renamed={"tier": "loyalty_tier"})
    return clean.clean_customers(raw, td.RUN_TS, on_bad_value="fail").drop(*readers.DAY_COLUMNS)


@query
def revenue_of_fourth_quarters(spark, sf_dir):
    """A report over a fact stored by month, of which a filtered calendar opens a quarter of the folders."""
    root = scratch_dir(spark)
    fact = star.with_order_month(_fact(spark, sf_dir))
    writers.write_table(fact, root + "/fact", "overwrite", [star.ORDER_MONTH], rebalance=True)
    stored_fact = readers.read_table(spark, root + "/fact")
    writers.write_table(star.dim_date(stored_fact), root + "/dim_date", "overwrite")
    calendar = readers.read_table(spark, root + "/dim_date")
    return star.revenue_of_period(stored_fact, _dim_product(spark, sf_dir), calendar, F.col("quarter") == 4)


@query
def revenue_by_product_bucketed(spark, sf_dir):
    """Orders and products stored in buckets of the product: joined and summed without an exchange."""
    names = [f"lakemart_{x}_{uuid.uuid4().hex}" for x in ("orders", "products")]
    writers.create_bucketed(td.orders(spark, sf_dir), names[0], "product_id", 8)
    writers.create_bucketed(td.products(spark, sf_dir), names[1], "product_id", 8)
    orders, products = (readers.read_catalog(spark, n) for n in names)
    found = settle(basic.top_products(derive.enrich_orders(orders, products, ("brand",))))
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return found


@query
def checked_writes(spark, sf_dir):
    """A month of orders written behind checks, then a damaged one of that month refused."""
    path, day = scratch_dir(spark) + "/orders", dt.date(1998, 3, 1)
    month = td.orders(spark, sf_dir).where("date_trunc('month', order_timestamp) = '1998-03-01'")
    landed = readers.with_run_day(month, day)
    checks = writers.Checks(
        key=("order_id",), not_null=("order_id", "order_timestamp"), ranges={"quantity": (1, 50)}, max_change=0.5)
    found = writers.write_checked(landed, path, day, checks)
    damaged = landed.unionByName(landed).withColumn("quantity", -F.col("quantity"))
    try:
        writers.write_checked(damaged, path, day, checks)
        broken = []
    except writers.Refused as refused:
        broken = refused.broken
    return readers.read_table(spark, path).drop(*readers.DAY_COLUMNS).select(
        "order_id", "quantity", "order_timestamp", F.lit(found["rows"]).cast("bigint").alias("rows_accepted"),
        F.lit(",".join(broken)).alias("refused_for"))


@query
def orders_of_a_status_in_order(spark, sf_dir):
    """Number and previous amount of each order among those of its status, three hot keys cut along the time."""
    return blocks.with_window(
        td.orders(spark, sf_dir), ["order_status"], ["order_timestamp", "order_id"],
        {"previous_amount": "total_amount"}, "order_number", limit=1000, blocks=16,
    ).select("order_id", "order_status", "order_number", "previous_amount")

"""Jobs over one lake folder: feeds to tables, tables to marts, marts to reports.

    python -m lakemart.jobs silver-orders --root s3a://lake --day 2024-05-06
    python -m lakemart.jobs gold-daily-sales --root s3a://lake --as-of 2024-05-06

Every job can be run again. Layout under the root: ``bronze/<feed>``,
``silver/<table>``, ``gold/<mart>``, ``warehouse/<table>``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.operators import clean, landing, scd2
from lakemart.plans import basic, gold, refresh, star
from lakemart.session import build_session, remove, shuffle_partitions_for
from lakemart.sources import readers, writers


@dataclass(frozen=True)
class Run:
    """What a job needs to know: where, for when, and which input."""

    spark: SparkSession
    root: str
    as_of: str | None = None
    run_ts: str | None = None
    day: dt.date | None = None
    batch_id: str | None = None
    on_bad_value: str = "null"
    expire_on_insert: bool = False

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def silver(self, name: str) -> DataFrame:
        return readers.read_table(self.spark, self.path("silver", name))

    def products(self) -> DataFrame:
        """Products in force: one row each, or every mart would count its orders twice."""
        current = scd2.read_current(self.spark, self.path("silver", "products"))
        twice = scd2.check_one_current(current).take(1)
        if twice:
            raise ValueError(
                f"product {twice[0]['product_id']} has several current versions;"
                " publish inserts with --expire-on-insert")
        return current

    @property
    def bad_record(self) -> str:
        return "fail" if self.on_bad_value == "fail" else "aside"

    def keep_aside(self, raw: DataFrame, feed: str) -> None:
        """Store the feed's malformed records next to it, for someone to look at."""
        if readers.CORRUPT in raw.columns:
            self.write_plain(readers.set_aside(raw), "aside", feed)

    def landed(self, feed: str, schema) -> DataFrame:
        """The run's day of a CSV feed; a feed whose folder gives no day takes it from the run."""
        if self.day is None:
            raise ValueError(f"{feed} by the day needs a day")
        raw = readers.read_csv_day(self.spark, self.path("bronze", feed), self.day, schema, self.bad_record)
        if not set(readers.DAY_COLUMNS) <= set(raw.columns):
            raw = readers.with_run_day(raw, self.day)
        self.keep_aside(raw, f"{feed}/{self.day}")
        return raw

    def run_day(self) -> dt.date | None:
        """The day of the run's time in the session's zone; None for the wall clock."""
        if self.run_ts is None:
            return None
        at = dt.datetime.fromisoformat(str(self.run_ts))
        if at.tzinfo is not None:
            at = at.astimezone(ZoneInfo(self.spark.conf.get("spark.sql.session.timeZone")))
        return at.date()

    def write_silver(self, df: DataFrame, name: str, mode: str, many_days: bool) -> None:
        path = self.path("silver", name)
        writers.write_table(df, path, mode, writers.DAY_COLUMNS, rebalance=many_days)

    def write_gold(self, df: DataFrame, name: str) -> None:
        writers.write_gold(df, self.path("gold", name), self.run_day())

    def write_plain(self, df: DataFrame, layer: str, name: str) -> None:
        writers.write_table(df, self.path(layer, name), "overwrite")


JOBS: dict[str, Callable[[Run], None]] = {}


def job(fn: Callable[[Run], None]) -> Callable[[Run], None]:
    JOBS[fn.__name__.replace("_", "-")] = fn
    return fn


#: Jobs that keep a table or mart up by a landed day or batch, beside the full runs in ``JOBS``.
BY_LANDING: dict[str, Callable[[Run], None]] = {}


def landing_job(fn: Callable[[Run], None]) -> Callable[[Run], None]:
    BY_LANDING[fn.__name__.replace("_", "-")] = fn
    return fn


# ---- feeds to tables ----


@job
def silver_customers(run: Run) -> None:
    """The whole feed, rewritten: a customer may move to another landing day."""
    raw = readers.read_csv_feed(
        run.spark, run.path("bronze", "customers"), schemas.CUSTOMERS, on_bad_record=run.bad_record)
    run.keep_aside(raw, "customers")
    cleaned = clean.clean_customers(raw, run.run_ts, run.on_bad_value)
    run.write_silver(cleaned, "customers", "overwrite", many_days=True)


@job
def silver_inventory(run: Run) -> None:
    """The whole feed, rewritten."""
    raw = readers.read_csv_feed(
        run.spark, run.path("bronze", "inventory"), schemas.INVENTORY, on_bad_record=run.bad_record)
    run.keep_aside(raw, "inventory")
    cleaned = clean.clean_inventory(raw, run.run_ts, run.on_bad_value)
    run.write_silver(cleaned, "inventory", "overwrite", many_days=True)


@landing_job
def land_customers(run: Run) -> None:
    """One landed day into the customers by key: only the buckets of its keys are read and rewritten."""
    cleaned = clean.clean_customers(run.landed("customers", schemas.CUSTOMERS), run.run_ts, run.on_bad_value)
    landing.land(run.spark, run.path("silver", "customers_by_key"), cleaned, "customer_id")


@landing_job
def land_inventory(run: Run) -> None:
    """One landed day into the movements by key."""
    cleaned = clean.clean_inventory(run.landed("inventory", schemas.INVENTORY), run.run_ts, run.on_bad_value)
    landing.land(
        run.spark, run.path("silver", "inventory_by_key"), cleaned, "inventory_event_id", ["event_timestamp"])


@landing_job
def land_clicks(run: Run) -> None:
    """One landed day of clicks into the funnel's day cells; a day may be landed once only."""
    if run.day is None:
        raise ValueError("land-clicks needs a day")
    feed = run.path("bronze", "clickstream")
    raw = readers.read_json_feed(
        run.spark, readers.day_path(feed, run.day), schemas.CLICKSTREAM, feed, run.bad_record)
    run.keep_aside(raw, f"clickstream/{run.day}")
    refresh.land_clicks(run.spark, run.path("gold", "funnel_cells"), clean.clean_clickstream(raw, run.on_bad_value))


@landing_job
def land_products(run: Run) -> None:
    """One batch of the change feed into the event log; late batches find their place in the history."""
    if run.batch_id is None:
        raise ValueError("land-products needs a batch id")
    feed = run.path("bronze", f"products/{run.batch_id}")
    raw = readers.read_csv_feed(run.spark, feed, schemas.PRODUCT_CHANGES, on_bad_record=run.bad_record)
    run.keep_aside(raw, f"products/{run.batch_id}")
    events = clean.type_product_changes(raw, run.run_ts, run.on_bad_value)
    scd2.land_changes(run.spark, run.path("silver", "product_events"), events, run.expire_on_insert)


@job
def silver_orders(run: Run) -> None:
    """One landed day; that day of the table is replaced, also by nothing.

    A feed whose folder gives no day takes it from the run.
    """
    if run.day is None:
        raise ValueError("silver-orders needs a day")
    feed = run.path("bronze", "orders")
    raw = readers.read_csv_day(run.spark, feed, run.day, schemas.ORDERS, run.bad_record)
    if not set(readers.DAY_COLUMNS) <= set(raw.columns):
        raw = readers.with_run_day(raw, run.day)
    run.keep_aside(raw, f"orders/{run.day}")
    cleaned = clean.clean_orders(raw, run.run_ts, run.on_bad_value)
    writers.write_day(cleaned, run.path("silver", "orders"), run.day)


@job
def silver_clickstream(run: Run) -> None:
    """The whole feed, rewritten."""
    feed = run.path("bronze", "clickstream")
    raw = readers.read_json_feed(run.spark, feed, schemas.CLICKSTREAM, on_bad_record=run.bad_record)
    run.keep_aside(raw, "clickstream")
    cleaned = clean.clean_clickstream(raw, run.on_bad_value)
    run.write_silver(cleaned, "clickstream", "overwrite", many_days=True)


@job
def silver_products(run: Run) -> None:
    """One batch of the change feed, from ``bronze/products/<batch id>``."""
    if run.batch_id is None:
        raise ValueError("silver-products needs a batch id")
    feed = run.path("bronze", f"products/{run.batch_id}")
    raw = readers.read_csv_feed(run.spark, feed, schemas.PRODUCT_CHANGES, on_bad_record=run.bad_record)
    run.keep_aside(raw, f"products/{run.batch_id}")
    batch = clean.clean_product_changes(raw, run.run_ts, run.on_bad_value)
    root = run.path("silver", "products")
    scd2.publish_batch(run.spark, root, run.batch_id, batch, run.expire_on_insert)


@job
def compact_products(run: Run) -> None:
    """Merge the stored history; published batches stay known."""
    scd2.compact(run.spark, run.path("silver", "products"))


# ---- single-aggregate marts ----


@job
def basic_sessions(run: Run) -> None:
    feed = run.path("bronze", "clickstream")
    raw = readers.read_json_feed(run.spark, feed, schemas.CLICKSTREAM, on_bad_record=run.bad_record)
    clicks = clean.clean_clickstream(raw, run.on_bad_value)
    run.write_plain(basic.sessions(clicks), "gold", "clickstream_sessions")


@job
def basic_customer_metrics(run: Run) -> None:
    mart = basic.customer_metrics_basic(run.silver("orders"))
    run.write_plain(mart, "gold", "customer_metrics_basic")


@job
def basic_daily_sales(run: Run) -> None:
    run.write_plain(basic.daily_sales_basic(run.silver("orders")), "gold", "daily_sales_basic")


@job
def basic_inventory_health(run: Run) -> None:
    mart = basic.inventory_health_basic(run.silver("inventory"))
    run.write_plain(mart, "gold", "inventory_health_basic")


@job
def basic_top_products(run: Run) -> None:
    run.write_plain(basic.top_products(run.silver("orders")), "gold", "top_products")


# ---- gold marts ----


@job
def gold_daily_sales(run: Run) -> None:
    mart = gold.gold_daily_sales(run.silver("orders"), run.products(), run.as_of, run.run_ts)
    run.write_gold(mart, "daily_sales")


@landing_job
def refresh_daily_sales(run: Run) -> None:
    """One sale day of the maintained mart, and the growth of the rows that follow it."""
    if run.day is None:
        raise ValueError("refresh-daily-sales needs a day")
    root = run.path("gold", "daily_sales_by_month")
    refresh.refresh_sales(
        run.spark, root, run.day, run.silver("orders"), run.products(), run.as_of, run.run_ts)


@landing_job
def gold_funnel_from_cells(run: Run) -> None:
    """The funnel of all landed days, or of the run's day alone, from the day cells."""
    cells = readers.read_table(run.spark, run.path("gold", "funnel_cells/cells"))
    mart = refresh.funnel_between(cells, run.day, run.day, run.run_ts)
    run.write_gold(mart, "conversion_funnel_by_cells")


@job
def gold_inventory_health(run: Run) -> None:
    movements = run.silver("inventory")
    mart = gold.gold_inventory_health(movements, run.products(), run.as_of, run.run_ts)
    run.write_gold(mart, "inventory_health")


@job
def gold_product_performance(run: Run) -> None:
    mart = gold.gold_product_performance(
        run.products(),
        run.silver("orders"),
        run.silver("inventory"),
        run.as_of,
        run.run_ts,
        settle_totals=True,
    )
    run.write_gold(mart, "product_performance")


@job
def gold_conversion_funnel(run: Run) -> None:
    mart = gold.gold_conversion_funnel(run.silver("clickstream"), run.run_ts)
    run.write_gold(mart, "conversion_funnel")


@job
def gold_customer_metrics(run: Run) -> None:
    mart = gold.gold_customer_metrics(
        run.silver("customers"), run.silver("orders"), run.products(), run.as_of, run.run_ts
    )
    run.write_gold(mart, "customer_metrics")


# ---- warehouse ----


@job
def warehouse_tables(run: Run) -> None:
    """The fact first, then its dimensions; the calendar reads the stored fact."""
    run.write_plain(star.fact_orders(run.silver("orders")), "warehouse", "fact_orders")
    fact = readers.read_table(run.spark, run.path("warehouse", "fact_orders"))
    run.write_plain(star.dim_date(fact), "warehouse", "dim_date")
    run.write_plain(star.dim_product(run.products()), "warehouse", "dim_product")
    run.write_plain(star.dim_customer(run.silver("customers")), "warehouse", "dim_customer")


@job
def warehouse_load(run: Run) -> None:
    """One landed day of orders into the fact's folder of that day; a repeat replaces it."""
    if run.day is None:
        raise ValueError("warehouse-load needs a day")
    orders = run.silver("orders")
    own = (F.col("year") == run.day.year) & (F.col("month") == run.day.month) & (F.col("day") == run.day.day)
    fact = star.fact_orders(orders.where(own))
    writers.write_day(readers.with_run_day(fact, run.day), run.path("warehouse", "fact_orders_by_day"), run.day)


@job
def warehouse_reports(run: Run) -> None:
    """Both revenue reports, stored highest revenue first."""
    fact, products, calendar = (
        readers.read_table(run.spark, run.path("warehouse", name))
        for name in ("fact_orders", "dim_product", "dim_date")
    )
    by_category = star.revenue_by_category(fact, products)
    run.write_plain(by_category, "warehouse", "revenue_by_category")
    by_month = star.revenue_by_month_category(fact, products, calendar)
    run.write_plain(by_month, "warehouse", "revenue_by_month_category")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lakemart.jobs", description=__doc__)
    jobs = JOBS | BY_LANDING
    parser.add_argument("job", choices=sorted(jobs))
    parser.add_argument("--root", required=True)
    parser.add_argument("--as-of")
    parser.add_argument("--run-ts")
    parser.add_argument("--day", type=dt.date.fromisoformat)
    parser.add_argument("--batch-id")
    parser.add_argument("--on-bad-value", choices=schemas.BAD_VALUE_MODES, default="null")
    parser.add_argument("--expire-on-insert", action="store_true")
    parser.add_argument(
        "--shuffle-gb", type=int, help="expected shuffle volume; sets the starting partition count"
    )
    args = parser.parse_args(argv)
    # Scratch lies in the lake, where executors reach it, unless the cluster names a folder.
    scratch = f"{args.root.rstrip('/')}/_scratch/{uuid.uuid4().hex}"
    spark = build_session(f"lakemart-{args.job}")
    own_scratch = not spark.conf.get("spark.checkpoint.dir", None)
    if own_scratch and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch)
    if args.shuffle_gb:
        cores = spark.sparkContext.defaultParallelism
        count = shuffle_partitions_for(args.shuffle_gb * 2**30, cores)
        spark.conf.set("spark.sql.shuffle.partitions", str(count))
    run = Run(
        spark,
        args.root,
        args.as_of,
        args.run_ts or dt.datetime.now(dt.timezone.utc).isoformat(),
        args.day,
        args.batch_id,
        args.on_bad_value,
        args.expire_on_insert,
    )
    try:
        jobs[args.job](run)
    finally:
        if own_scratch:
            remove(spark, scratch)


if __name__ == "__main__":
    main()

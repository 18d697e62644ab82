"""Plans and skew: what has to hold when one key owns a large share of the rows."""

import contextlib
import pathlib
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.checks import testdata as td
from lakemart.checks.queries import REGISTRY as QUERIES
from lakemart.checks.queries import _publish as publish
from lakemart.operators import clean, derive
from lakemart.plans import basic, gold, star
from lakemart.session import shuffle_partitions_for
from lakemart.sources import readers, writers
from tests.helpers import plan_of

SF = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **conf):
    named = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    for k, v in named.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_partitions(spark):
    """No broadcasts, and thresholds at which the fixture counts as large."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


@pytest.fixture(scope="module")
def hot(spark):
    """Orders of which a third name one product, a third one customer, and some no product."""
    root = tempfile.mkdtemp(prefix="run-")
    n = 60_000
    third = F.col("id") % 3
    rows = spark.range(0, n, 1, 12).select(
        F.concat(F.lit("o"), "id").alias("order_id"),
        F.when(third == 1, "c-hot").otherwise(F.concat(F.lit("c"), F.hash("id") % 5000)).alias("customer_id"),
        F.when(third == 0, "p-hot").when(F.col("id") % 30 == 1, None)
        .otherwise(F.concat(F.lit("p"), F.pmod(F.hash("id"), F.lit(700)))).alias("product_id"),
        (F.col("id") % 5 + 1).cast("int").alias("quantity"),
        F.lit(2.0).alias("unit_price"),
        (F.col("id") % 5 + 1).cast("double").alias("total_amount"),
        F.lit("UPI").alias("payment_method"),
        F.lit("Placed").alias("order_status"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("order_timestamp"),
    )
    rows.write.parquet(root + "/orders")
    keys = spark.range(0, 700).select(F.concat(F.lit("p"), "id").alias("product_id"))
    keys.unionByName(spark.sql("select 'p-hot' product_id")).select(
        "product_id",
        F.lit("n").alias("product_name"),
        F.concat(F.lit("k"), F.crc32("product_id") % 5).alias("category"),
        F.lit("s").alias("subcategory"),
        F.concat(F.lit("b"), F.crc32("product_id") % 7).alias("brand"),
        F.lit(1.0).alias("cost_price"),
        F.lit(2.0).alias("price"),
        F.lit(3.0).alias("popularity_score"),
        F.lit("2023-11-01").cast("date").alias("launch_date"),
        F.lit(True).alias("is_active"),
    ).write.parquet(root + "/products")
    return spark.read.parquet(root + "/orders"), spark.read.parquet(root + "/products")


def stages(plan):
    return plan.split("== Initial Plan ==")[0]


def test_row_grain_join_splits_a_hot_product(spark, hot):
    orders, products = hot
    with small_partitions(spark):
        enriched = derive.enrich_orders(orders, products)
        assert "skew=true" in stages(plan_of(enriched))
        assert enriched.count() == orders.count()
        priced = derive.price_orders(orders.where("product_id is not null"), products)
        assert "skew=true" in stages(plan_of(priced))


def test_customer_metrics_survive_a_hot_customer_and_product(spark, hot):
    orders, products = hot
    customers = orders.select("customer_id").distinct().select(
        "customer_id",
        *[F.lit("x").alias(c) for c in schemas.CUSTOMERS.names if c not in ("customer_id", "signup_date")],
        F.lit("2020-01-01").cast("date").alias("signup_date"),
    )
    with small_partitions(spark):
        mart = gold.gold_customer_metrics(customers, orders, products, "2024-02-01", "2024-02-01")
        plan = stages(plan_of(mart))
        assert "skew=true" in plan, "the product join is split"
        # Orders are combined per cell before anything is gathered by customer alone.
        cell = re.search(r"Exchange hashpartitioning\(customer_id#\d+, category#\d+, brand#\d+", plan)
        assert cell and "partial_sum" in plan[cell.end():].split("Exchange")[0]
        got = mart.where("customer_id = 'c-hot'").first()
    want = orders.where("customer_id = 'c-hot'").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("q"), F.max("order_timestamp").alias("t")
    ).first()
    assert (got.total_orders, got.total_quantity, got.last_purchase_date) == tuple(want)


def test_daily_sales_under_skew_equals_row_grain(spark, hot):
    orders, products = hot
    joined = orders.join(products, "product_id", "left")
    want = joined.groupBy(F.to_date("order_timestamp").alias("sale_date"), "category", "brand").agg(
        F.count("*").alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("product_id").alias("unique_products"),
    )
    with small_partitions(spark):
        mart = gold.gold_daily_sales(orders, products, "2024-01-01", "2024-01-01")
        assert "skew=true" in stages(plan_of(mart))
        got = mart.select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_members_and_cells_are_found_by_all_tasks(spark, hot):
    """Hash tables with a group for almost every row are dealt out and not merged by compressed bytes."""
    orders, products = hot
    for mart, tables in (
        (gold.gold_daily_sales(orders, products, "2024-01-01", "2024-01-01"), 2),
        (gold._customer_profiles(orders, products), 1),
    ):
        dealt = re.findall(r"hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", stages(plan_of(mart)))
        assert [int(n) for n in dealt] == [int(spark.conf.get("spark.sql.shuffle.partitions"))] * tables


def test_reports_sum_before_they_join(spark, hot):
    orders, products = hot
    fact = orders.withColumn("processed_timestamp", F.current_timestamp())
    fact = star.fact_orders(fact)
    dim = products.select("product_id", "category")
    with small_partitions(spark):
        plan = stages(plan_of(star.revenue_by_category(fact, dim)))
    join = plan.index("SortMergeJoin")
    assert "partial_sum(total_amount" in plan[join:], "map-side sums sit below the join"


def test_hot_duplicates_are_limited_map_side(spark, hot):
    orders, _ = hot
    copies = orders.select(
        *[F.col(c).cast("string").alias(c) for c in schemas.ORDERS.names if c != "order_id"],
        F.when(F.col("product_id") == "p-hot", "same").otherwise(F.col("order_id")).alias("order_id"),
    )
    cleaned = clean.clean_orders(copies, "2024-01-01")
    plan = stages(plan_of(cleaned))
    below_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle
    assert cleaned.count() == copies.select("order_id").distinct().count()


@pytest.mark.parametrize("mart", ["sessions", "top_products", "daily", "inventory", "funnel"])
def test_aggregates_combine_before_the_shuffle(spark, hot, mart):
    orders, _ = hot
    clicks = orders.select(
        F.col("order_id").alias("session_id"), "customer_id", F.lit("purchase").alias("event_type"),
        "product_id", F.col("order_timestamp").alias("event_timestamp"),
    )
    df = {
        "sessions": lambda: basic.sessions(clicks),
        "top_products": lambda: basic.top_products(orders),
        "daily": lambda: basic.daily_sales_basic(orders),
        "inventory": lambda: basic.inventory_health_basic(derive.orders_to_sale_movements(orders)),
        "funnel": lambda: gold.gold_conversion_funnel(clicks, "2024-01-01"),
    }[mart]()
    plan = stages(plan_of(df))
    assert "partial_" in plan[plan.rindex("Exchange"):]
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_a_hot_day_is_written_by_several_tasks(spark, hot):
    orders, _ = hot
    root = tempfile.mkdtemp(prefix="run-")
    day = F.when(F.col("product_id") == "p-hot", F.lit("2024-01-01")).otherwise(
        F.date_format("order_timestamp", "yyyy-MM-01")
    ).cast("date")
    landed = writers.land_on(orders, day)
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64k"):
        writers.write_table(landed, root, "overwrite", writers.DAY_COLUMNS, rebalance=True)
    files = {}
    for path in pathlib.Path(root).rglob("*.parquet"):
        files.setdefault(str(path.parent.relative_to(root)), []).append(path)
    assert len(files["year=2024/month=1/day=1"]) > 1
    assert readers.read_table(spark, root).count() == orders.count()


def test_a_hot_day_of_a_packed_feed_is_several_files(spark, hot):
    orders, _ = hot
    root = tempfile.mkdtemp(prefix="run-")
    landed = writers.land_on(orders.drop("processed_timestamp"), F.lit("2024-01-01").cast("date"))
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64k"):
        writers.publish_feed(landed, root, compression="gzip")
    assert len(list(pathlib.Path(root).rglob("*.csv.gz"))) > 1, "a packed file is not split by its readers"
    assert readers.read_csv_feed(spark, root, schemas.ORDERS).count() == orders.count()


def test_the_queries_land_packed_feeds_and_tables(spark):
    """Text of the movements is some five times what it takes packed."""
    root = tempfile.mkdtemp(prefix="run-")
    movements = td.raw_movements(spark, SF)
    publish(movements, root + "/feed", "event_timestamp")
    writers.publish_feed(writers.land_on(movements, F.lit("2024-01-01").cast("date")), root + "/text")
    size = {
        name: sum(p.stat().st_size for p in pathlib.Path(root, name).rglob("part-*"))
        for name in ("feed", "text")
    }
    assert size["feed"] < size["text"] / 2, size
    writers.write_table(movements, root + "/table", "overwrite")
    assert all(".zstd." in p.name for p in pathlib.Path(root, "table").glob("part-*"))


def test_lines_move_once_to_their_orders(spark):
    with small_partitions(spark):
        found = td.raw_orders(spark, SF)
        plan = plan_of(found).split("+- == Initial Plan ==")[0]
    assert "hashpartitioning(l_orderkey" in plan
    assert not re.search(r"hashpartitioning\(l_orderkey#\d+L?, l_linenumber", plan), plan
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", plan)) == 1, plan
    want = td.raw_orders(spark, SF, td.order_lines(spark, SF))
    assert found.count() == want.count()
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_no_query_multiplies_rows_or_runs_python(spark):
    """No cartesian product, no nested loop join and no Python worker in any plan."""
    for name, run in QUERIES.items():
        plan = run(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert banned not in plan, (name, banned)


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["customer_metrics_basic"](spark, SF)._jdf.queryExecution()
    scan = plan.executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in scan
    assert "l_discount" not in scan and "o_totalprice" not in scan


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions_for(0, 64) == 64
    assert shuffle_partitions_for(10 * 2**40, 8000) == 81920

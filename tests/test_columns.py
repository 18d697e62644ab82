"""Bands, guards, picks and the clock on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.functions import bands, clock, guards, picks
from tests.helpers import texts


def labels(spark, rule, values, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", rule(F.col("x")).alias("y")).orderBy("i").collect()]


def test_sales_trend(spark):
    got = labels(spark, bands.sales_trend, [None, 20.0, 20.1, 19.9, 0.0, -0.1])
    assert got == ["New", "High Growth", "High Growth", "Stable", "Stable", "Declining"]


def test_inventory_status(spark):
    got = labels(spark, bands.inventory_status, [None, 1.0, 1.1, 0.99, 0.7, 0.69, 0.0])
    assert got == ["Unknown", "Critical", "Critical", "Watch", "Watch", "Healthy", "Healthy"]


def test_product_status(spark):
    got = labels(spark, lambda x: bands.product_status(x, F.lit(100.0)), [150.0, 149.9, 100.0, 99.9])
    assert got == ["Best Seller", "Good Performer", "Good Performer", "Slow Moving"]


def test_inventory_risk(spark):
    got = labels(spark, bands.inventory_risk, [-101, -100, -99, None], "bigint")
    assert got == ["Low Stock Risk", "Healthy", "Healthy", "Healthy"]


def test_sales_vs_popularity(spark):
    got = labels(spark, lambda x: bands.sales_vs_popularity(x, F.lit(10.0)), [51, 50, 10, 9], "bigint")
    assert got == ["Overperforming", "On Track", "On Track", "Underperforming"]
    got = labels(spark, lambda x: bands.sales_vs_popularity(F.lit(3), x), [None])
    assert got == ["On Track"]


def test_funnel_status(spark):
    got = labels(spark, bands.funnel_status, [15.0, 14.9, 8.0, 7.9, 250.0])
    assert got == ["Excellent", "Good", "Good", "Needs Attention", "Excellent"]


def test_customer_status(spark):
    seen = F.lit("2024-01-01").cast("timestamp")
    got = labels(spark, lambda x: bands.customer_status(seen, x), [30, 31, 90, 91, -1], "int")
    assert got == ["Active", "At Risk", "At Risk", "Inactive", "Active"]
    never = F.lit(None).cast("timestamp")
    assert labels(spark, lambda x: bands.customer_status(never, x), [None], "int") == [
        "Never Purchased"
    ]


def test_ratios(spark):
    df = spark.createDataFrame(
        [(1, 1, 4), (2, 1, 0), (3, None, 4), (4, 1, None), (5, 0, 4)], "i int, n int, d int"
    )
    n, d = F.col("n"), F.col("d")
    got = df.select(
        "i",
        guards.ratio_or_zero(n, d, 100).alias("z"),
        guards.ratio_or_null(n, d, 100).alias("u"),
    ).orderBy("i")
    assert [(r.z, r.u) for r in got.collect()] == [
        (25.0, 25.0), (0.0, None), (None, None), (None, None), (0.0, 0.0),
    ]


def test_conditional_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 4)], "k string, v int")
    a = F.col("k") == "a"
    got = df.agg(
        guards.sum_when(a, F.col("v")).alias("s"),
        guards.count_when(a).alias("n"),
        guards.any_when(a).alias("x"),
        guards.any_when(F.col("k") == "zz").alias("y"),
    ).first()
    assert tuple(got) == (1, 1, 1, 0)


def test_pick_one_is_total(spark):
    rows = [("k", "2", "b"), ("k", "2", "a"), ("k", "1", "0"), (None, "1", "x"), (None, "9", "y")]
    df = texts(spark, ["k", "v", "w"], rows)
    for parts in (1, 5):
        order = picks.total_order(df, ["v"], ["k"])
        got = picks.pick_one(df.repartition(parts), ["k"], order).collect()
        assert {tuple(r) for r in got} == {("k", "2", "a"), (None, "9", "y")}


def test_clock(spark):
    one = spark.range(1)
    at = dt.datetime(2024, 7, 6, 1, 2, 3)
    row = clock.stamp_run(one, at).first()
    assert (row.year, row.month, row.day) == (2024, 7, 6)
    row = clock.stamp_run(one, "2024-07-06T23:30:00-02:00").first()
    assert (row.year, row.month, row.day) == (2024, 7, 7)
    assert one.select(clock.as_of_date(dt.date(2024, 7, 6)).alias("d")).first().d == dt.date(2024, 7, 6)
    today = one.select((clock.as_of_date(None) == F.current_date()).alias("d")).first()
    assert today.d


def test_conform_names_and_modes(spark):
    schema = schemas._struct("a int, b date")
    df = texts(spark, ["b", "extra", "a"], [("2024-01-02", "x", " 7 "), ("soon", "y", "many")])
    got = schemas.conform(df, schema, "null")
    assert got.schema == schema
    assert [tuple(r) for r in got.collect()] == [(7, dt.date(2024, 1, 2)), (None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        schemas.conform(df, schema, "fail").collect()
    with pytest.raises(schemas.ContractError, match="'c'"):
        schemas.conform(df, schemas._struct("a int, c int"))
    with pytest.raises(ValueError, match="on_bad_value"):
        schemas.conform(df, schema, "maybe")

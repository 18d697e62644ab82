"""Marts that are kept up to date by the day, from their own stored rows.

The funnel is stored as day cells, whose distinct counts unite for any range of
days. Daily sales are stored by month; a day that comes late recomputes that day
from its orders, and the growth of each group's next row from the stored mart.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart import schemas
from lakemart.functions.clock import AsOf, RunTs
from lakemart.functions.guards import count_when
from lakemart.operators import bitmaps
from lakemart.plans import gold
from lakemart.session import folder_names, remove, stored
from lakemart.sources.writers import write_table

# ---- conversion funnel ----

STAGES = {
    "product_views": "view_product", "cart_additions": "add_to_cart",
    "checkout_starts": "checkout", "purchases": "purchase",
}
UNIQUE = {"customer": "unique_customers", "session": "unique_sessions"}


def funnel_cells(clicks: DataFrame, customers: DataFrame, sessions: DataFrame) -> DataFrame:
    """Cells per (event_day, product_id) of a landing; the dictionaries know all of its keys.

    Clicks are read once and combined per session before they meet the dictionaries.
    """
    event = F.col("event_type")
    seen = clicks.groupBy(
        F.to_date("event_timestamp").alias("event_day"), "product_id", "customer_id", "session_id"
    ).agg(*[count_when(event == kind).alias(name) for name, kind in STAGES.items()])
    numbered = bitmaps.members(
        seen, {"customer": "customer_id", "session": "session_id"}, {"customer": customers, "session": sessions})
    return bitmaps.cells(numbered, ["event_day", "product_id"], list(UNIQUE), list(STAGES))


def land_clicks(spark: SparkSession, root: str, clicks: DataFrame) -> None:
    """Add one landing of clicks to the funnel cells at ``root``."""
    home = root.rstrip("/")
    ids = {
        name: bitmaps.extend(spark, f"{home}/{name}_ids", clicks.select(column))
        for name, column in (("customer", "customer_id"), ("session", "session_id"))
    }
    month = F.date_format("event_day", "yyyy-MM")
    found = funnel_cells(clicks, ids["customer"], ids["session"]).withColumn("event_month", month)
    write_table(found, f"{home}/cells", "append", ["event_month"], rebalance=True)


def funnel_between(
    cells: DataFrame, first: dt.date | None = None, last: dt.date | None = None, run_ts: RunTs = None
) -> DataFrame:
    """The conversion funnel of a range of days, both ends included; all days by default."""
    if first is not None:
        cells = cells.where((F.col("event_day") >= F.lit(first)) & (F.col("event_month") >= f"{first:%Y-%m}"))
    if last is not None:
        cells = cells.where((F.col("event_day") <= F.lit(last)) & (F.col("event_month") <= f"{last:%Y-%m}"))
    return gold.funnel_of(bitmaps.counts(cells, ["product_id"], UNIQUE, list(STAGES)), run_ts)


# ---- daily sales ----

MONTH = "sale_month"
_GROUP = ["category", "brand"]
_STORED = T.StructType([*schemas.GOLD_DAILY_SALES.fields, T.StructField(MONTH, T.StringType())])
_NO_DAY = "none"


def _month(day: str | Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(_NO_DAY))


def read_sales(spark: SparkSession, root: str) -> DataFrame:
    """The maintained mart, with its month."""
    if not folder_names(spark, f"{root.rstrip('/')}/{MONTH}=*"):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).parquet(root)


def store_sales(mart: DataFrame, root: str) -> None:
    """Begin a maintained mart with the rows of a full run."""
    write_table(mart.withColumn(MONTH, _month("sale_date")), root, "overwrite", [MONTH], rebalance=True)


def refresh_sales(
    spark: SparkSession,
    root: str,
    day: dt.date,
    orders: DataFrame,
    products: DataFrame,
    as_of: AsOf = None,
    run_ts: RunTs = None,
) -> list[str]:
    """Replace one sale day of the mart at ``root``; the months that were rewritten.

    ``orders`` are those of ``day``, whether it is new, late or landed again; other
    rows are left out. Each of the day's groups takes its previous revenue from the
    stored mart. Where a group had or has the day, its next stored row gets the
    growth that follows, and the run's stamp. No other orders are read, and of the
    mart only narrow columns besides the rewritten months.
    """
    begin, end = (F.lit(d).cast("timestamp") for d in (day, day + dt.timedelta(days=1)))
    own = orders.where((F.col("order_timestamp") >= begin) & (F.col("order_timestamp") < end))
    totals = stored(gold.sales_totals(own, products, as_of))
    mart = read_sales(spark, root)
    narrow = mart.select("sale_date", *_GROUP, "total_revenue")
    # Rows without a date come before all others, as they do in the mart's window.
    earlier = F.col("sale_date").isNull() | (F.col("sale_date") < F.lit(day))
    around = narrow.groupBy(*_GROUP).agg(
        F.max_by(F.struct("total_revenue"), F.when(earlier, F.coalesce("sale_date", F.lit("0001-01-01").cast("date"))))
        .alias("before"),
        F.min(F.when(F.col("sale_date") > F.lit(day), F.col("sale_date"))).alias("next_date"),
        F.max(F.col("sale_date").eqNullSafe(F.lit(day))).alias("had"))
    groups = totals.select(
        *[F.col(c).alias(f"__{c}") for c in _GROUP], F.col("total_revenue").alias("own_revenue"), F.lit(True).alias("has"))
    same = F.col("category").eqNullSafe(F.col("__category")) & F.col("brand").eqNullSafe(F.col("__brand"))
    known = stored(
        around.join(groups, same, "left").where("had OR has").select(
            *[F.col(c).alias(f"__{c}") for c in _GROUP], F.col("before.total_revenue").alias("before"),
            # What the next row finds before it: the day itself, or without it what was before the day.
            F.when(F.col("has"), F.col("own_revenue")).otherwise(F.col("before.total_revenue")).alias("passed_on"),
            "next_date"))
    fresh = gold.sales_of(
        totals.join(known, same, "left").withColumn("previous_day_revenue", F.col("before"))
        .drop("before", "passed_on", "next_date", "__category", "__brand"), run_ts)
    months = {f"{day:%Y-%m}"} | {
        r[0] for r in known.where("next_date IS NOT NULL").select(_month("next_date")).distinct().collect()}
    rows = mart.where(F.col(MONTH).isin(sorted(months)) & ~F.col("sale_date").eqNullSafe(F.lit(day)))
    joined = rows.join(known, same & (F.col("sale_date") == F.col("next_date")), "left")
    kept = joined.where("next_date IS NULL").select(*schemas.GOLD_DAILY_SALES.names)
    grown = gold.sales_of(
        joined.where("next_date IS NOT NULL").withColumn("previous_day_revenue", F.col("passed_on")), run_ts)
    out = stored(kept.unionByName(grown).unionByName(fresh).withColumn(MONTH, _month("sale_date")))
    write_table(out, root, "dynamic", [MONTH], rebalance=True)
    _clear_empty(spark, root, out, months)
    return sorted(months)


def _clear_empty(spark: SparkSession, root: str, out: DataFrame, months: Sequence[str]) -> None:
    """Months left without rows: a dynamic overwrite does not clear them."""
    left = {r[0] for r in out.select(MONTH).distinct().collect()}
    for month in set(months) - left:
        remove(spark, f"{root.rstrip('/')}/{MONTH}={month}")

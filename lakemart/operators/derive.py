"""Rows derived from other feeds: enrichment, order-driven movements and clicks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.session import stored

UNMATCHED_MODES = ("fail", "null")
REPEATED_MODES = ("fail", "first")

PRODUCT_ATTRIBUTES = ("category", "brand", "cost_price", "launch_date", "is_active")

# Codes and offsets of the order-derived feeds.
SALE = "SALE"
WAREHOUSES = ("WH_BLR", "WH_MUM", "WH_DEL", "WH_HYD")
ORDER_FUNNEL = (
    ("view_product", 4),
    ("add_to_cart", 3),
    ("checkout", 2),
    ("purchase", 1),
)


def enrich_orders(
    orders: DataFrame,
    products: DataFrame,
    attributes: tuple[str, ...] = PRODUCT_ATTRIBUTES,
) -> DataFrame:
    """Orders with their product's attributes; unknown products give NULLs.

    ``products`` has one row per product (see ``current_version``). No
    broadcast hint: the planner broadcasts while the projected dimension is
    under its threshold and otherwise sort-merges, where adaptive execution
    splits the orders of a hot product over several tasks.
    """
    narrow = products.select("product_id", *attributes)
    return orders.drop(*attributes).join(narrow, "product_id", "left")


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    values: list[str],
    on_unmatched: str = "fail",
    on_repeated: str = "fail",
) -> DataFrame:
    """Add ``values`` found by ``key``; a key without a match is an error.

    With ``on_unmatched="null"`` the row stays, with NULLs. A matched key that
    ``dimension`` has more than once is an error too, or with
    ``on_repeated="first"`` gives the row whose ``values`` sort first.

    The dimension is reduced to one row a key and stored before the join. Then
    both sides of a sort-merge join are bare exchanges, and adaptive execution
    splits the facts of a hot key; an aggregate under the join would keep them in
    one task. A dimension that turns out small is broadcast.
    """
    if on_unmatched not in UNMATCHED_MODES:
        raise ValueError(f"on_unmatched must be one of {UNMATCHED_MODES}, got {on_unmatched!r}")
    if on_repeated not in REPEATED_MODES:
        raise ValueError(f"on_repeated must be one of {REPEATED_MODES}, got {on_repeated!r}")
    row, times = "__row", "__times"
    right = stored(dimension.groupBy(key).agg(
        F.min(F.struct(*values)).alias(row), F.count(F.lit(1)).alias(times)))
    joined = facts.join(right, key, "left")
    name = F.coalesce(F.col(key).cast("string"), F.lit("NULL"))

    def checked(value: str):
        # The checks sit on the looked-up columns themselves, so no later
        # projection that still uses one of them can optimise them away.
        found = F.col(f"{row}.{value}")
        if on_repeated == "fail":
            found = F.when(F.col(times) > 1, F.raise_error(F.concat(F.lit(f"repeated {key} "), name))).otherwise(found)
        if on_unmatched == "fail":
            missing = F.raise_error(F.concat(F.lit(f"no match for {key} "), name))
            found = F.when(F.col(times).isNull(), missing).otherwise(found)
        return found

    return joined.withColumns({v: checked(v) for v in values}).drop(row, times)


def price_orders(
    orders: DataFrame, products: DataFrame, on_unmatched: str = "fail"
) -> DataFrame:
    """Unit price from the product; total is quantity times price to the cent."""
    prices = products.select("product_id", F.col("price").alias("unit_price"))
    bare = orders.drop("unit_price", "total_amount")
    priced = lookup(bare, prices, "product_id", ["unit_price"], on_unmatched)
    total = F.round(F.col("quantity") * F.col("unit_price"), 2)
    return priced.withColumn("total_amount", total)


def order_amount_for_payments(
    payments: DataFrame, orders: DataFrame, on_unmatched: str = "fail"
) -> DataFrame:
    """Payments carrying their order's total as ``amount``."""
    totals = orders.select("order_id", F.col("total_amount").alias("amount"))
    return lookup(payments.drop("amount"), totals, "order_id", ["amount"], on_unmatched)


def _slot(key: Column, n: int) -> Column:
    """A stable number in ``0..n-1`` for a text key."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(n))


def orders_to_sale_movements(orders: DataFrame) -> DataFrame:
    """One SALE movement per order, leaving a warehouse fixed by the order id."""
    slot = _slot(F.col("order_id"), len(WAREHOUSES)).cast("int")
    warehouse = F.get(F.array(*[F.lit(w) for w in WAREHOUSES]), slot)
    return orders.select(
        F.concat(F.lit("INV_"), "order_id").alias("inventory_event_id"),
        "product_id",
        warehouse.alias("warehouse_id"),
        F.lit(SALE).alias("movement_type"),
        (-F.abs("quantity")).alias("quantity_change"),
        F.col("order_timestamp").alias("event_timestamp"),
    )


def orders_to_funnel_events(orders: DataFrame) -> DataFrame:
    """The four clicks that led to each order, one session per order."""
    steps = F.array(
        *[
            F.struct(F.lit(name).alias("event_type"), F.lit(minutes).alias("minutes"))
            for name, minutes in ORDER_FUNNEL
        ]
    )
    return orders.select(
        F.concat(F.lit("SESS_"), "order_id").alias("session_id"),
        "customer_id",
        "product_id",
        "order_timestamp",
        F.explode(steps).alias("step"),
    ).select(
        "session_id",
        "customer_id",
        F.col("step.event_type").alias("event_type"),
        "product_id",
        (F.col("order_timestamp") - F.make_dt_interval(mins=F.col("step.minutes"))).alias(
            "event_timestamp"
        ),
    )


def combine_movements(operational: DataFrame, from_orders: DataFrame) -> DataFrame:
    """Both movement feeds; nothing is removed."""
    return operational.unionByName(from_orders)


def combine_events(browsing: DataFrame, from_orders: DataFrame) -> DataFrame:
    """Both click feeds; nothing is removed."""
    return browsing.unionByName(from_orders)

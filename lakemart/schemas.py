"""Column contracts of every feed and table, and the check applied at job borders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "money": T.DecimalType(10, 2),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Columns as ``name type`` pairs; unlike a DDL string this needs no session."""
    pairs = [pair.split() for pair in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# ---- typed feeds (after cleaning) ----
CUSTOMERS = _struct(
    "customer_id string, first_name string, last_name string, email string, city string,"
    " state string, signup_date date, loyalty_tier string, preferred_category string"
)
PRODUCTS = _struct(
    "product_id string, product_name string, category string, subcategory string, brand string,"
    " cost_price double, price double, popularity_score double, launch_date date, is_active boolean"
)
PRODUCT_CHANGES = _struct(
    "product_id string, product_name string, category string, subcategory string, brand string,"
    " price double, cost_price double, popularity_score double, launch_date date,"
    " is_active boolean, operation string, source_updated_at timestamp"
)
ORDERS = _struct(
    "order_id string, customer_id string, product_id string, quantity int, unit_price double,"
    " total_amount double, payment_method string, order_status string, order_timestamp timestamp"
)
PAYMENTS = _struct(
    "payment_id string, order_id string, payment_method string, payment_status string,"
    " amount double, currency string, payment_timestamp timestamp"
)
INVENTORY = _struct(
    "inventory_event_id string, product_id string, warehouse_id string, movement_type string,"
    " quantity_change int, event_timestamp timestamp"
)
CLICKSTREAM = _struct(
    "session_id string, customer_id string, event_type string, product_id string,"
    " event_timestamp timestamp"
)

# ---- type-2 product history ----
PRODUCT_HISTORY = _struct(
    "product_id string, product_name string, category string, subcategory string, brand string,"
    " price double, cost_price double, popularity_score double, launch_date date,"
    " is_active boolean, effective_from timestamp, effective_to timestamp, is_current boolean,"
    " processed_timestamp timestamp"
)

# ---- star schema ----
FACT_ORDERS = _struct(
    "order_id string, customer_id string, product_id string, quantity int,"
    " unit_price money, total_amount money, payment_method string,"
    " order_status string, order_timestamp timestamp, processed_timestamp timestamp"
)

# ---- gold marts ----
RUN_COLUMNS = "processed_timestamp timestamp, year int, month int, day int"

GOLD_DAILY_SALES = _struct(
    "sale_date date, category string, brand string, total_orders bigint, units_sold bigint,"
    " total_revenue double, unique_customers bigint, unique_products bigint,"
    " average_order_value double, average_order_quantity double, estimated_cost double,"
    " gross_profit double, gross_margin_percent double, active_products_sold bigint,"
    " new_product_revenue double, previous_day_revenue double, daily_growth_percent double,"
    " sales_trend string, " + RUN_COLUMNS
)
GOLD_INVENTORY_HEALTH = _struct(
    "product_id string, product_name string, category string, subcategory string, brand string,"
    " is_active boolean, warehouse_id string, stock_in bigint, stock_out bigint,"
    " sales_inventory bigint, adjustments bigint, total_outbound bigint,"
    " net_inventory_change bigint, total_inventory_events bigint, last_inventory_event timestamp,"
    " days_since_last_inventory_event int, inventory_consumption_ratio double,"
    " inventory_status string, warehouse_activity_rank int, " + RUN_COLUMNS
)
GOLD_PRODUCT_PERFORMANCE = _struct(
    "product_id string, product_name string, category string, subcategory string, brand string,"
    " price double, cost_price double, launch_date date, is_active boolean,"
    " popularity_score double, total_orders bigint, units_sold bigint, total_revenue double,"
    " average_order_quantity double, unique_customers bigint, first_sale_date timestamp,"
    " last_sale_date timestamp, days_since_last_sale int, stock_in bigint, stock_out bigint,"
    " adjustments bigint, sales_inventory bigint, net_inventory_change bigint,"
    " estimated_cost double, gross_profit double, gross_margin_percent double,"
    " average_product_revenue double, product_status string, inventory_risk string,"
    " sales_vs_popularity string, " + RUN_COLUMNS
)
GOLD_CONVERSION_FUNNEL = _struct(
    "product_id string, product_views bigint, cart_additions bigint, checkout_starts bigint,"
    " purchases bigint, unique_customers bigint, unique_sessions bigint,"
    " view_to_cart_rate double, cart_to_checkout_rate double, checkout_to_purchase_rate double,"
    " overall_conversion_rate double, cart_abandonments bigint, checkout_abandonments bigint,"
    " funnel_status string, " + RUN_COLUMNS
)
GOLD_CUSTOMER_METRICS = _struct(
    "customer_id string, first_name string, last_name string, email string, city string,"
    " state string, signup_date date, customer_tenure_days int, loyalty_tier string,"
    " preferred_category string, total_orders bigint, total_quantity bigint,"
    " total_revenue double, average_order_value double, highest_order_value double,"
    " lowest_order_value double, average_order_quantity double, first_purchase_date timestamp,"
    " last_purchase_date timestamp, days_since_last_purchase int, favorite_category string,"
    " favorite_brand string, most_recent_category string, most_recent_brand string,"
    " most_recent_purchase_timestamp timestamp, customer_status string, " + RUN_COLUMNS
)

BAD_VALUE_MODES = ("null", "fail")


class ContractError(ValueError):
    """A frame lacks a column its contract names."""


def cast_column(name: str, target: T.DataType, on_bad_value: str = "null") -> Column:
    """``name`` as ``target``; a malformed cell becomes NULL or stops the job."""
    if on_bad_value not in BAD_VALUE_MODES:
        raise ValueError(f"on_bad_value must be one of {BAD_VALUE_MODES}, got {on_bad_value!r}")
    column = F.col(name)
    typed = column.try_cast(target) if on_bad_value == "null" else column.cast(target)
    return typed.alias(name)


def require(df: DataFrame, names: list[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ContractError(f"{what}: missing columns {missing}; found {df.columns}")


def conform(
    df: DataFrame,
    schema: T.StructType,
    on_bad_value: str = "null",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Select the contract's columns by name, in order and typed; ``keep`` rides along."""
    require(df, [*schema.names, *keep], "conform")
    have = {f.name: f.dataType for f in df.schema.fields}
    typed = [
        F.col(f.name)
        if have[f.name] == f.dataType
        else cast_column(f.name, f.dataType, on_bad_value)
        for f in schema.fields
    ]
    return df.select(*typed, *keep)


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns as they arrive in a text feed."""
    return T.StructType([T.StructField(n, T.StringType()) for n in schema.names])

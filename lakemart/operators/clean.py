"""Text feeds to typed, deduplicated tables.

Every cleaner selects its contract's columns by name, types them, keeps one
row per key under a total order (latest first, then all other columns, so the
survivor does not depend on file order) and stamps the run. Landing-day
columns ride along where the feed has them. Records that a reader set aside as
malformed are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart import schemas
from lakemart.functions.clock import RunTs, stamp
from lakemart.functions.picks import pick_one, total_order
from lakemart.sources.readers import DAY_COLUMNS, well_formed


def _landing(df: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in DAY_COLUMNS if c in df.columns)


def _clean(
    raw: DataFrame,
    schema: T.StructType,
    key: str,
    newest: Sequence[str],
    run_ts: RunTs,
    on_bad_value: str,
) -> DataFrame:
    raw = well_formed(raw)
    landing = _landing(raw)
    typed = schemas.conform(raw, schema, on_bad_value, keep=landing)
    order = total_order(typed, [*newest, *landing], [key])
    return stamp(pick_one(typed, [key], order), run_ts)


def clean_customers(
    raw: DataFrame, run_ts: RunTs = None, on_bad_value: str = "null"
) -> DataFrame:
    """One typed row per customer; the latest landing wins."""
    return _clean(raw, schemas.CUSTOMERS, "customer_id", [], run_ts, on_bad_value)


def clean_inventory(
    raw: DataFrame, run_ts: RunTs = None, on_bad_value: str = "null"
) -> DataFrame:
    """One typed row per inventory movement; the latest event time wins."""
    newest = ["event_timestamp"]
    return _clean(raw, schemas.INVENTORY, "inventory_event_id", newest, run_ts, on_bad_value)


def clean_orders(raw: DataFrame, run_ts: RunTs = None, on_bad_value: str = "null") -> DataFrame:
    """One typed row per order; the latest order time wins."""
    newest = ["order_timestamp"]
    return _clean(raw, schemas.ORDERS, "order_id", newest, run_ts, on_bad_value)


def clean_payments(raw: DataFrame, on_bad_value: str = "null") -> DataFrame:
    """Typed payments; the feed has a contract but no table is built from it."""
    return schemas.conform(well_formed(raw), schemas.PAYMENTS, on_bad_value, keep=_landing(raw))


def clean_clickstream(raw: DataFrame, on_bad_value: str = "null") -> DataFrame:
    """Typed click events. Repeated events are kept: the feed has no event key."""
    return schemas.conform(well_formed(raw), schemas.CLICKSTREAM, on_bad_value, keep=_landing(raw))


def clean_product_changes(
    raw: DataFrame, run_ts: RunTs = None, on_bad_value: str = "null"
) -> DataFrame:
    """The change batch: trimmed, typed, latest event per product.

    Rows without a product or an operation are dropped; text that is empty
    after trimming is kept, and so is an operation code nobody knows.
    """
    usable = _usable_changes(raw, on_bad_value)
    order = total_order(usable, ["source_updated_at"], ["product_id"])
    return stamp(pick_one(usable, ["product_id"], order), run_ts)


def type_product_changes(
    raw: DataFrame, run_ts: RunTs = None, on_bad_value: str = "null"
) -> DataFrame:
    """Every event of the change feed, trimmed and typed as above: what a replay takes."""
    return stamp(_usable_changes(raw, on_bad_value), run_ts)


def _usable_changes(raw: DataFrame, on_bad_value: str) -> DataFrame:
    trimmed = ("product_id", "product_name", "category", "subcategory", "brand")
    schemas.require(raw, schemas.PRODUCT_CHANGES.names, "product changes")
    neat = well_formed(raw).withColumns(
        {
            **{c: F.trim(c) for c in trimmed},
            "operation": F.upper(F.trim("operation")),
        }
    )
    typed = schemas.conform(neat, schemas.PRODUCT_CHANGES, on_bad_value)
    return typed.where(F.col("product_id").isNotNull() & F.col("operation").isNotNull())

import datetime as dt

import pytest

from lakemart import schemas
from lakemart.operators import clean
from tests.helpers import rows_by, texts, ts

RUN = "2024-06-01 00:00:00"


def test_customers_latest_landing_wins(spark):
    names = [*schemas.CUSTOMERS.names, "year", "month", "day"]
    base = ("c1", "A", "B", "e", "old", "s", "2024-05-06", "Gold", "Books")
    newer = (*base[:4], "new", *base[5:])
    raw = texts(
        spark,
        names,
        [
            (*base, "2024", "5", "9"),
            (*newer, "2024", "5", "10"),
            ("c2", *base[1:6], "not a date", "Gold", None, "2024", "5", "9"),
        ],
    )
    raw = raw.withColumns({c: raw[c].cast("int") for c in ("year", "month", "day")})
    got = rows_by(clean.clean_customers(raw, RUN), "customer_id")
    assert got["c1"].city == "new" and got["c1"].signup_date == dt.date(2024, 5, 6)
    assert got["c1"].day == 10
    assert got["c2"].signup_date is None
    assert got["c2"].processed_timestamp == ts(RUN)


def test_orders_types_ties_and_bad_cells(spark):
    def row(order_id, qty, amount, at):
        return (order_id, "c", "p", qty, "9.5", amount, "UPI", "Placed", at)

    raw = texts(
        spark,
        schemas.ORDERS.names,
        [
            row("o1", "2", "19.0", "2024-05-06T01:02:03.123456"),
            row("o1", "3", "28.5", "2024-05-06T01:02:03.123457"),
            row("o1", "9", "85.5", "bad time"),
            row("o2", "two", "19.0", "2024-05-06T00:00:00"),
            row("o3", "2", "1.0", "2024-05-06T00:00:00"),
            row("o3", "1", "5.0", "2024-05-06T00:00:00"),
        ],
    )
    got = rows_by(clean.clean_orders(raw, RUN), "order_id")
    assert (got["o1"].quantity, got["o1"].order_timestamp.microsecond) == (3, 123457)
    assert got["o2"].quantity is None
    assert got["o3"].quantity == 1, "equal times fall back to the other columns"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.clean_orders(raw, RUN, on_bad_value="fail").collect()


def test_reordered_columns_are_taken_by_name(spark):
    raw = texts(
        spark,
        list(reversed(schemas.INVENTORY.names)),
        [("2024-05-06T01:02:03", "-4", "SALE", "WH_BLR", "p", "i1")],
    )
    row = clean.clean_inventory(raw, RUN).first()
    assert (row.inventory_event_id, row.warehouse_id, row.quantity_change) == ("i1", "WH_BLR", -4)


def test_clicks_and_payments_keep_repeats(spark):
    click = ("s", "c", "purchase", "p", "2024-05-06T01:02:03")
    got = clean.clean_clickstream(texts(spark, schemas.CLICKSTREAM.names, [click, click]))
    assert got.schema == schemas.CLICKSTREAM and got.count() == 2
    pay = ("x", "o", "Wallet", "FAILED", "1.5", "INR", "2024-05-06T01:02:03")
    got = clean.clean_payments(texts(spark, schemas.PAYMENTS.names, [pay]))
    assert got.schema == schemas.PAYMENTS and got.first().amount == 1.5


def change(product_id, operation, at="2024-01-01T00:00:00", price="1.5", active="True"):
    return (product_id, " n ", "c", "s", "b", price, "1", "7", "2023-01-31", active, operation, at)


def test_product_changes(spark):
    raw = texts(
        spark,
        schemas.PRODUCT_CHANGES.names,
        [
            change(" p1 ", " i "),
            change("p1", "u", "2024-01-02T00:00:00", price="2"),
            change("", "I"),
            change(None, "I"),
            change("p2", None),
            change("p3", "X", price="cheap", active="maybe"),
            change("p4", "d", "2024-01-01T00:00:00", price="2"),
            change("p4", "u", "2024-01-01T00:00:00", price="1"),
        ],
    )
    got = rows_by(clean.clean_product_changes(raw, RUN), "product_id")
    assert set(got) == {"p1", "", "p3", "p4"}
    assert (got["p1"].operation, got["p1"].price, got["p1"].product_name) == ("U", 2.0, "n")
    assert (got["p3"].operation, got["p3"].price, got["p3"].is_active) == ("X", None, None)
    assert got["p4"].operation == "U", "a tie goes by the remaining columns"

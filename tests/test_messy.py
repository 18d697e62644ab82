"""The SQL twins again, on tables full of holes.

Cells are blanked, parts and orders go missing and customers stop ordering, so
NULL, zero and unmatched branches that the driver's tables never reach are
compared too.
"""

import tempfile

import duckdb
import pandas as pd
import pytest

from lakemart.checks.oracle import ORACLE
from lakemart.checks.queries import REGISTRY as QUERIES
from tests.test_oracle import normal

SOURCE = "/root/testdata/sf0.001"

# Which cells go blank: about one in `n`, by a hash of the row.
BLANKED = {
    "lineitem": {"l_quantity": 11, "l_extendedprice": 7, "l_shipdate": 13, "l_suppkey": 17, "l_returnflag": 19},
    "orders": {"o_custkey": 9, "o_orderdate": 8, "o_orderstatus": 10},
    "part": {"p_brand": 6, "p_type": 5, "p_retailprice": 4, "p_size": 7, "p_name": 9},
    "customer": {"c_name": 5, "c_mktsegment": 7},
    "events": {"user_id": 9, "value": 6, "props": 8, "event_type": 10, "ts": 12},
    "documents": {"lang": 6, "source": 9},
}
KEPT = {
    "orders": "o_custkey % 3 <> 0",
    "part": "p_partkey % 10 <> 0",
    "lineitem": "l_partkey % 7 <> 0",
}

# Not on holes: these stop at an order without a match, as they should.
STRICT = {"payment_amounts"}
NAMES = sorted(set(QUERIES) - STRICT)


@pytest.fixture(scope="module")
def messy():
    folder = tempfile.mkdtemp(prefix="run-")
    con = duckdb.connect()
    con.execute("SET default_null_order = 'nulls_first_on_asc_last_on_desc'")
    for name, holes in BLANKED.items():
        cells = ", ".join(
            f"CASE WHEN hash(row_number() OVER (), '{c}') % {n} = 0 THEN NULL ELSE {c} END AS {c}"
            for c, n in holes.items()
        )
        con.execute(
            f"COPY (SELECT * REPLACE ({cells}) FROM '{SOURCE}/{name}.parquet'"
            f" WHERE {KEPT.get(name, 'true')}) TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return folder, con


def test_holes_are_there(messy):
    _, con = messy
    for name, holes in BLANKED.items():
        for c in holes:
            blank = con.execute(f"SELECT count(*) FROM {name} WHERE {c} IS NULL").fetchall()[0][0]
            assert blank > 0, (name, c)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql_on_holes(spark, messy, name):
    folder, con = messy
    got = QUERIES[name](spark, folder).toPandas()
    want = con.execute(ORACLE[name]).df()
    left, right = normal(got), normal(want)
    assert len(left) == len(right) > 0
    for c in left.columns:
        a, b = (s.astype(object).where(s.notna(), None) for s in (left[c], right[c]))
        pd.testing.assert_series_equal(a, b, check_dtype=False, check_names=False)


def test_payments_stop_at_a_missing_order(spark, messy):
    with pytest.raises(Exception, match="no match for order_id"):
        QUERIES["payment_amounts"](spark, messy[0]).collect()

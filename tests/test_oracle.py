"""Every registered query against its SQL twin over the whole tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from lakemart.checks.oracle import ORACLE
from lakemart.checks.queries import REGISTRY as QUERIES

SF_DIR = os.environ.get("LAKEMART_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame()
    for column in sorted(frame.columns):
        values = frame[column]
        if "date" in column or "timestamp" in column or column.startswith(("effective", "session_")):
            try:
                values = pd.to_datetime(values, format="ISO8601").astype("datetime64[us]")
            except (ValueError, TypeError):
                pass
        out[column] = values
    # Rank each column's text once, then sort by the ranks.
    ranks = pd.DataFrame({c: pd.factorize(out[c].astype(str), sort=True)[0] for c in out.columns})
    order = ranks.sort_values(list(ranks.columns)).index
    return out.iloc[order].reset_index(drop=True)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLE[name])
    kinds = {d[0]: str(d[1]) for d in want.description}
    same = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    assert {n: same[t] for n, t in got.dtypes} == kinds
    left, right = normal(got.toPandas()), normal(want.df())
    assert len(left) == len(right) > 0
    # No tolerance: values are exact on both sides.
    pd.testing.assert_frame_equal(left, right, check_dtype=False, check_exact=True)

"""Keep-one tables maintained landing by landing.

A table is stored under ``<root>/buckets=<n>/bucket=<b>/`` by a hash of its key.
A landing touches the buckets of its own keys; only those are read, joined with
the landing and replaced. As the survivor is the first row in a total order,
the table equals the one kept from all landings at once, whatever their order
and however often one of them comes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.picks import pick_one, total_order
from lakemart.session import folder_names, stored
from lakemart.sources.writers import DAY_COLUMNS, write_table

BUCKET = "bucket"
STAMP = "processed_timestamp"
#: Buckets of a new table. A landing of ``k`` keys reads at most ``k`` of them.
BUCKETS = 256


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def home_of(spark: SparkSession, root: str, buckets: int = BUCKETS) -> tuple[str, int]:
    """Folder and bucket count of a table; a stored one keeps the count it began with."""
    found = folder_names(spark, f"{root.rstrip('/')}/buckets=*")
    if len(found) > 1:
        raise ValueError(f"{root} holds several bucket counts: {found}")
    n = int(found[0].removeprefix("buckets=")) if found else buckets
    return f"{root.rstrip('/')}/buckets={n}", n


def slices(spark: SparkSession, home: str, schema: T.StructType, buckets: Sequence[int] | None = None) -> DataFrame:
    """The stored rows, of the named buckets alone if given: no other folder is opened."""
    if not folder_names(spark, f"{home}/{BUCKET}=*"):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).parquet(home)
    return table if buckets is None else table.where(F.col(BUCKET).isin(list(buckets)))


def touched(rows: DataFrame) -> list[int]:
    """Buckets that ``rows`` belong to: at most as many numbers as there are buckets."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def land(
    spark: SparkSession,
    root: str,
    cleaned: DataFrame,
    key: str,
    newest: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> list[int]:
    """Bring one cleaned landing into the table at ``root``; the buckets that it touched.

    Of rows with one key the latest by ``newest`` and landing day stays, then the
    first by all other columns, as the cleaners choose it. Of equal rows the one
    with the earliest stamp stays, so a repeated landing changes nothing. One run
    at a time may write; one that died is repeated.
    """
    home, n = home_of(spark, root, buckets)

    def kept(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        days = [c for c in DAY_COLUMNS if c in df.columns]
        plain = df.drop(BUCKET, STAMP)
        order = total_order(plain, [*newest, *days], [key])
        return pick_one(df, keys, [*order, *([F.col(STAMP).asc()] if STAMP in df.columns else [])])

    fresh = stored(kept(cleaned.withColumn(BUCKET, bucket_of([key], n)), [key]))
    hit = touched(fresh)
    if hit:
        old = slices(spark, home, fresh.schema, hit)
        # A key has at most two rows by now, so one exchange serves the choice and the folders.
        both = old.unionByName(fresh).repartitionByRange(BUCKET, key)
        write_table(kept(both, [BUCKET, key]), home, "dynamic", [BUCKET])
    return hit


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """The table as of its last landing, without the bucket column."""
    home, _ = home_of(spark, root)
    return spark.read.parquet(home).drop(BUCKET)

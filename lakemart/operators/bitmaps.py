"""Exact distinct counts that add up: bitmaps over dense ids, stored per day.

Keys get numbers from a dictionary that only grows, new keys of one landing next
to each other. The members of a group and day are then bitmaps of 32,768 numbers
each, which Spark builds and unites inside its aggregates; any range of days is
their union, without the events and without a sort for each distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.session import folder_names, stored

#: Parts in which new keys are numbered side by side.
PARTS = 1024


def dictionary(spark: SparkSession, root: str) -> DataFrame:
    """Rows (key, id) so far."""
    if not folder_names(spark, f"{root.rstrip('/')}/*.parquet"):
        return spark.createDataFrame([], "key string, id bigint")
    return spark.read.schema("key string, id bigint").parquet(root)


def extend(spark: SparkSession, root: str, keys: DataFrame, parts: int = PARTS) -> DataFrame:
    """Number the keys that the dictionary at ``root`` lacks; the whole dictionary.

    ``keys`` has one text column; nulls get no number. Numbers begin at 1 and have
    no gaps; one that is given stays. New keys are dealt by hash and numbered part
    by part; only the parts' sizes pass through the driver. One run at a time.
    """
    known = dictionary(spark, root)
    fresh = (
        keys.toDF("key").where("key IS NOT NULL").distinct().join(known, "key", "left_anti")
        .withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")))
    fresh = stored(fresh)
    sizes = dict(fresh.groupBy("part").count().collect())
    if sizes:
        before, starts = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0], []
        for part in range(parts):
            starts.append(before)
            before += sizes.get(part, 0)
        start = F.get(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col("part"))
        row = F.row_number().over(Window.partitionBy("part").orderBy("key"))
        fresh.select("key", (start + row).alias("id")).write.mode("append").parquet(root)
    return dictionary(spark, root)


def members(df: DataFrame, columns: dict[str, str], dictionaries: dict[str, DataFrame]) -> DataFrame:
    """``df`` with the number of each key: new name to key column, and its dictionary."""
    for name, column in columns.items():
        numbers = dictionaries[name].select(F.col("key").alias(f"__{name}"), F.col("id").alias(name))
        df = df.join(numbers, F.col(column) == F.col(f"__{name}"), "left").drop(f"__{name}")
    return df


def cells(df: DataFrame, groups: Sequence[str], ids: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Rows (groups, member, slot, bits, sums): one for the sums, and one for each bitmap.

    ``df`` is best combined by groups and ids before, as its rows are repeated for
    every id here. A null id is in no bitmap, as ``count_distinct`` skips nulls.
    """
    def part(name: str | None) -> Column:
        number = F.col(name) if name else F.lit(None).cast("bigint")
        kept = [(F.lit(0).cast("bigint") if name else F.col(s).cast("bigint")).alias(s) for s in sums]
        return F.struct(F.lit(name).cast("string").alias("member"), number.alias("number"), *kept)

    every = F.filter(F.array(part(None), *[part(i) for i in ids]),
                     lambda p: p["member"].isNull() | p["number"].isNotNull())
    flat = df.select(*groups, F.explode(every).alias("p")).select(*groups, "p.*")
    return flat.withColumn("slot", F.bitmap_bucket_number("number")).groupBy(*groups, "member", "slot").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce("number", F.lit(1)))).alias("bits"),
        *[F.sum(s).alias(s) for s in sums])


def counts(cells: DataFrame, groups: Sequence[str], ids: dict[str, str], sums: Sequence[str]) -> DataFrame:
    """Sums and exact distinct counts per ``groups`` over any union of cells; id name to new name."""
    united = cells.groupBy(*groups, "member", "slot").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("__n"), *[F.sum(s).alias(s) for s in sums])
    return united.groupBy(*groups).agg(
        *[F.sum(s).alias(s) for s in sums],
        *[F.coalesce(F.sum(F.when(F.col("member") == i, F.col("__n"))), F.lit(0)).alias(new) for i, new in ids.items()])

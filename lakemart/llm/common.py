"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import scratch_dir


#: Whether the shuffle files of a statement go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % parts


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Statements inside leave no shuffle files behind."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Later steps start from the files, so a lost executor costs no recomputation and
    the shuffle files behind them are of no more use: they go at once, not when the
    driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark) + "/staged"
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Characters in all texts: sizes the work, never the result."""
    return int(docs.agg(F.coalesce(F.sum(F.length(column)), F.lit(0))).first()[0])


def python_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each batch with its columns as Python lists."""
    for batch in batches:
        yield batch, [c.to_pylist() for c in batch.columns]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (id, component), the smallest reachable id.

    Alternates large-star and small-star steps; every step is two shuffles of
    the edge table, and a hot node's edges shrink to one per neighbour. The
    edges are cut from their lineage in the shared folder after each round.
    """
    def directed(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    current = staged(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        # Large star: each larger neighbour of a node points at the node's least neighbour.
        both = directed(current)
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least.withColumn("m", F.least("a", "m")), "a")
            .where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        # Small star: each node's smaller neighbours and itself point at the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        current = staged(small)
        state = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start..start+length-1 of all ranges, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)

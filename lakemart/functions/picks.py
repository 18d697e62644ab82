"""Keep one row per key under an explicit total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key group in ``order``.

    The rank filter plans as a window group limit, so every map task sends at
    most one row per key: a key holding a large share of the rows reaches the
    reducer as one row per map task.
    """
    rank = "__rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)


def total_order(df: DataFrame, newest: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """``newest`` descending, then every other column ascending: equal ranks mean equal rows."""
    settled = {*newest, *keys}
    rest = [F.col(c).asc() for c in df.columns if c not in settled]
    return [*[F.col(c).desc() for c in newest], *rest]

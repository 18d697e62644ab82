"""Ordered windows over hot keys, as prefix scans of blocks with carried state.

A window puts all rows of its key into one task. Here the rows of a key with more
than ``limit`` rows are cut into blocks along the first order column, at
percentiles of its own values; blocks are windows of their own in as many
tasks. What a block needs of the blocks before it, its last value or their row
count, is carried over a table of one row a block. Rows of other keys stay in one
block. Orders are ascending with nulls first, as are the results'.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import stored

LIMIT, BLOCKS = 1_000_000, 64
BLOCK, _HOT, _CARRY = "__block", "__hot", "__carry"


def _number(df: DataFrame, column: str) -> Column:
    """The column as a number that keeps its order."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.col(column)
    raise TypeError(f"blocks need a number, date or time to cut along, not {column} {kind.simpleString()}")


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__{k}" for k in keys})


def in_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int = LIMIT, blocks: int = BLOCKS
) -> tuple[DataFrame, bool]:
    """``df`` with its block number and whether its key is hot, and if any key is."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    hot = stored(_renamed(counts, keys))
    if hot.isEmpty():
        return df.withColumns({BLOCK: F.lit(0), _HOT: F.lit(False)}), False
    shares = [i / blocks for i in range(1, blocks)]
    at = _number(df, order[0])
    # Blocks of a quarter of the limit, as far as there are blocks: of all cuts every few are kept.
    wanted = F.least(F.ceil(F.lit(4) * F.max("__n") / F.lit(limit)), F.lit(blocks)).cast("bigint").alias("__k")
    step = lambda i: F.floor((i + F.lit(1)) * F.col("__k") / blocks) > F.floor(i * F.col("__k") / blocks)
    cuts = stored(_renamed(
        df.select(*keys, at.alias("__at")).join(hot, _same(keys)).groupBy(*keys)
        .agg(F.percentile_approx("__at", shares, 10_000).alias("__cuts"), wanted)
        .select(*keys, F.filter("__cuts", lambda _, i: step(i)).alias("__cuts"), F.lit(True).alias("__is")), keys))
    # Rows before the first cut, and nulls, are block 0; equal values share a block.
    block = F.coalesce(F.size(F.filter("__cuts", lambda cut: cut < at)), F.lit(0))
    block = F.when(F.col("__cuts").isNull() | at.isNull(), 0).otherwise(block)
    found = df.join(cuts, _same(keys), "left").withColumns(
        {BLOCK: block, _HOT: F.coalesce("__is", F.lit(False))})
    return found.drop("__cuts", "__is", *[f"__{k}" for k in keys]), True


def with_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: dict[str, str] | None = None,
    number: str | None = None,
    limit: int = LIMIT,
    blocks: int = BLOCKS,
) -> DataFrame:
    """Add ``previous`` values (new name: column), as ``lag`` gives them, and row numbers.

    ``order`` should tell the rows of a key apart, or ties fall as they may.
    """
    previous = previous or {}
    df = stored(df)  # read for counts, cuts, ends and rows
    cut, any_hot = in_blocks(df, keys, order, limit, blocks)
    row = number or "__row"
    w = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    local = cut.withColumns(
        {row: F.row_number().over(w), **{new: F.lag(old).over(w) for new, old in previous.items()}})
    if not any_hot:
        return local.drop(BLOCK, _HOT, *([] if number else [row]))
    last = F.max_by(F.struct(*[F.col(c).alias(new) for new, c in previous.items()], F.lit(1).alias("__one")),
                    F.struct(*order))
    ends = cut.where(_HOT).groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("__n"), last.alias("__last"))
    by_block = Window.partitionBy(*keys).orderBy(BLOCK)
    carried = stored(_renamed(ends.select(
        *keys, BLOCK, F.lag("__last").over(by_block).alias("__carry"),
        F.coalesce(F.sum("__n").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
    ), [*keys, BLOCK]))
    first = F.col(row) == 1
    out = local.join(carried, _same([*keys, BLOCK]), "left").withColumns(
        {new: F.when(first, F.coalesce(F.col(new), F.col(f"__carry.{new}"))).otherwise(F.col(new)) for new in previous})
    if number:
        out = out.withColumn(number, (F.col(row) + F.coalesce("__before", F.lit(0))).cast("bigint"))
    names = [*df.columns, *previous, *([number] if number else [])]
    return out.select(*names)


def next_where(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    condition: Column,
    value: Column,
    name: str,
    limit: int = LIMIT,
    blocks: int = BLOCKS,
    merge: Callable[[DataFrame, list[str]], DataFrame] | None = None,
    deal: dict[str, Column] | None = None,
) -> DataFrame:
    """Add ``name``: ``value`` in a struct, of the first later row of the key that meets ``condition``.

    Null where no later row does; the struct tells that from a null value. ``merge``
    makes one row of equal ones, grouping by all columns it is given, too. ``deal`` are
    columns that follow from the keys and say which rows share a task. Whatever the
    number of hot keys, whole rows move once: what comes after a block travels as a
    row of the block. ``df`` is read up to four times.
    """
    deal = deal or {}
    cut, any_hot = in_blocks(df, keys, order, limit, blocks)
    group = [*keys, BLOCK] if any_hot else [*keys]
    hit = F.when(condition, F.struct(value.alias("value")))
    rows, given = cut.drop(_HOT), [BLOCK]
    ahead = [F.col(c).desc_nulls_last() for c in order]
    if any_hot:
        # A block without such a row takes the next block that has one.
        firsts = cut.where(_HOT).groupBy(*group).agg(
            F.min_by(F.struct(value.alias("value")), F.when(condition, F.struct(*order))).alias("__first"))
        by_block = Window.partitionBy(*keys).orderBy(F.desc(BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
        carried = firsts.select(*group, F.last("__first", ignorenulls=True).over(by_block).alias(_CARRY))
        rows = rows.unionByName(carried.where(F.col(_CARRY).isNotNull()), allowMissingColumns=True)
        hit, given = F.coalesce(F.col(_CARRY), hit), [BLOCK, _CARRY]
        ahead = [F.col(_CARRY).isNull(), *ahead]
    rows = rows.withColumns(deal) if deal else rows
    rows = rows.repartition(*(deal or keys), *group[len(keys):])
    if merge:
        rows = merge(rows, [*given, *(c for c in deal if c not in given)])
    # Backwards, so that the frame only ever grows by a row.
    later = Window.partitionBy(*deal, *group).orderBy(*ahead).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn(name, F.last(hit, ignorenulls=True).over(later))
    if any_hot:
        found = found.where(F.col(_CARRY).isNull())
    return found.select(*df.columns, *(c for c in deal if c not in df.columns), name)

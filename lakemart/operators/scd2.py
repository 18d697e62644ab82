"""Type-2 product history from an insert/update/delete batch.

Only the current slice of the history is ever read or rewritten; versions that
a batch closes are added to the past. Each batch writes one folder named after
itself, so nothing is overwritten while it is being read and running a batch
again changes nothing.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart import schemas
from lakemart.operators.blocks import LIMIT, next_where
from lakemart.operators.landing import BUCKET, BUCKETS, bucket_of, home_of, slices
from lakemart.session import folder_names, move, remove, stored
from lakemart.sources.writers import by_folder, empty_like, write_table

COLUMNS = schemas.PRODUCT_HISTORY.names

# Operation codes of the change feed.
INSERT, UPDATE, DELETE = "I", "U", "D"


def empty_history(spark: SparkSession) -> DataFrame:
    return empty_like(schemas.PRODUCT_HISTORY, spark)


def advance(current: DataFrame, batch: DataFrame, expire_on_insert: bool = False) -> DataFrame:
    """Apply one cleaned batch (one row per product) to the current slice.

    The result holds the slice's versions, still current or now closed, and the
    added ones, told apart by ``is_current``. U and D close the product's
    current versions at the event time; I and U add a current version. An I for
    a product that already has one leaves both current unless
    ``expire_on_insert``; a U for an unknown product still adds one; other codes
    change nothing. A closed version keeps its ``processed_timestamp``.
    """
    closing = [UPDATE, DELETE, INSERT] if expire_on_insert else [UPDATE, DELETE]
    ends = batch.where(F.col("operation").isin(closing)).select(
        "product_id",
        F.col("source_updated_at").alias("__ended_at"),
        F.lit(True).alias("__ended"),
    )
    ended = F.col("__ended").isNotNull()
    carried = (
        current.join(ends, "product_id", "left")
        .withColumns(
            {
                "effective_to": F.when(ended, F.col("__ended_at")).otherwise(F.col("effective_to")),
                "is_current": ~ended,
            }
        )
        .select(COLUMNS)
    )
    added = (
        batch.where(F.col("operation").isin(INSERT, UPDATE))
        .withColumns(
            {
                "effective_from": F.col("source_updated_at"),
                "effective_to": F.lit(None).cast("timestamp"),
                "is_current": F.lit(True),
            }
        )
        .select(COLUMNS)
    )
    return carried.unionByName(added)


def apply_scd2(history: DataFrame, batch: DataFrame, expire_on_insert: bool = False) -> DataFrame:
    """The whole history after ``batch``, as one frame."""
    past = history.where(~F.col("is_current")).select(COLUMNS)
    return past.unionByName(advance(history.where("is_current"), batch, expire_on_insert))


EVENT = [n for n in schemas.PRODUCT_CHANGES.names if n != "source_updated_at"]
#: Events of a bucket that share a task.
SLICE_ROWS = 500_000
_SLICE = "__slice"


def replay(changes: DataFrame, expire_on_insert: bool = False, limit: int = LIMIT) -> DataFrame:
    """The history that all events of a change feed lead to, in whatever order they landed.

    ``changes`` are typed events (see ``clean.type_product_changes``), any number
    for a product. They count in order of their event time, ties by all other
    columns, each as a batch of its own would in ``advance``: I and U begin a
    version, and the next U or D of the product (or I, with ``expire_on_insert``)
    ends it. An event that landed twice counts once, with its earliest stamp.

    One sorted pass over each product's events, in which a version looks ahead for
    its end; a product with more than ``limit`` events is cut along the time. The
    feed is stored first, as products are counted before their events are dealt.
    """
    return _versions(stored(changes), expire_on_insert, limit).select(COLUMNS)


def _versions(
    changes: DataFrame, expire_on_insert: bool, limit: int = LIMIT, deal: dict[str, Column] | None = None
) -> DataFrame:
    """The history of events that are read from files, with the columns by which it is dealt."""
    closing = [UPDATE, DELETE, INSERT] if expire_on_insert else [UPDATE, DELETE]

    def once(events: DataFrame, given: list[str]) -> DataFrame:
        return events.groupBy(*schemas.PRODUCT_CHANGES.names, *given).agg(
            F.min("processed_timestamp").alias("processed_timestamp"))

    order = ["source_updated_at", *[c for c in EVENT if c != "product_id"]]
    events = changes.select(*schemas.PRODUCT_CHANGES.names, "processed_timestamp")
    ended = next_where(
        events, ["product_id"], order, F.col("operation").isin(closing), F.col("source_updated_at"), "__end", limit,
        merge=once, deal=deal)
    return (
        ended.where(F.col("operation").isin(INSERT, UPDATE))
        .withColumns({
            "effective_from": F.col("source_updated_at"),
            "effective_to": F.col("__end.value"),
            "is_current": F.col("__end").isNull(),
        })
        .select(*COLUMNS, *(deal or {}))
    )


def land_changes(
    spark: SparkSession, root: str, changes: DataFrame, expire_on_insert: bool = False, buckets: int = BUCKETS
) -> list[int]:
    """Add typed events to the log at ``root`` and replay the products of the buckets they touch.

    Batches may come late, in any order and more than once: the stored history is
    always that of ``replay`` over all events so far. Only the touched buckets of
    log and history are read, and only those of the history replaced. A batch
    joins the log once its history is there, under a name made of its events, so
    one that died is repeated, and one that landed before is known by them.
    """
    home = root.rstrip("/")
    log, n = home_of(spark, f"{home}/events", buckets)
    landings, n = home_of(spark, f"{home}/landings", n)
    history, _ = home_of(spark, f"{home}/history", n)
    pending = f"{home}/_pending/{uuid.uuid4().hex}"
    watch = Observation(f"landing-{uuid.uuid4().hex}")
    fresh = changes.select(*schemas.PRODUCT_CHANGES.names, "processed_timestamp")
    dealt = by_folder(fresh.observe(watch, *_fingerprint()).withColumn(BUCKET, bucket_of(["product_id"], n)), [BUCKET])
    # A product's events side by side: their texts compress well, here and whenever they are dealt out again.
    write_table(dealt.sortWithinPartitions(BUCKET, "product_id", "source_updated_at"), pending, "overwrite", [BUCKET])
    hit = sorted(int(f.removeprefix(f"{BUCKET}=")) for f in folder_names(spark, f"{pending}/{BUCKET}=*"))
    # A write without rows may leave nothing to observe.
    name, first, last = _name(watch.get) if hit else ("", 0, 0)
    if not hit or _landed(spark, landings, name, first):
        remove(spark, pending)
        return hit
    schema = T.StructType([*fresh.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    # Logs of earlier versions have one folder for all batches.
    parts = [log, *(f"{landings}/{f}" for f in folder_names(spark, f"{landings}/landing=*")), pending]
    events = reduce(DataFrame.unionByName, [slices(spark, p, schema, hit) for p in parts])
    share = max(-(-events.count() // (len(hit) * SLICE_ROWS)), 1)
    deal = {BUCKET: bucket_of(["product_id"], n),
            _SLICE: F.pmod(F.xxhash64(F.lit(1), "product_id"), F.lit(share)).cast("int")}
    # Dealt by bucket already, so each task writes few folders without another exchange.
    write_table(_versions(events, expire_on_insert, deal=deal).drop(_SLICE), history, "dynamic", [BUCKET])
    # A bucket of deletes alone has no version to replace its folder with; nor had it one before.
    move(spark, pending, f"{landings}/landing={name}_at{last}_{uuid.uuid4().hex[:8]}")
    return hit


def _fingerprint() -> list[Column]:
    """Of a batch: number of events, two sums of their hashes, its first and last stamp."""
    stamp = F.coalesce(F.unix_micros("processed_timestamp"), F.lit(0))
    names = schemas.PRODUCT_CHANGES.names
    # A hash does not tell where a null stands.
    whole = [*names, *(F.col(c).isNull() for c in names)]
    total = lambda *columns: F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))
    return [F.count(F.lit(1)).alias("n"), total(*whole).alias("a"), total(F.lit(1), *whole).alias("b"),
            F.min(stamp).alias("first"), F.max(stamp).alias("last")]


def _name(found: dict) -> tuple[str, int, int]:
    return f"{found['n']}_{found['a']}_{found['b']}", found["first"] or 0, found["last"] or 0


def _landed(spark: SparkSession, landings: str, name: str, first: int) -> bool:
    """Whether these events landed before, with no later stamps."""
    return any(
        int(re.search(r"_at(-?\d+)_", f)[1]) <= first
        for f in folder_names(spark, f"{landings}/landing={name}_at*"))


def read_replayed(spark: SparkSession, root: str) -> DataFrame:
    """The history that ``land_changes`` maintains."""
    home, _ = home_of(spark, f"{root.rstrip('/')}/history")
    fields = [*schemas.PRODUCT_HISTORY.fields, T.StructField(BUCKET, T.IntegerType())]
    return slices(spark, home, T.StructType(fields)).select(COLUMNS)


def current_version(history: DataFrame) -> DataFrame:
    """Rows in force now. Marts take this, never the whole history."""
    return history.where("is_current")


def check_one_current(history: DataFrame) -> DataFrame:
    """Products with more than one version in force, and how many."""
    return (
        history.where("is_current")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("current_versions"))
        .where("current_versions > 1")
    )


def check_overlaps(history: DataFrame) -> DataFrame:
    """Versions that start before the previous version of their product ended."""
    w = Window.partitionBy("product_id").orderBy(
        F.col("effective_from").asc(), F.col("effective_to").asc_nulls_last()
    )
    previous = F.lag(F.struct("effective_to")).over(w)
    return (
        history.withColumn("__previous", previous)
        .where(
            F.col("__previous").isNotNull()
            & (
                F.col("__previous.effective_to").isNull()
                | (F.col("__previous.effective_to") > F.col("effective_from"))
            )
        )
        .drop("__previous")
    )


# ---- storage: <root>/batch=<id>/is_current=<true|false>, <root>/compact=<id>/..., <root>/_published/ ----

_STORED = T.StructType(list(schemas.PRODUCT_HISTORY.fields))
_PUBLISHED, _COMPACT = "_published", "compact="
_SAFE_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _names(spark: SparkSession, pattern: str) -> list[str]:
    place, fs = _files(spark, pattern)
    return sorted(f.getPath().getName() for f in fs.globStatus(place) or [])


def _checked_id(batch_id: str) -> str:
    if not _SAFE_ID.fullmatch(batch_id):
        raise ValueError(f"batch id {batch_id!r} may hold letters, digits, dot, dash and underscore")
    return batch_id


def _mark(spark: SparkSession, root: str, name: str) -> None:
    """Make ``name`` visible; of two writers of one name the second fails."""
    place, fs = _files(spark, f"{root.rstrip('/')}/{_PUBLISHED}/{name}")
    fs.create(place, False).close()


def published_batches(spark: SparkSession, root: str) -> list[str]:
    """Ids of the batches whose own marker was set after the data job, in order."""
    names = _names(spark, f"{root.rstrip('/')}/{_PUBLISHED}/*")
    return [n for n in names if not n.startswith(_COMPACT)]


def _compacted(spark: SparkSession, root: str) -> str | None:
    """The newest batch that a finished compaction covers."""
    names = _names(spark, f"{root.rstrip('/')}/{_PUBLISHED}/{_COMPACT}*")
    return names[-1].removeprefix(_COMPACT) if names else None


def _unmarked(spark: SparkSession, root: str, done: list[str]) -> list[str]:
    """Batch folders with data and no marker: a run that died, or is under way."""
    found = _names(spark, f"{root.rstrip('/')}/batch=*")
    return [n for n in (f.removeprefix("batch=") for f in found) if n not in done]


def _slice(spark: SparkSession, root: str, folder: str, current: bool) -> DataFrame | None:
    """One stored slice, if it has rows; only its own folder is opened."""
    path = f"{root.rstrip('/')}/{folder}/is_current={str(current).lower()}"
    place, fs = _files(spark, path)
    if not fs.exists(place):
        return None
    names = [f for f in _STORED.fields if f.name != "is_current"]
    stored = spark.read.schema(T.StructType(names)).parquet(path)
    return stored.withColumn("is_current", F.lit(current)).select(COLUMNS)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The versions in force after the newest batch: one folder, however many batches."""
    done = published_batches(spark, root)
    if not done:
        return read_history(spark, root)
    covered = _compacted(spark, root)
    folder = f"{_COMPACT}{covered}" if covered == done[-1] else f"batch={done[-1]}"
    found = _slice(spark, root, folder, current=True)
    return empty_history(spark) if found is None else found


def read_history(spark: SparkSession, root: str, upto: str | None = None) -> DataFrame:
    """Every version as of batch ``upto`` (the newest published one by default).

    Of batches that a compaction covers only its state is left, so ``upto`` can't
    be older. Data without any marker is an error: it was never published, or
    the markers are lost.
    """
    every = published_batches(spark, root)
    if not every and _unmarked(spark, root, every):
        raise ValueError(f"{root} holds batches, but none is published; repeat the first one")
    covered = _compacted(spark, root)
    done = [b for b in every if upto is None or b <= upto]
    if not done:
        return empty_history(spark)
    if covered is not None and done[-1] < covered:
        raise ValueError(f"batch {upto!r} is part of the history compacted up to {covered!r}")
    later = [f"batch={b}" for b in done if covered is None or b > covered]
    folders = ([f"{_COMPACT}{covered}"] if covered is not None else []) + later
    parts = [_slice(spark, root, f, current=False) for f in folders]
    parts.append(_slice(spark, root, folders[-1], current=True))
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None], empty_history(spark))


def publish_batch(
    spark: SparkSession,
    root: str,
    batch_id: str,
    batch: DataFrame,
    expire_on_insert: bool = False,
) -> bool:
    """Apply ``batch`` to the stored history; False if it is already there.

    Ids must sort in batch order. Closed and current versions are written by
    one job into a folder of their own; the batch is visible once its marker
    is set after that job, and a run that died before it is simply repeated.
    Another batch's folder without a marker stops the run: it has to be
    repeated first, or else its changes would be lost.
    """
    done = published_batches(spark, root)
    if _checked_id(batch_id) in done:
        return False
    if done and batch_id < done[-1]:
        raise ValueError(f"batch {batch_id!r} sorts before the published {done[-1]!r}")
    open_ids = [b for b in _unmarked(spark, root, done) if b != batch_id]
    if open_ids:
        raise ValueError(f"batches {open_ids} have data but were not published; repeat them first")
    current = read_current(spark, root) if done else empty_history(spark)
    folder = f"{root.rstrip('/')}/batch={batch_id}"
    write_table(advance(current, batch, expire_on_insert), folder, mode="overwrite", partition_by=["is_current"])
    _mark(spark, root, batch_id)
    return True


def compact(spark: SparkSession, root: str) -> bool:
    """Merge the closed versions of all published batches and the newest current slice.

    Superseded folders go once the merged one is marked, so a reader that began
    before may have to start again; False if there is nothing to merge. No
    batch may be published meanwhile.
    """
    done = published_batches(spark, root)
    covered = _compacted(spark, root)
    if not done or covered == done[-1]:
        return False
    base, upto = root.rstrip("/"), done[-1]
    write_table(read_history(spark, root), f"{base}/{_COMPACT}{upto}", mode="overwrite", partition_by=["is_current"])
    _mark(spark, root, f"{_COMPACT}{upto}")
    old = [f"batch={b}" for b in done] + ([f"{_COMPACT}{covered}"] if covered is not None else [])
    for folder in old:
        remove(spark, f"{base}/{folder}")
    return True

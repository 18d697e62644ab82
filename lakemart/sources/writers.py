"""Table and feed writes."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import folder_names, move, remove
from lakemart.sources.readers import DAY_COLUMNS, LINE_ESCAPES

WRITE_MODES = ("append", "overwrite", "dynamic")

# How date and time cells look in a text feed.
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DATE_TEXT = "yyyy-MM-dd"


def by_folder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Group rows by target folder before a partitioned write.

    A rebalance, not a plain repartition: adaptive execution splits a folder
    that holds far more than its share over several tasks and merges small
    ones, so a hot day neither lands in one task nor scatters into tiny files.
    """
    return df.hint("rebalance", *columns)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    compression: str = "zstd",
) -> None:
    """Write parquet.

    ``append`` adds files, ``overwrite`` replaces the table, ``dynamic``
    replaces only the partitions present in ``df`` and so is safe to re-run.
    Pass ``rebalance`` when many partitions are written at once; a run that
    fills a single partition does not need the extra shuffle.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, got {mode!r}")
    if mode == "dynamic" and not partition_by:
        raise ValueError("dynamic overwrite needs partition columns")
    if rebalance and partition_by:
        df = by_folder(df, partition_by)
    writer = df.write.mode("append" if mode == "append" else "overwrite").option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode != "append":
        # Set both ways: a session default must not decide what gets deleted.
        overwrite = "dynamic" if mode == "dynamic" else "static"
        writer = writer.option("partitionOverwriteMode", overwrite)
    writer.parquet(path)


def write_day(df: DataFrame, path: str, day: dt.date) -> None:
    """Replace one day's folder by ``df``, also when ``df`` has no rows.

    A dynamic overwrite only clears partitions that it has rows for; here the
    run knows its day. A row of another day stops the write.
    """
    own = (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    stop = F.raise_error(F.lit(f"a row is not of {day}")).cast("boolean")
    rows = df.where(F.when(own, True).otherwise(stop)).drop(*DAY_COLUMNS)
    folder = f"{path.rstrip('/')}/year={day.year}/month={day.month}/day={day.day}"
    write_table(rows, folder, "overwrite")


def write_gold(df: DataFrame, path: str, day: dt.date | None = None) -> None:
    """Write a mart into its run's partition; running again replaces that run.

    Without the run's ``day`` a second run that finds no rows leaves the first one's.
    """
    if day is not None:
        write_day(df, path, day)
    else:
        write_table(df, path, mode="dynamic", partition_by=DAY_COLUMNS)


@dataclass(frozen=True)
class Checks:
    """What a day's rows have to meet before they are made visible.

    ``not_null`` columns without nulls, ``ranges`` of least and greatest values,
    no more than ``max_repeats`` rows beyond one for each ``key``, at least
    ``min_rows``, and a row count that differs from the present one of that day by
    no more than the share ``max_change``.
    """

    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    ranges: Mapping[str, tuple] = field(default_factory=dict)
    max_repeats: int = 0
    min_rows: int = 1
    max_change: float | None = None

    def metrics(self) -> list[Column]:
        return [
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"nulls {c}") for c in self.not_null],
            *[F.count_if((F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high))).alias(f"outside {c}")
              for c, (low, high) in self.ranges.items()],
        ]

    def broken(self, found: Mapping[str, int], before: int | None) -> list[str]:
        out = [name for name, n in found.items() if name.startswith(("nulls ", "outside ")) and n]
        if found["repeats"] > self.max_repeats:
            out.append("repeats")
        if found["rows"] < self.min_rows:
            out.append("rows")
        if self.max_change is not None and before and abs(found["rows"] - before) > self.max_change * before:
            out.append("change")
        return sorted(out)


class Refused(ValueError):
    """A day's rows that did not meet their checks; the day's earlier rows are still in place."""

    def __init__(self, day: dt.date, broken: list[str], found: dict[str, int]):
        super().__init__(f"{day} refused for {broken}: {found}")
        self.broken, self.found = broken, found


def write_checked(df: DataFrame, path: str, day: dt.date, checks: Checks) -> dict[str, int]:
    """Replace one day's folder by ``df`` if it meets ``checks``; what was found.

    Rows go to a folder that readers pass over, counted by the write itself; only
    repeats need a second look, at the key columns of what was written. Then the
    folders change places, or ``Refused`` is raised and the day stays as it was.
    """
    spark, home = df.sparkSession, path.rstrip("/")
    pending = f"{home}/_pending/{uuid.uuid4().hex}"
    watch = Observation(f"checks-{uuid.uuid4().hex}")
    rows = df.drop(*DAY_COLUMNS).observe(watch, *checks.metrics())
    write_table(rows, f"{pending}/new", "overwrite")
    found = {k: int(v) for k, v in watch.get.items()}
    written = spark.read.schema(rows.schema).parquet(f"{pending}/new")
    found["repeats"] = found["rows"] - written.select(*checks.key).distinct().count() if checks.key else 0
    folder = f"{home}/year={day.year}/month={day.month}/day={day.day}"
    there = bool(folder_names(spark, folder))
    before = spark.read.schema(rows.schema).parquet(folder).count() if there else None
    broken = checks.broken(found, before)
    if not broken:
        if there:
            move(spark, folder, f"{pending}/old")
        move(spark, f"{pending}/new", folder)
    remove(spark, pending)
    if broken:
        raise Refused(day, broken, found)
    return found


def create_bucketed(df: DataFrame, name: str, key: str, buckets: int, mode: str = "error") -> None:
    """Store ``df`` as a catalog table dealt by ``key``: joins and sums by it need no exchange.

    Both tables of a join take the same number of buckets. A hot key is one bucket,
    so this is for keys with many values of like size.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def create_table_as(df: DataFrame, name: str, mode: str = "error") -> None:
    """Materialise ``df`` as a catalog table."""
    df.write.mode(mode).format("parquet").saveAsTable(name)


def _single_lines(df: DataFrame, escape_lines: bool) -> DataFrame:
    """Text columns with line breaks escaped, or an error at the first one."""

    def safe(name: str) -> Column:
        text = F.col(name)
        if not escape_lines:
            broken = F.raise_error(F.lit(f"{name} holds a line break; publish with escape_lines"))
            return F.when(F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r")), broken).otherwise(text)
        for raw, spelled in LINE_ESCAPES:
            text = F.replace(text, F.lit(raw), F.lit(spelled))
        return text

    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: safe(c) for c in texts})


def publish_feed(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    mode: str = "append",
    escape_lines: bool = False,
    compression: str = "none",
) -> None:
    """Write a feed as text under ``year=/month=/day=`` folders.

    ``df`` carries the three day columns. CSV gets a header; JSON is one record
    per line. Times are ISO text with microseconds in both. Text keeps its
    blanks, quotes and backslashes. CSV cannot tell empty text from NULL: both
    read back as NULL. A CSV cell can't hold a line break, or its file could not
    be split: the write stops on one, or with ``escape_lines`` spells it as an
    escape that ``read_csv_feed`` undoes.

    Text is several times the size of the rows in it; ``compression="gzip"`` lands
    it packed, and the readers unpack it by the file's name. Such a file is read by
    one task, but the rebalance splits a hot day over files of a bounded size.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"fmt must be csv or json, got {fmt!r}")
    if fmt == "csv":
        df = _single_lines(df, escape_lines)
    writer = by_folder(df, DAY_COLUMNS).write.mode(mode).partitionBy(*DAY_COLUMNS)
    writer = writer.option("timestampFormat", TIMESTAMP_TEXT).option("dateFormat", DATE_TEXT)
    writer = writer.option("compression", compression)
    if fmt == "csv":
        plain = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
        writer.options(header="true", **plain).csv(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)


def land_on(df: DataFrame, at: Column) -> DataFrame:
    """Add the day columns of a landing date."""
    return df.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)})


def audit(df: DataFrame, name: str = "audit") -> tuple[DataFrame, Observation]:
    """Count the rows that flow to the next write, in that same job.

    Read ``observation.get["rows"]`` once the write is done.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def empty_like(df_schema: T.StructType, spark) -> DataFrame:
    """No rows, declared columns: the first state of a table."""
    return spark.createDataFrame([], df_schema)

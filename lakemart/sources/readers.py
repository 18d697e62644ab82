"""Feed and table scans."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart import schemas

DAY_COLUMNS = ("year", "month", "day")
CORRUPT = "_corrupt_record"
BAD_RECORD_MODES = ("fail", "aside")

# How line breaks are spelled in a CSV feed that escapes them.
LINE_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def _on_bad_record(reader, mode: str):
    """Stop at a malformed record, or keep it whole in a column of its own.

    Without column pruning, so that a record is judged by all of its cells,
    whatever the job reads of it.
    """
    if mode not in BAD_RECORD_MODES:
        raise ValueError(f"on_bad_record must be one of {BAD_RECORD_MODES}, got {mode!r}")
    reader = reader.option("columnPruning", "false")
    if mode == "fail":
        return reader.option("mode", "FAILFAST")
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def set_aside(df: DataFrame) -> DataFrame:
    """The malformed records of a feed read with ``on_bad_record="aside"``."""
    return df.where(F.col(CORRUPT).isNotNull())


def well_formed(df: DataFrame) -> DataFrame:
    """The records that are not set aside; a feed without that column as it is."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in df.columns else df


def unescape_lines(df: DataFrame) -> DataFrame:
    """Undo the line-break escapes of ``publish_feed`` in every text column."""

    def plain(name: str):
        # Between doubled backslashes every other one begins a line break.
        def breaks(part):
            for raw, spelled in LINE_ESCAPES[1:]:
                part = F.replace(part, F.lit(spelled), F.lit(raw))
            return part

        return F.array_join(F.transform(F.split(name, r"\\\\", -1), breaks), "\\")

    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: plain(c) for c in texts})


def read_csv_feed(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    base_path: str | None = None,
    days_from_path: bool = False,
    on_bad_record: str = "fail",
    escaped_lines: bool = False,
) -> DataFrame:
    """All-text CSV feed under ``path``, with its landing day as int columns.

    Columns are taken by header name, never by position: with ``schema`` the
    feed must hold all of its columns, and only those are kept. Names come from
    one header; every other file's header is checked against it during the
    scan, so a file laid out differently stops the job instead of filling the
    wrong columns.

    The day comes from the partition folders. Set ``days_from_path`` for feeds
    whose folders cannot be discovered as partitions (uneven depth, extra
    levels): then it is read off each file's path.

    A record with too few or too many cells stops the job; with
    ``on_bad_record="aside"`` it stays, marked in ``_corrupt_record``, and the
    cleaners leave it out (see ``set_aside``). ``escaped_lines`` undoes the
    escapes that ``publish_feed`` writes on request.
    """
    # Quotes inside a quoted cell are doubled, so a backslash is only itself.
    options = {"header": "true", "enforceSchema": "false", "escape": '"'}
    if base_path:
        options["basePath"] = base_path
    if days_from_path:
        options["recursiveFileLookup"] = "true"
    reader = _on_bad_record(spark.read.options(**options), on_bad_record)
    df = reader.csv(path)
    if on_bad_record == "aside":
        header = [f for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = reader.schema(T.StructType([*header, T.StructField(CORRUPT, T.StringType())])).csv(path)
    if days_from_path:
        df = with_path_day(df)
    if escaped_lines:
        df = unescape_lines(df)
    if schema is None:
        return df
    schemas.require(df, schema.names, f"feed {path}")
    others = (*DAY_COLUMNS, CORRUPT)
    return df.select(*schema.names, *[c for c in others if c in df.columns and c not in schema.names])


#: Header lines that one feed may mix.
GENERATIONS = 50


def headers_of(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, header): the first line of every file under ``path``, as text.

    Only lines of a file's first block are looked at; of those one a file is kept.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return (
        lines.select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"),
                     F.col("_metadata.file_block_start").alias("at"))
        .where("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))
    )


def read_csv_generations(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    required: tuple[str, ...] = (),
    renamed: dict[str, str] | None = None,
    on_bad_record: str = "fail",
    escaped_lines: bool = False,
) -> DataFrame:
    """All-text CSV feed whose files differ in their headers, in the contract's columns.

    Files are grouped by header line and every group is read by its own names, so
    reordered, missing and added columns never fill a wrong one. ``renamed`` gives
    old names their present ones. A column that a group lacks is null there, unless
    it is ``required``: then the group stops the job, as do two columns of one
    name. Columns outside the contract are left out; landing days ride along.

    Costs one more text scan than ``read_csv_feed``, which stays the reader for
    feeds of one header. An empty file has no header and no rows.
    """
    groups = headers_of(spark, path).groupBy("header").agg(F.collect_list("file").alias("files"))
    found = groups.limit(GENERATIONS + 1).collect()
    if len(found) > GENERATIONS:
        raise schemas.ContractError(f"feed {path}: more than {GENERATIONS} different headers")
    out = None
    for row in sorted(found, key=lambda r: r.header):
        files = [unquote(f) for f in sorted(row.files)]
        part = read_csv_feed(
            spark, files, base_path=path, on_bad_record=on_bad_record, escaped_lines=escaped_lines)
        names = [(renamed or {}).get(c, c) for c in part.columns]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise schemas.ContractError(f"feed {path}: columns {twice} come twice in {row.header!r}")
        part = part.toDF(*names)
        schemas.require(part, list(required), f"feed {path}, header {row.header!r}")
        others = [c for c in (*DAY_COLUMNS, CORRUPT) if c in names and c not in schema.names]
        part = part.select(
            *[F.col(c) if c in names else F.lit(None).cast("string").alias(c) for c in schema.names], *others)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], schemas.as_text(schema)) if out is None else out


def read_json_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    base_path: str | None = None,
    on_bad_record: str = "fail",
) -> DataFrame:
    """JSON-lines feed with every field as text; no inference pass over the data.

    A broken line stops the job or is set aside, as in ``read_csv_feed``.
    """
    fields = list(schemas.as_text(schema).fields)
    if on_bad_record == "aside":
        fields.append(T.StructField(CORRUPT, T.StringType()))
    reader = _on_bad_record(spark.read.schema(T.StructType(fields)), on_bad_record)
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.json(path)


def day_path(path: str, day: dt.date) -> str:
    """Glob of one day's folder, padded (``month=07``) or not (``month=7``)."""

    def either(value: int) -> str:
        return f"{{{value:02d},{value}}}" if value < 10 else str(value)

    return (
        f"{path.rstrip('/')}/year={day.year}/month={either(day.month)}/day={either(day.day)}"
    )


def read_csv_day(
    spark: SparkSession,
    path: str,
    day: dt.date,
    schema: T.StructType | None = None,
    on_bad_record: str = "fail",
) -> DataFrame:
    """One day of a CSV feed. Only that day's folder is listed, however long the feed."""
    return read_csv_feed(
        spark, day_path(path, day), schema, base_path=path, on_bad_record=on_bad_record)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; schema and partition columns come from the files."""
    return spark.read.parquet(path)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """A table or view by catalog name."""
    return spark.table(name)


def name_for_sql(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temporary view and hand it back."""
    df.createOrReplaceTempView(name)
    return df


def with_path_day(df: DataFrame) -> DataFrame:
    """``year, month, day`` from the file path, for feeds read file by file."""
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        *[F.regexp_extract(path, rf"{c}=(\d+)", 1).try_cast("int").alias(c) for c in DAY_COLUMNS],
    )


def with_run_day(df: DataFrame, day: dt.date) -> DataFrame:
    """``year, month, day`` from the run's own parameters."""
    return df.withColumns(
        {"year": F.lit(day.year), "month": F.lit(day.month), "day": F.lit(day.day)}
    )

"""The injected clock: business date, run time and the run columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = dt.date | str | None
RunTs = dt.datetime | str | None


def as_of_date(as_of: AsOf) -> Column:
    """The business date as a column; the wall clock only when none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def run_timestamp(run_ts: RunTs) -> Column:
    """The run time as a column, read in the session zone unless it carries its own."""
    if run_ts is None:
        return F.current_timestamp()
    text = run_ts.isoformat() if isinstance(run_ts, dt.datetime) else run_ts
    return F.lit(text).cast("timestamp")


def stamp(df: DataFrame, run_ts: RunTs) -> DataFrame:
    return df.withColumn("processed_timestamp", run_timestamp(run_ts))


def stamp_run(df: DataFrame, run_ts: RunTs) -> DataFrame:
    """Add ``processed_timestamp`` and the run partition ``year, month, day``."""
    at = run_timestamp(run_ts)
    return df.withColumns(
        {
            "processed_timestamp": at,
            "year": F.year(at),
            "month": F.month(at),
            "day": F.dayofmonth(at),
        }
    )

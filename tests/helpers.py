import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

UTC = dt.timezone.utc


def ts(text):
    """A UTC time for comparing with collected zone-aware columns."""
    return dt.datetime.fromisoformat(text)


def frame(spark, schema, rows):
    """Rows given as tuples of text or values, typed by ``schema`` through casts."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    plain = [tuple(None if v is None else str(v) for v in row) for row in rows]
    raw = spark.createDataFrame(plain, text)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def texts(spark, names, rows):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.createDataFrame(rows, schema)


def rows_by(df, *keys):
    found = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        key = key[0] if len(keys) == 1 else key
        assert key not in found, f"{key} twice"
        found[key] = row
    return found


def plan_of(df):
    """The executed plan, after adaptive execution has settled it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()

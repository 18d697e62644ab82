"""Session settings and shared scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the size-dependent work: it turns a join into a
# broadcast only when the measured side is under the threshold, splits skewed
# join partitions and merges small shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, cores: int) -> int:
    """Initial shuffle partition count for a stage moving ``shuffle_bytes``.

    One partition per 128 MB, at least one per core; adaptive execution merges
    what turns out too small, but it never splits an aggregate's partition, so
    the starting count has to follow the data.
    """
    by_size = -(-shuffle_bytes // _TARGET_PARTITION_BYTES)
    return max(cores, by_size)


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder name every executor can reach.

    Taken under ``spark.checkpoint.dir``; a local session without that setting
    uses its warehouse folder, a cluster has to name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/lakemart-{uuid.uuid4().hex}"


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and folders that a path pattern finds in its store, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(f.getPath().getName() for f in fs.globStatus(place) or [])


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; its target may not exist yet."""
    at, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Deal rows by ``columns`` over all shuffle partitions; adaptive execution leaves them as they are.

    It merges partitions by their compressed bytes, and rows of repeated names take thirty
    times as much in a hash table: one that holds about as many groups as rows wants this.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and continue from the files.

    Unlike a checkpoint, files tell the planner their size, so a small frame is
    still broadcast and a large one is a bare scan below its exchange.
    """
    path = scratch_dir(df.sparkSession) + "/stored"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and continue from there.

    Survives the loss of executors, unlike cached blocks. The session's own
    checkpoint folder is used; one is chosen only where none is set.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    return df.checkpoint()

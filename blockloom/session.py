"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Keys of streams live on the executors' disks instead of their heaps.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A trigger saves what changed, not all keys; old keys go with the next rows.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # All stores of an executor share this much memory for what they write and
    # read; each by itself takes two buffers of 64 MB, whatever else it holds.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Larger generated methods are not compiled by HotSpot and run two times
    # slower than the plain operators this makes Spark use instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "blockloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the engine's settings; ``extra`` keys use ``__`` for dots.

    ``spark.sql.shuffle.partitions`` is left to the cluster: AQE coalesces
    downwards, so a large deployment sets it high once and small jobs still
    end up with few tasks.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; a cluster
    without the setting is an error, since executors could not see each
    other's files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="blockloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under the application's own subfolder, so that clearing up
    after an application is one delete."""
    application = spark.sparkContext.applicationId
    return f"{work_folder(spark)}/{application}/{label}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system it is in; without one, that
    of Spark's default file system, not the disk of the machine that opens it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def stage(df: DataFrame, label: str, session: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, in another ``session`` if one is given.

    Cuts lineage: what follows reads Parquet instead of recomputing, and a
    lost executor costs a file read, not the whole upstream job.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete what :func:`stage` wrote for ``df``, once nothing reads it any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

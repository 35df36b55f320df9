"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wicketflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC time; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Looking up the caller of every column expression slows down plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_STORE = "spark.sql.streaming.stateStore."
#: Keeps the state of streams in files of the executors, behind a cache of bounded size that all
#: partitions of an executor share, and writes only what changed at each batch.
STATE_ON_DISK = {
    f"{_STORE}providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}rocksdb.maxMemoryUsageMB": "500",
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state on disk; a session's own settings come back after."""
    before = {key: spark.conf.get(key, None) for key in STATE_ON_DISK}
    for key, value in STATE_ON_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def free_shuffles(spark: SparkSession) -> None:
    """Delete the files of shuffles whose plans are gone.

    Spark deletes them once the driver's garbage collection finds the plans, which may be long
    after a stream has ended.
    """
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which every executor can reach.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wicketflow-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/wicketflow/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    For a table that several branches of one plan need: each branch would
    otherwise scan and shuffle the raw deliveries again. The files outlive lost
    executors; whoever owns the shared folder expires them.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

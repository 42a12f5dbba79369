"""Spark session, the shared folder for intermediate tables, and caching."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

APP_NAME = "ML"
# Bytes of rows that go to a Python worker at a time. Spark's own limit of 64 MB is held about twice on both sides of every task.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def create_session(is_local: bool, app_name: str = APP_NAME) -> SparkSession:
    """Session for the job. On a cluster all sizes come from the submit configuration.

    Timestamps are read in UTC so that results do not depend on the machine.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if is_local:
        builder = (
            builder.config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.memory", "4g")
            .config("spark.executor.memory", "1g")
            .config("spark.executor.cores", "2")
        )
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir.

    A machine-local folder is made only for a local master, where all executors live on this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="reviewgrove-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def bound_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python workers in batches of about ``BATCH_BYTES``, unless it names a limit itself.

    The setting stays, since frames are computed later. Results do not depend on it.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


class Staged:
    """Folders that a piece of work has written to the shared folder, and that it deletes when nobody reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def close(self) -> None:
        """Delete the folders. Frames that read them cannot be computed afterwards."""
        while self.paths:
            delete_path(self.spark, self.paths[-1])
            self.paths.pop()


_OWNER: ContextVar[Staged | None] = ContextVar("owner of staged tables", default=None)


@contextmanager
def owning(spark: SparkSession) -> Iterator[Staged]:
    """Within it, every path from ``fresh_path``, so every staged table, belongs to the ``Staged`` it gives.

    The owner outlives the block, since results are lazy; whoever takes the result closes it. If the block
    fails, its folders are deleted at once.
    """
    owner = Staged(spark)
    token = _OWNER.set(owner)
    try:
        yield owner
    except BaseException:
        owner.close()
        raise
    finally:
        _OWNER.reset(token)


def file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_path(spark: SparkSession, path: str) -> None:
    system, place = file_system(spark, path)
    system.delete(place, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark).rstrip('/')}/reviewgrove/{name}-{uuid4().hex}"
    if (owner := _OWNER.get()) is not None:
        owner.paths.append(path)
    return path


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table.

    Expensive text work is done once, the lineage is cut, and a lost executor costs a re-read
    instead of a re-computation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Cache ``df`` while several actions read it, and release it afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()

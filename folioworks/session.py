"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE may swap a sort-merge join for a hash join once every build
    # partition is known to be below this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Building large column expressions is slow with call-site capture on.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "folioworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local master, which has no executors elsewhere, gets one beside its tables when the
    setting is missing.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def _at(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A new folder name in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    place, system = _at(spark, path)
    system.mkdirs(place.getParent())
    # Of a path that doesn't exist yet Hadoop takes no note, so the folder is made at once.
    system.mkdirs(place)
    system.deleteOnExit(place)
    return path


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs in here go when it ends, not when the driver collects its garbage.

    For queries that are run once: one that is run again makes its shuffles anew.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared folder and read it back.

    Cuts the lineage there. Unlike a checkpoint, the table can be read by
    column and Spark knows its size. It goes when the application ends, or by ``discard``.
    ``options`` are those of the parquet writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.mode("append").options(**options).parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._scratch = path
    return made


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these tables; nothing that still has to run may read them."""
    for table in tables:
        if path := getattr(table, "_scratch", None):
            place, system = _at(table.sparkSession, path)
            system.delete(place, True)


def file_size(spark: SparkSession, uri: str) -> int:
    """Bytes of a file, by its URI as ``inputFiles`` gives it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getLen()


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _at(spark, path)
    return system.exists(place)


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    place, system = _at(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place)]


def put_in_place(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder to ``to``, in the place of what is there."""
    place, system = _at(spark, path)
    target, _ = _at(spark, to)
    system.mkdirs(target.getParent())
    system.delete(target, True)
    if not system.rename(place, target):
        raise OSError(f"{path} can't be renamed to {to}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark can reach it."""
    place, system = _at(spark, path)
    system.delete(place, True)

"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "lorebase", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; `extra` keys use `__` in place of `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of this machine, which is removed at exit.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="lorebase-")
        atexit.register(shutil.rmtree, _local_folders[app], True)
    return _local_folders[app]


def session_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/lorebase-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's folder."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _file(spark: SparkSession, path: str):
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()), named


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that path."""
    filesystem, named = _file(spark, path)
    return filesystem.exists(named)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder."""
    filesystem, named = _file(spark, path)
    filesystem.delete(named, True)


def release(spark: SparkSession) -> None:
    """Remove everything this application stored; DataFrames that read it are void afterwards."""
    remove(spark, session_folder(spark))


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """`df` written once to the shared folder and read back, for steps that read it several times.

    Later reads take only the columns they need, and a lost executor costs a re-read, not the lineage.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

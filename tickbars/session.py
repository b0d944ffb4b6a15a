"""Session settings shared by every job, and the shared folder for written state."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app_name: str = "tickbars",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the jobs rest on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Recording the call site of every column expression takes longer than planning.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Tick clocks are UTC; bars and parsed times are read in the same zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set SQL options for one block and put the earlier values back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: the session's ``spark.checkpoint.dir``.

    A session without that setting, as in tests, needs one by ``set_shared_dir``.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _given.get("folder")
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder.rstrip("/")


_given: dict[str, str] = {}


def set_shared_dir(folder: str) -> None:
    """The folder for sessions that don't set ``spark.checkpoint.dir`` themselves."""
    _given["folder"] = folder


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder for one run's written tables."""
    return f"{shared_dir(spark)}/tickbars/{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once under the shared folder, for what would be computed twice."""
    path = new_run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and ``path`` as it takes it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = file_system(spark, path)
    return fs.exists(location)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a run of this package has written."""
    fs, location = file_system(spark, path)
    fs.delete(location, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there whole or not at all; it replaces what was there."""
    fs, beside = file_system(spark, f"{path}.beside")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    location = file_system(spark, path)[1]
    fs.delete(location, False)
    if not fs.rename(beside, location):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    fs, location = file_system(spark, path)
    stream = fs.open(location)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, location = file_system(spark, path)
    fs.mkdirs(location)

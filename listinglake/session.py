"""Session settings, the shared scratch folder and Hadoop file helpers."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what results depend on (UTC) and adaptive execution; sizes stay the caller's."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not _one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="listinglake-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/listinglake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for this application below the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def store(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to a scratch table and read it back.

    Cuts lineage with data that outlives a lost executor, unlike a cache.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, qualified path) of any URI Spark can open."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    return files, files.makeQualified(target)


def exists(spark: SparkSession, path: str) -> bool:
    files, target = hadoop_path(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder made by :func:`scratch_path`."""
    if not path.startswith(_scratch_root(spark)):
        raise ValueError(f"not a scratch folder of this application: {path}")
    files, target = hadoop_path(spark, path)
    files.delete(target, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application, once its results are written."""
    remove(spark, _scratch_root(spark))


def file_names(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Names of plain files directly in ``folder``; [] when it is missing."""
    files, target = hadoop_path(spark, folder)
    if not files.exists(target) or not files.getFileStatus(target).isDirectory():
        return []
    found = (status for status in files.listStatus(target) if status.isFile())
    return sorted(
        name for name in (s.getPath().getName() for s in found) if name.endswith(suffix)
    )


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file, such as a commit or a marker."""
    files, target = hadoop_path(spark, path)
    stream = files.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def get_text(spark: SparkSession, path: str) -> str:
    """Content of one small text file."""
    files, target = hadoop_path(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


@functools.lru_cache(maxsize=8)
def has_delta(spark: SparkSession) -> bool:
    """True when the Delta connector is on the class path of this session."""
    try:
        spark.read.format("delta").load("/nonexistent-listinglake-probe").schema
    except Exception as error:
        return "DATA_SOURCE_NOT_FOUND" not in str(error) and "ClassNotFound" not in str(error)
    return True

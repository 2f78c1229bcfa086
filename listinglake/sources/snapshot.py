"""Current files of a table whose commit log is JSON lines of add and remove."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake import publication
from listinglake.errors import SnapshotLogError
from listinglake.operators import serving
from listinglake.session import exists, file_names, hadoop_path, has_delta

LOG = "_delta_log"
_COMMIT = r"^\d+\.json$"
GOLD_TABLES = ("fct_vacancies", "dim_company", "dim_location")


def _commits(spark: SparkSession, table: str) -> list[str]:
    """Commit names in order; refused when the JSON commits are not the whole log."""
    names = [n for n in file_names(spark, f"{table}/{LOG}", ".json") if n[:-5].isdigit()]
    versions = [int(name[:-5]) for name in names]
    if versions and versions != list(range(len(versions))):
        raise SnapshotLogError(
            f"{table}: JSON commits must run from version 0 without a gap, found "
            f"{versions[0]}..{versions[-1]} ({len(versions)} files); older ones may sit "
            "in a checkpoint, which needs the Delta connector"
        )
    return names


def replay(spark: SparkSession, table: str) -> DataFrame:
    """``path`` of each file whose last action in the log is an add.

    Lines are read as splittable text. A line's place is its file name, the start of
    its split and its number inside the split, so the last action per path is a
    map-side ``max_by`` and no commit has to fit into one row.
    """
    lines = (
        spark.read.option("pathGlobFilter", "*.json")
        .text(f"{table}/{LOG}")
        .select(
            "value",
            F.struct(
                F.col("_metadata.file_name").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("place"),
        )
        .where(F.col("place.file").rlike(_COMMIT) & (F.trim("value") != ""))
    )
    action = F.from_json(
        "value", "add struct<path:string>, remove struct<path:string>", {"mode": "FAILFAST"}
    )
    added, removed = F.nullif(F.col("a.add.path"), F.lit("")), F.col("a.remove.path")
    return (
        lines.withColumn("a", action)
        .select(
            F.coalesce(added, removed).alias("path"), added.isNotNull().alias("adds"), "place"
        )
        .where("path != ''")
        .groupBy("path")
        .agg(F.max_by("adds", "place").alias("live"))
        .where("live")
        .select("path")
    )


def present_files(spark: SparkSession, table: str) -> DataFrame:
    """``path`` of each Parquet file below ``table``, relative to it; no content read."""
    _, root = hadoop_path(spark, table)
    skipped = len(root.toString()) + 2
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(table)
        .select(F.expr(f"substring(path, {skipped})").alias("path"))
    )


def active_files(spark: SparkSession, table: str) -> list[str]:
    """Paths of the current snapshot; every top-level Parquet file when there is no log.

    The list holds file names, not rows: Spark's own scan keeps the same list.
    """
    if not exists(spark, table):
        return []
    root = hadoop_path(spark, table)[1].toString()
    if not _commits(spark, table):
        return [f"{root}/{name}" for name in file_names(spark, table, ".parquet")]
    live = replay(spark, table).join(present_files(spark, table), "path", "left_semi")
    return sorted(f"{root}/{row.path}" for row in live.collect())


def read_files(spark: SparkSession, paths: list[str], schema: str | None = None) -> DataFrame:
    """One scan over Parquet ``paths``; no paths give no rows."""
    if not paths:
        return spark.createDataFrame([], schema or "empty string")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*paths)


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The current snapshot of ``table``, or None when it has no file.

    A published table is what the pointer names. A logged one always goes through the log:
    a plain Parquet read would count removed files again.
    """
    published = publication.locate(spark, table)
    if published:
        pointer, name = published
        return pointer.read(spark, name)
    if not exists(spark, table):
        return None
    if not _commits(spark, table):
        found = file_names(spark, table, ".parquet")
        return spark.read.option("pathGlobFilter", "*.parquet").parquet(table) if found else None
    if has_delta(spark):
        return spark.read.format("delta").load(table)
    paths = active_files(spark, table)
    return read_files(spark, paths) if paths else None


def read_gold(spark: SparkSession, folder: str) -> DataFrame | None:
    """Serving rows of a gold folder, or None unless all three tables have files.

    Tables published together are read from one pointer, so a fact never meets the
    dimensions of another build.
    """
    together = publication.locate(spark, f"{folder}/{GOLD_TABLES[0]}")
    if together and together[1]:
        pointer, fact = together
        names = [fact[: -len(GOLD_TABLES[0])] + name for name in GOLD_TABLES]
        if all(name in pointer.tables for name in names):
            return serving.prepare(serving.denormalise(*(pointer.read(spark, n) for n in names)))
    found = {}
    for name in GOLD_TABLES:
        frame = read_table(spark, f"{folder}/{name}")
        if frame is None:
            return None
        found[name] = frame
    return serving.prepare(serving.denormalise(*found.values()))

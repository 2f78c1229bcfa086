"""Full-refresh tables and the serving export."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from listinglake import publication
from listinglake.errors import ExportError
from listinglake.session import file_names, hadoop_path, has_delta

# Rows of one part of an export, at most.
PART_ROWS = 5_000_000


def write_table(frame: DataFrame, path: str) -> int:
    """Replace the table at ``path``, schema included; gives the rows written.

    Delta when the connector is there. Otherwise Parquet in a generation of its own, made
    live by a pointer: until then, and if the write fails, readers find the old rows. The
    generation before the live one stays for those who read it.
    """
    spark = frame.sparkSession
    if has_delta(spark):
        counted = Observation()
        writer = frame.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        writer.format("delta").option("overwriteSchema", "true").save(path)
        return counted.get.get("rows", 0)
    staged = publication.stage(frame, path)
    publication.publish(spark, path, [staged])
    publication.sweep(spark, path)
    return staged.rows


def export(
    frame: DataFrame, destination: str, single_file: bool = False, part_rows: int = PART_ROWS
) -> list[str]:
    """Snappy Parquet at ``destination``; gives its files.

    A folder of parts, written in parallel, or with ``single_file`` exactly one file. The
    caller chooses, never the size of the data: one file is written by one task, in a stream,
    from parts that were computed in parallel. The old export stays readable until the new
    one is complete, and comes back if the swap fails.
    """
    spark = frame.sparkSession
    files, target = hadoop_path(spark, destination)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    parts, merged, old = (
        f"{destination.rstrip('/')}__{name}" for name in ("parts", "merged", "old")
    )
    writer = frame.write.mode("overwrite").option("compression", "snappy")
    writer.option("maxRecordsPerFile", part_rows).parquet(parts)
    finished = parts
    if single_file:
        staged = spark.read.schema(frame.schema).parquet(parts).coalesce(1)
        staged.write.mode("overwrite").option("compression", "snappy").parquet(merged)
        names = file_names(spark, merged, ".parquet")
        if len(names) != 1:
            raise ExportError(f"expected one part in {merged}, found {len(names)}")
        finished = f"{merged}/{names[0]}"

    files.mkdirs(target.getParent())
    files.delete(path(old), True)
    replaces = files.exists(target)
    if replaces and not files.rename(target, path(old)):
        raise ExportError(f"could not set {destination} aside")
    moved = False
    try:
        moved = files.rename(path(finished), target)
    finally:
        if replaces and not moved:
            files.rename(path(old), target)
    if not moved:
        raise ExportError(f"could not move {finished} to {destination}")
    for leftover in (parts, merged, old):
        files.delete(path(leftover), True)
    if single_file:
        return [destination]
    return [f"{destination}/{name}" for name in file_names(spark, destination, ".parquet")]

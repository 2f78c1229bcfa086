"""Landed captures of many small files, packed into files of a target size.

A capture is packed as a whole: its files are put into bins, in the order of their names, until a
bin holds the target; a file above the target is dealt to several. Each bin becomes one Parquet
file whose rows name the landed file they come from. The result is published beside the captures
(``_compacted``, which readers of JSON skip), under a print of the landed files: their number,
bytes and latest change. A capture that was landed anew has another print, so it is read as JSON
again until the next run packs it. A run that finds nothing new writes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listinglake import publication, schemas
from listinglake.operators.skew import lookup_join
from listinglake.session import store
from listinglake.sources.landing import STAMP

COMPACTED = "_compacted"
TABLE = "bronze"
TARGET_BYTES = 128 * 1024 * 1024
#: Bins of one capture are numbered below this.
_BINS = 1 << 20


@dataclass(frozen=True)
class Compacted:
    captures: int
    files_in: int
    files_out: int


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(stamp, path, length, changed) of the landed files; only file status is read."""
    path = F.col("_metadata.file_path")
    stamp = F.regexp_extract(path, rf"/{STAMP}=([^/]+)/[^/]+$", 1)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(stamp.alias("stamp"), path.alias("path"), "length", F.unix_micros("modificationTime").alias("changed"))
        .where("stamp != ''")
    )


def prints(files: DataFrame) -> dict[str, str]:
    """Each capture's print. One entry per capture, not per file."""
    found = files.groupBy("stamp").agg(
        F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.max("changed")).alias("print")
    )
    return {row["stamp"]: row["print"] for row in found.collect()}


def _binned(files: DataFrame, target: int) -> DataFrame:
    """(path, first, pieces): the bins of each file, numbered within its capture.

    Large files get bins of their own. Small ones are cut where their running size passes a
    multiple of the target, so a bin holds less than twice the target.
    """
    large = F.col("length") > target
    in_order = Window.partitionBy("stamp").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    small_before = F.coalesce(F.sum(F.when(large, 0).otherwise(F.col("length"))).over(in_order), F.lit(0))
    pieces = F.when(large, F.ceil(F.col("length") / target)).otherwise(1)
    large_before = F.coalesce(F.sum(F.when(large, F.ceil(F.col("length") / target)).otherwise(0)).over(in_order), F.lit(0))
    small_bins = F.floor(F.sum(F.when(large, 0).otherwise(F.col("length"))).over(Window.partitionBy("stamp")) / target) + 1
    first = F.when(large, small_bins + large_before).otherwise(F.floor(small_before / target))
    return files.select("stamp", "path", first.cast("int").alias("first"), pieces.cast("int").alias("pieces"))


def compact(spark: SparkSession, folder: str, target_bytes: int = TARGET_BYTES) -> Compacted:
    """Pack every capture of ``folder`` that is new or was landed anew."""
    folder = folder.rstrip("/")
    root = f"{folder}/{COMPACTED}"
    files = store(landed_files(spark, folder), "landed-files")
    live = publication.live(spark, root)
    old = live.tables.get(TABLE) if live else None
    now = prints(files)
    packed = _packed(old)
    todo = sorted(stamp for stamp, print_ in now.items() if packed.get(stamp) != print_)
    if not todo:
        return Compacted(0, 0, 0)
    order = F.create_map(*[F.lit(x) for at, stamp in enumerate(todo) for x in (stamp, at)])
    bins = store(
        _binned(files.where(F.col("stamp").isin(todo)), target_bytes).withColumn("at", order[F.col("stamp")]), "bins"
    )
    rows = (
        spark.read.schema(schemas.BRONZE)
        .option("basePath", folder)
        .json([f"{folder}/{STAMP}={stamp}" for stamp in todo])
        .select("*", F.col("_metadata.file_path").alias("path"))
        .drop(STAMP)
    )
    columns = [name for name, _ in schemas.fields(schemas.BRONZE)]
    piece = F.pmod(F.xxhash64(*columns), F.col("pieces"))
    placed = lookup_join(rows, bins, "path", "inner").select(
        *columns,
        F.col("stamp").alias(STAMP),
        F.element_at(F.split("path", "/"), -1).alias("landed_file"),
        (F.col("at") * _BINS + F.col("first") + piece).cast("bigint").alias("part"),
    )
    staged = publication.stage_parts(placed, root, TABLE, "part")
    parts = {}
    for key, part in staged.parts.items():
        stamp = todo[int(key) // _BINS]
        parts[f"{stamp}/{now[stamp]}/{int(key) % _BINS}"] = part
    gone = [key for key in (old.parts if old else ()) if _capture(key)[0] in todo]
    table = replace(staged, parts=parts)
    table = old.with_parts(table, gone) if old else table
    kept = {stamp: print_ for stamp, print_ in packed.items() if stamp not in todo}
    # Captures without a row have no part, but are packed.
    done = {f"{stamp}/{print_}": 1 for stamp, print_ in (kept | {s: now[s] for s in todo}).items()}
    table = replace(table, notes=done)
    publication.publish(spark, root, [table], expected=live.version if live else 0)
    many = files.where(F.col("stamp").isin(todo)).count()
    return Compacted(len(todo), many, len(parts))


def _capture(key: str) -> tuple[str, str]:
    return tuple(key.split("/")[:2])


def _packed(table: publication.Table | None) -> dict[str, str]:
    """Packed captures and the prints they were packed from."""
    return dict(map(_capture, table.notes)) if table else {}


def read_captures(spark: SparkSession, folder: str) -> DataFrame:
    """All captures: packed ones from their packed files, the others from JSON.

    The columns of bronze, the capture's stamp and the landed file of every row.
    """
    folder = folder.rstrip("/")
    live = publication.live(spark, f"{folder}/{COMPACTED}")
    table = live.tables[TABLE] if live else None
    now = prints(landed_files(spark, folder))
    packed = {stamp for stamp, print_ in _packed(table).items() if now.get(stamp) == print_}
    fresh = [key for key in table.parts if _capture(key)[0] in packed] if table else []
    columns = [*[name for name, _ in schemas.fields(schemas.BRONZE)], STAMP, "landed_file"]
    rest = [f"{folder}/{STAMP}={stamp}" for stamp in now if stamp not in packed]
    frames = []
    if table:
        frames.append(table.read(spark, live.root, fresh).select(*columns))
    if rest or not frames:
        landed = spark.read.schema(f"{schemas.BRONZE}, {STAMP} string").option("basePath", folder).json(rest or folder)
        file = F.element_at(F.split("_metadata.file_path", "/"), -1).alias("landed_file")
        frames.append(landed.select("*", file).select(*columns))
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

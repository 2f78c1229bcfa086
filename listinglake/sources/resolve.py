"""The first source that has vacancies, and a token that shows when files change."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake import schemas
from listinglake.constants import (
    SOURCE_EMPTY,
    SOURCE_GOLD,
    SOURCE_GOLD_SAMPLE,
    SOURCE_PARQUET,
    SOURCE_RAW,
    SOURCE_SAMPLE,
)
from listinglake.errors import ListingLakeError
from listinglake.operators import serving, silver
from listinglake.session import exists, hadoop_path
from listinglake.sources import landing, snapshot

logger = logging.getLogger(__name__)



@dataclass(frozen=True)
class Readable:
    """What a source serves, and a cheaper frame that is empty exactly when it is."""

    frame: DataFrame
    probe: DataFrame


Candidate = tuple[str, Callable[[], "Readable | DataFrame | None"]]


@dataclass(frozen=True)
class Resolved:
    frame: DataFrame
    label: str
    skipped: dict[str, str] = field(default_factory=dict)


# What Spark says of a file that is not what its reader expects.
_UNREADABLE = (
    "FAILED_READ_FILE",
    "CANNOT_READ_FILE_FOOTER",
    "is not a Parquet file",
    "MALFORMED_RECORD",
    "PATH_NOT_FOUND",
)


def first_with_rows(spark: SparkSession, candidates: Iterable[Candidate]) -> Resolved:
    """The first candidate that can be read and is not empty.

    Missing, unreadable and empty sources are skipped with their reason. Every other
    failure rises, a lost executor among them: it must not pass for a missing source.
    """
    skipped: dict[str, str] = {}
    for label, read in candidates:
        try:
            found = read()
            if isinstance(found, DataFrame):
                found = Readable(found, found)
            if found is not None and not found.probe.isEmpty():
                return Resolved(found.frame, label, skipped)
            skipped[label] = "no rows"
        except (AnalysisException, ListingLakeError) as error:
            skipped[label] = str(error).splitlines()[0]
        except (PySparkException, Py4JJavaError) as error:
            if not any(sign in str(error) for sign in _UNREADABLE):
                raise
            skipped[label] = str(error).splitlines()[0]
        logger.info("skipped source %s: %s", label, skipped[label])
    return Resolved(spark.createDataFrame([], schemas.SERVING), SOURCE_EMPTY, skipped)


def read_export(spark: SparkSession, path: str) -> DataFrame | None:
    """Serving rows of an exported file (or folder of parts)."""
    return serving.prepare(spark.read.parquet(path)) if exists(spark, path) else None


def read_raw(spark: SparkSession, folder: str, glob: str = "*.json") -> Readable | None:
    """Serving rows straight from the documents of a folder or one document.

    A dedupe leaves at least one row, so the rows before it tell whether any are left.
    """
    if not exists(spark, folder):
        return None
    at = landing.Landing(folder, glob, recursive=False)
    listings = landing.listings(spark, at, arrays=True)
    return Readable(
        silver.build_display(listings, sort=False), silver.relevant(silver.project(listings))
    )


def vacancies(
    spark: SparkSession,
    delta_root: str | None = None,
    export_path: str | None = None,
    parquet_root: str | None = None,
    raw_folder: str | None = None,
    sample_path: str | None = None,
) -> Resolved:
    """Gold table, exported sample, gold Parquet, bronze documents, bundled sample."""
    steps = [
        (SOURCE_GOLD, delta_root, snapshot.read_gold),
        (SOURCE_GOLD_SAMPLE, export_path, read_export),
        (SOURCE_PARQUET, parquet_root, snapshot.read_gold),
        (SOURCE_RAW, raw_folder, read_raw),
        (SOURCE_SAMPLE, sample_path, read_raw),
    ]
    return first_with_rows(
        spark,
        [(label, lambda read=read, at=at: read(spark, at)) for label, at, read in steps if at],
    )


def freshness_token(spark: SparkSession, root: str) -> str:
    """``count:newest change`` of the Parquet and JSON files below ``root``.

    Commit logs count too. Empty when nothing is there. Only file status is read.
    """
    if not exists(spark, root):
        return ""
    files, target = hadoop_path(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    # Spark skips names with a leading underscore unless asked for them.
    logs = [
        status.getPath().toString()
        for pattern in (snapshot.LOG, f"*/{snapshot.LOG}", f"*/*/{snapshot.LOG}")
        for status in files.globStatus(path(target, pattern)) or []
    ]
    row = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{parquet,json}")
        .load([target.toString(), *logs])
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.max(F.unix_micros("modificationTime")).alias("newest"),
        )
        .first()
    )
    return f"{row['files']}:{row['newest']}" if row["files"] else ""

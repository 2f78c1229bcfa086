"""Landed JSON: foreign documents, canonical bronze and raw responses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake import schemas
from listinglake.constants import CAPTURE_GLOB, LANDING_GLOB
from listinglake.errors import LandingNotFoundError
from listinglake.functions import variants as V
from listinglake.session import exists, file_names, hadoop_path

STAMP = "capture_stamp"


def require_landing(spark: SparkSession, folder: str) -> None:
    """Fail when ``folder`` is missing or has no JSON document at its top level."""
    if not exists(spark, folder):
        raise LandingNotFoundError(f"landing folder does not exist: {folder}")
    if not file_names(spark, folder, ".json"):
        raise LandingNotFoundError(f"no {LANDING_GLOB} document in {folder}")


@dataclass(frozen=True)
class Landing:
    """Where documents lie and how to read them; ``stream`` reads new files only."""

    folder: str
    glob: str = LANDING_GLOB
    recursive: bool = True
    stream: bool = False
    files_per_batch: int = 1000

    def scan(self, spark: SparkSession) -> DataFrame:
        """(text, file): one row per file."""
        reader = spark.readStream if self.stream else spark.read
        if self.stream:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        found = (
            reader.option("pathGlobFilter", self.glob)
            .option("recursiveFileLookup", self.recursive)
            .text(self.folder, wholetext=True)
        )
        return found.select(
            F.ltrim("value", F.lit("\ufeff")).alias("text"),
            F.col("_metadata.file_path").alias("file"),
        )


def documents(spark: SparkSession, at: Landing) -> DataFrame:
    """One row per JSON file: ``text``, its ``jobs`` array, itself as an array ``whole``.

    One route for every size. Arrays hold each entry as its raw JSON text, so nothing is
    inferred, one odd entry costs itself and not its document, and only a single entry has
    to fit a VARIANT. Both arrays are null where the document has no such array.
    """
    opening = F.substring(F.ltrim("text", F.lit(" \t\r\n")), 1, 1)
    jobs = F.from_json("text", "jobs array<string>")["jobs"]
    whole = F.from_json("text", "array<string>")
    return at.scan(spark).select(
        "file",
        "text",
        F.when(opening == "{", jobs).alias("jobs"),
        F.when(opening == "[", whole).alias("whole"),
    )


def _entries(arrays: bool) -> Column:
    """The entries of a document as raw JSON texts, null when it has no listing array."""
    return F.coalesce("jobs", "whole") if arrays else F.col("jobs")


def opened(docs: DataFrame, arrays: bool = False) -> DataFrame:
    """(file, whole, entry, text): one row per entry of a listing array, as raw JSON text.

    ``whole`` says that the document has such an array; only documents without one keep
    their ``text``. Takes the ``jobs`` array; with ``arrays`` a top-level array counts too.
    """
    whole = _entries(arrays).isNotNull()
    # Outer, so that Spark does not infer a filter that unpacks each document twice.
    return docs.select(
        "file",
        whole.alias("whole"),
        F.explode_outer(_entries(arrays)).alias("entry"),
        F.when(~whole, F.col("text")).alias("text"),
    )


def parsed(entries: DataFrame, names: Sequence[str] = schemas.LISTING_FIELDS) -> DataFrame:
    """(file, whole, text, entry, job) of :func:`opened` documents, each entry parsed once.

    ``job`` holds the fields of a listing object as text, absent ones null, and is null for what
    is no object; only then the ``entry`` is kept.
    """
    # An object opens with a brace. Its fields come through a generator, below which Spark pushes
    # no filter: each filter on a field would parse the entry anew.
    opens = F.ltrim("entry", F.lit(" \t\r\n")).startswith("{")
    job = F.when(opens, V.opened(F.try_parse_json("entry"), names))
    kept = [c for c in entries.columns if c != "entry"]
    once = entries.select(*kept, "entry", F.inline_outer(F.array(F.struct(job.alias("job")))))
    return once.select(*kept, F.when(F.col("job").isNull(), F.col("entry")).alias("entry"), "job")


def listed(rows: DataFrame) -> DataFrame:
    """One row per listing object of :func:`parsed` entries, every field as text."""
    return rows.where("job IS NOT NULL").select("job.*", "file")


def listings_of(entries: DataFrame, names: Sequence[str] = schemas.LISTING_FIELDS) -> DataFrame:
    """One row per listing object of :func:`opened` documents, every field as text.

    Absent fields are null. Empty or absent arrays give no rows and entries that are no
    objects are dropped, without harm to their neighbours.
    """
    return listed(parsed(entries, names))


def quarantine_of(entries: DataFrame) -> DataFrame:
    """``file``, ``reason`` and text of what gives no listing because of its shape.

    Documents without a listing array, and single objects that no VARIANT takes: beyond its
    size, or with one member twice.
    """
    valid = F.get_json_object("text", "$").isNotNull()
    foreign = entries.where("NOT whole").select(
        "file",
        F.when(valid, "no jobs array").otherwise("not valid JSON").alias("reason"),
        "text",
    )
    large = entries.where(F.ltrim("entry").startswith("{") & F.try_parse_json("entry").isNull())
    return foreign.unionByName(
        large.select("file", F.lit("unreadable entry").alias("reason"), F.col("entry").alias("text"))
    )


def flatten(
    docs: DataFrame, names: Sequence[str] = schemas.LISTING_FIELDS, arrays: bool = False
) -> DataFrame:
    """:func:`listings_of` for documents that are read once."""
    return listings_of(opened(docs, arrays), names)


def flatten_structs(frame: DataFrame, column: str) -> DataFrame:
    """One row per non-null struct of the array ``column``, its fields as columns."""
    kept = [F.col(c) for c in frame.columns if c != column]
    return frame.select(*kept, F.inline(F.filter(column, lambda entry: entry.isNotNull())))


def quarantine(docs: DataFrame, arrays: bool = False) -> DataFrame:
    """:func:`quarantine_of` for documents that are read once."""
    return quarantine_of(opened(docs, arrays))


def listings(
    spark: SparkSession,
    at: Landing,
    names: Sequence[str] = schemas.LISTING_FIELDS,
    arrays: bool = False,
) -> DataFrame:
    """All listings of all documents."""
    return flatten(documents(spark, at), names, arrays)


def quarantined(spark: SparkSession, at: Landing, arrays: bool = False) -> DataFrame:
    """All that gives no listings because of its shape."""
    return quarantine(documents(spark, at), arrays)


def has_listing_array(spark: SparkSession, at: Landing, arrays: bool = False) -> bool:
    """Whether any document has a listing array, empty or not."""
    found = documents(spark, at).where(_entries(arrays).isNotNull()).select("file")
    return not found.limit(1).isEmpty()


def read_listings(
    spark: SparkSession,
    folder: str,
    names: Sequence[str] = schemas.LISTING_FIELDS,
    arrays: bool = False,
    recursive: bool = True,
) -> DataFrame:
    """All listings of a folder that must hold at least one document."""
    require_landing(spark, folder)
    return listings(spark, Landing(folder, recursive=recursive), names, arrays)


def latest_file(spark: SparkSession, folder: str, glob: str = CAPTURE_GLOB) -> str:
    """Path of the newest capture; its UTC stamp makes name order time order."""
    files, target = hadoop_path(spark, folder)
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, glob)
    found = [s.getPath() for s in files.globStatus(pattern) or [] if s.isFile()]
    if not found:
        raise LandingNotFoundError(f"no {glob} in {folder}")
    return max(found, key=lambda path: path.getName()).toString()


def read_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Landed responses: JSON lines with the body as untouched text."""
    return spark.read.schema(schemas.RESPONSES).json(folder)


def read_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical bronze captures: JSON lines under one folder per stamp."""
    return spark.read.schema(f"{schemas.BRONZE}, {STAMP} string").json(folder)


def latest_capture(spark: SparkSession, folder: str) -> str:
    """Newest capture stamp, from folder names alone."""
    files, target = hadoop_path(spark, folder)
    names = [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]
    stamps = [name.split("=", 1)[1] for name in names if name.startswith(f"{STAMP}=")]
    if not stamps:
        raise LandingNotFoundError(f"no capture in {folder}")
    return max(stamps)

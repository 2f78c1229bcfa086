"""Captures in the bronze zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake import schemas
from listinglake.functions.times import capture_stamp
from listinglake.sources.landing import STAMP


def stamp_of(spark: SparkSession, captured_at: datetime | None = None) -> str:
    """Stamp of the moment, by Spark's clock when none is given.

    The session runs in UTC, so text without a zone reads as UTC.
    """
    given = F.current_timestamp()
    if captured_at is not None:
        given = F.lit(captured_at.isoformat()).cast("timestamp")
    return spark.range(1).select(capture_stamp(given)).first()[0]


def write_bronze(listings: DataFrame, folder: str, captured_at: datetime | None = None) -> str:
    """Write one capture as splittable JSON lines; gives its stamp.

    A folder per stamp lets readers prune to the captures they need. Only the folder of
    this stamp is replaced, so the same capture again does not double its rows.
    """
    stamp = stamp_of(listings.sparkSession, captured_at)
    columns = [name for name, _ in schemas.fields(schemas.BRONZE)]
    rows = listings.select(*columns)
    rows.write.mode("overwrite").json(f"{folder.rstrip('/')}/{STAMP}={stamp}")
    return stamp

"""Bronze to silver in one plan: what is collected is what silver reads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from listinglake import publication
from listinglake.constants import TITLE_KEYWORDS
from listinglake.operators import star
from listinglake.plans import incremental
from listinglake.plans.collect import collect_into
from listinglake.session import configure, store
from listinglake.sources import landing

BRONZE, ATTEMPTS, LAKE = "bronze", "attempts", "lake"


@dataclass(frozen=True)
class Ingested:
    stamp: str
    merged: incremental.Merged
    rows: dict[str, int]


def ingest(
    spark: SparkSession,
    responses_folder: str,
    root: str,
    captured_at: datetime | None = None,
    keywords: Sequence[str] = TITLE_KEYWORDS,
    max_pages: int | None = None,
) -> Ingested:
    """Collect landed responses, merge the capture into silver and publish the star of it.

    Below ``root``: ``bronze`` holds the captures, ``attempts`` what became of the requests,
    ``lake`` the silver parts and the gold tables. Only the new capture is read from bronze. A
    call that dies can be made again with the same ``captured_at``: the capture replaces itself,
    and rows merged already change nothing.
    """
    configure(spark)
    root = root.rstrip("/")
    stamp = collect_into(spark, responses_folder, f"{root}/{BRONZE}", f"{root}/{ATTEMPTS}", captured_at, max_pages)
    capture = landing.read_bronze(spark, f"{root}/{BRONZE}").where(F.col(landing.STAMP) == stamp)
    merged = incremental.merge_capture(spark, f"{root}/{LAKE}", capture.drop(landing.STAMP), keywords)
    return Ingested(stamp, merged, publish_star(spark, f"{root}/{LAKE}"))


def publish_star(spark: SparkSession, root: str) -> dict[str, int]:
    """Build the star of the silver parts below ``root`` and publish its tables together."""
    before = publication.live(spark, root)
    gold = star.build(store(incremental.read_silver(spark, root), "silver"))
    staged = [publication.stage(frame, root, f"gold/{name}") for name, frame in gold.tables().items()]
    publication.publish(spark, root, staged, expected=before.version if before else 0)
    return {table.name: table.rows for table in staged}

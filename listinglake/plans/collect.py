"""Landed responses to bronze: validate, normalise, dedupe, record attempts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.constants import PAGED_BOARD
from listinglake.functions import variants as V
from listinglake.functions.text import fold
from listinglake.operators import boards, requests
from listinglake.operators.arrival import first_arrivals, two_part_arrival
from listinglake.operators.skew import lookup_join
from listinglake.session import configure, store
from listinglake.sinks.bronze import write_bronze
from listinglake.sinks.tables import write_table
from listinglake.sources.landing import read_responses


@dataclass(frozen=True)
class Collected:
    listings: DataFrame
    attempts: DataFrame
    rejected: DataFrame


def _judge(responses: DataFrame) -> DataFrame:
    """What is known of each response, with the raw entries of its listing array.

    Bodies are opened here and nowhere else; those set aside are looked up again.
    """
    links = F.try_parse_json(F.get_json_object("body", "$.links"))
    paged = F.col("page").isNotNull()
    data = F.when(F.col("source") == PAGED_BOARD, F.size("raw")).when(
        paged, F.size(boards.entries(F.col("body"), "data"))
    )
    parsed = boards.parse(responses).withColumn("raw", boards.raw_entries())
    return parsed.select(
        "request_seq",
        "source",
        "run",
        "query_category",
        "page",
        "params",
        F.coalesce("error", "reason").alias("error"),
        F.greatest(data, F.lit(0)).alias("entries"),
        F.when(paged, V.is_truthy(V.field(links, "next"), V.kind(links, "next"))).otherwise(False).alias("has_next"),
        F.when(F.col("error").isNull(), F.col("raw")).alias("raw"),
    )


def collect(responses: DataFrame, max_pages: int | None = None) -> Collected:
    """Listings kept, attempts and rejected responses of one collection.

    ``responses`` has the columns of ``schemas.RESPONSES``; ``request_seq`` is unique
    and the order of the calls. A bad response is recorded and skipped. Pages behind the
    stop of their run, or behind ``max_pages`` if given, do not count; they are rejected
    with that reason. The collection fails only when nothing
    was kept.
    """
    opened = store(_judge(responses), "judged")
    judged = opened.drop("raw")
    unpaged = judged.where("page is null")
    paged = judged.where("page is not null").withColumn("ok", F.col("error").isNull())
    prefix = requests.page_prefix(paged, ["source", "run"], max_pages, failed_stop=True)
    asked = store(unpaged.unionByName(prefix.select(*judged.columns)), "asked")

    # Entries are joined for paged boards only; elsewhere every response counts.
    good_pages = asked.where("page is not null and error is null").select("request_seq")
    bodies = opened.where("error is null").select("request_seq", "source", "query_category", "page", "raw")
    used = bodies.where("page is null").unionByName(
        lookup_join(bodies.where("page is not null"), good_pages, "request_seq", "left_semi")
    )
    listings = store(boards.union_boards(used, raw=F.col("raw")), "listings")
    kept = store(
        first_arrivals(
            listings,
            F.col("id"),
            [fold(F.col("title")), fold(F.col("company_name"))],
            two_part_arrival("request_seq", "position"),
        ),
        "kept",
    )
    manifest = asked.select(
        "request_seq",
        "source",
        F.col("query_category").alias("category"),
        F.col("page").cast("int").alias("page"),
        "params",
        "error",
    )
    attempts = store(
        requests.request_yield(manifest, kept, ["request_seq"]).select(
            "source", "category", "page", "params", "added", "error"
        ),
        "attempts",
    )
    requests.require_rows(attempts)
    behind = paged.join(asked.select("request_seq"), "request_seq", "left_anti")
    failed = asked.where("error is not null").select(
        "request_seq", F.col("error").alias("reason")
    )
    failed = failed.union(
        behind.select("request_seq", F.lit("behind the stop of its run").alias("reason"))
    )
    whole = lookup_join(responses, failed, "request_seq", "inner").select(
        "request_seq", "source", "reason", "body"
    )
    lost = boards.unreadable(used, "raw", ["request_seq", "source"]).select(
        "request_seq", "source", F.lit("unreadable entry").alias("reason"), F.col("entry").alias("body")
    )
    return Collected(kept.drop("request_seq", "position"), attempts, whole.unionByName(lost))


def collect_into(
    spark: SparkSession,
    responses_folder: str,
    bronze_folder: str,
    attempts_folder: str,
    captured_at: datetime | None = None,
    max_pages: int | None = None,
) -> str:
    """Collect landed responses into one bronze capture; gives its stamp.

    Attempts, rejected responses and the one-row roll-up of the capture become tables
    below ``attempts_folder``. The same capture again replaces itself.
    """
    collected = collect(read_responses(configure(spark), responses_folder), max_pages)
    stamp = write_bronze(collected.listings, bronze_folder, captured_at)
    write_table(collected.attempts, f"{attempts_folder}/{stamp}")
    write_table(collected.rejected, f"{attempts_folder}/rejected/{stamp}")
    rolled = requests.catalogue(collected.listings, stamp)
    write_table(rolled, f"{attempts_folder}/catalogue/{stamp}")
    return stamp

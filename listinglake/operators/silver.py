"""Bronze listings to the silver vacancy table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake.constants import TITLE_KEYWORDS, UNKNOWN_COMPANY, UNSPECIFIED_LOCATION
from listinglake.functions.text import clean_text, contains_any, default_to, strip_html
from listinglake.functions.times import publication_timestamp
from listinglake.operators.ranking import latest_on_two_keys
from listinglake.operators.serving import newest_first

_WHOLE_NUMBER = r"^[\s\p{Cntrl}]*[+-]?\d+[\s\p{Cntrl}]*$"


def optional(frame: DataFrame, name: str) -> Column:
    """Column ``name`` as text, or null text when the frame lacks it."""
    return (F.col(name) if name in frame.columns else F.lit(None)).cast("string")


def listing_id(frame: DataFrame) -> Column:
    """``id`` as bigint; text that is no whole number gives null.

    The match comes first because a cast that fails is far dearer than one that works.
    """
    text = optional(frame, "id")
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("bigint"))


def project(listings: DataFrame, offset: str = "drop") -> DataFrame:
    """The eight silver columns, cleaned; nothing is filtered yet."""
    cleaned = [
        clean_text(optional(listings, name)).alias(name)
        for name in ("title", "company_name", "category")
    ]
    more = [
        clean_text(optional(listings, name)).alias(name)
        for name in ("candidate_required_location", "salary")
    ]
    return listings.select(
        listing_id(listings).alias("id"),
        *cleaned,
        publication_timestamp(listings, offset=offset).alias("publication_date"),
        *more,
        strip_html(optional(listings, "description")).alias("description"),
    )


def relevant(frame: DataFrame, keywords: Sequence[str] = TITLE_KEYWORDS) -> DataFrame:
    """Rows with an id and a title that holds one of ``keywords``."""
    return frame.where(contains_any(F.col("title"), tuple(keywords)) & F.col("id").isNotNull())


def rejected_ids(listings: DataFrame) -> DataFrame:
    """Listings whose id is present but no whole number, with all their columns."""
    return listings.where(optional(listings, "id").isNotNull() & listing_id(listings).isNull())


def build(
    listings: DataFrame, keywords: Sequence[str] = TITLE_KEYWORDS, offset: str = "drop"
) -> DataFrame:
    """Clean, filter and dedupe: newest per id, then newest per title and company."""
    return latest_on_two_keys(
        relevant(project(listings, offset), keywords),
        "id",
        ["title", "company_name"],
        "publication_date",
    )


def build_display(
    listings: DataFrame,
    keywords: Sequence[str] = TITLE_KEYWORDS,
    offset: str = "drop",
    sort: bool = True,
) -> DataFrame:
    """Listings straight to the serving columns, without a star.

    Same rules as :func:`build` with other blanks: company and location get their
    default members and the other texts ``""`` *before* the dedupe.
    """
    rows = relevant(project(listings, offset), keywords).select(
        F.col("id").alias("vacancy_id"),
        F.to_date("publication_date").alias("publication_date"),
        F.col("publication_date").alias("publication_timestamp"),
        "title",
        default_to(F.col("company_name"), UNKNOWN_COMPANY).alias("company_name"),
        default_to(F.col("category"), "").alias("category"),
        default_to(F.col("candidate_required_location"), UNSPECIFIED_LOCATION).alias(
            "location_name"
        ),
        default_to(F.col("salary"), "").alias("salary"),
        default_to(F.col("description"), "").alias("description"),
    )
    deduped = latest_on_two_keys(
        rows, "vacancy_id", ["title", "company_name"], "publication_timestamp"
    )
    return newest_first(deduped) if sort else deduped

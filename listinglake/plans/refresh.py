"""Full refresh: landed documents to silver, gold and the serving export."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from listinglake import publication
from listinglake.constants import TITLE_KEYWORDS
from listinglake.errors import IntegrityError, UnusableLandingError
from listinglake.operators import serving, silver, star
from listinglake.session import configure, store
from listinglake.sinks.tables import export
from listinglake.sources import landing

logger = logging.getLogger(__name__)


def refresh(
    spark: SparkSession,
    landing_folder: str,
    root: str,
    export_path: str | None = None,
    keywords: Sequence[str] = TITLE_KEYWORDS,
) -> dict[str, int]:
    """Rebuild all tables below ``root`` and publish them together; gives rows per table.

    The landing is read once and each entry parsed once; the fields are stored. Every step reads the table the
    step before has written. Nothing is cached: a lost executor costs a re-read, not a
    recomputation of the whole chain. Documents and ids that are set aside become tables
    below ``root``/quarantine. Input without any listing array raises before a table is built.
    """
    configure(spark)
    landing.require_landing(spark, landing_folder)
    at = landing.Landing(landing_folder)
    entries = store(landing.parsed(landing.opened(landing.documents(spark, at))), "entries")
    if entries.where("whole").limit(1).isEmpty():
        raise UnusableLandingError(f"no document with a jobs array in {landing_folder}")
    listings = landing.listed(entries)
    aside = {
        "quarantine/documents": landing.quarantine_of(entries),
        "quarantine/rejected_ids": silver.rejected_ids(listings),
    }
    return _rebuild(spark, listings, root, export_path, keywords, aside)


def refresh_from(
    spark: SparkSession,
    listings: DataFrame,
    root: str,
    export_path: str | None = None,
    keywords: Sequence[str] = TITLE_KEYWORDS,
) -> dict[str, int]:
    """:func:`refresh` for listings from any source."""
    return _rebuild(spark, listings, root, export_path, keywords, {})


def _rebuild(
    spark: SparkSession,
    listings: DataFrame,
    root: str,
    export_path: str | None,
    keywords: Sequence[str],
    aside: dict[str, DataFrame],
) -> dict[str, int]:
    """Stage every table, hold them against each other, publish them by one pointer.

    A reader sees all tables of one build: until the last is written and checked, those of
    the build before.
    """
    root = root.rstrip("/")
    before = publication.live(spark, root)
    staged: dict[str, publication.Table] = {}

    def build(name: str, frame: DataFrame) -> DataFrame:
        staged[name] = publication.stage(frame, root, name)
        return staged[name].read(spark, root)

    cleaned = build("silver/jobs", silver.build(listings, keywords))
    gold = star.build(cleaned)
    built = star.Star(
        build("gold/dim_company", gold.dim_company),
        build("gold/dim_location", gold.dim_location),
        build("gold/fct_vacancies", gold.fct_vacancies),
    )
    for name, frame in aside.items():
        build(name, frame)
    fit = star.integrity(built).first()
    if fit["without_company"] or fit["without_location"] or fit["fact_rows"] != staged["silver/jobs"].rows:
        raise IntegrityError(f"{root}: {fit.asDict()} for {staged['silver/jobs'].rows} silver rows")
    publication.publish(spark, root, staged.values(), before.version if before else 0)
    publication.sweep(spark, root)
    if export_path:
        export(serving.denormalise(built.fct_vacancies, built.dim_company, built.dim_location), export_path)
    if not staged["silver/jobs"].rows:
        logger.warning("the silver table is empty after the title filter")
    return {name: table.rows for name, table in staged.items()}

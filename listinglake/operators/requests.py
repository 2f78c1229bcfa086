"""Request manifest, page runs, attempts and the catalogue roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake.constants import JOBICY_PAGE_SIZE, JOBICY_QUERIES
from listinglake.errors import NothingCollectedError
from listinglake.operators.skew import hot_from_counts, spread_join
from listinglake.session import store


def expand_categories(frame: DataFrame, category: str = "category") -> DataFrame:
    """One row per query a category needs: adds ``query_no`` and ``params``.

    The catalogue is a plan-time CASE, so the table is neither joined nor shuffled.
    """

    def queries(pairs: list[tuple]) -> F.Column:
        return F.array(
            *[
                F.create_map(
                    F.lit("count"), F.lit(str(JOBICY_PAGE_SIZE)), F.lit(kind), value
                )
                for kind, value in pairs
            ]
        )

    wanted = None
    for name, pairs in JOBICY_QUERIES.items():
        branch = queries([(kind, F.lit(value)) for kind, value in pairs])
        test = F.col(category) == name
        wanted = F.when(test, branch) if wanted is None else wanted.when(test, branch)
    wanted = wanted.otherwise(queries([("tag", F.col(category))]))
    return frame.select("*", F.posexplode(wanted).alias("query_no", "params"))


def page_prefix(
    pages: DataFrame, run: list[str], max_pages: int | None = None, failed_stop: bool = False
) -> DataFrame:
    """Pages a run really uses: 1, 2, 3, ... up to the first stop.

    ``pages`` holds ``page``, ``ok``, ``entries`` and ``has_next``. A failed or
    missing page ends the run before itself; an empty page, one without a next link
    and page ``max_pages``, if given, end it after themselves. Landed copies of a page
    count as read when any of them is ok. ``failed_stop`` also gives the failed page at
    the stop: it was asked for, though it brought nothing.

    The stop of a run is the first of its pages 1 and those after a leading page that
    does not lead on itself; found by an anti-join and a minimum, so a run of any length
    needs no task of its own.
    """
    if max_pages is not None and max_pages < 1:
        raise ValueError("max_pages must be positive")
    usable = pages.where(F.col("page") >= 1)
    if max_pages is not None:
        usable = usable.where(F.col("page") <= max_pages)
    rows = store(usable.groupBy(*run).agg(F.count(F.lit(1)).alias("_rows")), "page-runs")
    leading = store(
        usable.where(F.col("ok") & (F.col("entries") > 0) & F.col("has_next"))
        .select(*run, F.col("page").cast("bigint").alias("_page"))
        .distinct(),
        "leading-pages",
    )
    first = rows.select(*run, F.lit(1).cast("bigint").alias("_page"))
    onward = leading.select(*run, (F.col("_page") + 1).alias("_page"))
    stops = (
        first.union(onward)
        .join(leading, [*run, "_page"], "left_anti")
        .groupBy(*run)
        .agg(F.min("_page").alias("stop_page"))
    )
    counts = rows.select(F.xxhash64(*run).alias("_hot"), "_rows")
    hot = hot_from_counts(counts, counts.agg(F.sum("_rows")).first()[0] or 0)
    asked = usable if failed_stop else usable.where("ok")
    return (
        spread_join(asked, stops, run, "inner", hot, ["page"])
        .where("page <= stop_page")
        .drop("stop_page")
    )


def request_yield(manifest: DataFrame, kept: DataFrame, request: list[str]) -> DataFrame:
    """Manifest with ``added``: rows newly kept from each request, 0 when none were.

    A failed request (``error`` not null) has no ``added``.
    """
    counted = kept.groupBy(*request).agg(F.count(F.lit(1)).alias("_added"))
    added = F.coalesce(F.col("_added"), F.lit(0)).cast("bigint")
    if "error" in manifest.columns:
        added = F.when(F.col("error").isNull(), added)
    return manifest.join(counted, request, "left").withColumn("added", added).drop("_added")


def tally(attempts: DataFrame) -> DataFrame:
    """One row: calls, failed calls and rows kept."""
    return attempts.agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("error").isNotNull()).alias("failures"),
        F.coalesce(F.sum("added"), F.lit(0)).cast("bigint").alias("kept"),
    )


def require_rows(attempts: DataFrame) -> None:
    """Fail when no attempt kept a row; single failures are only recorded."""
    row = tally(attempts).first()
    if not row["kept"]:
        raise NothingCollectedError(f"no listing collected ({row['failures']} failed call(s))")


def catalogue(kept: DataFrame, captured_at: str | None = None) -> DataFrame:
    """One row: unique listings, sorted sources and categories, capture time.

    The two sets hold names of boards and query categories, not listings.
    """
    row = kept.agg(
        F.count(F.lit(1)).alias("job_count"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.array_sort(F.collect_set("query_category")).alias("categories"),
    )
    if captured_at is None:
        moment = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    else:
        moment = F.lit(captured_at)
    return row.withColumn("captured_at", moment)

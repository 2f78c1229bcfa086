"""Silver to the gold star: two dimensions and one fact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake.constants import UNKNOWN_COMPANY, UNSPECIFIED_LOCATION
from listinglake.functions.text import default_to
from listinglake.operators.numbering import Numbered, dense_keys
from listinglake.operators.skew import (
    BROADCAST_BYTES,
    HOT_ROWS,
    measured_bytes,
    spread_join,
)
from listinglake.session import store


@dataclass(frozen=True)
class Star:
    dim_company: DataFrame
    dim_location: DataFrame
    fct_vacancies: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))

    def create_views(self, prefix: str = "") -> None:
        """Offer the three tables to SQL under their names."""
        for name, frame in self.tables().items():
            frame.createOrReplaceTempView(prefix + name)


def prepare(silver: DataFrame) -> DataFrame:
    """Fact grain with names: default members filled, date and timestamp apart.

    The fill comes before the keys, so every row finds both dimensions.
    """
    return silver.select(
        F.col("id").alias("vacancy_id"),
        default_to(F.col("company_name"), UNKNOWN_COMPANY).alias("company_name"),
        default_to(F.col("candidate_required_location"), UNSPECIFIED_LOCATION).alias(
            "location_name"
        ),
        F.to_date("publication_date").alias("publication_date"),
        F.col("publication_date").alias("publication_timestamp"),
        "title",
        "description",
        "category",
        "salary",
    )


def _with_key(
    rows: DataFrame, name: str, numbered: Numbered, broadcast_bytes: int, hot_rows: int
) -> DataFrame:
    dimension = numbered.frame
    if measured_bytes(dimension) <= broadcast_bytes:
        return rows.join(F.broadcast(dimension), name)
    hot = numbered.hot(rows=hot_rows)
    return spread_join(rows, dimension, [name], "inner", hot, ["vacancy_id"])


def build(
    silver: DataFrame,
    key_type: str = "int",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> Star:
    """The star of a silver table.

    ``silver`` is read once per dimension (one column each) and once for the fact, so
    hand in a stored table. Keys are 1..n in name order and rebuilt by every run.
    """
    rows = prepare(silver)
    company = dense_keys(rows, "company_name", "company_id", key_type)
    location = dense_keys(rows, "location_name", "location_id", key_type)
    limits = (broadcast_bytes, hot_rows)
    named = _with_key(rows, "company_name", company, *limits)
    fact = _with_key(named, "location_name", location, *limits).select(
        "vacancy_id",
        "company_id",
        "location_id",
        "publication_date",
        "publication_timestamp",
        "title",
        "description",
        "category",
        "salary",
    )
    return Star(company.frame, location.frame, fact)


def build_stored(silver: DataFrame, **options) -> Star:
    """:func:`build` on a scratch copy of a silver plan that is not stored yet."""
    return build(store(silver, "silver"), **options)


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """(``key``, ``rows``): foreign keys without a member and the fact rows they hold.

    Counting per key first keeps a hot key to one row per task in the anti-join.
    """
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dimension.select(key), key, "left_anti")


def integrity(star: Star) -> DataFrame:
    """One row: fact rows and rows without company or location (expected 0)."""

    def lost(dimension: DataFrame, key: str) -> DataFrame:
        return orphans(star.fct_vacancies, dimension, key).select(
            F.lit(key).alias("check"), "rows"
        )

    total = star.fct_vacancies.select(F.lit("fact").alias("check"), F.lit(1).alias("rows"))
    checks = total.unionByName(lost(star.dim_company, "company_id")).unionByName(
        lost(star.dim_location, "location_id")
    )

    def rows_of(check: str):
        return F.coalesce(
            F.sum(F.when(F.col("check") == check, F.col("rows"))), F.lit(0)
        ).cast("bigint")

    return checks.agg(
        rows_of("fact").alias("fact_rows"),
        rows_of("company_id").alias("without_company"),
        rows_of("location_id").alias("without_location"),
    )

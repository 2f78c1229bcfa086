"""The serving side: denormalised view, counts, figures and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake.constants import DISPLAY_NAMES
from listinglake.functions.text import fold, strip
from listinglake.operators.numbering import positions
from listinglake.operators.skew import BROADCAST_BYTES, lookup_join
from listinglake.schemas import EXPORT_COLUMNS, SERVING, fields

COUNTED_COLUMNS = ("category", "location_name")
SEARCHED_COLUMNS = ("title", "company_name", "category", "location_name", "description")


def denormalise(
    fact: DataFrame,
    company: DataFrame,
    location: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fact with both names, every fact row kept."""
    named = lookup_join(fact, company, "company_id", "left", broadcast_bytes)
    # Hot locations are counted in the fact itself, not in the first join run once more.
    named = lookup_join(named, location, "location_id", "left", broadcast_bytes, counted=fact)
    return named.select(*EXPORT_COLUMNS)


def newest_first(frame: DataFrame, date: str = "publication_timestamp") -> DataFrame:
    """Newest first, undated last. Add a limit and Spark takes only the top rows."""
    return frame.orderBy(F.col(date).desc_nulls_last(), F.col("vacancy_id"))


def newest_positions(frame: DataFrame, date: str = "publication_timestamp") -> DataFrame:
    """Every row with its ``position`` in the newest-first list, without a sort in one task."""
    return positions(frame, [F.col(date).desc_nulls_last(), F.col("vacancy_id").asc()])


def prepare(frame: DataFrame, sort: bool = False) -> DataFrame:
    """Any vacancy frame on the serving columns: missing ones added, types fixed,
    bad dates null, null text ``""``, text trimmed (not the description)."""
    kinds = dict(frame.dtypes)

    def shaped(name: str, kind: str) -> Column:
        if name not in kinds:
            column = F.lit(None).cast(kind)
        elif kinds[name] == kind:
            column = F.col(name)
        elif kind == "string":
            column = F.col(name).cast("string")
        else:
            column = F.col(name).try_cast(kind)
        if kind == "string":
            column = F.coalesce(column, F.lit(""))
            column = column if name == "description" else strip(column)
        return column.alias(name)

    rows = frame.select(*[shaped(name, kind) for name, kind in fields(SERVING)])
    return newest_first(rows) if sort else rows


def display(frame: DataFrame) -> DataFrame:
    """The columns shown to a reader, under their display names."""
    return frame.drop("publication_timestamp").withColumnsRenamed(DISPLAY_NAMES)


def non_blank(name: str) -> Column:
    return F.trim(F.col(name).cast("string")) != ""


def value_counts(frame: DataFrame, name: str, limit: int) -> DataFrame:
    """``limit`` most frequent non-blank values of any column; ties go by value."""
    return (
        frame.where(non_blank(name))
        .groupBy(F.col(name).alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "label")
        .limit(limit)
    )


def top_counts(frame: DataFrame, name: str, limit: int) -> DataFrame:
    """As :func:`value_counts` for the two charted columns; others give no rows."""
    counts = value_counts(frame, name, limit) if name in COUNTED_COLUMNS else None
    if counts is None:
        return frame.sparkSession.createDataFrame([], "label string, count bigint")
    return counts


def kpis(frame: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: vacancies, distinct non-blank companies and locations."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct

    def members(name: str) -> Column:
        return distinct(F.nullif(F.col(name), F.lit("")))

    return frame.agg(
        F.count(F.lit(1)).alias("vacancies"),
        members("company_name").alias("companies"),
        members("location_name").alias("locations"),
    )


def visible_text() -> Column:
    """The searched fields, joined by one blank and case-folded."""
    return fold(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in SEARCHED_COLUMNS]))


def matches(query: str, text: Column | None = None) -> Column:
    """Literal, case-folded search over the visible text; blank finds everything.

    A query may span two fields. ``text`` is a ready :func:`visible_text` column when
    several queries share it.
    """
    if not query.strip():
        return F.lit(True)
    return F.contains(visible_text() if text is None else text, F.lit(query.casefold()))


def search(frame: DataFrame, query: str) -> DataFrame:
    return frame.where(matches(query))


def selectivity(frame: DataFrame, query: str) -> DataFrame:
    """One row: rows that match ``query`` and all rows, in one pass."""
    return frame.agg(
        F.count_if(matches(query)).alias("visible"), F.count(F.lit(1)).alias("total")
    )

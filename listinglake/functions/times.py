"""Publication dates: tolerant parsing, epochs, formats. Session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake.constants import (
    CAPTURE_STAMP,
    EPOCH_MS_ABOVE,
    FRACTION_AND_ZONE,
    ISO_SECONDS,
)
from listinglake.functions.text import strip

# A full date or date and time, with whatever fraction and zone may follow.
_WALL_CLOCK = (
    r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2})?(?:" + FRACTION_AND_ZONE[:-1] + ")?$"
)
_NUMBER = r"^-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?$"
_YEAR_10000 = 253_402_300_800


def parse_publication(column: Column, offset: str = "drop") -> Column:
    """Timestamp of a published date text; null when nothing fits.

    ``offset="drop"`` keeps the wall clock of a full date and time and ignores its
    fraction and zone. ``offset="convert"`` applies the zone. Both fall back to
    Spark's own tolerant cast. One match and one cast per row do the work; no
    formatter pattern is tried and thrown away.
    """
    text = column.cast("string")
    tolerant = text.try_cast("timestamp")
    if offset == "convert":
        return tolerant
    if offset != "drop":
        raise ValueError(f"offset must be 'drop' or 'convert', not {offset!r}")
    timed = F.substring(text, 11, 1).isin("T", " ")
    wall = F.when(timed, F.substring(text, 1, 19)).otherwise(F.substring(text, 1, 10))
    return F.when(
        text.rlike(_WALL_CLOCK), F.coalesce(wall.try_cast("timestamp"), tolerant)
    ).otherwise(tolerant)


def publication_timestamp(frame, name: str = "publication_date", offset: str = "drop") -> Column:
    """Parsed ``name`` whatever its type; null timestamps when the column is missing."""
    kinds = dict(frame.dtypes)
    if name not in kinds:
        return F.lit(None).cast("timestamp")
    if kinds[name] in ("timestamp", "timestamp_ntz", "date"):
        return F.col(name).cast("timestamp")
    return parse_publication(F.col(name), offset)


def epoch_text(seconds_or_millis: Column) -> Column:
    """UTC ISO text of an epoch; values above 10^10 are milliseconds."""
    value = seconds_or_millis.cast("double")
    seconds = F.when(value > EPOCH_MS_ABOVE, value / 1000).otherwise(value)
    moment = F.when(F.abs(seconds) < _YEAR_10000, F.timestamp_seconds(seconds))
    return F.date_format(moment, ISO_SECONDS)


def publication_text(column: Column, numeric_epoch: bool = True) -> Column:
    """ISO text of a landed date: epochs become dates, other text is stripped.

    Landed text no longer tells ``1780000000`` from ``"1780000000"``;
    ``numeric_epoch=False`` leaves both as they are.
    """
    text = F.coalesce(strip(column.cast("string")), F.lit(""))
    if not numeric_epoch:
        return text
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(number.isNotNull(), F.coalesce(epoch_text(number), F.lit(""))).otherwise(text)


def capture_stamp(moment: Column) -> Column:
    """``yyyyMMdd_HHmmss`` in UTC."""
    return F.date_format(moment.cast("timestamp"), CAPTURE_STAMP)


def iso_text(moment: Column) -> Column:
    return F.date_format(moment.cast("timestamp"), ISO_SECONDS)

"""Most frequent values of a column with very many, exact, without counting them all.

A mergeable frequent-items sketch per task names candidates and moves a bounded number of items,
however many values there are. The candidates alone are then counted exactly. The sketch's
guarantee bounds how often any other value can occur; where the last wanted count is above that
bound, the answer is proven. Where it is not, as when values are about equally frequent, every
value is counted after all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake.operators.serving import non_blank, value_counts

#: Items a sketch tracks: bounds its memory and what a task sends.
TRACKED = 10_000
#: Candidates counted for each value wanted.
SPARE = 4


@dataclass(frozen=True)
class Top:
    """``frame`` has (label, count); ``proven`` is false when all values had to be counted."""

    frame: DataFrame
    proven: bool


def _error_share(tracked: int) -> float:
    """Largest error of a sketch's count, as a share of all rows.

    A table of n slots errs by at most 3.5 / n of the rows, and three quarters of its slots,
    a power of two, are used for items.
    """
    slots = 1
    while slots * 3 < tracked * 4:
        slots *= 2
    return 3.5 / slots


def top_values(frame: DataFrame, name: str, limit: int, tracked: int = TRACKED) -> Top:
    """As :func:`listinglake.operators.serving.value_counts`, for columns of very many values."""
    labels = frame.where(non_blank(name)).select(F.col(name).alias("label"))
    wanted = min(max(SPARE * limit, 64), tracked)
    seen = labels.agg(
        F.count(F.lit(1)).alias("rows"),
        F.call_function("approx_top_k", F.col("label"), F.lit(wanted), F.lit(tracked)).alias("top"),
    ).first()
    candidates = [item["item"] for item in seen["top"] or ()]
    if not candidates:
        return Top(value_counts(frame, name, limit), False)
    error = _error_share(tracked) * seen["rows"]
    # A value the sketch does not list occurs at most twice the error; one behind the candidates
    # at most as often as the last of them, and the error.
    bound = 2 * error
    if len(candidates) == wanted:
        bound = max(bound, seen["top"][-1]["count"] + error)
    exact = (
        labels.where(F.col("label").isin(candidates))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "label")
        .limit(limit)
    )
    counts = [row["count"] for row in exact.collect()]
    whole = sum(counts) == seen["rows"] or (len(counts) == limit and counts[-1] > bound)
    if not whole:
        return Top(value_counts(frame, name, limit), False)
    return Top(exact, True)

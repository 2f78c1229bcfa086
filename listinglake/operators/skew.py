"""Joins and lookups that stay balanced when a few keys hold most rows.

Two tools:

* ``lookup_join`` broadcasts a lookup side only after measuring it, and otherwise
  falls back to ``spread_join``;
* ``spread_join`` salts exactly the keys that are hot. A key with share ``s`` of the
  rows gets ``ceil(s / SHARE)`` salts, so its rows land in that many tasks, and only
  its few matches on the other side are repeated. All hot keys together need fewer
  than ``2 / SHARE`` salts, which bounds both the repeats and the broadcast hot list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake.session import store

# A key is hot when it holds this share of all rows and at least this many.
SHARE = 1 / 2000
HOT_ROWS = 100_000
# A lookup side is broadcast up to this many bytes, measured.
BROADCAST_BYTES = 64 * 1024 * 1024
# Per-row overhead assumed on top of the measured text.
_ROW_BYTES = 64


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(
    frame: DataFrame,
    keys: list[str],
    total: int | None = None,
    share: float = SHARE,
    rows: int = HOT_ROWS,
) -> DataFrame | None:
    """(``_hot``, ``_fan``): hash and salt count of each hot key, under 1/share rows.

    One column-pruned pass with map-side counts; only the hot keys are stored. Null
    keys count as a key too. None when no key is hot, which needs no pass at all when
    the whole frame has fewer than ``rows`` rows.
    """
    total = frame.count() if total is None else total
    if total < rows:
        return None
    hashed = frame.groupBy(_hash(keys).alias("_hot")).agg(F.count(F.lit(1)).alias("_rows"))
    return hot_from_counts(hashed, total, share, rows)


def hot_from_counts(
    counts: DataFrame, total: int, share: float = SHARE, rows: int = HOT_ROWS
) -> DataFrame | None:
    """As :func:`hot_keys`, from (``_hot``, ``_rows``) counts that sum to ``total``."""
    if total < rows:
        return None
    floor = max(total * share, rows)
    # Grouped once more, so two hot keys of one hash stay one row.
    hot = store(
        counts.where(F.col("_rows") >= F.lit(floor))
        .groupBy("_hot")
        .agg(F.ceil(F.sum("_rows") / F.lit(floor)).cast("int").alias("_fan")),
        "hot-keys",
    )
    return None if hot.isEmpty() else hot


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    hot: DataFrame | None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Equi-join on ``keys``; ``left`` may be skewed, ``hot`` lists its hot keys.

    Without hot keys it is the plain join.

    A salt comes from the row's task and its ``spread_by`` columns. The task alone
    already parts equal copies; both are the same again when a lost task is rerun,
    which a random salt would not be.
    """
    if hot is None:
        return left.join(right, keys, how)
    fan = F.coalesce(F.col("_fan"), F.lit(1))
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in spread_by]), fan)
    salted = (
        left.withColumn("_hot", _hash(keys))
        .join(F.broadcast(hot), "_hot", "left")
        .withColumn("_salt", salt.cast("int"))
        .drop("_hot", "_fan")
    )
    repeated = (
        right.withColumn("_hot", _hash(keys))
        .join(F.broadcast(hot), "_hot", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), fan - 1)))
        .drop("_hot", "_fan")
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def measured_bytes(frame: DataFrame) -> int:
    """Upper estimate of the rows of ``frame`` in memory, from one aggregate."""
    sizes = [F.lit(_ROW_BYTES)]
    for name, kind in frame.dtypes:
        if kind in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(F.col(name)), F.lit(0)))
        elif kind.startswith(("array", "map", "struct", "variant")):
            text = F.to_json(F.struct(F.col(name)))
            sizes.append(2 * F.octet_length(text))
    return frame.agg(F.sum(sum(sizes[1:], sizes[0]).cast("bigint"))).first()[0] or 0


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str] | str,
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, whose ``keys`` are unique.

    The right side is broadcast when its measured size is at most ``limit`` bytes.
    Beyond that the join shuffles, with the hot keys of ``left`` salted. They are counted in
    ``counted``, a cheaper frame with the same keys, when one is given.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if measured_bytes(right) <= limit:
        return left.join(F.broadcast(right), keys, how)
    hot = hot_keys(left if counted is None else counted, keys, rows=hot_rows)
    return spread_join(left, right, keys, how, hot)

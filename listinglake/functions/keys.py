"""Stable hash ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_id(source: Column, native_id: Column) -> Column:
    """Positive bigint from the first 8 bytes of sha256(``source:native_id``)."""
    digest = F.sha2(F.concat_ws(":", source, native_id.cast("string")), 256)
    signed = F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")
    return signed.bitwiseAND(F.lit((1 << 63) - 1))

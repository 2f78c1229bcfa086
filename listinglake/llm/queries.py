"""All queries of this subpackage; importing the operators registers them."""

from listinglake.llm import (  # noqa: F401
    decontam,
    infill,
    licences,
    mixing,
    neardup,
    neighbours,
    pii,
    quality,
    repeats,
    resampling,
    secret_scan,
    token_counts,
    warc,
)
from listinglake.llm.tables import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

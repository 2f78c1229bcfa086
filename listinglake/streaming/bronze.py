"""The bronze scan run incrementally: each new landed document once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from listinglake.sources import landing


def land_new_listings(
    spark: SparkSession, folder: str, target: str, checkpoint: str, **options
) -> StreamingQuery:
    """Append the listings of documents not seen before to a Parquet table, then stop.

    The checkpoint remembers the documents, so a run after a failure goes on where the
    last one stopped and no listing is written twice. Dedupe stays with silver.
    ``options`` are those of :class:`listinglake.sources.landing.Landing`.
    """
    at = landing.Landing(folder, stream=True, **options)
    return (
        landing.listings(spark, at, arrays=True)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )

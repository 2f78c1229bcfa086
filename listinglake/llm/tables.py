"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import listinglake
from listinglake.session import configure as configure_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Bytes of one Arrow batch. A task holds several copies of a batch, in the JVM and in its Python
#: worker, and both keep the memory: ten thousand texts a batch cost an executor hundreds of MB.
BATCH_BYTES = 4 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Session settings, bounded Arrow batches, and this package on the path of the Python workers.

    An installed package needs no path; one used from its folder is found by it.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(listinglake.__file__)))
    environment = spark.sparkContext.environment
    known = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if home not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, home])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return configure_session(spark)


def query(name: str, sql: str | None = None):
    """Register ``build(spark, sf_dir)`` as query ``name``, with its SQL when there is one."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_share(key: Column, share: float) -> Column:
    """Whether a row is in a sample of that share, by a hash of it."""
    return F.pmod(key, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def fitting_sample(documents: DataFrame, rows: int) -> DataFrame:
    """(key, text) of a sample for fitting a model: about ``rows`` different rows at most.

    Rows without id or text take no part. The key is a hash of id and text together, so no id
    that is repeated can exceed the bound. Equal rows share a key: :func:`first_of_key` leaves
    one of each in a map before the shuffle, and one of all in the task that fits. The same rows
    are drawn in every run.
    """
    whole = documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    share = min(1.0, rows / max(whole.select("doc_id").count(), 1))
    keyed = whole.select(F.xxhash64("doc_id", "text").alias("key"), "text")
    return keyed.where(in_share(F.col("key"), share))


def first_of_key(batches):
    """Arrow batches without the rows whose ``key`` came before; keeps the keys of one sample."""
    seen: set[int] = set()
    for batch in batches:
        fresh = []
        for key in batch.column("key").to_pylist():
            fresh.append(key not in seen)
            seen.add(key)
        yield batch.filter(pa.array(fresh, pa.bool_()))

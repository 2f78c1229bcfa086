"""Samples that models are fitted on keep their bound, whatever ids and rows repeat."""

import time

import pytest
from pyspark.sql import functions as F

from listinglake.llm import licences, pii, quality
from listinglake.llm.tables import fitting_sample

ROWS = 60_000


@pytest.mark.parametrize(
    "doc_id, text, wanted",
    [
        ("cast(null as bigint)", "'a@b.example 1'", 0),
        ("7L", "'a@b.example 1'", 1),
        ("7L", "concat('a@b.example ', id)", 2000),
        ("id", "concat('a@b.example ', id)", 2000),
        ("id", "cast(null as string)", 0),
    ],
)
def test_a_sample_keeps_its_bound(spark, doc_id, text, wanted):
    frame = spark.range(ROWS).selectExpr(f"{doc_id} AS doc_id", f"{text} AS text", "1 AS rows")
    drawn = fitting_sample(frame, 2000).dropDuplicates(["key"])
    count = drawn.count()
    assert abs(count - wanted) <= 0.1 * wanted or (wanted == 1 and count <= 1)
    again = fitting_sample(frame.repartition(3), 2000).dropDuplicates(["key"])
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, again.collect()))


def test_models_train_on_repeated_and_missing_ids(spark, monkeypatch):
    """The training tasks see no more rows than their bound."""
    frame = spark.range(3000).selectExpr("1L AS doc_id", "concat('good words ', id) AS text")
    frame = frame.unionByName(spark.range(3000).selectExpr("cast(null as bigint) AS doc_id", "'bad' AS text"))
    frame = frame.unionByName(spark.range(3000).selectExpr("2L AS doc_id", "'the same text' AS text"))
    # Neither id is in the held-out fold.
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    fit = quality._train

    def counted(batches):
        held = list(batches)
        rows = sum(batch.num_rows for batch in held)
        if rows > 450:
            raise AssertionError(f"{rows} rows")
        yield from fit(iter(held))

    monkeypatch.setattr(quality, "_train", counted)
    assert quality.train(frame, labels, rows=300).any()
    assert pii.find_personal(frame.withColumn("text", F.concat("text", F.lit(" x@y.example")))).count() == 9000
    assert licences.train(frame).any()


def test_a_text_of_very_many_spans_is_linear_work():
    text = " ".join(f"mail{k}@host{k % 7}.example" for k in range(100_000))
    start = time.perf_counter()
    ((base, more),) = pii.search([text], pii.prior())
    assert len(base) == 100_000 and not more
    assert time.perf_counter() - start < 60

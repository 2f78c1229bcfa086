import pytest

from listinglake.llm.tables import configure

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    configure(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with extra columns that clash with inner names."""

    def build(rows, extra=False):
        frame = spark.createDataFrame(
            [(i, t, "en", f"s{k % 2}", len(t or "")) for k, (i, t) in enumerate(rows)], DOCUMENT
        )
        if extra:
            from pyspark.sql import functions as F

            for name in ("same", "band", "weight", "_score", "item_id", "label", "rows", "tokens"):
                frame = frame.withColumn(name, F.lit(1))
        return frame

    return build


#: Nulls, empty and blank texts, repeated rows, one very long text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, "some words of a text without an id"),
    (None, None),
    (4, "one"),
    (5, "the same words again and again"),
    (5, "the same words again and again"),
    (6, "word " * 60_000),
    (7, "x" * 100_000),
]


@pytest.fixture
def odd():
    return list(ODD)

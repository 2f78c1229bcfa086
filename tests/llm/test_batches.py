"""Arrow batches of texts are bounded in bytes, not only in rows."""

import pyarrow as pa
from pyspark.sql import functions as F

from listinglake.llm import tables


def test_batches_of_long_texts_are_bounded(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "size": [batch.nbytes]})

    tables.configure(spark)
    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("ten chars "), 1000).alias("text"))
    found = texts.mapInArrow(sizes, "rows bigint, size bigint").collect()
    assert sum(row.rows for row in found) == 2000
    assert max(row.size for row in found) < 2 * tables.BATCH_BYTES

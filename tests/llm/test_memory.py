"""What a task hands to its Python worker at a time is bounded in bytes, not in rows."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import BATCH, BATCH_BYTES, small_batches, stored


def test_batches_of_long_texts_are_small_and_whole(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())],
                ["n", "size"])

    rows = spark.range(0, 6000, 1, 1).select(F.expr("repeat('0123456789', 250)").alias("text"))
    found = stored(rows.mapInArrow(sizes, "n long, size long"), "sizes").collect()
    assert sum(r["n"] for r in found) == 6000
    assert max(r["size"] for r in found) < 1.1 * BATCH_BYTES


def test_the_session_stays_as_it_was(spark):
    assert spark.conf.get(BATCH, None) is None
    with pytest.raises(KeyError), small_batches(spark):
        assert spark.conf.get(BATCH) == str(BATCH_BYTES)
        raise KeyError
    assert spark.conf.get(BATCH, None) is None
    spark.conf.set(BATCH, "1m")
    try:
        with small_batches(spark):
            assert spark.conf.get(BATCH) == "1m"
        assert spark.conf.get(BATCH) == "1m"
    finally:
        spark.conf.unset(BATCH)

"""What the operators of this folder share: words, tables, work tables, batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import scratch_path

# Words: A-Z lower-cased, then runs of digits, a-z and everything outside ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
# One byte table does the lower-casing and turns every byte between words into a space;
# bytes above 0x7F belong to non-ASCII characters, which are all word characters.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20
                   for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 (null: none)."""
    return (text or "").encode().translate(WORD_BYTES).split()


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text as an array column (null: empty), the same as ``words_of``."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP)
    return F.filter(parts, lambda w: w != "")


def row_hash(doc_id: Column, text: Column) -> Column:
    """Tells rows of one doc_id apart. Repeated equal rows share it, and with it whatever
    is found out about them."""
    return F.xxhash64(doc_id, text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed value: the setting that bounds what a task hands to its Python worker at a time.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, batches for Python end at ``BATCH_BYTES``, whatever the number of their rows:
    the JVM holds a batch two or three times over beside its heap, the worker once more. A
    bound that the session was given stands."""
    if spark.conf.get(BATCH, None) is not None:
        yield
        return
    spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes a work table to the shared folder and reads it back: later steps neither
    compute it again nor depend on the executors that made it. Batches for Python are small."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    with small_batches(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunks(batches: Iterator[pa.RecordBatch], size: str,
           most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes in the string column ``size``, so
    that memory does not follow the number of rows in a batch. A row is never cut. What the
    batches held goes back to the system in the end, as the worker lives on for other stages."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(size))
        total = column.nbytes
        rows = max(1, int(batch.num_rows * most / max(total, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()

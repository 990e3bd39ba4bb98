"""Session settings the library is tuned for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed value: the setting that lets a task keep a file per folder open.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # folders per part without sorting the rows by part first
    WRITERS: "8",
}


@contextmanager
def unsorted_folders(spark: SparkSession) -> Iterator[None]:
    """Inside, writing by folder does not sort whole rows by folder first, in a session that
    was not made by ``configure`` either."""
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, SETTINGS[WRITERS])
    try:
        yield
    finally:
        spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)


# What a shuffle partition should hold at most; smaller ones are merged at run time.
PARTITION_BYTES = 128 << 20


def configure(builder: SparkSession.Builder,
              input_bytes: int | None = None) -> SparkSession.Builder:
    """The settings; with the size of the largest input, also the number of partitions that
    shuffles start with (the run merges partitions, it never adds any)."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                 max(200, -(-input_bytes // PARTITION_BYTES)))
    return builder


def local_session(cpus: int = 8, memory: str = "8g", name: str = "tidemark") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (configure(SparkSession.builder.master(f"local[{cpus}]").appName(name))
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.driver.memory", memory)
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark

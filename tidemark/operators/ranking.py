"""Row numbers inside groups, whatever share of all rows a group holds.

A plain window puts a whole group into one task. Here every row takes the same way: a range
partitioning on the group *and* the sort columns cuts the table into ordered slices of about
equal size, rows are numbered inside each slice, and a group that crosses from one slice into
the next is shifted by its rows before. No group is looked for, so none can be missed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import scratch_path


def sliced_rows(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                slices: int | None = None) -> DataFrame:
    """``df`` in ordered slices, numbered by ``_slice``; as many as the session has shuffle
    partitions unless told otherwise.

    ``order`` must be total within a group for the slices to be even. The slice number
    comes from the exchange, so the rows are written to the shared work folder: a
    recomputed range partitioning could pick other bounds.
    """
    columns = [*[F.col(c) for c in partition], *order]
    spread = df.repartitionByRange(*([slices] if slices else []), *columns)
    folder = scratch_path(df.sparkSession, "slices")
    # hashes shrink to half under zstd, not at all under snappy
    spread.withColumn("_slice", F.spark_partition_id()).write.option(
        "compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def rows_before(sliced: DataFrame, partition: Sequence[str]) -> DataFrame:
    """(_group, _slice, _before) of the groups that cross from one slice into another: their
    rows in earlier slices.

    Such a group is the first or the last of each slice it touches, so there are at most
    two rows per slice.
    """
    group = F.struct(*partition)
    ends = sliced.groupBy("_slice").agg(F.array_distinct(
        F.array(F.min(group), F.max(group))).alias("ends"))
    crossing = (ends.select(F.explode("ends").alias("_group"))
                .groupBy("_group").agg(F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("_group"))
    earlier = Window.partitionBy("_group").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    return (sliced.select(group.alias("_group"), "_slice")
            .join(F.broadcast(crossing), "_group")  # at most two rows per slice
            .groupBy("_group", "_slice").agg(F.count(F.lit(1)).alias("_rows"))
            .withColumn("_before", F.sum("_rows").over(earlier))
            .filter(F.col("_before").isNotNull()).drop("_rows"))


def number_rows(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                name: str, slices: int | None = None) -> DataFrame:
    """``row_number`` in which no task holds more than about one slice."""
    sliced = sliced_rows(df, partition, order, slices)
    local = Window.partitionBy(*partition, "_slice").orderBy(*order)
    # as many tasks as slices; left to itself the run merges them up to the advisory size
    spread = sliced.repartition(slices, *partition, "_slice") if slices else sliced
    return (spread.withColumn("_local", F.row_number().over(local))
            .withColumn("_group", F.struct(*partition))
            # at most two rows per slice
            .join(F.broadcast(rows_before(sliced, partition)), ["_group", "_slice"], "left")
            .withColumn(name, F.col("_local") + F.coalesce("_before", F.lit(0).cast("bigint")))
            .drop("_group", "_slice", "_local", "_before"))

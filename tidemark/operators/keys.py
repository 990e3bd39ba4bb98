"""Row identity for sources without a transaction id."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import hashing
from tidemark.model import LINEAGE_COLUMNS, TableSpec
from tidemark.operators import ranking


def derived(spec: TableSpec) -> list[Column]:
    """Change hash, measures and quality flags of a row."""
    return [hashing.attribute_hash(spec.attribute_names).alias("attr_hash"),
            *[F.expr(f"CAST({d.sql} AS {d.dtype.simpleString()}) AS {d.name}")
              for d in (*spec.measures, *spec.flags)]]


def with_hashes(valid: DataFrame, spec: TableSpec) -> DataFrame:
    """Identity and change hashes, measures and quality flags; no shuffle."""
    return valid.select(
        "*", hashing.key_hash(spec.key_names).alias("business_key_hash"), *derived(spec))


def occurrence_order(spec: TableSpec) -> list[Column]:
    """Equal business keys are told apart by their attributes, then by file position."""
    return [*[F.col(a).asc_nulls_last() for a in spec.attribute_names],
            F.col("_row_num").asc_nulls_last(), F.col("_source_file").asc_nulls_last()]


def _staged(keyed: DataFrame, spec: TableSpec) -> DataFrame:
    lineage = [c for c in LINEAGE_COLUMNS if c != "_row_num"]
    return keyed.select(*spec.row_columns, *lineage)


# Rows that a task of a shuffle of whole rows should hold at most: far below its memory.
TASK_ROWS = 100_000


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks for a shuffle of so many whole rows; None where the session's own number will do.

    A session's number of shuffle partitions does not follow the input, and the run merges
    partitions up to an advisory size that is counted compressed. Beyond ``TASK_ROWS`` a core,
    the number is therefore given, so that a task's sorts stay the same size as tables grow.
    """
    wanted = -(-rows // TASK_ROWS)
    return wanted if wanted > spark.sparkContext.defaultParallelism else None


def spread_by(df: DataFrame, key: str | Column, tasks: int | None = None) -> DataFrame:
    """Rows spread by a key, over a number of tasks if one is given."""
    return df.repartition(*([tasks] if tasks else []), key)


@dataclass(frozen=True)
class Crowded:
    """Business keys too many of whose rows would meet in one task, found by buckets of keys."""

    buckets: int
    found: tuple[int, ...]

    def holds(self, business_key: Column) -> Column:
        return _bucket(business_key, self.buckets).isin(*self.found)

    def parts(self, rows: DataFrame, business_key: Column) -> tuple[DataFrame, DataFrame | None]:
        """(rows of all other keys, rows of crowded keys if there are any such keys)."""
        if not self.found:
            return rows, None
        return rows.filter(~self.holds(business_key)), rows.filter(self.holds(business_key))


def _bucket(business_key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(business_key), F.lit(buckets)).cast("int")


def find_crowded(tasks: int | None, *business_keys: DataFrame) -> Crowded:
    """Which buckets of business keys hold more than ``TASK_ROWS`` rows of tables of one column.

    A bucket holds a small part of a task's rows, so one beyond that holds a heavy key. The
    counts are a few numbers per task; the driver gets one number per ``TASK_ROWS`` rows at most.
    """
    buckets = 64 * max(64, tasks or 0)
    each = [df.select(_bucket(F.col(df.columns[0]), buckets).alias("b")) for df in business_keys]
    counts = reduce(DataFrame.unionByName, each).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    return Crowded(buckets, tuple(r["b"] for r in counts.filter(F.col("n") > TASK_ROWS).collect()))


def assign_keys_together(valid: DataFrame, spec: TableSpec, tasks: int | None = None) -> DataFrame:
    """What ``assign_keys`` gives, by one shuffle of the cleaned rows on the business key, on which
    they stay spread. For rows without crowded keys: a key is numbered in one task."""
    key = hashing.key_hash(spec.key_names)
    spread = spread_by(valid, key, tasks).select("*", key.alias("business_key_hash"))
    within = Window.partitionBy("_cut_date", "_cut_label", "business_key_hash").orderBy(
        *occurrence_order(spec))
    numbered = spread.withColumn("occurrence_seq", F.row_number().over(within).cast("bigint"))
    return _staged(numbered.select(
        "*", hashing.occurrence_hash(F.col("business_key_hash"), F.col("occurrence_seq"))
        .alias("movement_key"), *derived(spec)), spec)


def assign_keys(valid: DataFrame, spec: TableSpec, slices: int | None = None,
                by_key: bool = False) -> DataFrame:
    """Staged rows: hashes, occurrence number, movement key, measures, flags, lineage.

    Numbering cuts the rows into slices (``ranking.number_rows``); a table with a real key
    needs none. Its shuffles carry the cleaned row and 16 bytes of identity; the texts of the
    hashes, the measures and the flags are computed behind them. ``by_key`` also spreads
    the rows by movement key, for the join or the windows to come, before they are widened.
    """
    if spec.natural:
        staged = _staged(with_hashes(valid, spec).withColumn(
            "occurrence_seq", F.lit(1).cast("bigint")).withColumn(
            "movement_key", F.col("business_key_hash")), spec)
        return spread_by(staged, "movement_key", slices) if by_key else staged
    identity = F.unhex(hashing.key_hash(spec.key_names)).alias("_identity")
    group = ["_cut_date", "_cut_label", "_identity"]
    numbered = ranking.number_rows(valid.select("*", identity), group, occurrence_order(spec),
                                   "occurrence_seq", slices)
    business_key = F.lower(F.hex("_identity"))
    movement_key = hashing.occurrence_hash(business_key, F.col("occurrence_seq"))
    if by_key:
        numbered = spread_by(numbered, movement_key, slices)
    return _staged(numbered.select(
        "*", business_key.alias("business_key_hash"), movement_key.alias("movement_key"),
        *derived(spec)), spec)


def duplicate_keys(staged: DataFrame, key: str = "movement_key") -> DataFrame:
    """Per cut: rows minus distinct keys. Anything but zero breaks the merge."""
    per_key = staged.groupBy("_cut_label", key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy("_cut_label").agg(
        (F.sum("_n") - F.count(F.lit(1))).cast("bigint").alias("duplicates"))


def require_unique(staged: DataFrame, key: Sequence[str]) -> DataFrame:
    """The same rows; the job fails on the second row of a key.

    Numbering by ``key`` uses the distribution and order that the merge join on ``key``
    needs anyway, so the check adds no shuffle and no sort.
    """
    w = Window.partitionBy(*key).orderBy(*key)
    message = F.concat_ws(" ", F.lit("key is not unique in the cut:"),
                          *[F.col(k).cast("string") for k in key])
    failed = F.raise_error(message).cast("boolean")
    return (staged.withColumn("_copy", F.row_number().over(w))
            .filter(F.when(F.col("_copy") > 1, failed).otherwise(F.lit(True)))
            .drop("_copy"))

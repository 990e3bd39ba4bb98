"""Reading one cut, fingerprinting it, and choosing which cuts to process."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import attribute_hash, multiset_checksum
from tidemark.model import LEDGER_SCHEMA, Cut, TableSpec


class OutOfOrderError(RuntimeError):
    """A cut is older than the newest one already processed."""


def scan_cut(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The declared columns of a cut; a missing file or column is an error."""
    return spark.read.parquet(path).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.source.fields],
        F.col("_metadata.file_name").alias("_source_file"),
        row_number_in_file().alias("_row_num"))


def row_number_in_file() -> Column:
    """1-based position of a row in its parquet file, exact however the file is split."""
    return F.col("_metadata.row_index") + 1


def with_lineage(scanned: DataFrame, cut: Cut) -> DataFrame:
    """Adds label, date and load time to a scanned cut."""
    return scanned.select(
        *[c for c in scanned.columns if c not in ("_source_file", "_row_num")],
        "_source_file",
        F.lit(cut.label).alias("_cut_label"),
        F.lit(cut.cut_date).alias("_cut_date"),
        "_row_num",
        F.current_timestamp().alias("_load_ts"))


def fingerprint_columns(spec: TableSpec, of: str = "") -> list[Column]:
    """Row count and a checksum over the rows' values, as aggregates. Equal rows in another
    order or in other files have the same one. ``of`` prefixes the column names, for rows held
    in a struct."""
    row_hash = attribute_hash(of + c for c in spec.source_columns)
    return [F.count(F.lit(1)).alias("source_rows"),
            multiset_checksum(row_hash).alias("checksum")]


def fingerprint_text(rows: Column, checksum: Column) -> Column:
    return F.concat_ws(":", rows.cast("string"), checksum)


def fingerprint(scanned: DataFrame, spec: TableSpec) -> DataFrame:
    """One row (source_rows, fingerprint) for the content of a scanned cut."""
    return scanned.agg(*fingerprint_columns(spec)).select(
        "source_rows", fingerprint_text(F.col("source_rows"), F.col("checksum"))
        .alias("fingerprint"))


def manifest(spark: SparkSession, cuts: Sequence[Cut]) -> DataFrame:
    """One row per cut, in date order."""
    rows = [(c.label, c.path, c.cut_date) for c in sorted(cuts, key=lambda c: c.cut_date)]
    return spark.createDataFrame(rows, "cut_label string, file string, cut_date date")


def pending_cuts(manifest_with_fingerprints: DataFrame, ledger: DataFrame) -> DataFrame:
    """Cuts whose date *and* content have not been processed."""
    done = ledger.select("cut_date", "fingerprint").distinct()
    return manifest_with_fingerprints.join(done, ["cut_date", "fingerprint"], "left_anti")


def late_cuts(manifest_df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Cuts older than the newest processed one. The same date is not late."""
    newest = ledger.agg(F.max("cut_date").alias("newest")).scalar()
    return manifest_df.filter(F.col("cut_date") < newest)


def check_order(wanted: DataFrame, ledger: DataFrame) -> None:
    """Refuses cuts of a manifest that are older than the newest one processed."""
    late = late_cuts(wanted, ledger).first()
    if late:
        raise OutOfOrderError(
            f"cut {late['cut_label']} of {late['cut_date']} is older than "
            "the newest one processed; cuts go in date order")


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)

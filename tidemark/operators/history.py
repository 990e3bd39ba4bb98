"""Type 2 history: built from many cuts in one pass, and read as of a date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import key_hash, version_hash
from tidemark.model import DELETE, INSERT, UPDATE, Cut, TableSpec
from tidemark.operators.keys import (
    assign_keys, assign_keys_together, find_crowded, require_unique, spread_by,
)
from tidemark.operators.merge import version_columns


def calendar(spark: SparkSession, cuts: Sequence[Cut]) -> DataFrame:
    """One row per cut with its position and the cut after it."""
    ordered = sorted(cuts, key=lambda c: c.cut_date)
    dates = [c.cut_date for c in ordered]
    if len(set(dates)) != len(dates):
        raise ValueError("a one-pass history needs one cut per date")
    following = [*ordered[1:], None]
    rows = [(c.label, c.cut_date, n, f and f.cut_date, f and f.label)
            for n, (c, f) in enumerate(zip(ordered, following))]
    return spark.createDataFrame(
        rows, "_cut_label string, _cut_date date, _cut_no int, "
              "_next_date date, _next_label string")


def bulk_history(valid: DataFrame, spec: TableSpec, cuts: Sequence[Cut],
                 slices: int | None = None, before: DataFrame | None = None) -> DataFrame:
    """All versions of all keys from the valid rows of every cut.

    Equal to merging the cuts one by one. Rows are spread by business key once, for the numbering
    and all windows; those of crowded keys are numbered in slices and then spread by movement key.
    A movement key has at most one row per cut.

    ``before`` are the open versions that an earlier history left. They come along as a cut
    ahead of the first one, and leave as what the cuts make of them: open or closed.
    """
    days = calendar(valid.sparkSession, cuts)
    if before is None and not spec.natural:
        key = key_hash(spec.key_names)
        rows, many = find_crowded(slices, valid.select(key)).parts(valid, key)
        found = _versions(_dated(assign_keys_together(rows, spec, slices), days, spec), spec)
        return found if many is None else found.unionByName(_versions(
            _dated(assign_keys(many, spec, slices, by_key=True), days, spec), spec))
    # rows of open versions travel with the others, so these are spread once they are there
    staged = assign_keys(valid, spec, slices, by_key=before is None or spec.natural)
    if spec.natural:  # the numbering makes other keys unique
        staged = require_unique(staged, ["movement_key", "_cut_date"])
    rows = _dated(staged, days, spec)
    if before is not None:
        rows = rows.unionByName(_carried(before, spec, cuts), allowMissingColumns=True)
        rows = spread_by(rows, "movement_key", slices)
    return _versions(rows, spec)


def _dated(staged: DataFrame, days: DataFrame, spec: TableSpec) -> DataFrame:
    """Staged rows with the place of their cut; one row per cut is broadcast."""
    return staged.join(F.broadcast(days), ["_cut_label", "_cut_date"]).selectExpr(
        "*", f"CAST(NULL AS {_kept_type(spec)}) AS _kept")


# What an open version keeps of its own beside the columns it shares with staged rows.
_KEPT = ("change_type", "is_deleted", "valid_from", "source_file", "cut_label", "load_ts",
         "prev_attr_hash")


def _kept_type(spec: TableSpec) -> str:
    fields = [f"{c}: {spec.version_schema[c].dataType.simpleString()}" for c in _KEPT]
    return f"STRUCT<{', '.join(fields)}>"


def _carried(before: DataFrame, spec: TableSpec, cuts: Sequence[Cut]) -> DataFrame:
    """Open versions as rows of a cut ahead of the first one."""
    first = min(cuts, key=lambda c: c.cut_date)
    return before.select(
        *spec.row_columns, F.struct(*_KEPT).alias("_kept"), F.lit(-1).alias("_cut_no"),
        F.lit(first.cut_date).alias("_next_date"), F.lit(first.label).alias("_next_label"))


def _versions(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Versions from presence: a key has one row per cut it appears in, and may have one of
    an open version ahead of them (``_kept``), live or buried.

    All windows run from the newest cut to the oldest, over one sort; a group has at
    most one row per cut.
    """
    # rows lie together by either of the two, so neither costs a shuffle
    w = "PARTITION BY business_key_hash, movement_key ORDER BY _cut_no DESC"
    up_to_here = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    newer = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    rows = rows.selectExpr(
        "*", f"lead(_cut_no) OVER ({w}) AS _seen_no",
        f"lead(_kept.is_deleted) OVER ({w}) AS _seen_buried",
        f"lead(attr_hash) OVER ({w}) AS prev_attr_hash",
        f"lag(_cut_no) OVER ({w}) AS _newer_no")
    rows = rows.selectExpr("*", f"""CASE
            WHEN _kept IS NOT NULL THEN _kept.change_type
            WHEN _seen_no IS NULL OR _seen_no < _cut_no - 1 OR _seen_buried THEN '{INSERT}'
            WHEN prev_attr_hash <> attr_hash THEN '{UPDATE}' END AS change_type""", """
        CASE WHEN _next_date IS NOT NULL AND (_newer_no IS NULL OR _newer_no > _cut_no + 1)
                AND NOT coalesce(_kept.is_deleted, false)
            THEN named_struct('day', _next_date, 'label', _next_label) END AS _left""")
    rows = rows.selectExpr(
        *[c for c in rows.columns if c != "_left"],
        f"last(_left, true) OVER {up_to_here} AS _gone",
        "last(CASE WHEN change_type IS NOT NULL THEN _cut_date END, true) "
        f"OVER {newer} AS _reopened").filter("change_type IS NOT NULL")
    # a deletion belongs to the last version opened before it
    rows = rows.selectExpr("*", "_gone IS NOT NULL AND (_reopened IS NULL "
                                "OR _gone.day <= _reopened) AS _ends")
    row = {c: c for c in spec.row_columns}
    return (rows.selectExpr("*", "explode(CASE WHEN _ends THEN array(false, true) "
                                 "ELSE array(false) END) AS _buried")
            .selectExpr(
                "*", "CASE WHEN _ends AND NOT _buried THEN _gone.day ELSE _reopened END AS _until")
            .selectExpr(*version_columns(spec, {
                **row,
                "change_type": f"CASE WHEN _buried THEN '{DELETE}' ELSE change_type END",
                "is_current": "_until IS NULL",
                "is_deleted": "_buried OR coalesce(_kept.is_deleted, false)",
                "valid_from": "CASE WHEN _buried THEN _gone.day "
                              "ELSE coalesce(_kept.valid_from, _cut_date) END",
                "valid_to": "_until", "source_file": "coalesce(_kept.source_file, _source_file)",
                "cut_label": "CASE WHEN _buried THEN _gone.label "
                             "ELSE coalesce(_kept.cut_label, _cut_label) END",
                "load_ts": "CASE WHEN _buried THEN current_timestamp() "
                           "ELSE coalesce(_kept.load_ts, _load_ts) END",
                "prev_attr_hash": "CASE WHEN _buried THEN attr_hash WHEN _kept IS NOT NULL "
                                  "THEN _kept.prev_attr_hash ELSE prev_attr_hash END",
            })))


def with_version_id(history: DataFrame) -> DataFrame:
    return history.withColumn(
        "version_id", version_hash(F.col("movement_key"), F.col("valid_from")))


def as_of(history: DataFrame, day: date) -> DataFrame:
    """Live state on a date."""
    d = F.lit(day)
    return history.filter(
        (F.col("valid_from") <= d)
        & (F.col("valid_to").isNull() | (F.col("valid_to") > d)) & ~F.col("is_deleted"))


def as_of_many(history: DataFrame, days: Sequence[date]) -> DataFrame:
    """Live state on each of a list of dates, in one scan: a version is repeated for the
    dates it covers and for no other."""
    wanted = F.array(*[F.lit(d) for d in days])
    covered = F.filter(wanted, lambda d: (F.col("valid_from") <= d)
                       & (F.col("valid_to").isNull() | (F.col("valid_to") > d)))
    return (history.filter(~F.col("is_deleted"))
            .select(F.explode(covered).alias("as_of_date"), "*"))


def as_of_join(probes: DataFrame, history: DataFrame, key: str = "movement_key",
               day: str = "day") -> DataFrame:
    """Every probe (key, day, ...) with the version that held on its day, as a struct
    ``version``; NULL where the key had none, was deleted, or key or day are NULL.

    An equi-join on the key with the interval as a further condition: at most one version of
    a key holds on a day, so no row is repeated. Probes of a hot key are split over tasks by
    the adaptive skew join, as they are the side that the left join preserves.
    """
    at = "_version"
    versions = history.filter(~F.col("is_deleted")).select(
        F.col(key).alias("_key"), F.struct(*history.columns).alias(at))
    holds = ((F.col(f"{at}.valid_from") <= F.col(day))
             & (F.col(f"{at}.valid_to").isNull() | (F.col(f"{at}.valid_to") > F.col(day))))
    return (probes.drop("version")
            .join(versions, (F.col(key) == F.col("_key")) & holds, "left")
            .drop("_key").withColumnRenamed(at, "version"))


def trace(history: DataFrame) -> DataFrame:
    """Every version of every key, in order."""
    return history.orderBy("movement_key", "valid_from")

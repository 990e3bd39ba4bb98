"""Compare a cut with the open versions: rows meet on their business key, then one explode.

A business key's rows are numbered where they meet its open versions, so the cut and the
open versions are shuffled once each. Rows of keys that would crowd a task are numbered in slices
instead and joined on the movement key, an md5, which gives even tasks whatever the
distribution of the business columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import hashing

from tidemark.model import (
    CLOSED, DELETE, INSERT, LIVE, NOOP, TOMBSTONE, UNCHANGED, UPDATE, Cut, TableSpec,
)
from tidemark.operators.keys import (
    assign_keys, derived, find_crowded, occurrence_order, require_unique, spread_by,
)


def pair_up(live: DataFrame, staged: DataFrame, tasks: int | None = None) -> DataFrame:
    """(new, old): the staged row and the open version of each key; either may be NULL.
    ``tasks`` is the number the staged rows were spread over by movement key, if one was given."""
    new = require_unique(staged, ["movement_key"]).selectExpr("movement_key", "struct(*) AS new")
    spread = spread_by(live, "movement_key", tasks) if tasks else live
    old = spread.selectExpr("movement_key", "struct(*) AS old")
    return new.join(old, "movement_key", "full_outer")


def classify(live: DataFrame, staged: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every key of either side with its action and whether its open version closes."""
    return _judged(pair_up(live, staged, tasks))


def compare(live: DataFrame, valid: DataFrame, spec: TableSpec,
            tasks: int | None = None) -> DataFrame:
    """What ``classify`` gives for the staged rows of a cut, from its valid rows."""
    if spec.natural:
        return classify(live, assign_keys(valid, spec, tasks, by_key=True), tasks)
    key, known = hashing.key_hash(spec.key_names), F.col("business_key_hash")
    crowded = find_crowded(tasks, valid.select(key), live.select(known))
    (rows, many), (held, many_held) = crowded.parts(valid, key), crowded.parts(live, known)
    pairs = _paired_together(held, rows, spec, tasks)
    if many is not None:
        staged = assign_keys(many, spec, tasks, by_key=True)
        pairs = pairs.unionByName(pair_up(many_held, staged, tasks))
    return _judged(pairs)


# Lineage of a staged row, and the version's column it goes to.
_ORIGIN = {"_source_file": "source_file", "_cut_label": "cut_label", "_load_ts": "load_ts"}
_HASHES = ("attr_hash", "prev_attr_hash")


def _paired_together(live: DataFrame, valid: DataFrame, spec: TableSpec,
                     tasks: int | None) -> DataFrame:
    """(movement_key, new, old) by one shuffle of both sides on the business key. Where a side
    has no row, its struct holds NULLs.

    The two sides share columns. Hashes travel as bytes; those of keys, and what follows from a
    cut's row, are computed behind the shuffle.
    """
    key, shared = hashing.key_hash(spec.key_names), [*spec.key_names, *spec.attribute_names,
                                                     *spec.signal_names]
    own = [c for c in spec.version_schema.fieldNames() if c not in (
        *shared, *_ORIGIN.values(), "movement_key", "business_key_hash", "occurrence_seq")]
    rows = valid.select(*shared, *_ORIGIN, "_cut_date", "_row_num",
                        F.unhex(key).alias("_identity"), F.lit(False).alias("_held"))
    held = live.select(
        *shared, *[F.col(c).alias(name) for name, c in _ORIGIN.items()], "occurrence_seq",
        F.unhex("business_key_hash").alias("_identity"), F.lit(True).alias("_held"),
        *[(F.unhex(c) if c in _HASHES else F.col(c)).alias(f"_was_{c}") for c in own])
    both = spread_by(rows.unionByName(held, allowMissingColumns=True), "_identity", tasks)
    within = Window.partitionBy("_identity", "_held").orderBy(*occurrence_order(spec))
    both = both.withColumn("occurrence_seq", F.when(F.col("_held"), F.col("occurrence_seq"))
                           .otherwise(F.row_number().over(within).cast("bigint")))

    meet = Window.partitionBy("_identity", "occurrence_seq").orderBy("_held")
    sides = [*shared, *_ORIGIN, "occurrence_seq", *[f"_was_{c}" for c in own]]
    met = both.select("*", F.lag("_held").over(meet).alias("_met"), *[
        F.lead(c).over(meet).alias(f"_next_{c}") for c in sides])
    met = met.filter(~F.col("_held") | F.col("_met").isNull())  # a version is with its row
    business_key = F.lower(F.hex("_identity"))
    met = met.select("*", business_key.alias("business_key_hash"), hashing.occurrence_hash(
        business_key, F.col("occurrence_seq")).alias("movement_key"), *derived(spec))

    def new(c: str) -> Column:
        return F.when(~F.col("_held"), F.col(c)).alias(c)

    def old(c: str) -> Column:
        if c in ("movement_key", "business_key_hash"):
            known = F.col("_held") | F.col("_next_occurrence_seq").isNotNull()
            return F.when(known, F.col(c)).alias(c)
        at = f"_was_{c}" if c in own else {v: k for k, v in _ORIGIN.items()}.get(c, c)
        value = F.when(F.col("_held"), F.col(at)).otherwise(F.col(f"_next_{at}"))
        return (F.lower(F.hex(value)) if c in _HASHES else value).alias(c)

    return met.select(
        "movement_key", F.struct(*[new(c) for c in spec.staged_schema.fieldNames()]).alias("new"),
        F.struct(*[old(c) for c in spec.version_schema.fieldNames()]).alias("old"))


def _judged(pairs: DataFrame) -> DataFrame:
    # the second INSERT is a deleted key coming back
    return pairs.selectExpr("*", f"""CASE
        WHEN new.attr_hash IS NOT NULL AND old.attr_hash IS NULL THEN '{INSERT}'
        WHEN new.attr_hash IS NOT NULL AND old.is_deleted THEN '{INSERT}'
        WHEN new.attr_hash <> old.attr_hash THEN '{UPDATE}'
        WHEN new.attr_hash = old.attr_hash THEN '{UNCHANGED}'
        WHEN NOT old.is_deleted THEN '{DELETE}'
        ELSE '{NOOP}' END AS action""").selectExpr("*", f"""
        old.attr_hash IS NOT NULL AND action IN ('{INSERT}', '{UPDATE}', '{DELETE}')
        AS closes""")


def version_columns(spec: TableSpec, values: Mapping[str, str]) -> list[str]:
    """Select list of a version row: each column's SQL under its declared name and type."""
    return [f"CAST({values[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in spec.version_schema]


def versions(classified: DataFrame, spec: TableSpec, cut: Cut) -> DataFrame:
    """Version rows after the cut: untouched, closed and opened ones.

    A key yields its open version, kept or closed, and the version it opens, which holds
    the cut's row or, for a deletion, buries the last known one. ``part`` says where each
    row belongs (live, tombstone, closed) and ``opened`` marks those this cut opened.
    """
    slots = f"""CASE
        WHEN action IN ('{UNCHANGED}', '{NOOP}') THEN array('kept')
        WHEN action = '{DELETE}' THEN array('closed', 'buried')
        WHEN closes THEN array('closed', 'opened')
        ELSE array('opened') END"""
    day = f"DATE'{cut.cut_date.isoformat()}'"

    def by_slot(opened: str, buried: str, otherwise: str) -> str:
        return (f"CASE slot WHEN 'opened' THEN {opened} WHEN 'buried' THEN {buried} "
                f"ELSE {otherwise} END")

    rows = {c: by_slot(f"new.{c}", f"old.{c}", f"old.{c}") for c in spec.row_columns}
    return (classified.selectExpr("new", "old", "action", f"explode({slots}) AS slot")
            .selectExpr(*version_columns(spec, {
                **rows,
                "change_type": by_slot("action", "action", "old.change_type"),
                "is_current": "slot <> 'closed'",
                "is_deleted": by_slot("false", "true", "old.is_deleted"),
                "valid_from": by_slot(day, day, "old.valid_from"),
                "valid_to": f"CASE WHEN slot = 'closed' THEN {day} END",
                "source_file": by_slot("new._source_file", "old.source_file", "old.source_file"),
                "cut_label": by_slot("new._cut_label", sql_text(cut.label), "old.cut_label"),
                "load_ts": by_slot("new._load_ts", "current_timestamp()", "old.load_ts"),
                "prev_attr_hash": by_slot("old.attr_hash", "old.attr_hash", "old.prev_attr_hash"),
            }), "slot IN ('opened', 'buried') AS opened")
            .withColumn("part", part_of()))


def sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def part_of() -> Column:
    return F.expr(f"CASE WHEN NOT is_current THEN '{CLOSED}' "
                  f"WHEN is_deleted THEN '{TOMBSTONE}' ELSE '{LIVE}' END")


def merge(live: DataFrame, staged: DataFrame, spec: TableSpec, cut: Cut) -> DataFrame:
    return versions(classify(live, staged), spec, cut)


def open_versions(merged: DataFrame, spec: TableSpec) -> DataFrame:
    """The open versions to merge the next cut with."""
    return merged.filter("is_current").selectExpr(*spec.version_schema.fieldNames())


def no_versions(staged: DataFrame, spec: TableSpec) -> DataFrame:
    """The state before the first cut."""
    return staged.sparkSession.createDataFrame([], spec.version_schema)


def events(opened: DataFrame) -> DataFrame:
    """Change-log rows of newly opened versions.

    Each event opens exactly one version, so the log is a projection of the history.
    A deletion has no new hash; a key that came back keeps the hash it was deleted with.
    """
    return opened.select(
        "cut_label", F.col("valid_from").alias("cut_date"), "movement_key", "change_type",
        "prev_attr_hash",
        F.when(F.col("change_type") != DELETE, F.col("attr_hash")).alias("new_attr_hash"))


def action_counts() -> list[Column]:
    """Aggregates over a classified cut; a key that came back counts as new."""
    names = {"rows_new": INSERT, "rows_changed": UPDATE, "rows_deleted": DELETE,
             "rows_unchanged": UNCHANGED}
    return [F.count_if(F.col("action") == a).alias(n) for n, a in names.items()]

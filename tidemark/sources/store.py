"""The published tables, as parquet folders that become visible commit by commit.

``raw/_cut_date=/_cut_label=``        landed cuts, each slice replaceable
``versions/commit=/part=/until=``     per commit: open versions (live, tombstone) in full,
                                      and the versions it closed, by the month they ended
``change_log/commit=``, ``quarantine/commit=``
``marts/commit=/<name>``              the marts' states, shown once the gate is passed
``failures/<run>``                    one small record per run that failed
``ledger/<commit>``                   one small record per cut, written last

A commit's record lists the commits it stands on (``lineage``). Readers start from the
newest record and see only what it lists, so work that crashed before its record, or was
replaced later, is never read. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import (
    CHANGE_LOG_SCHEMA, CLOSED, FAILURE_SCHEMA, LEDGER_SCHEMA, LIVE, TOMBSTONE, Cut, Mart,
    TableSpec,
)
from tidemark.operators.history import as_of, with_version_id
from tidemark.operators.marts import finish_flow, summary_of, top_of
from tidemark.session import unsorted_folders


USABLE = "_usable"
# Fixed value: the folder of the counters beside the marts.
COUNTERS = "estado"
# Where open versions lie; sorts behind every month.
OPEN_END = "open"
# Hashes in hex shrink to half under zstd, not at all under the default.
PACKED = {"compression": "zstd"}


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


@dataclass(frozen=True)
class Head:
    """A published state: its commit number and the commits readable from it."""

    commit: int = 0
    lineage: tuple[int, ...] = ()


class Store:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec) -> None:
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec

    def path(self, *parts: Any) -> str:
        return "/".join([self.root, *map(str, parts)])

    def _read(self, table: str, schema: T.StructType, partitions: str) -> DataFrame:
        """A table under its declared schema; no rows when nothing was written yet.
        Partition values are typed by the schema, not guessed from the folder names."""
        full = T.StructType([*schema.fields, *T.StructType.fromDDL(partitions).fields])
        if not self._exists(table):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(self.path(table))

    def _folder(self, *parts: Any):
        """(file system, path) of a folder of the store, on whatever storage it lies."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(*parts))
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def _exists(self, *parts: Any) -> bool:
        files, path = self._folder(*parts)
        return files.exists(path)

    # -- raw -------------------------------------------------------------------------
    def write_raw(self, landed: DataFrame) -> None:
        """Replaces the (date, label) slices present in ``landed``, keeps all others."""
        with unsorted_folders(self.spark):
            (landed.write.partitionBy("_cut_date", "_cut_label").options(**PACKED)
             .option("partitionOverwriteMode", "dynamic").mode("overwrite")
             .parquet(self.path("raw")))

    def landed(self, cut: Cut | None = None) -> DataFrame:
        """Landed rows with the mark that landing put on those with a usable identity."""
        keys = ("_cut_date", "_cut_label")
        body = T.StructType([f for f in self.spec.raw_schema if f.name not in keys])
        body = body.add(USABLE, T.BooleanType())
        df = self._read("raw", body, "_cut_date date, _cut_label string")
        return df if cut is None else cut_slice(df, cut)

    def raw(self, cut: Cut | None = None) -> DataFrame:
        return self.landed(cut).select(*self.spec.raw_schema.fieldNames())

    # -- ledger ----------------------------------------------------------------------
    def records(self) -> DataFrame:
        """Run records of all commits, also of those that were replaced."""
        if not self._exists("ledger"):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return (self.spark.read.schema(LEDGER_SCHEMA)
                .option("recursiveFileLookup", "true").json(self.path("ledger")))

    def head(self) -> Head:
        row = (self.records().select("commit", "lineage")
               .orderBy(F.desc("commit")).limit(1).collect())
        return Head(row[0]["commit"], tuple(row[0]["lineage"])) if row else Head()

    def ledger(self, head: Head | None = None) -> DataFrame:
        """Run records of the visible commits."""
        return self._visible(self.records(), head)

    def write_failure(self, record: dict[str, Any]) -> None:
        row = tuple(record.get(f) for f in FAILURE_SCHEMA.fieldNames())
        (self.spark.createDataFrame([row], FAILURE_SCHEMA).coalesce(1)
         .write.json(self.path("failures", record["run_id"])))

    def failures(self) -> DataFrame:
        """Runs that were refused or broke off; they published nothing."""
        if not self._exists("failures"):
            return self.spark.createDataFrame([], FAILURE_SCHEMA)
        return (self.spark.read.schema(FAILURE_SCHEMA)
                .option("recursiveFileLookup", "true").json(self.path("failures")))

    def publish(self, records: Iterable[dict[str, Any]]) -> None:
        """Makes a commit visible: its records are written aside as one file, which is then
        renamed into the ledger. A crash before the rename leaves nothing in the way."""
        rows = [tuple(r.get(f) for f in LEDGER_SCHEMA.fieldNames()) for r in records]
        commit, attempt = rows[0][0], uuid.uuid4().hex
        (self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1)
         .write.json(self.path("attempts", attempt)))
        files, aside = self._folder("attempts", attempt)
        written = next(f.getPath() for f in files.listStatus(aside)
                       if f.getPath().getName().startswith("part-"))
        ledger = self._folder("ledger")[1]
        files.mkdirs(ledger)
        record = self._folder("ledger", f"{commit:08d}.json")[1]
        if files.exists(record) or not files.rename(written, record):
            raise FileExistsError(f"commit {commit} is already published")
        files.delete(aside, True)

    def _visible(self, df: DataFrame, head: Head | None) -> DataFrame:
        lineage = (head or self.head()).lineage
        return df.filter(F.col("commit").isin(*lineage) if lineage else F.lit(False))

    # -- versions --------------------------------------------------------------------
    def write_versions(self, versions: DataFrame, commit: int) -> None:
        until = F.coalesce(month_of(F.col("valid_to")), F.lit(OPEN_END))
        rows = versions.select(*self.spec.version_schema.fieldNames(), "part",
                               until.alias("until"))
        (rows.write.partitionBy("part", "until").options(**PACKED).mode("overwrite")
         .parquet(self.path("versions", f"commit={commit}")))

    def versions(self) -> DataFrame:
        """Every version row on disk, visible or not, with its commit, part and month."""
        return self._read("versions", self.spec.version_schema,
                          "commit bigint, part string, until string")

    def _version_rows(self, df: DataFrame) -> DataFrame:
        return df.select(*self.spec.version_schema.fieldNames())

    def open_versions(self, head: Head | None = None) -> DataFrame:
        """Live rows and standing tombstones; reads the newest commit only."""
        head = head or self.head()
        return self._version_rows(self.versions().filter(
            (F.col("commit") == head.commit) & F.col("part").isin(LIVE, TOMBSTONE)))

    def open_at_most(self, head: Head | None = None) -> int:
        """A bound on the open versions, from the run records: every key came as new once."""
        found = self.ledger(head).agg(F.sum("rows_new").alias("n")).first()
        return found["n"] or 0

    def live(self, head: Head | None = None) -> DataFrame:
        head = head or self.head()
        return with_version_id(self._version_rows(self.versions().filter(
            (F.col("commit") == head.commit) & (F.col("part") == LIVE))))

    def history(self, head: Head | None = None) -> DataFrame:
        """All versions: those closed by any visible commit and the open ones."""
        head = head or self.head()
        closed = self._visible(self.versions().filter(F.col("part") == CLOSED), head)
        return with_version_id(
            self._version_rows(closed).unionByName(self.open_versions(head)))

    def as_of(self, day: date, head: Head | None = None) -> DataFrame:
        """Live state on a date; reads what ``history_between`` reads."""
        return as_of(self.history_between(day, day, head), day)

    def history_between(self, first: date, last: date, head: Head | None = None) -> DataFrame:
        """The versions that held on any day from ``first`` to ``last``, tombstones included.

        Closed versions lie by the month they ended, so only folders of the month of
        ``first`` and of later ones are opened, whether one commit brought them or many.
        """
        head = head or self.head()
        closed = self._visible(self.versions().filter(
            (F.col("part") == CLOSED) & (F.col("until") >= f"{first:%Y-%m}")), head)
        held = ((F.col("valid_from") <= F.lit(last))
                & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(first))))
        rows = self._version_rows(closed).unionByName(self.open_versions(head))
        return with_version_id(rows.filter(held))

    def table_sizes(self, head: Head | None = None) -> DataFrame:
        """(table, rows) of every table; a store nothing was written to has them all, empty."""
        head = head or self.head()
        tables = {"raw": self.raw(), "history": self.history(head),
                  "open_versions": self.open_versions(head), "change_log": self.change_log(head),
                  "quarantine": self.quarantine(head), "ledger": self.ledger(head),
                  "failures": self.failures()}
        return reduce(DataFrame.unionByName, [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
            for name, df in tables.items()])

    def opened_by(self, commit: int, cut: Cut | None = None) -> DataFrame:
        """Versions a commit wrote and, given its cut, opened."""
        df = self.versions().filter(F.col("commit") == commit)
        if cut is not None:
            df = df.filter(F.col("valid_from") == F.lit(cut.cut_date))
        return self._version_rows(df)

    # -- change log and quarantine ---------------------------------------------------
    def write_change_log(self, events: DataFrame, commit: int) -> None:
        (events.select(*CHANGE_LOG_SCHEMA.fieldNames()).write.options(**PACKED)
         .mode("overwrite").parquet(self.path("change_log", f"commit={commit}")))

    def change_log(self, head: Head | None = None) -> DataFrame:
        df = self._read("change_log", CHANGE_LOG_SCHEMA, "commit bigint")
        return self._visible(df, head).select(*CHANGE_LOG_SCHEMA.fieldNames())

    def drop_quarantine(self, commit: int) -> None:
        """Removes what an earlier attempt at the commit may have left."""
        files, folder = self._folder("quarantine", f"commit={commit}")
        files.delete(folder, True)

    def write_quarantine(self, rows: DataFrame, commit: int) -> None:
        rows.write.mode("overwrite").parquet(self.path("quarantine", f"commit={commit}"))

    def quarantine(self, head: Head | None = None) -> DataFrame:
        schema = self.spec.quarantine_schema
        df = self._read("quarantine", schema, "commit bigint")
        return self._visible(df, head).select(*schema.fieldNames())

    # -- marts -----------------------------------------------------------------------
    def write_mart(self, mart: Mart, state: DataFrame, commit: int) -> None:
        state.write.mode("overwrite").parquet(self.path("marts", f"commit={commit}", mart.name))

    def mart_state(self, mart: Mart, commit: int) -> DataFrame | None:
        at = ("marts", f"commit={commit}", mart.name)
        return self.spark.read.parquet(self.path(*at)) if self._exists(*at) else None

    def write_counters(self, counted: DataFrame, commit: int) -> None:
        counted.write.mode("overwrite").parquet(
            self.path("marts", f"commit={commit}", COUNTERS))

    def counters(self, commit: int) -> DataFrame | None:
        at = ("marts", f"commit={commit}", COUNTERS)
        return self.spark.read.parquet(self.path(*at)) if self._exists(*at) else None

    def _actors(self, head: Head | None) -> tuple[DataFrame, DataFrame]:
        """Counters and actors' state as of the last commit that passed the gate."""
        commit = self.checked_commit((head or self.head()).lineage)
        counted = None if commit is None else self.counters(commit)
        actors = None if counted is None else self.mart_state(self.spec.actors, commit)
        if actors is None:
            raise LookupError("the state summary was not built yet")
        return counted, actors

    def state_summary(self, head: Head | None = None) -> DataFrame:
        """Live rows, tombstones, versions and active clients, without reading any of them."""
        return summary_of(*self._actors(head), self.spec.actors.by)

    def top_actors(self, n: int = 10, head: Head | None = None) -> DataFrame:
        """The actors with the largest total over their live rows."""
        return top_of(self._actors(head)[1], self.spec.actors, n)

    def mark_checked(self, commit: int) -> None:
        """Shows a commit's marts to readers."""
        files, mark = self._folder("marts", f"commit={commit}", "checked")
        files.mkdirs(mark)

    def checked_commit(self, commits: Sequence[int]) -> int | None:
        """The last of the commits whose marts passed the gate."""
        return next((c for c in reversed(commits)
                     if self._exists("marts", f"commit={c}", "checked")), None)

    def mart(self, name: str, head: Head | None = None) -> DataFrame:
        """A mart as of the last commit whose marts passed the gate."""
        mart = next(m for m in self.spec.marts if m.name == name)
        commit = self.checked_commit((head or self.head()).lineage)
        state = None if commit is None else self.mart_state(mart, commit)
        if state is None:
            raise LookupError(f"{name} was not built yet")
        return finish_flow(state, mart)

    def changes_since(self, base: int, head: Head) -> DataFrame:
        """Rows that entered (``_sign`` 1) or left (-1) the live state after a commit of the
        head's lineage. What came and went in between is in with both signs."""
        return self.versions_since(base, head).filter(~F.col("is_deleted"))

    def versions_since(self, base: int, head: Head) -> DataFrame:
        """Versions opened (``_sign`` 1) and closed (-1) after a commit of the head's lineage;
        one that was opened and closed since is in twice."""
        newest = self.ledger(head).filter(F.col("commit") == base).agg(
            F.max("cut_date")).first()[0]
        later = head.lineage[head.lineage.index(base) + 1:]
        closed = self._version_rows(self.versions().filter(
            F.col("commit").isin(*later) & (F.col("part") == CLOSED)))
        since = F.col("valid_from") > F.lit(newest)
        opened = self.open_versions(head).filter(since).unionByName(closed.filter(since))
        return (opened.withColumn("_sign", F.lit(1))
                .unionByName(closed.withColumn("_sign", F.lit(-1))))

    # -- housekeeping ----------------------------------------------------------------
    def drop_old_open_versions(self, keep: int = 2) -> list[int]:
        """Deletes the open-version folders that newer commits made redundant.

        Closed versions, logs and records stay; the history is unchanged. The newest two
        are always kept, as replacing the newest date starts from the one before it.
        """
        if keep < 2:
            raise ValueError("at least two commits keep their open versions")
        head = self.head()
        old = list(head.lineage[:-keep])
        for commit in old:
            for part in (LIVE, TOMBSTONE):
                files, folder = self._folder("versions", f"commit={commit}", f"part={part}")
                files.delete(folder, True)
        return old


def cut_slice(landed: DataFrame, cut: Cut) -> DataFrame:
    """One cut out of the landed rows; prunes folders when read from the store."""
    return landed.filter((F.col("_cut_label") == cut.label)
                         & (F.col("_cut_date") == F.lit(cut.cut_date)))

"""Declarative assertions. Each one names violating rows; none at all passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import DELETE, INSERT, MOVEMENTS, UPDATE, TableSpec


class QualityGateError(RuntimeError):
    """Raised when a suite has violations."""


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str

    @property
    def name(self) -> str:
        return f"not_null_{self.table}_{self.column}"


@dataclass(frozen=True)
class Accepted:
    """Violated once per value outside the list; NULL is not a value."""

    table: str
    column: str
    values: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"accepted_values_{self.table}_{self.column}"


@dataclass(frozen=True)
class Unique:
    """Violated once per repeated value; NULLs do not repeat."""

    table: str
    column: str

    @property
    def name(self) -> str:
        return f"unique_{self.table}_{self.column}"


@dataclass(frozen=True)
class OneOpenVersion:
    """A key has at most one open version."""

    table: str

    @property
    def name(self) -> str:
        return f"one_open_version_{self.table}"


@dataclass(frozen=True)
class OneVersionPerCut:
    """A key opens at most one version per date."""

    table: str

    @property
    def name(self) -> str:
        return f"one_version_per_cut_{self.table}"


@dataclass(frozen=True)
class CoherentValidity:
    """Open versions have no end date, closed ones do."""

    table: str

    @property
    def name(self) -> str:
        return f"coherent_validity_{self.table}"


@dataclass(frozen=True)
class Fresh:
    """The newest date is at most ``days`` behind ``expected``."""

    table: str
    column: str
    expected: date
    days: int = 0

    @property
    def name(self) -> str:
        return f"fresh_{self.table}_{self.column}"


Assertion = (NotNull | Accepted | Unique | OneOpenVersion | OneVersionPerCut
             | CoherentValidity | Fresh)


# -- violating rows --------------------------------------------------------------------
def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unexpected_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return (df.filter(~F.col(column).isin(*values))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n")))


def repeated_values(df: DataFrame, *columns: str) -> DataFrame:
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1"))


def several_open(history: DataFrame) -> DataFrame:
    return (history.filter("is_current").groupBy("movement_key")
            .agg(F.count(F.lit(1)).alias("versiones_vigentes"))
            .filter("versiones_vigentes > 1"))


def several_per_cut(history: DataFrame) -> DataFrame:
    return (history.groupBy("movement_key", "valid_from")
            .agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))


def validity_problem() -> Column:
    """The two labels."""
    return (F.when(F.col("is_current") & F.col("valid_to").isNotNull(), "vigente_con_valid_to")
            .when(~F.col("is_current") & F.col("valid_to").isNull(), "cerrada_sin_valid_to"))


def incoherent_validity(history: DataFrame) -> DataFrame:
    return (history.withColumn("problema", validity_problem())
            .filter(F.col("problema").isNotNull())
            .select("problema", "movement_key", "valid_from"))


# -- suites ----------------------------------------------------------------------------
def _row_check(a: Assertion) -> Column | None:
    """Assertions that one scan of the table can settle together."""
    if isinstance(a, NotNull):
        return F.count_if(F.col(a.column).isNull())
    if isinstance(a, Accepted):
        return F.count_distinct(F.when(~F.col(a.column).isin(*a.values), F.col(a.column)))
    if isinstance(a, CoherentValidity):
        return F.count_if(validity_problem().isNotNull())
    if isinstance(a, Fresh):
        newest = F.max(a.column)
        late = newest.isNull() | (F.date_diff(F.lit(a.expected), newest) > a.days)
        return F.when(late, 1).otherwise(0).cast("bigint")
    return None


# Assertions that one keyed aggregate of the table can settle together.
_KEYED = (OneOpenVersion, OneVersionPerCut)


def keyed_violations(history: DataFrame) -> DataFrame:
    """One row: keys with several open versions, (key, date) pairs with several versions. Rows
    are spread by key once; counting per key and date and then per key needs no more."""
    per_date = (history.select("movement_key", "valid_from", "is_current")
                .repartition("movement_key").groupBy("movement_key", "valid_from")
                .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_current").alias("n_open")))
    per_key = per_date.groupBy("movement_key").agg(
        F.sum("n_open").alias("n_open"), F.count_if(F.col("n") > 1).alias("repeated"))
    return per_key.agg(F.count_if(F.col("n_open") > 1).alias("several_open"),
                       F.coalesce(F.sum("repeated"), F.lit(0)).alias("several_per_cut"))


def _named(counted: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """(assertion, violations) rows of one row of counts, by assertion name and column."""
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("assertion"), F.col(c).alias("violations"))
        for name, c in columns.items()])))


def run_suite(tables: Mapping[str, DataFrame], suite: Sequence[Assertion]) -> DataFrame:
    """(assertion, violations), one row per assertion."""
    parts = []
    for table, df in tables.items():
        mine = [a for a in suite if a.table == table]
        together = [(a, check) for a in mine if (check := _row_check(a)) is not None]
        if together:
            counted = df.agg(*[c.alias(f"c{i}") for i, (_, c) in enumerate(together)])
            parts.append(_named(counted, {a.name: f"c{i}" for i, (a, _) in enumerate(together)}))
        keyed = {a.name: "several_open" if isinstance(a, OneOpenVersion) else "several_per_cut"
                 for a in mine if isinstance(a, _KEYED)}
        if keyed:
            parts.append(_named(keyed_violations(df), keyed))
        parts += [repeated_values(df, a.column)
                  .agg(F.count(F.lit(1)).alias("violations"))
                  .select(F.lit(a.name).alias("assertion"), "violations")
                  for a in mine if isinstance(a, Unique)]
    missing = {a.table for a in suite} - set(tables)
    if missing:
        raise ValueError(f"no table given for: {sorted(missing)}")
    return reduce(DataFrame.unionByName, parts)


def gate(results: DataFrame) -> None:
    """Stop on the first suite with violations. Reads one row per assertion."""
    failed = results.filter("violations > 0").collect()
    if failed:
        raise QualityGateError(", ".join(
            f"{r['assertion']}: {r['violations']}" for r in sorted(failed)))


_CHANGES = (INSERT, UPDATE, DELETE)


def suite(spec: TableSpec) -> tuple[Assertion, ...]:
    """The assertions over a table's history, change log, live state and marts: what the
    declarations promise holds in what is published."""
    keys = spec.key_names
    mapped = [(k.name, tuple(dict.fromkeys(v for _, v in k.mapping)))
              for k in spec.key if k.kind == "mapped"]
    return (
        *[NotNull("history", c) for c in (
            "movement_key", "business_key_hash", *keys, "change_type", "is_current",
            "is_deleted", "valid_from")],
        *[Accepted("history", name, values) for name, values in mapped],
        Accepted("history", "change_type", _CHANGES),
        NotNull("change_log", "movement_key"),
        NotNull("change_log", "change_type"),
        Accepted("change_log", "change_type", _CHANGES),
        Unique("live", "movement_key"),
        NotNull("live", "movement_key"),
        *[Accepted("live", name, values) for name, values in mapped],
        *[Unique(m.name, m.by) for m in spec.marts],
        *[NotNull(m.name, m.by) for m in spec.marts if m.by in keys],
        OneOpenVersion("history"),
        OneVersionPerCut("history"),
        CoherentValidity("history"),
    )


MOVEMENTS_SUITE = suite(MOVEMENTS)

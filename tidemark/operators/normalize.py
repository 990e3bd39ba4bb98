"""Clean and type the rows of a cut; split off those without a usable identity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, text
from tidemark.model import LINEAGE_COLUMNS, KeyColumn, TableSpec


def _key_value(k: KeyColumn) -> Column:
    c = F.col(k.source)
    if k.kind == "text":
        return text.canonical(c)
    if k.kind == "date":
        return dates.parsed_date(c, k.formats)
    if k.kind == "mapped":
        return text.mapped(c, k.mapping)
    return c


def _signal(k: KeyColumn) -> Column:
    c = F.col(k.source)
    return dates.reformatted(c) if k.kind == "date" else text.recoded(c, k.mapping)


def key_columns(spec: TableSpec) -> list[Column]:
    return [_key_value(k).alias(k.name) for k in spec.key]


def normalized_columns(spec: TableSpec) -> list[Column]:
    """Key, attribute and signal columns of one row, from the source columns."""
    return [
        *key_columns(spec),
        *[(text.optional(F.col(a.name)) if a.kind == "text" else F.col(a.name)).alias(a.name)
          for a in spec.attributes],
        *[_signal(k).alias(k.flag) for k in spec.key if k.flag],
    ]


def normalize(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Normalised columns plus the lineage of the landed row; one narrow projection."""
    lineage = [F.col(c) for c in LINEAGE_COLUMNS if c in raw.columns]
    return raw.select(*normalized_columns(spec), *lineage)


def _present(k: KeyColumn, spec: TableSpec) -> Column:
    c = F.col(k.name)
    is_text = isinstance(spec.version_schema[k.name].dataType, T.StringType)
    return text.has_text(c) if is_text else c.isNotNull()


def usable(spec: TableSpec) -> Column:
    """True where every identity column is present. Never NULL, so it splits cleanly."""
    return reduce(lambda a, b: a & b, [_present(k, spec) for k in spec.key])


def split(normalized: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(valid rows, unusable rows)."""
    ok = usable(spec)
    return normalized.filter(ok), normalized.filter(~ok)


def quarantine(normalized: DataFrame, spec: TableSpec) -> DataFrame:
    """Unusable rows under their source column names, with every reason spelled out."""
    return with_reasons(split(normalized, spec)[1], spec)


def with_reasons(bad: DataFrame, spec: TableSpec) -> DataFrame:
    """Quarantine rows for normalised rows already known to be unusable."""
    by_source = {k.source: k for k in spec.key}
    shown = []
    for f in spec.source.fields:
        k = by_source.get(f.name)
        c = F.col(k.name if k else f.name)
        shown.append((c.cast("string") if k and k.kind == "date" else c).alias(f.name))
    reasons = F.concat_ws(
        "; ", *[F.when(~_present(k, spec), F.lit(k.reason or f"{k.name} missing"))
                for k in spec.key])
    lineage = [c for c in LINEAGE_COLUMNS if c != "_row_num" and c in bad.columns]
    return bad.select(*shown, reasons.alias("_reasons"), *lineage)

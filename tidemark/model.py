"""What a snapshot table looks like: its key, its mutable columns, its schemas.

Every operator reads these declarations; none hard-codes a column list.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import types as T

# Separator, NULL marker and occurrence mark inside the hashes.
HASH_SEPARATOR = "||"
NULL_MARK = "<NULL>"
OCCURRENCE_MARK = "#"

# The change types of a version.
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
UNCHANGED, NOOP = "UNCHANGED", "NOOP"

# Where a version row lives: visible, deleted but still the last word, or superseded.
LIVE, TOMBSTONE, CLOSED = "live", "tombstone", "closed"


@dataclass(frozen=True)
class Cut:
    """One complete snapshot: a label, where its parquet lies, its as-of date."""

    label: str
    path: str
    cut_date: date

    def __post_init__(self) -> None:
        if not self.label or not self.path or self.cut_date is None:
            raise ValueError("a cut needs a label, a path and a date")
        if isinstance(self.cut_date, str):
            object.__setattr__(self, "cut_date", date.fromisoformat(self.cut_date))


@dataclass(frozen=True)
class KeyColumn:
    """One part of a row's identity.

    ``kind`` is ``text`` (trimmed, upper-cased), ``date`` (text parsed as ISO or one
    of ``formats``), ``mapped`` (canonical value looked up in ``mapping``) or ``asis``.
    ``reason`` is what quarantine reports when the part is unusable; ``flag`` names
    the quality flag for a reformatted date or a recoded value.
    """

    source: str
    name: str
    kind: str = "text"
    reason: str = ""
    formats: tuple[str, ...] = ()
    mapping: tuple[tuple[str, str], ...] = ()
    flag: str | None = None


@dataclass(frozen=True)
class Attribute:
    """A mutable column: ``text`` (trimmed, upper-cased, '' as NULL) or ``asis``."""

    name: str
    kind: str = "asis"


@dataclass(frozen=True)
class Derived:
    """A column computed from the normalised row by a SQL expression."""

    name: str
    sql: str
    dtype: T.DataType


@dataclass(frozen=True)
class Total:
    """A sum over a mart's rows, of a SQL expression."""

    name: str
    sql: str


@dataclass(frozen=True)
class Mart:
    """Live rows counted and summed per value of a column, largest first total first."""

    name: str
    by: str
    totals: tuple[Total, ...]


@dataclass(frozen=True)
class TableSpec:
    """A snapshot table. ``natural`` means the key is already unique inside a cut."""

    name: str
    source: T.StructType
    key: tuple[KeyColumn, ...]
    attributes: tuple[Attribute, ...]
    measures: tuple[Derived, ...] = field(default=())
    flags: tuple[Derived, ...] = field(default=())
    natural: bool = False
    marts: tuple[Mart, ...] = field(default=())
    # whose live rows are counted and summed per value, kept as a state only
    actors: Mart | None = None

    # -- column lists ------------------------------------------------------------
    @property
    def source_columns(self) -> list[str]:
        return self.source.fieldNames()

    @property
    def key_names(self) -> list[str]:
        return [k.name for k in self.key]

    @property
    def attribute_names(self) -> list[str]:
        return [a.name for a in self.attributes]

    @property
    def signal_names(self) -> list[str]:
        return [k.flag for k in self.key if k.flag]

    @property
    def flag_names(self) -> list[str]:
        return [f.name for f in self.flags] + self.signal_names

    # -- schemas -----------------------------------------------------------------
    def _source_type(self, name: str) -> T.DataType:
        return self.source[name].dataType

    def _key_field(self, k: KeyColumn) -> T.StructField:
        kinds = {"text": T.StringType(), "mapped": T.StringType(), "date": T.DateType()}
        return T.StructField(k.name, kinds.get(k.kind) or self._source_type(k.source))

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([*self.source.fields, *_LINEAGE])

    @property
    def _row_fields(self) -> list[T.StructField]:
        return [
            T.StructField("movement_key", T.StringType()),
            T.StructField("business_key_hash", T.StringType()),
            T.StructField("occurrence_seq", T.LongType()),
            *[self._key_field(k) for k in self.key],
            *[T.StructField(a.name, self._source_type(a.name)) for a in self.attributes],
            *[T.StructField(m.name, m.dtype) for m in self.measures],
            T.StructField("attr_hash", T.StringType()),
            *[T.StructField(f.name, f.dtype) for f in self.flags],
            *[T.StructField(s, T.BooleanType()) for s in self.signal_names],
        ]

    @property
    def row_columns(self) -> list[str]:
        """Columns shared by staged rows and history versions."""
        return [f.name for f in self._row_fields]

    @property
    def staged_schema(self) -> T.StructType:
        lineage = [f for f in _LINEAGE if f.name != "_row_num"]
        return T.StructType([*self._row_fields, *lineage])

    @property
    def version_schema(self) -> T.StructType:
        return T.StructType([*self._row_fields, *_VERSION_TAIL])

    @property
    def quarantine_schema(self) -> T.StructType:
        shown = {k.source: self._key_field(k) for k in self.key}
        cols = []
        for f in self.source.fields:
            dtype = f.dataType
            if f.name in shown:
                dtype = shown[f.name].dataType
                dtype = T.StringType() if isinstance(dtype, T.DateType) else dtype
            cols.append(T.StructField(f.name, dtype))
        lineage = [f for f in _LINEAGE if f.name != "_row_num"]
        return T.StructType([*cols, T.StructField("_reasons", T.StringType()), *lineage])


_LINEAGE = [
    T.StructField("_source_file", T.StringType()),
    T.StructField("_cut_label", T.StringType()),
    T.StructField("_cut_date", T.DateType()),
    T.StructField("_row_num", T.LongType()),
    T.StructField("_load_ts", T.TimestampType()),
]
LINEAGE_COLUMNS = [f.name for f in _LINEAGE]

_VERSION_TAIL = [
    T.StructField("change_type", T.StringType()),
    T.StructField("is_current", T.BooleanType()),
    T.StructField("is_deleted", T.BooleanType()),
    T.StructField("valid_from", T.DateType()),
    T.StructField("valid_to", T.DateType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("cut_label", T.StringType()),
    T.StructField("load_ts", T.TimestampType()),
    # attr_hash of the version this one replaced; lets the change log be read off history
    T.StructField("prev_attr_hash", T.StringType()),
]

CHANGE_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("cut_label", T.StringType()),
    T.StructField("cut_date", T.DateType()),
    T.StructField("movement_key", T.StringType()),
    T.StructField("change_type", T.StringType()),
    T.StructField("prev_attr_hash", T.StringType()),
    T.StructField("new_attr_hash", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("commit", T.LongType()),
    T.StructField("lineage", T.ArrayType(T.LongType())),
    T.StructField("run_id", T.StringType()),
    T.StructField("cut_label", T.StringType()),
    T.StructField("cut_date", T.DateType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("source_rows", T.LongType()),
    T.StructField("rows_valid", T.LongType()),
    T.StructField("rows_quarantined", T.LongType()),
    T.StructField("rows_new", T.LongType()),
    T.StructField("rows_changed", T.LongType()),
    T.StructField("rows_deleted", T.LongType()),
    T.StructField("rows_unchanged", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    # the stream and its batch that brought the cut, if any
    T.StructField("stream", T.StringType()),
    T.StructField("batch", T.LongType()),
])

# The states of a run. A refused cut stays refused when it comes again.
SUCCESS, FAILED, REFUSED = "SUCCESS", "FAILED", "REFUSED"

FAILURE_SCHEMA = T.StructType([
    *[LEDGER_SCHEMA[c] for c in ("run_id", "cut_label", "cut_date", "source_file", "status")],
    T.StructField("error", T.StringType()),
    *[LEDGER_SCHEMA[c] for c in ("started_at", "finished_at", "stream", "batch")],
])

# The two directions, the marts and their columns.
INFLOW, OUTFLOW = "ENTRADA", "SALIDA"
_NET = Total("flujo_neto", "signed_amount")
FLOW_BY_PRODUCT = Mart("flujo_por_producto", "product", (
    _NET, Total("total_entradas", f"CASE WHEN type = '{INFLOW}' THEN amount END"),
    Total("total_salidas", f"CASE WHEN type = '{OUTFLOW}' THEN amount END")))
FLOW_BY_FUND = Mart("flujo_por_fondo", "fund", (_NET,))
CLIENTS = Mart("clientes", "id_cliente", (Total("volumen", "abs(amount)"),))

# The financial-movements table. Its identity columns describe the fact itself; its
# attributes are what a later correction may edit.
# Names, canonical directions, quarantine reasons, date format.
MOVEMENTS = TableSpec(
    name="movimientos",
    source=T.StructType([
        T.StructField("id_cliente", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("fund", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("commercial_name", T.StringType()),
    ]),
    key=(
        KeyColumn("id_cliente", "id_cliente", reason="id_cliente vacio"),
        KeyColumn("date", "mov_date", "date", "date no parseable",
                  formats=("d/M/yyyy",), flag="dq_date_reformatted"),
        KeyColumn("product", "product", reason="product vacio"),
        KeyColumn("type", "type", "mapped", "type no mapeable",
                  mapping=(("ENTRADA", "ENTRADA"), ("IN", "ENTRADA"),
                           ("SALIDA", "SALIDA"), ("OUT", "SALIDA")),
                  flag="dq_type_recoded"),
        KeyColumn("fund", "fund", reason="fund vacio"),
    ),
    attributes=(Attribute("amount"), Attribute("description", "text"),
                Attribute("commercial_name", "text")),
    # the type gives the direction, the magnitude is unsigned; + 0.0 turns -0.0 into 0.0
    measures=(Derived(
        "signed_amount",
        "CASE type WHEN 'ENTRADA' THEN abs(amount) WHEN 'SALIDA' THEN -abs(amount) + 0.0D END",
        T.DoubleType()),),
    flags=(
        Derived("dq_amount_null", "amount IS NULL", T.BooleanType()),
        Derived("dq_amount_zero", "amount = 0", T.BooleanType()),
        Derived("dq_amount_negative", "amount < 0", T.BooleanType()),
    ),
    marts=(FLOW_BY_PRODUCT, FLOW_BY_FUND),
    actors=CLIENTS,
)

"""The registered queries as plain SQL over the driver's tables.

Written cut by cut, as successive merges with an explicit state, where the Spark side
builds the history in one pass: the two agree only if both follow the same rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.model import MOVEMENTS
from tidemark.operators import quality
from tidemark.plans import demo

# The movements fixture.
_RAW = """
cuts(i, cut_label, cut_date) AS (VALUES (1, 'T', DATE '2024-11-01'),
  (2, 'T1', DATE '2024-11-02'), (3, 'T2', DATE '2024-11-03')),
src AS (SELECT event_id AS rn, CAST(CAST(ts AS DATE) AS VARCHAR) AS iso, user_id, event_type,
  value, CASE WHEN event_id % 997 = 0 THEN CAST(floor(event_id / 997) AS BIGINT) % 6 ELSE -1 END
  AS bad FROM events),
raw AS MATERIALIZED (SELECT
  CASE WHEN bad=0 THEN '  ' WHEN rn%9=0 THEN ' cli'||user_id||' ' ELSE 'CLI'||user_id END
    AS id_cliente,
  CASE WHEN bad IN (1,5) THEN 'no-es-fecha'
    WHEN rn%14=0 THEN substr(iso,9,2)||'/'||substr(iso,6,2)||'/'||substr(iso,1,4)
    ELSE iso END AS date,
  CASE WHEN bad=2 THEN '' WHEN rn%3=0 THEN upper(event_type)
    WHEN rn%7=0 THEN ' '||event_type||' ' ELSE event_type END AS product,
  CASE WHEN bad IN (3,5) THEN 'transfer' WHEN rn%2=0 THEN
    CASE rn%5 WHEN 0 THEN 'entrada' WHEN 1 THEN 'Entrada' WHEN 2 THEN 'ENTRADA'
      WHEN 3 THEN 'IN' ELSE 'in' END ELSE
    CASE rn%5 WHEN 0 THEN 'salida' WHEN 1 THEN 'Salida' WHEN 2 THEN 'SALIDA'
      WHEN 3 THEN 'OUT' ELSE 'out' END END AS type,
  CASE WHEN bad=4 THEN NULL ELSE 'f'||(rn%4) END AS fund,
  CASE WHEN rn%33=0 THEN NULL WHEN rn%53=0 THEN 0.0::DOUBLE WHEN rn%48=0 THEN -value
    WHEN i>=2 AND rn%13=0 THEN value+1 ELSE value END AS amount,
  CASE WHEN rn%11=0 THEN NULL WHEN rn%23=0 THEN '' ELSE 'Desc '||(rn%3) END AS description,
  CASE WHEN rn%6=0 THEN NULL ELSE 'bank '||(rn%4) END AS commercial_name,
  'events.parquet' AS _source_file, cut_label AS _cut_label, cut_date AS _cut_date,
  rn AS _row_num
  FROM src, cuts WHERE CASE i WHEN 1 THEN rn%5<>0 WHEN 2 THEN rn%4<>1 ELSE rn%6<>2 END)"""

_NORM = """
norm AS MATERIALIZED (SELECT upper(trim(id_cliente)) AS id_cliente,
  coalesce(try_cast(trim(date) AS DATE), CAST(try_strptime(trim(date), '%d/%m/%Y') AS DATE))
    AS mov_date,
  upper(trim(product)) AS product,
  CASE WHEN upper(trim(type)) IN ('ENTRADA','IN') THEN 'ENTRADA'
       WHEN upper(trim(type)) IN ('SALIDA','OUT') THEN 'SALIDA' END AS type,
  upper(trim(fund)) AS fund, amount,
  nullif(upper(trim(description)), '') AS description,
  nullif(upper(trim(commercial_name)), '') AS commercial_name,
  try_cast(trim(date) AS DATE) IS NULL AS dq_date_reformatted,
  upper(trim(type)) NOT IN ('ENTRADA','SALIDA') AS dq_type_recoded,
  _source_file, _cut_label, _cut_date, _row_num FROM raw),
judged AS (SELECT *, coalesce(id_cliente,'') <> '' AND mov_date IS NOT NULL
  AND coalesce(product,'') <> '' AND type IS NOT NULL AND coalesce(fund,'') <> '' AS usable
  FROM norm),
valid AS MATERIALIZED (SELECT *,
  md5(concat_ws('||', id_cliente, CAST(mov_date AS VARCHAR), product, type, fund))
    AS business_key_hash,
  md5(concat_ws('||', coalesce(CAST(amount AS VARCHAR), '<NULL>'),
    coalesce(description, '<NULL>'), coalesce(commercial_name, '<NULL>'))) AS attr_hash,
  CASE type WHEN 'ENTRADA' THEN abs(amount) ELSE -abs(amount) + 0.0 END AS signed_amount,
  amount IS NULL AS dq_amount_null, amount = 0 AS dq_amount_zero,
  amount < 0 AS dq_amount_negative
  FROM judged WHERE usable)"""

_STAGED = """
numbered AS (SELECT *, row_number() OVER (PARTITION BY _cut_date, business_key_hash
  ORDER BY amount NULLS LAST, description NULLS LAST, commercial_name NULLS LAST, _row_num)
  AS occurrence_seq FROM valid),
staged AS MATERIALIZED (SELECT *,
  md5(business_key_hash || '#' || CAST(occurrence_seq AS VARCHAR)) AS movement_key
  FROM numbered)"""

ROW_COLUMNS = ", ".join(MOVEMENTS.row_columns)


def _merge_steps(columns: Sequence[str], cuts: Sequence[tuple[str, str]]) -> str:
    """CTEs that merge the staged cuts one after the other: per cut n the actions a{n},
    the versions it closed c{n} and the open versions after it o{n}; then ``history``."""
    row = ", ".join(columns)
    steps = []
    blank = ", ".join(f"CAST(NULL AS {'BOOLEAN' if c.startswith('is_') else 'DATE'}) AS {c}"
                      for c in ("is_current", "is_deleted", "valid_from", "valid_to"))
    tail = ("change_type, is_current, is_deleted, valid_from, valid_to, source_file, "
            "cut_label, prev_attr_hash")
    steps.append(f"""
o0 AS (SELECT {row}, CAST(NULL AS VARCHAR) AS change_type, {blank},
  CAST(NULL AS VARCHAR) AS source_file, CAST(NULL AS VARCHAR) AS cut_label,
  CAST(NULL AS VARCHAR) AS prev_attr_hash FROM staged WHERE false)""")
    copied = ", ".join(f"o.{c}" for c in columns)
    taken = ", ".join(f"s.{c}" for c in columns)
    for n, (label, day) in enumerate(cuts, start=1):
        steps.append(f"""
s{n} AS (SELECT * FROM staged WHERE _cut_label = '{label}'),
a{n} AS MATERIALIZED (SELECT coalesce(s.movement_key, o.movement_key) AS movement_key,
  s.movement_key IS NOT NULL AS has_new, o.movement_key IS NOT NULL AS has_old,
  o.is_deleted AS old_is_deleted, o.attr_hash AS old_attr_hash, s.attr_hash AS new_attr_hash,
  CASE WHEN s.movement_key IS NULL THEN CASE WHEN o.is_deleted THEN 'NOOP' ELSE 'DELETE' END
       WHEN o.movement_key IS NULL OR o.is_deleted THEN 'INSERT'
       WHEN o.attr_hash = s.attr_hash THEN 'UNCHANGED' ELSE 'UPDATE' END AS action
  FROM s{n} s FULL OUTER JOIN o{n - 1} o ON s.movement_key = o.movement_key),
c{n} AS MATERIALIZED (SELECT {copied}, o.change_type, false AS is_current, o.is_deleted,
  o.valid_from, DATE '{day}' AS valid_to, o.source_file, o.cut_label, o.prev_attr_hash
  FROM o{n - 1} o JOIN a{n} a ON o.movement_key = a.movement_key
  WHERE a.action IN ('INSERT','UPDATE','DELETE')),
n{n} AS MATERIALIZED (SELECT {taken}, a.action AS change_type, true AS is_current,
  false AS is_deleted, DATE '{day}' AS valid_from, CAST(NULL AS DATE) AS valid_to,
  s._source_file AS source_file, s._cut_label AS cut_label, a.old_attr_hash AS prev_attr_hash
  FROM a{n} a JOIN s{n} s ON s.movement_key = a.movement_key
  WHERE a.action IN ('INSERT','UPDATE')),
t{n} AS MATERIALIZED (SELECT {copied}, 'DELETE' AS change_type, true AS is_current,
  true AS is_deleted, DATE '{day}' AS valid_from, CAST(NULL AS DATE) AS valid_to,
  o.source_file, '{label}' AS cut_label, o.attr_hash AS prev_attr_hash
  FROM a{n} a JOIN o{n - 1} o ON o.movement_key = a.movement_key WHERE a.action = 'DELETE'),
o{n} AS MATERIALIZED (SELECT {row}, {tail} FROM n{n} UNION ALL SELECT {row}, {tail} FROM t{n}
  UNION ALL SELECT {copied}, o.change_type, o.is_current, o.is_deleted, o.valid_from,
  o.valid_to, o.source_file, o.cut_label, o.prev_attr_hash
  FROM o{n - 1} o JOIN a{n} a ON o.movement_key = a.movement_key
  WHERE a.action IN ('UNCHANGED','NOOP'))""")
    parts = [f"SELECT {row}, {tail} FROM c{n}" for n in range(1, len(cuts) + 1)]
    parts.append(f"SELECT {row}, {tail} FROM o{len(cuts)}")
    steps.append("\nhistory AS MATERIALIZED (" + "\n  UNION ALL ".join(parts) + ")")
    return ",".join(steps)


_DAYS = [(c.label, c.cut_date.isoformat()) for c in demo.CUTS]
_HISTORY = _merge_steps(MOVEMENTS.row_columns, _DAYS)


def _sum(x: str) -> str:
    """A sum of doubles by their shortest decimal forms, rounded once."""
    return (f"CAST(CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))) AS VARCHAR) "
            "AS DOUBLE)")


_VIEWS = f"""
live AS (SELECT * FROM history WHERE is_current AND NOT is_deleted),
change_log AS (SELECT cut_label, valid_from AS cut_date, movement_key, change_type,
  prev_attr_hash, CASE WHEN change_type <> 'DELETE' THEN attr_hash END AS new_attr_hash
  FROM history),
flow_by_product AS (SELECT product, count(*) AS n_movimientos,
  {_sum("signed_amount")} AS flujo_neto,
  {_sum("CASE WHEN type='ENTRADA' THEN amount END")}
    AS total_entradas,
  {_sum("CASE WHEN type='SALIDA' THEN amount END")}
    AS total_salidas
  FROM live GROUP BY product),
flow_by_fund AS (SELECT fund, count(*) AS n_movimientos,
  {_sum("signed_amount")} AS flujo_neto
  FROM live GROUP BY fund),
flow_by_type AS (SELECT type, count(*) AS n_movimientos,
  {_sum("amount")} AS total_monto FROM live GROUP BY type),
cdc_summary AS (SELECT cut_label, CAST(cut_date AS VARCHAR) AS cut_date,
  count(*) FILTER (WHERE change_type='INSERT') AS nuevos,
  count(*) FILTER (WHERE change_type='UPDATE') AS corregidos,
  count(*) FILTER (WHERE change_type='DELETE') AS eliminados
  FROM change_log GROUP BY ALL),
state_summary AS (SELECT (SELECT count(*) FROM live) AS movimientos_vigentes,
  (SELECT count(*) FROM history WHERE is_current AND is_deleted) AS eliminados_vigentes,
  (SELECT count(*) FROM history) AS versiones_totales,
  (SELECT count(DISTINCT id_cliente) FROM live) AS clientes_activos),
dq_profile AS (SELECT count(*) AS total, CAST(sum(dq_amount_null::INT) AS BIGINT) AS amount_nulos,
  CAST(sum(dq_amount_zero::INT) AS BIGINT) AS amount_ceros,
  CAST(sum(dq_amount_negative::INT) AS BIGINT) AS amount_negativos,
  CAST(sum(dq_date_reformatted::INT) AS BIGINT) AS fecha_reformateada,
  CAST(sum(dq_type_recoded::INT) AS BIGINT) AS type_recodificado FROM live),
quarantine_total AS (SELECT count(*) AS cuarentena_total FROM judged WHERE NOT usable),
top_clients AS (SELECT id_cliente, count(*) AS n_movimientos,
  {_sum("abs(amount)")} AS volumen
  FROM live GROUP BY id_cliente ORDER BY volumen DESC NULLS LAST, id_cliente LIMIT 10)"""

_CORRUPTED = """
corrupted AS (SELECT * REPLACE (
    CASE WHEN occurrence_seq = 2 THEN NULL ELSE product END AS product,
    CASE WHEN dq_amount_zero THEN 'OTRO' ELSE type END AS type,
    CASE WHEN dq_amount_negative THEN 'OTHER' ELSE change_type END AS change_type,
    CASE WHEN is_current AND is_deleted THEN valid_from
         WHEN NOT is_current AND change_type = 'UPDATE' THEN NULL ELSE valid_to END AS valid_to)
  FROM history UNION ALL SELECT * FROM history WHERE change_type = 'UPDATE'),
copies AS (SELECT 'clean' AS copy, * FROM history
  UNION ALL SELECT 'corrupted' AS copy, * FROM corrupted)"""


def _raw(body: str) -> str:
    return f"WITH {_RAW}\n{body}"


def _norm(body: str) -> str:
    return f"WITH {_RAW},{_NORM}\n{body}"


def _staged(body: str) -> str:
    return f"WITH {_RAW},{_NORM},{_STAGED}\n{body}"


def _hist(body: str, more: str = "") -> str:
    return f"WITH {_RAW},{_NORM},{_STAGED},{_HISTORY},{_VIEWS}{more}\n{body}"


def _checked(body: str) -> str:
    return _hist(body, "," + _CORRUPTED)


def _cuts(body: str) -> str:
    """A statement over every merge; ``{n}`` is its number, ``{before}`` the one before."""
    return _hist("\nUNION ALL ".join(
        body.format(n=n, before=n - 1, cut=f"'{label}' AS cut_label",
                    merged=f"'{label}' AS merged_cut")
        for n, (label, _) in enumerate(_DAYS, start=1)))


_APART = _merge_steps(MOVEMENTS.row_columns, [
    (c.label, day.isoformat()) for c, day in zip(demo.CUTS, demo.MONTHS_APART)])
_SHOWN = ROW_COLUMNS + (", change_type, is_current, is_deleted, valid_from, valid_to, "
                        "cut_label, prev_attr_hash")

# -- assertions over the copies -----------------------------------------------------------
_CHECKED_TABLES = {
    "history": "(SELECT * FROM copies WHERE copy = '{copy}')",
    "change_log": "(SELECT * FROM copies WHERE copy = '{copy}')",
    "live": "(SELECT * FROM copies WHERE copy = '{copy}' AND is_current AND NOT is_deleted)",
    "flujo_por_producto": "(SELECT DISTINCT product FROM copies WHERE copy = '{copy}' "
                       "AND is_current AND NOT is_deleted)",
    "flujo_por_fondo": "(SELECT DISTINCT fund FROM copies WHERE copy = '{copy}' "
                    "AND is_current AND NOT is_deleted)",
}


def _violations(a: quality.Assertion, table: str) -> str:
    if isinstance(a, quality.NotNull):
        return f"SELECT count(*) FROM {table} WHERE {a.column} IS NULL"
    if isinstance(a, quality.Accepted):
        values = ", ".join(f"'{v}'" for v in a.values)
        return f"SELECT count(DISTINCT {a.column}) FROM {table} WHERE {a.column} NOT IN ({values})"
    if isinstance(a, quality.Unique):
        return (f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {a.column} IS NOT NULL "
                f"GROUP BY {a.column} HAVING count(*) > 1)")
    if isinstance(a, quality.OneOpenVersion):
        return (f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE is_current "
                "GROUP BY movement_key HAVING count(*) > 1)")
    if isinstance(a, quality.OneVersionPerCut):
        return (f"SELECT count(*) FROM (SELECT 1 FROM {table} "
                "GROUP BY movement_key, valid_from HAVING count(*) > 1)")
    return (f"SELECT count(*) FROM {table} WHERE (is_current AND valid_to IS NOT NULL) "
            "OR (NOT is_current AND valid_to IS NULL)")


def _suite(*kinds: type, passed: bool = False) -> str:
    rows = []
    for copy in ("clean", "corrupted"):
        for a in quality.MOVEMENTS_SUITE:
            if kinds and not isinstance(a, kinds):
                continue
            table = _CHECKED_TABLES[a.table].format(copy=copy)
            rows.append(f"SELECT '{copy}' AS copy, '{a.name}' AS assertion, "
                        f"({_violations(a, table)}) AS violations")
    body = "\nUNION ALL ".join(rows)
    if passed:
        body = f"SELECT *, violations = 0 AS passed FROM ({body})"
    return _checked(body)


def _long(section: str, source: str, item: str, metrics: Sequence[str]) -> list[str]:
    return [f"SELECT '{section}' AS section, {item} AS item, '{m}' AS metric, "
            f"CAST({m} AS DOUBLE) AS value FROM {source}" for m in metrics]


_INSIGHTS = "\nUNION ALL ".join([
    *_long("cdc_por_corte", "cdc_summary", "cut_label", ["nuevos", "corregidos", "eliminados"]),
    *_long("estado_vigente", "state_summary", "''",
           ["movimientos_vigentes", "eliminados_vigentes", "versiones_totales",
            "clientes_activos"]),
    *_long("flujo_por_producto", "flow_by_product", "product",
           ["n_movimientos", "flujo_neto", "total_entradas", "total_salidas"]),
    *_long("por_tipo", "flow_by_type", "type", ["n_movimientos", "total_monto"]),
    *_long("calidad_vigente", "dq_profile", "''",
           ["total", "amount_nulos", "amount_ceros", "amount_negativos", "fecha_reformateada",
            "type_recodificado"]),
    *_long("cuarentena_total", "quarantine_total", "''", ["cuarentena_total"]),
    *_long("top_clientes", "top_clients", "id_cliente", ["n_movimientos", "volumen"]),
])

# -- orders -------------------------------------------------------------------------------
_ORDER_DAYS = [(c.label, c.cut_date.isoformat()) for c in demo.ORDER_CUTS]
_ORDERS = f"""WITH cuts(_cut_label, _cut_date) AS (VALUES
  {", ".join(f"('{label}', DATE '{day}')" for label, day in _ORDER_DAYS)}),
snapshots AS (SELECT o_orderkey, o_custkey, CASE WHEN date_diff('day', CAST(o_orderdate AS DATE),
    _cut_date) >= 90 THEN o_orderstatus ELSE 'O' END AS o_orderstatus,
  o_totalprice, o_orderpriority, 'orders.parquet' AS _source_file, _cut_label, _cut_date
  FROM orders, cuts WHERE CAST(o_orderdate AS DATE) < _cut_date
  AND CAST(o_orderdate AS DATE) >= _cut_date - INTERVAL 48 MONTH),
staged AS MATERIALIZED (SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS movement_key,
  md5(CAST(o_orderkey AS VARCHAR)) AS business_key_hash, CAST(1 AS BIGINT) AS occurrence_seq,
  md5(concat_ws('||', coalesce(CAST(o_custkey AS VARCHAR), '<NULL>'),
    coalesce(o_orderstatus, '<NULL>'), coalesce(CAST(o_totalprice AS VARCHAR), '<NULL>'),
    coalesce(o_orderpriority, '<NULL>'))) AS attr_hash FROM snapshots),
{_merge_steps(demo.ORDERS.row_columns, _ORDER_DAYS)}
SELECT * FROM history"""

_LINEITEM = ("l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_orderkey, "
             "l_partkey, l_suppkey, l_linenumber")

_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{label}' AS cut_label, count(*) FILTER (WHERE action='INSERT') AS rows_new, "
    f"count(*) FILTER (WHERE action='UPDATE') AS rows_changed, "
    f"count(*) FILTER (WHERE action='DELETE') AS rows_deleted, "
    f"count(*) FILTER (WHERE action='UNCHANGED') AS rows_unchanged FROM a{n}"
    for n, (label, _) in enumerate(_DAYS, start=1))

_PER_CUT = list(enumerate([label for label, _ in _DAYS], start=1))
_SUMMARIES = "\nUNION ALL ".join(
    f"SELECT '{label}' AS cut_label, (SELECT count(*) FROM o{n} WHERE NOT is_deleted) AS "
    f"movimientos_vigentes, (SELECT count(*) FROM o{n} WHERE is_deleted) AS eliminados_vigentes, "
    + " + ".join([f"(SELECT count(*) FROM o{n})",
                  *[f"(SELECT count(*) FROM c{m})" for m in range(1, n + 1)]])
    + f" AS versiones_totales, (SELECT count(DISTINCT id_cliente) FROM o{n} WHERE NOT is_deleted) "
    "AS clientes_activos" for n, label in _PER_CUT)
_TOPS = "\nUNION ALL ".join(
    f"SELECT * FROM (SELECT '{label}' AS cut_label, id_cliente, count(*) AS n_movimientos, "
    f"{_sum('abs(amount)')} AS volumen FROM o{n} WHERE NOT is_deleted GROUP BY id_cliente "
    "ORDER BY volumen DESC NULLS LAST, id_cliente LIMIT 10)" for n, label in _PER_CUT)
_AS_OF = """SELECT k.movement_key, day, h.valid_from, h.cut_label, h.attr_hash, h.signed_amount
FROM (SELECT DISTINCT movement_key FROM history UNION ALL SELECT 'none') k
JOIN (VALUES (DATE '2024-10-31'), (DATE '2024-11-01'), (DATE '2024-11-02'),
  (DATE '2024-11-03'), (DATE '2024-12-31')) v(day) ON true
LEFT JOIN history h ON h.movement_key = k.movement_key AND NOT h.is_deleted
  AND h.valid_from <= day AND (h.valid_to IS NULL OR h.valid_to > day)"""
_TEXTS = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<NULL>')" for c in MOVEMENTS.source_columns)
_FINGERPRINT = ("SELECT _cut_label AS cut_label, _cut_date AS cut_date, count(*) AS source_rows, "
                "concat_ws(':', count(*), " + ", ".join(
                    f"sum(CAST('0x' || substr(h, {1 + 8 * k}, 8) AS BIGINT))" for k in range(4))
                + ") AS fingerprint FROM (SELECT _cut_label, _cut_date, "
                f"md5(concat_ws('||', {_TEXTS})) AS h FROM raw) GROUP BY ALL")

_METRICS = f"""SELECT c.cut_label, c.cut_date, r.source_rows, r.rows_valid,
  r.source_rows - r.rows_valid AS rows_quarantined, m.rows_new, m.rows_changed, m.rows_deleted,
  m.rows_unchanged, 'SUCCESS' AS status
FROM cuts c JOIN (SELECT _cut_label, count(*) AS source_rows,
    count(*) FILTER (WHERE usable) AS rows_valid FROM judged GROUP BY 1) r
  ON r._cut_label = c.cut_label JOIN ({_COUNTS}) m ON m.cut_label = c.cut_label"""

_QUARANTINE = (
    "SELECT id_cliente, CAST(mov_date AS VARCHAR) AS date, product, type, fund, amount, "
    "description, commercial_name, concat_ws('; ', "
    "CASE WHEN coalesce(id_cliente,'')='' THEN 'id_cliente vacio' END, "
    "CASE WHEN mov_date IS NULL THEN 'date no parseable' END, "
    "CASE WHEN coalesce(product,'')='' THEN 'product vacio' END, "
    "CASE WHEN type IS NULL THEN 'type no mapeable' END, "
    "CASE WHEN coalesce(fund,'')='' THEN 'fund vacio' END) AS _reasons, "
    "{more}_cut_label, _cut_date FROM judged WHERE NOT usable")

ORACLE: dict[str, str] = {
    "scan_cut": _raw("SELECT id_cliente, date, product, type, fund, amount, description, "
                     "commercial_name FROM raw WHERE _cut_label = 'T'"),
    "land_lineage": "SELECT event_id, user_id, event_type, value, 'events.parquet' AS "
                    "_source_file, 'T' AS _cut_label, DATE '2024-11-01' AS _cut_date FROM events",
    "land_row_num": "SELECT o_orderkey, o_orderkey + 1 AS row_num FROM orders",
    # row numbers restart in every file of a cut, so the largest depends on how a source
    # split its files; the fixture's writer makes one file per cut
    "land_idempotent": _raw("SELECT _cut_label, _cut_date, count(*) AS n_rows, "
                            "count(*) AS max_row_num FROM raw GROUP BY ALL"),
    "landed_count": _raw("SELECT _cut_label, count(*) AS source_rows FROM raw GROUP BY ALL"),
    "manifest": _raw("SELECT c.cut_label, c.cut_label || '.parquet' AS file, c.cut_date, "
                     "(SELECT count(*) FROM raw WHERE _cut_date = c.cut_date) AS n_rows "
                     "FROM cuts c"),
    "cut_fingerprint": _raw(_FINGERPRINT),
    "pending_cuts": _raw("SELECT _cut_label AS cut_label, _cut_date AS cut_date, "
                         "count(*) AS source_rows FROM raw WHERE _cut_label <> 'T' GROUP BY ALL"),
    "order_guard": _raw("SELECT DISTINCT _cut_label AS cut_label, _cut_date AS cut_date FROM raw "
                        "WHERE _cut_date < (SELECT max(_cut_date) FROM raw "
                        "WHERE _cut_label <> 'T2')"),
    "single_cut": _staged("SELECT movement_key, attr_hash, _cut_date AS valid_from, "
                          "_cut_label AS cut_label FROM staged WHERE _cut_label = 'T1'"),
    "ledger_append": _raw("SELECT CAST(i AS BIGINT) AS commit, cut_label, cut_date, "
                          "'SUCCESS' AS status FROM cuts WHERE cut_label IN "
                          "(SELECT _cut_label FROM raw)"),
    "run_metrics": _hist(_METRICS),
    "history_publish": _hist(f"SELECT {_SHOWN} FROM history"),
    "rebuild": _hist(f"SELECT {_SHOWN} FROM history"),
    "stream_cuts": _hist("SELECT cut_label, change_type, count(*) AS n FROM change_log "
                         "GROUP BY ALL"),
    "stream_replayed": _hist("SELECT cut_label, change_type, count(*) AS n FROM change_log "
                             "GROUP BY ALL"),
    "run_twice": _raw("SELECT CAST(i AS BIGINT) AS commit, cut_label, cut_date, 'SUCCESS' AS "
                      "status FROM cuts WHERE cut_label IN (SELECT _cut_label FROM raw)"),
    "norm_text": _norm("SELECT _cut_label, _row_num, id_cliente, product, fund FROM norm"),
    "norm_optional": _norm("SELECT _cut_label, _row_num, description, commercial_name FROM norm"),
    "norm_type": _norm("SELECT n._cut_label, n._row_num, r.type AS type_raw, n.type FROM norm n "
                       "JOIN raw r USING (_cut_label, _row_num)"),
    "norm_date": _norm("SELECT n._cut_label, n._row_num, r.date AS date_raw, n.mov_date "
                       "FROM norm n JOIN raw r USING (_cut_label, _row_num)"),
    "flag_date": _norm("SELECT _cut_label, _row_num, dq_date_reformatted FROM norm"),
    "flag_type": _norm("SELECT _cut_label, _row_num, dq_type_recoded FROM norm"),
    "flag_amount": _norm("SELECT _cut_label, _row_num, dq_amount_null, dq_amount_zero, "
                         "dq_amount_negative FROM valid"),
    "split_valid": _norm("SELECT _cut_label, _row_num, usable FROM judged"),
    "quarantine": _norm(_QUARANTINE.format(more="_source_file, ")),
    "quarantine_stored": _norm(_QUARANTINE.format(more="")),
    "key_hash": _norm("SELECT _cut_label, _row_num, business_key_hash FROM valid"),
    "attr_hash": _norm("SELECT _cut_label, _row_num, attr_hash FROM valid"),
    "signed_amount": _norm("SELECT _cut_label, _row_num, type, amount, signed_amount FROM valid"),
    "occurrence_seq": _staged("SELECT _cut_label, business_key_hash, occurrence_seq, attr_hash, "
                              "dq_date_reformatted, dq_type_recoded FROM staged"),
    "occurrence_seq_heavy": (
        f"SELECT l_returnflag, l_linestatus, {_LINEITEM}, row_number() OVER "
        f"(PARTITION BY l_returnflag, l_linestatus ORDER BY {_LINEITEM}) AS occurrence_seq "
        "FROM lineitem"),
    "movement_key": _staged(f"SELECT {ROW_COLUMNS}, _source_file, _cut_label, _cut_date "
                            "FROM staged"),
    "stage_key_unique": _staged(
        "SELECT 'movement_key' AS key, _cut_label, count(*) - count(DISTINCT movement_key) "
        "AS duplicates FROM staged GROUP BY ALL UNION ALL SELECT 'business_key_hash', "
        "_cut_label, count(*) - count(DISTINCT business_key_hash) FROM staged GROUP BY ALL"),
    "cut_slice": _raw("SELECT * FROM raw WHERE _cut_label = 'T1' "
                      "AND _cut_date = DATE '2024-11-02'"),
    "open_versions": _hist(f"SELECT {_SHOWN} FROM history WHERE is_current"),
    "live_state": _hist(f"SELECT {_SHOWN} FROM live"),
    "tombstones": _hist(f"SELECT {_SHOWN} FROM history WHERE is_current AND is_deleted"),
    "cdc_full_outer": _cuts("SELECT {cut}, movement_key, has_new, has_old, old_is_deleted, "
                            "old_attr_hash, new_attr_hash FROM a{n}"),
    "cdc_classify": _cuts("SELECT {cut}, movement_key, action, has_old AND action IN "
                          "('INSERT','UPDATE','DELETE') AS closes FROM a{n}"),
    "cdc_reappeared": _cuts("SELECT {cut}, movement_key, old_attr_hash AS prev_attr_hash, "
                            "new_attr_hash AS new_attr_hash FROM a{n} "
                            "WHERE has_new AND has_old AND old_is_deleted"),
    "cdc_new_rows": _cuts("SELECT {cut}, change_type AS action, " + ROW_COLUMNS + " FROM n{n}"),
    "cdc_tombstone_rows": _cuts("SELECT {cut}, " + ROW_COLUMNS + " FROM t{n}"),
    "cdc_closed_rows": _cuts("SELECT {cut}, a.movement_key, o.valid_from, a.action "
                             "FROM a{n} a JOIN o{before} o ON a.movement_key = o.movement_key "
                             "WHERE a.action IN ('INSERT','UPDATE','DELETE')"),
    "scd2_closed": _cuts("SELECT {merged}, " + _SHOWN + " FROM c{n}"),
    "scd2_new_versions": _cuts("SELECT {merged}, " + _SHOWN + " FROM n{n}"),
    "scd2_tombstones": _cuts("SELECT {merged}, " + _SHOWN + " FROM t{n}"),
    "change_log": _hist("SELECT * FROM change_log"),
    "change_log_stored": _hist("SELECT * FROM change_log"),
    "merge_counts": _hist(_COUNTS),
    "merge_idempotent": _staged("SELECT CAST(0 AS BIGINT) AS rows_new, CAST(0 AS BIGINT) AS "
                                "rows_changed, CAST(0 AS BIGINT) AS rows_deleted, count(*) AS "
                                "rows_unchanged FROM staged WHERE _cut_label = 'T2'"),
    "version_id": _hist("SELECT md5(movement_key || '#' || CAST(valid_from AS VARCHAR)) AS "
                        "version_id, movement_key, valid_from FROM history"),
    "scd2_history": _hist("SELECT * FROM history"),
    "bulk_from_state": _hist(f"SELECT {_SHOWN} FROM history"),
    "bootstrap": _hist('SELECT "table", CAST(0 AS BIGINT) AS rows_before, rows_after FROM ('
                       + "\nUNION ALL ".join(
                           f"SELECT '{t}' AS \"table\", count(*) AS rows_after FROM {source}"
                           for t, source in (
                               ("raw", "raw"), ("history", "history"),
                               ("open_versions", "history WHERE is_current"),
                               ("change_log", "change_log"),
                               ("quarantine", "judged WHERE NOT usable"), ("ledger", "cuts"),
                               ("failures", "cuts WHERE false"))) + ")"),
    "history_by_date": f"WITH {_RAW},{_NORM},{_STAGED},{_APART}\n"
                       f"SELECT {_SHOWN} FROM history WHERE valid_from <= DATE '2025-01-14' "
                       "AND (valid_to IS NULL OR valid_to > DATE '2024-11-02')",
    "movement_trace": _hist("SELECT movement_key, change_type, is_current, is_deleted, "
                            "valid_from, valid_to, amount FROM history "
                            "ORDER BY movement_key, valid_from"),
    "mart_flow_by_product": _hist("SELECT * FROM flow_by_product"),
    "mart_flow_by_fund": _hist("SELECT * FROM flow_by_fund"),
    "flow_by_type": _hist("SELECT * FROM flow_by_type"),
    "cdc_summary": _hist("SELECT * FROM cdc_summary"),
    "change_counts": _hist("SELECT cut_label, change_type, count(*) AS n FROM change_log "
                           "GROUP BY ALL"),
    "state_summary": _hist("SELECT * FROM state_summary"),
    "state_summary_incremental": _hist(_SUMMARIES),
    "top_clients_incremental": _hist(_TOPS),
    "dq_profile": _hist("SELECT * FROM dq_profile"),
    "quarantine_total": _norm("SELECT count(*) AS cuarentena_total FROM judged WHERE NOT usable"),
    "top_clients": _hist("SELECT * FROM top_clients"),
    "run_summary": _hist("SELECT s.*, q.cuarentena_total FROM state_summary s, "
                         "quarantine_total q"),
    "insights": _hist(_INSIGHTS),
    "insights_export": _hist(_INSIGHTS),
    "assert_not_null": _suite(quality.NotNull),
    "assert_accepted_values": _suite(quality.Accepted),
    "assert_unique": _suite(quality.Unique),
    "assert_one_open_version": _checked(
        "SELECT copy, movement_key, count(*) AS versiones_vigentes FROM copies WHERE is_current "
        "GROUP BY ALL HAVING count(*) > 1"),
    "assert_one_version_per_cut": _checked(
        "SELECT copy, movement_key, valid_from, count(*) AS n FROM copies GROUP BY ALL "
        "HAVING count(*) > 1"),
    "assert_validity": _checked(
        "SELECT copy, 'vigente_con_valid_to' AS problema, movement_key, valid_from FROM copies "
        "WHERE is_current AND valid_to IS NOT NULL UNION ALL "
        "SELECT copy, 'cerrada_sin_valid_to', movement_key, valid_from FROM copies "
        "WHERE NOT is_current AND valid_to IS NULL"),
    "assert_freshness": _raw(
        "SELECT 'fresh_raw__cut_date' AS assertion, CAST(sum(CASE WHEN date_diff('day', "
        "newest, day) > 1 THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM "
        "(SELECT max(_cut_date) AS newest FROM raw), (VALUES (DATE '2024-11-03'), "
        "(DATE '2024-11-04'), (DATE '2024-11-05')) v(day)"),
    "quality_gate": _suite(passed=True),
    "as_of_state": _hist(
        "SELECT day AS as_of_date, movement_key, product, signed_amount, cut_label FROM history "
        "JOIN (VALUES (DATE '2024-10-31'), (DATE '2024-11-01'), (DATE '2024-11-02'), "
        "(DATE '2024-11-03'), (DATE '2024-12-31')) v(day) ON valid_from <= day "
        "AND (valid_to IS NULL OR valid_to > day) WHERE NOT is_deleted"),
    "as_of_join": _hist(_AS_OF),
    "marts_stored": _hist("\nUNION ALL ".join([
        *_long("flujo_por_producto", "flow_by_product", "product",
               ["n_movimientos", "flujo_neto", "total_entradas", "total_salidas"]),
        *_long("flujo_por_fondo", "flow_by_fund", "fund", ["n_movimientos", "flujo_neto"])])),
    "mart_incremental": _hist("SELECT * FROM flow_by_product"),
    "natural_key_cdc": _ORDERS,
}

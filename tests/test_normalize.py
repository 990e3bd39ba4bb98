import duckdb
from conftest import normalized, raw, row
from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.model import MOVEMENTS
from tidemark.operators import keys, normalize
from tidemark.plans import demo


def test_text_is_trimmed_of_all_space_separators_and_upper_cased(spark):
    padded = [f"{s} señor ñ {s}" for s in text.SPACES] + ["\tx\n", "​x", ""]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(padded)], "n int, v string")
    got = [r[0] for r in df.orderBy("n").select(text.canonical(F.col("v"))).collect()]
    want = [duckdb.execute("SELECT upper(trim(?))", [v]).fetchone()[0] for v in padded]
    assert len(text.SPACES) == 17
    assert got == want


def test_optional_text_reads_empty_as_null(spark):
    df = spark.createDataFrame([("  ",), ("",), (None,), (" a ",)], "v string")
    assert [r[0] for r in df.select(text.optional(F.col("v"))).collect()] == [None, None, None, "A"]


def test_dates(spark):
    want = {
        "2024-01-02": "2024-01-02", " 2024-1-2 ": "2024-01-02", "2024-01-02 10:00:00": "2024-01-02",
        "2024-01-02T10:00:00": "2024-01-02", "02/01/2024": "2024-01-02", "2/1/2024": "2024-01-02",
        "31/02/2024": None, "2024-02-30": None, "no-es-fecha": None, "": None, "2024": None,
        "2024-01": None, "2024/01/02": None, "02/01/24": None, "12/31/2024": None,
        "2024-01-02 garbage": None, "2024-01-02Tx": None, "2024-01-02 10:00:00.5+02:00": "2024-01-02",
    }
    df = spark.createDataFrame([(k,) for k in want], "v string")
    got = df.select("v", dates.parsed_date(F.col("v"), ("d/M/yyyy",)).cast("string"),
                    dates.reformatted(F.col("v"))).collect()
    assert {r[0]: r[1] for r in got} == want
    iso = {k for k, v in want.items() if v and "/" not in k}
    assert {r[0] for r in got if not r[2]} == iso


def test_type_map_and_recode_flag(spark):
    rows = [row(kind=k) for k in (" entrada", "IN", "Salida", "out ", "transfer", None)]
    got = normalized(spark, rows).orderBy("_row_num").select("type", "dq_type_recoded").collect()
    assert [tuple(r) for r in got] == [
        ("ENTRADA", False), ("ENTRADA", True), ("SALIDA", False), ("SALIDA", True),
        (None, True), (None, None)]


def test_amount_flags_are_three_valued_and_sign_follows_type(spark):
    rows = [row(amount=a, kind=k) for a in (None, 0.0, -0.0, -5.0, 5.0) for k in ("in", "out")]
    valid, _ = normalize.split(normalized(spark, rows), MOVEMENTS)
    got = keys.with_hashes(valid, MOVEMENTS).orderBy("_row_num").select(
        "dq_amount_null", "dq_amount_zero", "dq_amount_negative",
        F.col("signed_amount").cast("string")).collect()
    assert [tuple(r) for r in got] == [
        (True, None, None, None), (True, None, None, None),
        (False, True, False, "0.0"), (False, True, False, "0.0"),
        (False, True, False, "0.0"), (False, True, False, "0.0"),
        (False, False, True, "5.0"), (False, False, True, "-5.0"),
        (False, False, False, "5.0"), (False, False, False, "-5.0")]


def test_quarantine_lists_every_reason_and_shows_normalised_values(spark):
    rows = [row(), row(client="  "), row(day="x", kind="transfer"), row(product=None),
            row(fund=""), row(None, None, None, None, None)]
    df = normalized(spark, rows)
    good, bad = normalize.split(df, MOVEMENTS)
    assert (good.count(), bad.count()) == (1, 5)
    out = normalize.quarantine(df, MOVEMENTS)
    assert sorted(out.columns) == sorted(
        c for c in MOVEMENTS.quarantine_schema.fieldNames())
    got = {(r["_reasons"], r["date"], r["type"]) for r in out.collect()}
    assert got == {
        ("id_cliente vacio", "2024-01-01", "ENTRADA"),
        ("date no parseable; type no mapeable", None, None),
        ("product vacio", "2024-01-01", "ENTRADA"),
        ("fund vacio", "2024-01-01", "ENTRADA"),
        ("id_cliente vacio; date no parseable; product vacio; type no mapeable; fund vacio",
         None, None)}


def test_null_and_empty_description_hash_alike_but_null_mark_keeps_its_place(spark):
    rows = [row(description=None), row(description=" "), row(description="n", name=None),
            row(description="", name="n")]
    valid, _ = normalize.split(normalized(spark, rows), MOVEMENTS)
    h = [r["attr_hash"] for r in
         keys.with_hashes(valid, MOVEMENTS).orderBy("_row_num").collect()]
    assert h[0] == h[1] == h[3]
    assert h[2] != h[3]


def test_other_tables_need_only_a_spec(spark):
    df = spark.createDataFrame([(1, 2, "O", 3.0, "x"), (None, 2, "O", 3.0, "x")],
                               demo.ORDERS.source)
    out, bad = normalize.split(normalize.normalize(df, demo.ORDERS), demo.ORDERS)
    assert (out.count(), bad.count()) == (1, 1)


def test_landed_columns_match_the_schema(spark):
    assert raw(spark, [row()]).columns == MOVEMENTS.raw_schema.fieldNames()

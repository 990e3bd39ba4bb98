from datetime import date
from pathlib import Path

import pytest
from conftest import T, T1, T2, compared, row, write_cut
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.model import MOVEMENTS, Cut
from tidemark.operators import history, marts, quality
from tidemark.plans import demo, pipeline, reports
from tidemark.sources import cuts as source
from tidemark.sources.store import Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), MOVEMENTS)


FIRST = [row("A"), row("B"), row("C", day="bad")]
SECOND = [row("A", amount=5.0), row("D")]


def counts(record):
    return tuple(record[k] for k in ("source_rows", "rows_valid", "rows_quarantined", "rows_new",
                                     "rows_changed", "rows_deleted", "rows_unchanged"))


def test_an_unused_store_reads_as_empty_tables(store):
    for df in (store.raw(), store.history(), store.live(), store.change_log(),
               store.quarantine(), store.ledger()):
        assert df.count() == 0
    assert store.raw().columns == MOVEMENTS.raw_schema.fieldNames()
    assert store.quarantine().columns == MOVEMENTS.quarantine_schema.fieldNames()


def test_cuts_in_order(spark, store, tmp_path):
    first = write_cut(spark, tmp_path, FIRST, T)
    second = write_cut(spark, tmp_path, SECOND, T1)
    assert counts(pipeline.process_cut(spark, store, first)) == (3, 2, 1, 2, 0, 0, 0)
    assert counts(pipeline.process_cut(spark, store, second)) == (2, 2, 0, 1, 1, 1, 0)
    assert store.history().count() == 5
    assert store.live().count() == 2
    assert store.quarantine().count() == 1
    assert store.change_log().groupBy("cut_label").count().count() == 2
    assert store.change_log().filter("run_id IS NULL OR ts IS NULL").count() == 0
    assert store.raw(first).count() == 3
    assert store.raw().schema["_cut_date"].dataType.simpleString() == "date"
    assert [r["_row_num"] for r in store.raw(first).orderBy("_row_num").collect()] == [1, 2, 3]


def test_the_same_content_is_skipped_and_an_older_cut_refused(spark, store, tmp_path):
    first = write_cut(spark, tmp_path, FIRST, T)
    second = write_cut(spark, tmp_path, SECOND, T1)
    pipeline.process_cut(spark, store, first)
    pipeline.process_cut(spark, store, second)
    before = compared(store.history())
    assert pipeline.process_cut(spark, store, second) is None
    assert pipeline.process_cut(spark, store, first) is None
    other = write_cut(spark, tmp_path, [*FIRST, row("E")], T)
    with pytest.raises(source.OutOfOrderError):
        pipeline.process_cut(spark, store, other)
    with pytest.raises(source.OutOfOrderError):
        pipeline.process_cut(spark, store, Cut("earlier", first.path, date(2024, 10, 1)))
    assert compared(store.history()) == before
    assert store.ledger().count() == 2
    assert {r["status"] for r in store.failures().collect()} == {"REFUSED"}


def test_running_all_cuts_again_changes_nothing(spark, store, tmp_path):
    cuts = [write_cut(spark, tmp_path, rows, c) for rows, c in
            [(FIRST, T), (SECOND, T1), ([row("B"), row("D", amount=3.0)], T2)]]
    assert None not in pipeline.run_cuts(spark, store, cuts)
    before, records = compared(store.history()), store.records().collect()
    top = store.top_actors().collect()
    assert pipeline.run_cuts(spark, store, cuts) == [None] * 3
    assert compared(store.history()) == before and store.records().collect() == records
    assert store.failures().count() == 0 and store.top_actors().collect() == top


def test_a_gate_that_finds_something_leaves_a_record(spark, store, tmp_path):
    cut = write_cut(spark, tmp_path, FIRST, T)

    def check(_store):
        raise quality.QualityGateError("not_null_history_type: 1")

    with pytest.raises(quality.QualityGateError):
        pipeline.run_cuts(spark, store, [cut], check=check)
    [failed] = store.failures().collect()
    assert failed["status"] == "FAILED" and "not_null_history_type" in failed["error"]
    with pytest.raises(AnalysisException):
        pipeline.rebuild(spark, store, [Cut("T1", str(tmp_path / "missing"), T1.cut_date)])
    assert store.failures().count() == 2


def test_equal_rows_have_an_equal_fingerprint(spark, tmp_path):
    rows = [(*row(f"C{n % 7}", amount=None if n % 5 == 0 else n / 4),) for n in range(40)]
    schema = MOVEMENTS.source.simpleString()[7:-1].replace(":", " ")

    def print_of(given, parts, at):
        spark.createDataFrame(given, schema).repartition(parts).write.parquet(f"{tmp_path}/{at}")
        scanned = source.scan_cut(spark, f"{tmp_path}/{at}", MOVEMENTS)
        return source.fingerprint(scanned, MOVEMENTS).first()["fingerprint"]

    same = print_of(rows, 1, "a")
    assert print_of(rows[::-1], 5, "b") == same
    assert print_of([*rows, rows[0]], 1, "c") != same  # a repeated row counts
    blank = [(*rows[0][:6], "", rows[0][7]), *rows[1:]]
    missing = [(*rows[0][:6], None, rows[0][7]), *rows[1:]]
    assert len({same, print_of(blank, 1, "d"), print_of(missing, 1, "e")}) == 3


def test_other_content_for_the_newest_date_replaces_it(spark, store, tmp_path):
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, FIRST, T))
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, SECOND, T1))
    fixed = write_cut(spark, tmp_path, [row("A", amount=6.0), row("B")], T1)
    record = pipeline.process_cut(spark, store, fixed)
    assert counts(record) == (2, 2, 0, 0, 1, 0, 1)
    assert record["lineage"] == [1, 3]
    other = Store(spark, str(tmp_path / "other"), MOVEMENTS)
    pipeline.process_cut(spark, other, write_cut(spark, tmp_path, FIRST, T))
    pipeline.process_cut(spark, other, fixed)
    assert compared(store.history()) == compared(other.history())
    assert store.change_log().count() == other.change_log().count()
    assert store.raw().count() == 5
    reports.build_and_check(store)


def test_first_date_can_be_replaced_too(spark, store, tmp_path):
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, FIRST, T))
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, SECOND, T))
    assert store.head().lineage == (2,)
    assert store.history().count() == 2


def test_work_that_was_not_published_is_not_read(spark, store, tmp_path, monkeypatch):
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, FIRST, T))
    before = compared(store.history()), store.change_log().count()
    second = write_cut(spark, tmp_path, [*SECOND, row(fund=None)], T1)

    def crash(records):
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "publish", crash)
    with pytest.raises(RuntimeError):
        pipeline.process_cut(spark, store, second)
    assert (compared(store.history()), store.change_log().count()) == before
    assert store.quarantine().count() == 1
    monkeypatch.undo()
    assert counts(pipeline.process_cut(spark, store, second)) == (3, 2, 1, 1, 1, 1, 0)
    assert store.quarantine().count() == 2


def test_too_many_deletions_stop_a_cut(spark, store, tmp_path):
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, FIRST, T))
    empty = write_cut(spark, tmp_path, [], T1)
    with pytest.raises(pipeline.DeleteRatioError):
        pipeline.process_cut(spark, store, empty, max_delete_ratio=0.5)
    assert store.live().count() == 2
    failed = store.failures().collect()
    assert [(r["cut_label"], r["status"]) for r in failed] == [("T1", "FAILED")]
    assert failed[0]["error"].startswith("DeleteRatioError: ")
    assert counts(pipeline.process_cut(spark, store, empty)) == (0, 0, 0, 0, 0, 2, 0)


def test_missing_file_missing_column_incomplete_cut(spark, store, tmp_path):
    with pytest.raises(AnalysisException):
        pipeline.process_cut(spark, store, Cut("T", str(tmp_path / "none.parquet"), T.cut_date))
    spark.range(1).write.parquet(str(tmp_path / "odd.parquet"))
    with pytest.raises(AnalysisException):
        pipeline.process_cut(spark, store, Cut("T", str(tmp_path / "odd.parquet"), T.cut_date))
    with pytest.raises(ValueError):
        Cut("", "x", T.cut_date)
    assert store.head().commit == 0


def test_rebuild_equals_cut_by_cut(spark, store, tmp_path):
    cuts = [write_cut(spark, tmp_path, r, c) for c, r in
            [(T, FIRST), (T1, SECOND), (T2, [row("A"), row("B", fund="")])]]
    done = pipeline.run_cuts(spark, store, cuts)
    folded, log = compared(store.history()), compared(store.change_log().drop("run_id", "ts"))
    rebuilt = pipeline.run_cuts(spark, store, cuts, in_one_pass=True)
    assert [counts(r) for r in done] == [counts(r) for r in rebuilt]
    assert compared(store.history()) == folded
    assert compared(store.change_log().drop("run_id", "ts")) == log
    assert store.quarantine().count() == 2
    assert store.head().lineage == (4,)
    assert pipeline.process_cut(spark, store, cuts[-1]) is None
    with pytest.raises(source.OutOfOrderError):
        pipeline.process_cut(spark, store, write_cut(spark, tmp_path, [row()], T2))


def test_reset_starts_over(spark, store, tmp_path):
    cuts = [write_cut(spark, tmp_path, FIRST, T), write_cut(spark, tmp_path, SECOND, T1)]
    pipeline.run_cuts(spark, store, cuts)
    pipeline.run_cuts(spark, store, cuts, reset=True)
    assert store.head().lineage == (3, 4)
    assert store.history().count() == 5


def test_heavy_keys_in_the_store(spark, store, tmp_path):
    """Heavy in the first cut, absent from the second; every cut is numbered in slices."""
    hot = [row("HOT", amount=float(n % 7)) for n in range(300)]
    first = write_cut(spark, tmp_path, [*hot, row("A")], T)
    second = write_cut(spark, tmp_path, [row("A", amount=1.0)], T1)
    plain = Store(spark, str(tmp_path / "plain"), MOVEMENTS)
    for cut in (first, second):
        pipeline.process_cut(spark, plain, cut)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pipeline.process_cut(spark, store, first)
        b = pipeline.process_cut(spark, store, second)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert counts(b) == (1, 1, 0, 0, 1, 300, 0)
    assert compared(plain.history()) == compared(store.history())


def test_as_of_from_the_store_skips_older_commits(spark, store, tmp_path):
    for cut, rows in [(T, FIRST), (T1, SECOND), (T2, [row("A")])]:
        pipeline.process_cut(spark, store, write_cut(spark, tmp_path, rows, cut))
    for cut, n in [(T, 2), (T1, 2), (T2, 1)]:
        assert store.as_of(cut.cut_date).count() == n
        assert compared(store.as_of(cut.cut_date)) == compared(
            history.as_of(store.history(), cut.cut_date))


MONTHS = [Cut(f"M{n}", f"m{n}", date(2024, n, 28)) for n in range(1, 6)]


def spoil(store, month):
    """Makes the files of versions that ended in a month unreadable."""
    for file in Path(store.root).glob(f"versions/commit=*/part=closed/until={month}/part-*"):
        file.write_bytes(b"no longer parquet")


@pytest.mark.parametrize("in_one_pass", [False, True])
def test_reads_by_date_open_only_the_months_from_then_on(spark, store, tmp_path, in_one_pass):
    cuts = [write_cut(spark, tmp_path, [row("A", amount=float(n)), row("B")], cut)
            for n, cut in enumerate(MONTHS)]
    if in_one_pass:
        pipeline.rebuild(spark, store, cuts)
    else:
        for cut in cuts:
            pipeline.process_cut(spark, store, cut)
    months = sorted(p.name for p in Path(store.root).glob("versions/*/part=closed/until=*"))
    assert months == [f"until=2024-{n:02}" for n in range(2, 6)]
    between = store.history_between(date(2024, 2, 28), date(2024, 3, 28))
    assert sorted(r["valid_from"].month for r in between.collect()) == [1, 2, 3]
    days = [date(2024, 2, 28), date(2024, 3, 1), date(2024, 4, 28), date(2025, 1, 1)]
    expected = [compared(history.as_of(store.history(), day)) for day in days]
    for day, rows in zip(days, expected):
        for month in (m for m in range(2, 6) if f"2024-{m:02}" < f"{day:%Y-%m}"):
            spoil(store, f"2024-{month:02}")
        assert compared(store.as_of(day)) == rows
    with pytest.raises(Exception, match="parquet|PARQUET|CANNOT_READ|Checksum"):
        store.history().collect()


def test_versions_that_ended_on_the_first_day_or_opened_on_the_last(spark, store, tmp_path):
    for cut, rows in [(T, FIRST), (T1, SECOND), (T2, [row("A")])]:
        pipeline.process_cut(spark, store, write_cut(spark, tmp_path, rows, cut))
    got = store.history_between(T1.cut_date, T2.cut_date)
    assert compared(got) == compared(store.history().filter(
        F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(T1.cut_date))))
    assert store.history_between(T.cut_date, T.cut_date).filter(
        F.col("valid_from") != F.lit(T.cut_date)).isEmpty()


def test_an_untouched_store_has_every_table(spark, store):
    assert {r["rows"] for r in store.table_sizes().collect()} == {0}


def test_dropping_old_open_versions_keeps_the_history(spark, store, tmp_path):
    for cut, rows in [(T, FIRST), (T1, SECOND), (T2, [row("A")])]:
        pipeline.process_cut(spark, store, write_cut(spark, tmp_path, rows, cut))
    before = compared(store.history())
    assert store.drop_old_open_versions() == [1]
    assert compared(store.history()) == before


def test_the_base_of_a_replaced_date_cannot_be_dropped(spark, store):
    with pytest.raises(ValueError):
        store.drop_old_open_versions(keep=1)


def test_a_refused_cut_leaves_no_quarantined_rows(spark, store, tmp_path):
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, FIRST, T))
    bad = [row("A"), row(client=" "), row(client="")]
    with pytest.raises(pipeline.DeleteRatioError):
        pipeline.process_cut(spark, store, write_cut(spark, tmp_path, bad, T1),
                             max_delete_ratio=0.0)
    record = pipeline.process_cut(spark, store, write_cut(spark, tmp_path, SECOND, T1))
    assert record["rows_quarantined"] == 0
    assert {r["_cut_label"] for r in store.quarantine().collect()} == {"T"}


def test_a_crash_while_publishing_does_not_lock_the_store(spark, store, tmp_path):
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, FIRST, T))
    files, folder = store._folder("attempts", "crashed", "_temporary")
    files.mkdirs(folder)
    files.mkdirs(store._folder("ledger", "00000002", "_temporary")[1])
    assert pipeline.process_cut(spark, store, write_cut(spark, tmp_path, SECOND, T1))
    assert store.head().commit == 2
    with pytest.raises(FileExistsError):
        store.publish([{**store.ledger().orderBy("commit").first().asDict()}])


def test_a_cut_may_be_a_folder_of_files(spark, store, tmp_path):
    folder = str(tmp_path / "parts.parquet")
    rows = [row(f"C{n % 5}", amount=float(n)) for n in range(40)]
    cut = write_cut(spark, tmp_path, rows, T)
    spark.read.parquet(cut.path).repartition(3).write.parquet(folder)
    record = pipeline.process_cut(spark, store, Cut("T", folder, T.cut_date))
    assert counts(record) == (40, 40, 0, 40, 0, 0, 0)
    assert store.raw().groupBy("_source_file", "_row_num").count().filter("count > 1").count() == 0


def test_gate_stops_on_a_damaged_history(spark, store, tmp_path):
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, FIRST, T))
    live = store.open_versions()
    damaged = live.unionByName(live)
    tables = reports.checked_tables(damaged, store.change_log())
    with pytest.raises(quality.QualityGateError, match="one_open_version"):
        quality.gate(quality.run_suite(tables, quality.MOVEMENTS_SUITE))


def test_insights_and_export(spark, store, tmp_path):
    accents = [row("Ñandú", product="Acción", amount=None), row("B", amount=2.0)]
    pipeline.run_cuts(spark, store, [write_cut(spark, tmp_path, accents, T)])
    results = reports.store_insights(store)
    assert list(results) == ["cdc_por_corte", "estado_vigente", "flujo_por_producto", "por_tipo",
                             "calidad_vigente", "cuarentena_total", "top_clientes"]
    paths = reports.export_insights(results, str(tmp_path / "out"))
    lines = sorted(r[0] for r in spark.read.text(paths["flujo_por_producto"]).collect())
    assert lines == [
        '{"product":"ACCIÓN","n_movimientos":1,"flujo_neto":null,"total_entradas":null,'
        '"total_salidas":null}',
        '{"product":"ETF","n_movimientos":1,"flujo_neto":2.0,"total_entradas":2.0,'
        '"total_salidas":null}']
    assert spark.table("movimientos_vigentes").count() == 2
    assert tuple(marts.run_summary(store.history(), store.quarantine()).first()) == (2, 0, 2, 2, 0)


# Rows, quarantined, staged, new, changed, deleted, unchanged per cut at sf0.001.
GOLDEN = [(800, 799, 1, 799, 0, 0, 0), (750, 749, 1, 149, 53, 199, 547),
          (833, 831, 2, 249, 5, 167, 577)]


def test_fixture_counts(spark, store):
    cuts = demo.write_cuts(spark, "/root/testdata/sf0.001")
    assert [counts(pipeline.process_cut(spark, store, c)) for c in cuts] == GOLDEN
    state = marts.state_summary(store.history()).first()
    assert tuple(state) == (831, 167, 1621, 15)
    assert tuple(marts.quality_profile(store.live()).first()) == (831, 30, 15, 19, 47, 333)


def test_another_table_has_its_own_marts_and_gate(spark, tmp_path):
    orders = Store(spark, str(tmp_path / "orders"), demo.ORDERS)
    columns = demo.ORDERS.source.simpleString()[7:-1].replace(":", " ")
    days = [[(1, 7, "O", 10.5, "H"), (2, 7, "F", 4e-7, "L")],
            [(1, 7, "F", 10.5, "H"), (3, 8, "F", float("nan"), "L")],
            [(1, 7, "F", 11.5, "H"), (4, 8, "O", 2.0, "L")]]
    for n, (cut, rows) in enumerate(zip((T, T1, T2), days)):
        path = str(tmp_path / f"day{n}")
        spark.createDataFrame(rows, columns).write.parquet(path)
        pipeline.run_cuts(spark, orders, [Cut(cut.label, path, cut.cut_date)])
        fresh = marts.flow(orders.live(), demo.ORDERS.marts[0])
        assert set(map(str, orders.mart("orders_by_status").collect())) == set(
            map(str, fresh.collect()))


def test_marts_of_a_failed_gate_are_not_shown(spark, store, tmp_path, monkeypatch):
    pipeline.run_cuts(spark, store, [write_cut(spark, tmp_path, FIRST, T)])
    before = store.mart("flujo_por_producto").collect()
    with monkeypatch.context() as m:
        m.setattr(quality, "suite", lambda spec: [quality.Accepted("live", "product", ("X",))])
        with pytest.raises(quality.QualityGateError):
            pipeline.run_cuts(spark, store, [write_cut(spark, tmp_path, SECOND, T1)])
    assert store.mart("flujo_por_producto").collect() == before
    reports.build_and_check(store)
    assert store.mart("flujo_por_producto").collect() == marts.flow_by_product(
        store.live()).collect() != before

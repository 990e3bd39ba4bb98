import pytest
from conftest import T, T1, T2, compared, row, write_cut
from pyspark.errors import StreamingQueryException

from tidemark.model import MOVEMENTS, Cut
from tidemark.plans import pipeline
from tidemark.sources import cuts as source
from tidemark.sources.store import Store
from tidemark.streaming import cuts as streaming
from tidemark.streaming.cuts import stream_cuts


def test_cuts_are_processed_in_date_order_and_only_once(spark, tmp_path):
    cuts = [write_cut(spark, tmp_path, rows, c) for c, rows in
            [(T, [row("A"), row("B")]), (T1, [row("A", amount=2.0)]), (T2, [row("B")])]]
    store = Store(spark, str(tmp_path / "streamed"), MOVEMENTS)
    folder, marks = str(tmp_path / "manifest"), str(tmp_path / "marks")
    source.manifest(spark, [cuts[1], cuts[0]]).write.json(folder)
    stream_cuts(spark, store, folder, marks).awaitTermination()
    source.manifest(spark, [cuts[2]]).write.mode("append").json(folder)
    stream_cuts(spark, store, folder, marks).awaitTermination()
    stream_cuts(spark, store, folder, marks).awaitTermination()
    assert [r["cut_label"] for r in store.ledger().orderBy("commit").collect()] == [
        "T", "T1", "T2"]
    direct = Store(spark, str(tmp_path / "direct"), MOVEMENTS)
    pipeline.run_cuts(spark, direct, cuts)
    assert compared(store.history()) == compared(direct.history())


def three_cuts(spark, folder):
    return [write_cut(spark, folder, rows, c) for c, rows in
            [(T, [row("A"), row("B")]), (T1, [row("A", amount=2.0)]), (T2, [row("B"), row("C")])]]


def test_a_batch_handed_over_again_after_a_crash(spark, tmp_path, monkeypatch):
    """The stream breaks off after all cuts of a batch are published and before its checkpoint."""
    cuts = three_cuts(spark, tmp_path)
    store = Store(spark, str(tmp_path / "streamed"), MOVEMENTS)
    folder, marks = str(tmp_path / "manifest"), str(tmp_path / "marks")
    source.manifest(spark, cuts).write.json(folder)
    process, calls = streaming.process_manifest, []

    def crashing(spark, store, rows, stream, batch, **options):
        calls.append((stream, batch))
        process(spark, store, rows, stream, batch, **options)
        if len(calls) == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(streaming, "process_manifest", crashing)
    with pytest.raises(StreamingQueryException):
        stream_cuts(spark, store, folder, marks).awaitTermination()
    before, records = compared(store.history()), store.records().collect()
    assert len(records) == 3 and calls[0][0] != marks  # the stream's own name
    monkeypatch.setattr(pipeline, "land", None)  # nothing is read again
    stream_cuts(spark, store, folder, marks).awaitTermination()
    assert calls[1] == calls[0]
    assert compared(store.history()) == before and store.records().collect() == records
    assert store.failures().count() == 0


def test_a_crash_between_two_cuts_of_a_batch(spark, tmp_path):
    cuts = three_cuts(spark, tmp_path)
    store = Store(spark, str(tmp_path / "store"), MOVEMENTS)
    streaming.process_manifest(spark, store, source.manifest(spark, cuts[:2]), "s", 4)
    streaming.process_manifest(spark, store, source.manifest(spark, cuts), "s", 4)
    direct = Store(spark, str(tmp_path / "direct"), MOVEMENTS)
    pipeline.run_cuts(spark, direct, cuts)
    assert compared(store.history()) == compared(direct.history())
    assert [(r["stream"], r["batch"]) for r in store.records().collect()] == [("s", 4)] * 3


def test_a_late_cut_is_recorded_once_and_stops_nothing(spark, tmp_path):
    cuts = three_cuts(spark, tmp_path)
    store = Store(spark, str(tmp_path / "store"), MOVEMENTS)
    folder, marks = str(tmp_path / "manifest"), str(tmp_path / "marks")
    source.manifest(spark, cuts[1:2]).write.json(folder)
    stream_cuts(spark, store, folder, marks).awaitTermination()
    source.manifest(spark, [cuts[0], cuts[2]]).write.mode("append").json(folder)
    stream_cuts(spark, store, folder, marks).awaitTermination()
    assert {r["cut_label"] for r in store.ledger().collect()} == {"T1", "T2"}
    [late] = store.failures().collect()
    assert (late["cut_label"], late["status"]) == ("T", "REFUSED")
    streaming.process_manifest(spark, store, source.manifest(spark, cuts[:1]), late["stream"],
                               late["batch"])
    assert store.failures().count() == 1


def test_a_date_replaced_within_a_batch_stays_replaced(spark, tmp_path):
    """The replaced cut's record is no longer visible, yet its cut is known as finished."""
    first, second, _ = three_cuts(spark, tmp_path)
    fixed = write_cut(spark, tmp_path, [row("A", amount=9.0)], Cut("Z", "z", T1.cut_date))
    store = Store(spark, str(tmp_path / "store"), MOVEMENTS)
    for _ in range(2):
        streaming.process_manifest(
            spark, store, source.manifest(spark, [first, second, fixed]), "s", 0)
        assert [r["amount"] for r in store.live().collect()] == [9.0]
    assert store.records().count() == 3

"""Shuffles that follow the rows, not the session: same results, small tasks, light rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import CUTS, T, T1, compared, raw, row, valid, write_cut
from tidemark.functions.hashing import multiset_checksum
from tidemark.model import MOVEMENTS
from tidemark.operators import history, keys, merge
from tidemark.plans import demo, pipeline
from tidemark.session import WRITERS, unsorted_folders
from tidemark.sources.store import Store


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def days() -> list[list[tuple]]:
    first = [row(f"C{n % 7}", amount=float(n)) for n in range(60)]
    second = [row(f"C{n % 7}", amount=float(n + n % 2)) for n in range(20, 80)]
    return [first, second, first[:40]]


def test_tasks_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert keys.tasks_for(spark, 0) is None
    assert keys.tasks_for(spark, cores * keys.TASK_ROWS) is None
    assert keys.tasks_for(spark, 500 * keys.TASK_ROWS + 1) == 501


@pytest.mark.parametrize("task_rows", [1_000_000, 2])
def test_a_store_is_the_same_whatever_its_tasks_hold(spark, tmp_path, monkeypatch, task_rows):
    cuts = [write_cut(spark, tmp_path, rows, cut) for rows, cut in zip(days(), CUTS)]
    few = Store(spark, str(tmp_path / "few"), MOVEMENTS)
    for cut in cuts:
        pipeline.process_cut(spark, few, cut)
    monkeypatch.setattr(keys, "TASK_ROWS", task_rows)
    many, bulk = [Store(spark, str(tmp_path / name), MOVEMENTS) for name in ("many", "bulk")]
    for cut in cuts:
        pipeline.process_cut(spark, many, cut)
    pipeline.process_cut(spark, bulk, cuts[0])
    pipeline.extend(spark, bulk, cuts[1:])
    assert compared(many.history()) == compared(few.history()) == compared(bulk.history())


def test_the_merge_has_as_many_tasks_as_asked_and_no_further_shuffle(spark):
    rows = valid(spark, days()[0])
    live = merge.no_versions(rows, MOVEMENTS)
    staged = keys.assign_keys(rows, MOVEMENTS, 6, by_key=True)
    plan = physical(merge.classify(live, staged, 6).select("movement_key", "action"))
    assert "ENSURE_REQUIREMENTS" not in [
        line for line in plan.splitlines() if "hashpartitioning(movement_key" in line]
    assert plan.count("hashpartitioning(md5(") == 1  # by key, before the key is a column


def test_numbering_shuffles_the_cleaned_row_only(spark):
    """No text of a hash, no measure and no flag is in the slices."""
    plan = physical(keys.assign_keys(valid(spark, days()[0]), MOVEMENTS, 3))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "_row_num" in line]
    assert scans
    for name in ("business_key_hash", "attr_hash", "signed_amount", "dq_amount_null"):
        assert not any(name in line for line in scans)


def test_bulk_history_spreads_by_key_once(spark):
    rows = valid(spark, days()[0]).unionByName(valid(spark, days()[1], T1))
    plan = physical(history.bulk_history(rows, MOVEMENTS, [T, T1], 5))
    assert plan.count("hashpartitioning(md5(") == 1
    assert "hashpartitioning(movement_key" not in plan


def test_versions_and_log_are_packed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), MOVEMENTS)
    pipeline.process_cut(spark, store, write_cut(spark, tmp_path, days()[0], T))
    for table in ("raw", "versions", "change_log"):
        files = [p.name for p in (tmp_path / "store" / table).rglob("part-*.parquet")]
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_writing_by_folder_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(WRITERS)
    with pytest.raises(KeyError), unsorted_folders(spark):
        assert spark.conf.get(WRITERS) == "8"
        raise KeyError
    assert spark.conf.get(WRITERS) == before


def test_checksum_adds_whole_32_bit_parts(spark):
    """The parts of the largest hash, of the smallest, and of no rows."""
    top = spark.range(3).select(multiset_checksum(F.lit("f" * 32)).alias("c")).first()["c"]
    assert top == ":".join([str(3 * (2**32 - 1))] * 4)
    mixed = spark.createDataFrame([("0" * 31 + "1",), ("8" + "0" * 31,), (None,)], "h string")
    assert mixed.agg(multiset_checksum(F.col("h"))).first()[0] == f"{8 << 28}:0:0:1"
    assert mixed.filter("false").agg(multiset_checksum(F.col("h"))).first()[0] == "0:0:0:0"


def test_the_bound_on_open_versions_covers_them(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), MOVEMENTS)
    assert store.open_at_most() == 0
    for rows, cut in zip(days(), CUTS):
        pipeline.process_cut(spark, store, write_cut(spark, tmp_path, rows, cut))
        assert store.open_at_most() >= store.open_versions().count()


def test_probes_are_not_shuffled_again_for_the_join(spark, tmp_path, monkeypatch):
    """Days are added behind the shuffle that makes the keys distinct; the join needs no other."""
    store = Store(spark, str(tmp_path / "store"), MOVEMENTS)
    for rows, cut in zip(days()[:2], CUTS):
        pipeline.process_cut(spark, store, write_cut(spark, tmp_path, rows, cut))
    monkeypatch.setattr(demo, "published", lambda *_: store)
    wanted = [T.cut_date, T1.cut_date]
    probes = demo.probes(spark, "unused", wanted)
    keys_there = {r[0] for r in store.history().select("movement_key").collect()}
    assert sorted(map(tuple, probes.collect())) == sorted(
        (k, d) for k in {*keys_there, "none"} for d in wanted)
    versions = store.history().hint("merge")
    plan = physical(history.as_of_join(probes, versions))
    assert plan.count("Exchange hashpartitioning(movement_key") == 1  # the distinct keys'

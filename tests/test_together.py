"""A cut meets the open versions by one shuffle on the business key, whatever a key holds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import CUTS, T, T1, compared, row, staged, valid, write_cut
from tidemark.model import MOVEMENTS
from tidemark.operators import history, keys, merge
from tidemark.plans import pipeline
from tidemark.sources.store import Store

DAYS = [
    [row("A"), row("A", amount=5.0), row("A", amount=5.0), row("B", description=None), row("C")],
    [row("A", amount=5.0), row("B", description="x"), row("D", amount=None)],
    [row("A", amount=7.0), row("A"), row("A"), row("A"), row("C"), row("D", amount=0.0)],
]


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def flat(classified):
    fields = [F.col(f"new.{c}").alias(f"new_{c}") for c in MOVEMENTS.row_columns]
    fields += [F.col(f"old.{c}").alias(f"old_{c}") for c in MOVEMENTS.version_schema.fieldNames()
               if c != "load_ts"]
    return sorted(map(str, classified.select("movement_key", "action", "closes", *fields).collect()))


@pytest.mark.parametrize("task_rows", [100_000, 2, 0])
def test_compare_gives_what_classify_gives(spark, monkeypatch, task_rows):
    """Keys that repeat, come back, and crowd a task or not; every column of both sides."""
    live = merge.no_versions(valid(spark, DAYS[0]), MOVEMENTS)
    for rows, cut in zip(DAYS, CUTS):
        expected = merge.classify(live, staged(spark, rows, cut))
        monkeypatch.setattr(keys, "TASK_ROWS", task_rows)
        assert flat(merge.compare(live, valid(spark, rows, cut), MOVEMENTS, 3)) == flat(expected)
        live = merge.open_versions(merge.versions(expected, MOVEMENTS, cut).checkpoint(), MOVEMENTS)


def test_cut_and_open_versions_are_shuffled_once(spark):
    rows = valid(spark, DAYS[0])
    live = merge.open_versions(merge.merge(
        merge.no_versions(rows, MOVEMENTS), staged(spark, DAYS[0]), MOVEMENTS, T).checkpoint(),
        MOVEMENTS)
    assert shuffles(merge.compare(live, valid(spark, DAYS[1], T1), MOVEMENTS, 6)) == 1
    both = rows.unionByName(valid(spark, DAYS[1], T1))
    assert shuffles(history.bulk_history(both, MOVEMENTS, [T, T1], 5)) == 1


def test_only_crowded_keys_are_set_apart(spark, monkeypatch):
    monkeypatch.setattr(keys, "TASK_ROWS", 3)
    table = spark.createDataFrame([("heavy",)] * 4 + [(f"k{n}",) for n in range(4)], "k string")
    others, crowded = keys.find_crowded(None, table).parts(table, F.col("k"))
    assert {r["k"] for r in crowded.collect()} == {"heavy"} and others.count() == 4
    assert keys.find_crowded(None, others).parts(others, F.col("k"))[1] is None
    # rows of both tables count
    halves = table.limit(0).unionByName(spark.createDataFrame([("k",), ("k",)], "k string"))
    assert keys.find_crowded(None, halves, halves).found


def test_one_pass_equals_the_fold_where_keys_crowd(spark, tmp_path, monkeypatch):
    cuts = [write_cut(spark, tmp_path, rows, cut) for rows, cut in zip(DAYS, CUTS)]
    fold, bulk = [Store(spark, str(tmp_path / name), MOVEMENTS) for name in ("fold", "bulk")]
    for cut in cuts:
        pipeline.process_cut(spark, fold, cut)
    monkeypatch.setattr(keys, "TASK_ROWS", 4)
    pipeline.rebuild(spark, bulk, cuts)
    assert compared(bulk.history()) == compared(fold.history())

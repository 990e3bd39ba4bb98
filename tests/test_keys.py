import random

import pytest
from conftest import normalized, row, staged, valid
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.model import MOVEMENTS
from tidemark.operators import keys, ranking
from tidemark.plans import demo


def test_collisions_are_numbered_by_attributes_with_nulls_last_then_position(spark):
    rows = [row(amount=None), row(amount=20.0), row(amount=10.0, description=None),
            row(amount=10.0, description="b"), row(amount=10.0, description="b")]
    df = keys.assign_keys(valid(spark, rows), MOVEMENTS)
    got = df.orderBy("occurrence_seq").select(
        "occurrence_seq", "amount", "description").collect()
    assert [tuple(r) for r in got] == [
        (1, 10.0, "B"), (2, 10.0, "B"), (3, 10.0, None), (4, 20.0, "D"), (5, None, "D")]
    assert df.select("movement_key").distinct().count() == 5
    assert df.select("business_key_hash").distinct().count() == 1


def test_dirty_spellings_have_one_identity(spark):
    rows = [row(" c1", "01/01/2024", "etf ", "IN", "f1"), row()]
    assert staged(spark, rows).select("business_key_hash").distinct().count() == 1


def test_occurrence_restarts_in_every_cut(spark):
    from conftest import T1
    both = valid(spark, [row(), row()]).unionByName(valid(spark, [row()], T1))
    got = keys.assign_keys(both, MOVEMENTS).groupBy("_cut_label").agg(
        F.max("occurrence_seq").alias("n")).collect()
    assert {r["_cut_label"]: r["n"] for r in got} == {"T": 2, "T1": 1}


def _skewed(n=3000):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        client = "HOT" if i % 3 else f"C{rnd.randrange(400)}"
        rows.append(row(client, amount=rnd.choice([None, 1.0, 2.0, float(i % 50)]),
                        description=rnd.choice([None, "a", "b"]),
                        name=rnd.choice([None, "x"])))
    return rows


def _plain(df, partition, order, name):
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))


@pytest.mark.parametrize("slices", [None, 1, 7, 40])
@pytest.mark.parametrize("same", [False, True])
def test_slices_give_the_same_numbers_as_a_plain_window(spark, same, slices):
    rows = [row() for _ in range(2000)] if same else _skewed()
    df = keys.with_hashes(valid(spark, rows), MOVEMENTS)
    partition, order = ["_cut_date", "business_key_hash"], keys.occurrence_order(MOVEMENTS)
    plain = _plain(df, partition, order, "n")
    sliced = ranking.number_rows(df, partition, order, "n", slices)
    assert sliced.schema["n"] == plain.schema["n"]
    cols = ["_row_num", "business_key_hash", "n"]
    assert sorted(plain.select(cols).collect()) == sorted(sliced.select(cols).collect())


def test_groups_may_be_null_and_tables_empty(spark):
    df = spark.createDataFrame([(None if i % 3 else 0, None if i % 7 else 1.0, i)
                                for i in range(300)], "g int, h double, i int")
    order = [F.col("i")]
    for rows in (df, df.limit(0)):
        got = ranking.number_rows(rows, ["g", "h"], order, "n", 9)
        assert sorted(map(str, got.collect())) == sorted(
            map(str, _plain(rows, ["g", "h"], order, "n").collect()))


@pytest.mark.parametrize("share", [2, 2000])
def test_no_slice_holds_a_whole_group(spark, share):
    """One key with half of the rows, and one with a two-thousandth of them."""
    total, slices = 40_000, 4_000 if share == 2000 else 20
    df = spark.range(total).select(
        F.when(F.col("id") % share == 0, -1).otherwise(F.col("id")).alias("g"), "id")
    sliced = ranking.sliced_rows(df, ["g"], [F.col("id")], slices)
    hot = sliced.filter("g = -1").groupBy("_slice").count()
    assert hot.count() > 1
    assert sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] < 4 * total / slices + 10
    assert ranking.rows_before(sliced, ["g"]).count() <= 2 * slices
    numbered = ranking.number_rows(df, ["g"], [F.col("id")], "n", slices)
    assert numbered.filter("g = -1 AND n <> id / %d + 1" % share).count() == 0
    assert numbered.count() == total


def test_numbering_has_one_shuffle_of_whole_rows_after_slicing(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id", "repeat('x', 50) AS wide")
    plan = ranking.number_rows(df, ["g"], [F.col("id")], "n", 5)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning(g") == 1
    assert "SortMergeJoin" not in physical


def test_a_repeated_key_stops_the_job(spark):
    df = staged(spark, [row(), row("C2")])
    assert keys.require_unique(df, ["movement_key"]).count() == 2
    doubled = df.unionByName(df.filter("id_cliente = 'C2'"))
    with pytest.raises(PySparkException, match="not unique"):
        keys.require_unique(doubled, ["movement_key"]).collect()
    got = keys.duplicate_keys(doubled).first()
    assert got["duplicates"] == 1


def test_a_natural_key_needs_no_occurrence(spark):
    rows = spark.createDataFrame(
        [(1, 5, "O", 1.0, "p"), (2, 5, "O", 1.0, "p")], demo.ORDERS.source)
    rows = rows.selectExpr("*", "'f' AS _source_file", "'T' AS _cut_label",
                           "DATE'2024-11-01' AS _cut_date", "o_orderkey AS _row_num",
                           "current_timestamp() AS _load_ts")
    got = keys.assign_keys(rows, demo.ORDERS)
    assert got.filter("movement_key <> business_key_hash OR occurrence_seq <> 1").count() == 0


def test_normalised_rows_keep_their_lineage(spark):
    assert {"_cut_label", "_cut_date", "_source_file", "_row_num", "_load_ts"} <= set(
        normalized(spark, [row()]).columns)

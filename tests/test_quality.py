from datetime import date

import pytest

from tidemark.functions.money import exact_sum
from tidemark.model import Mart, Total
from tidemark.operators import marts, quality
from pyspark.sql import functions as F


def test_the_suite_has_all_assertions():
    kinds = [type(a).__name__ for a in quality.MOVEMENTS_SUITE]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "NotNull": 16, "Accepted": 4, "Unique": 3, "OneOpenVersion": 1, "OneVersionPerCut": 1,
        "CoherentValidity": 1}


def test_each_assertion_finds_its_violation(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('k1', 'x', true, DATE'2024-01-01', CAST(NULL AS DATE)),
        ('k1', 'x', true, DATE'2024-01-01', DATE'2024-01-02'),
        ('k2', 'y', false, DATE'2024-01-01', CAST(NULL AS DATE)),
        (NULL, 'z', false, DATE'2024-01-01', DATE'2024-01-02')
        AS t(movement_key, type, is_current, valid_from, valid_to)""")
    suite = [quality.NotNull("t", "movement_key"), quality.Accepted("t", "type", ("x",)),
             quality.Unique("t", "movement_key"), quality.OneOpenVersion("t"),
             quality.OneVersionPerCut("t"), quality.CoherentValidity("t"),
             quality.Fresh("t", "valid_from", date(2024, 1, 3), 1),
             quality.Fresh("t", "valid_from", date(2024, 1, 2), 1)]
    got = {r["assertion"]: r["violations"] for r in
           quality.run_suite({"t": df}, suite[:-1]).collect()}
    assert got == {
        "not_null_t_movement_key": 1, "accepted_values_t_type": 2, "unique_t_movement_key": 1,
        "one_open_version_t": 1, "one_version_per_cut_t": 1, "coherent_validity_t": 2,
        "fresh_t_valid_from": 1}
    quality.gate(quality.run_suite({"t": df}, suite[-1:]))
    with pytest.raises(quality.QualityGateError):
        quality.gate(quality.run_suite({"t": df}, suite[:1]))
    with pytest.raises(ValueError):
        quality.run_suite({"t": df}, [quality.NotNull("u", "x")])


def test_null_is_not_an_unaccepted_value(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS c")
    assert quality.unexpected_values(df, "c", ("a",)).count() == 0


def test_sums_do_not_depend_on_order_and_lose_nothing(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1e15,), (-1e15,)], "v double")
    assert df.select(exact_sum(F.col("v"))).first()[0] == 1.0
    assert df.repartition(7).select(exact_sum(F.col("v"))).first()[0] == 1.0
    odd = spark.createDataFrame([(1e300,), (1.0,), (None,)], "v double")
    assert odd.select(exact_sum(F.col("v"))).first()[0] == 1e300
    empty = spark.createDataFrame([(None,)], "v double")
    assert empty.select(exact_sum(F.col("v"))).first()[0] is None


@pytest.mark.parametrize("values, expected", [
    ([4e-7, 4e-7], 8e-7), ([1e22, 1.0, -1e22], 1.0), ([1e23, 0.25], 1e23),
    ([float("nan"), 1.0], float("nan")), ([float("inf"), 1.0], float("inf")),
    ([float("inf"), float("-inf")], float("nan")), ([-0.1, -0.2], -0.3),
    ([1e-30, 1e-30], 2e-30), ([1e18, 0.5, -1e18], 0.5), ([-0.0], 0.0), ([-0.01, 0.02], 0.01),
    ([999999999.99] * 3, 2999999999.97), ([1e9, 0.005, -1e9, -0.01], -0.005),
    ([-10485.76, 10485.75, -10485.77], -10485.78)])
def test_no_amount_is_rounded_or_left_out(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(exact_sum(F.col("v"))).first()[0]
    assert got == expected or got != got and expected != expected


def test_rows_can_be_taken_back_from_a_sum(spark):
    mart = Mart("m", "k", (Total("t", "v"),))
    odd = [(k, v) for k, v in enumerate([float("nan"), float("inf"), 1e300, 1e-30, 4e-7])]
    rows = spark.createDataFrame([(k, w) for k, v in odd for w in (v, 0.1, 0.2)], "k int, v double")
    gone = spark.createDataFrame(odd, "k int, v double")
    left = marts.add_flow(marts.flow_state(rows, mart), marts.flow_state(gone, mart, F.lit(-1)), mart)
    assert [r["t"] for r in marts.finish_flow(left, mart).collect()] == [0.3] * 5

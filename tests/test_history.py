import random
from datetime import date

import pytest
from conftest import CUTS, compared, row, valid
from test_merge import run

from tidemark.model import FLOW_BY_PRODUCT, MOVEMENTS
from tidemark.operators import history, marts, merge, quality


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))


def random_cuts(seed, clients=6):
    rnd = random.Random(seed)
    return [(cut, [row(f"C{rnd.randrange(clients)}", product=rnd.choice(["ETF", "CDT"]),
                       kind=rnd.choice(["in", "salida"]), amount=rnd.choice([1.0, 2.0, None]),
                       description=rnd.choice(["a", None]))
                   for _ in range(rnd.randrange(2, 25))]) for cut in CUTS]


def bulk(spark, steps, **options):
    rows = None
    for cut, r in steps:
        part = valid(spark, r, cut)
        rows = part if rows is None else rows.unionByName(part)
    return history.bulk_history(rows, MOVEMENTS, CUTS, **options)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_pass_equals_cut_by_cut(spark, seed):
    steps = random_cuts(seed)
    folded, counts = run(spark, steps)
    one_pass = bulk(spark, steps)
    assert compared(folded) == compared(one_pass)
    live = 0
    for (_, rows), (new, changed, deleted, unchanged) in zip(steps, counts):
        assert len(rows) == new + changed + unchanged
        assert live == changed + unchanged + deleted
        live = len(rows)
    assert quality.several_open(folded).count() == 0
    assert quality.several_per_cut(folded).count() == 0
    assert quality.incoherent_validity(folded).count() == 0


def test_one_pass_in_slices(spark):
    steps = random_cuts(4, clients=2)
    assert compared(bulk(spark, steps)) == compared(bulk(spark, steps, slices=9))


def test_a_cut_without_rows_counts_as_a_cut(spark):
    steps = [(CUTS[0], [row("A")]), (CUTS[1], []), (CUTS[2], [row("A")]), (CUTS[3], [row("A")])]
    folded, _ = run(spark, steps)
    assert compared(folded) == compared(bulk(spark, steps))
    assert folded.count() == 3


def test_two_cuts_on_one_date_are_refused(spark):
    with pytest.raises(ValueError):
        history.calendar(spark, [CUTS[0], CUTS[0]])


def test_as_of(spark):
    steps = random_cuts(5)
    h = bulk(spark, steps)
    for cut, rows in steps:
        assert history.as_of(h, cut.cut_date).count() == len(rows)
    assert history.as_of(h, date(2024, 10, 1)).count() == 0
    assert history.as_of(h, date(2024, 11, 4)).count() == len(steps[2][1])
    days = [c.cut_date for c in CUTS] + [date(2024, 11, 4)]
    many = {r["as_of_date"]: r["count"]
            for r in history.as_of_many(h, days).groupBy("as_of_date").count().collect()}
    assert many == {d: history.as_of(h, d).count() for d in days}


def test_version_ids_are_unique_and_repeatable(spark):
    h = bulk(spark, random_cuts(6))
    ids = [r[0] for r in history.with_version_id(h).select("version_id").collect()]
    again = [r[0] for r in history.with_version_id(h).select("version_id").collect()]
    assert len(set(ids)) == len(ids) and sorted(ids) == sorted(again)


def test_incremental_mart_equals_recomputed_mart(spark):
    live, state = None, None
    from conftest import staged
    from pyspark.sql import functions as F
    for cut, rows in random_cuts(7):
        s = staged(spark, rows, cut)
        live = merge.no_versions(s, MOVEMENTS) if live is None else live
        merged = merge.merge(live, s, MOVEMENTS, cut).checkpoint()
        delta = marts.flow_state(marts.merge_delta(merged), FLOW_BY_PRODUCT, F.col("_sign"))
        state = (delta if state is None else marts.add_flow(state, delta, FLOW_BY_PRODUCT)).checkpoint()
        live = merge.open_versions(merged, MOVEMENTS)
        fresh = marts.flow_by_product(marts.live_state(live))
        got = marts.finish_flow(state, FLOW_BY_PRODUCT)
        assert sorted(map(str, got.select(fresh.columns).collect())) == sorted(
            map(str, fresh.collect()))

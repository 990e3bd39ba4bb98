"""State kept from changes, bulk builds from a state, and as-of joins, against full computations."""

import random
from datetime import date, timedelta

import pytest
from conftest import compared, row, write_cut
from pyspark.sql import functions as F

from tidemark.model import MOVEMENTS, Cut
from tidemark.operators import history, marts
from tidemark.plans import pipeline
from tidemark.sources import cuts as source
from tidemark.sources.store import Store

DAYS = [date(2024, 11, 1) + timedelta(days=2 * n) for n in range(5)]


def random_cuts(spark, folder, seed):
    """Cuts in which keys change, go, and come back; some clients lose their last row."""
    rng = random.Random(seed)
    cuts = []
    for n, day in enumerate(DAYS):
        rows = [row(f"C{c:02}", product=p, amount=rng.choice([1.0, -2.5, 0.1, None]))
                for c in range(14) for p in ("ETF", "BOND") if rng.random() < 0.6]
        if n != 2:  # the largest, tied, gone for one cut
            rows += [row("BIG", amount=1e6), row("ALSO", amount=-1e6)]
        rows += [row("C01", day="bad"), row("ONCE", amount=5.0)][:1 + (n == 1)]
        cuts.append(write_cut(spark, folder, rows, Cut(f"D{n}", "x", day)))
    return cuts


@pytest.fixture(scope="module")
def folded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("folded")
    cuts = random_cuts(spark, folder, 5)
    store = Store(spark, str(folder / "store"), MOVEMENTS)
    seen = []
    for cut in cuts:
        pipeline.run_cuts(spark, store, [cut])
        seen.append((store.state_summary().first(), store.top_actors(3).collect(),
                     marts.state_summary(store.history()).first(),
                     marts.top_clients(store.live(), 3).collect()))
    return cuts, store, seen


def test_state_from_changes_equals_the_full_one_after_every_cut(folded):
    for summary, top, full_summary, full_top in folded[2]:
        assert summary.asDict() == full_summary.asDict() and top == full_top
    tops = [[r["id_cliente"] for r in top[:2]] for _, top, *_ in folded[2]]
    assert tops[1] == ["ALSO", "BIG"] and "BIG" not in tops[2] and tops[3] == ["ALSO", "BIG"]
    clients = [s["clientes_activos"] for s, *_ in folded[2]]
    assert len(set(clients)) > 1  # clients came and went


def test_state_over_several_cuts_at_once(spark, folded, tmp_path):
    """The changes of a commit that holds many cuts, and of many commits without marts."""
    cuts, store, seen = folded
    other = Store(spark, str(tmp_path / "other"), MOVEMENTS)
    pipeline.run_cuts(spark, other, cuts[:1])
    pipeline.extend(spark, other, cuts[1:3])
    pipeline.process_cut(spark, other, cuts[3])
    pipeline.run_cuts(spark, other, cuts[4:])
    assert other.state_summary().first() == seen[-1][0]
    assert other.top_actors(3).collect() == seen[-1][1]
    for mart in MOVEMENTS.marts:
        assert other.mart(mart.name).collect() == store.mart(mart.name).collect()
    assert compared(other.history()) == compared(store.history())


def test_without_marts_there_is_no_summary(spark, tmp_path):
    with pytest.raises(LookupError):
        Store(spark, str(tmp_path / "none"), MOVEMENTS).state_summary()


@pytest.mark.parametrize("prefix", [1, 3])
def test_bulk_build_from_any_prefix_equals_the_fold(spark, folded, tmp_path, prefix):
    cuts, store, _ = folded
    other = Store(spark, str(tmp_path / "store"), MOVEMENTS)
    for cut in cuts[:prefix]:
        pipeline.process_cut(spark, other, cut)
    assert other.open_versions().filter("is_deleted").count() > 0 or prefix == 1
    records = pipeline.extend(spark, other, cuts[prefix:])
    assert compared(other.history()) == compared(store.history())
    assert compared(other.change_log().drop("run_id", "ts")) == compared(
        store.change_log().drop("run_id", "ts"))
    counts = ["cut_label", "rows_new", "rows_changed", "rows_deleted", "rows_unchanged"]
    assert [tuple(r[c] for c in counts) for r in records] == [
        tuple(r) for r in store.ledger().orderBy("commit").select(*counts).collect()[prefix:]]
    for day in (DAYS[prefix - 1], DAYS[-1]):
        assert compared(other.as_of(day)) == compared(store.as_of(day))


def test_bulk_build_goes_forward_only(spark, folded, tmp_path):
    cuts = folded[0]
    other = Store(spark, str(tmp_path / "store"), MOVEMENTS)
    pipeline.process_cut(spark, other, cuts[1])
    for wrong in (cuts[:1], cuts[1:3]):
        with pytest.raises(source.OutOfOrderError):
            pipeline.extend(spark, other, wrong)
    pipeline.extend(spark, other, cuts[2:4])
    assert pipeline.process_cut(spark, other, cuts[3]) is None


def test_as_of_join_equals_as_of(spark, folded):
    store = folded[1]
    versions = store.history().cache()
    days = [DAYS[0] - timedelta(days=1), *DAYS, DAYS[2] + timedelta(days=1), date(2030, 1, 1)]
    keys = [r[0] for r in versions.select("movement_key").distinct().collect()]
    rows = [(k, d, n) for n, (k, d) in enumerate((k, d) for k in [*keys, "none", None]
                                                for d in [*days, None])]
    rows += [(keys[0], DAYS[1], -n) for n in range(1, 4)]  # repeated probes stay
    probes = spark.createDataFrame(rows, "movement_key string, day date, version long")
    found = history.as_of_join(probes.withColumnRenamed("version", "n"), versions).collect()
    assert len(found) == len(rows) and len({r["n"] for r in found}) == len(rows)
    held = {(r["movement_key"], d): r["version_id"] for d in days
            for r in history.as_of(versions, d).collect()}
    for r in found:
        assert (r["version"] or {"version_id": None})["version_id"] == held.get(
            (r["movement_key"], r["day"]))
    assert held and any(r["version"] is None for r in found)
    clash = history.as_of_join(probes, versions)  # a probe's own ``version`` gives way
    assert clash.columns == ["movement_key", "day", "version"]


def test_as_of_join_of_many_probes_has_no_nested_loop(spark, folded):
    versions = folded[1].history()
    keys = versions.select("movement_key").distinct()
    probes = (keys.select("movement_key", F.explode(F.sequence(F.lit(1), F.lit(4000))).alias("n"))
              .select("movement_key", F.date_add(F.lit(DAYS[0]), F.col("n") % 12).alias("day")))
    found = history.as_of_join(probes.hint("merge"), versions)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert found.count() == probes.count() > 100_000

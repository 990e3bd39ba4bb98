import pytest
from conftest import T, T1, T2, T3, compared, row, staged

from tidemark.model import MOVEMENTS
from tidemark.operators import marts, merge


def run(spark, steps):
    """Merges (cut, rows) steps; returns the history and the counts of each step."""
    live, closed, counts = None, [], []
    for cut, rows in steps:
        s = staged(spark, rows, cut)
        live = merge.no_versions(s, MOVEMENTS) if live is None else live
        classified = merge.classify(live, s)
        counts.append(tuple(classified.agg(*merge.action_counts()).first()))
        out = merge.versions(classified, MOVEMENTS, cut).checkpoint()
        closed.append(out.filter("part = 'closed'"))
        live = merge.open_versions(out, MOVEMENTS)
    history = live
    for c in closed:
        history = history.unionByName(c.select(*live.columns))
    return history, counts


@pytest.fixture(autouse=True)
def checkpoints(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))


def test_new_changed_deleted_unchanged(spark):
    first = [row("A", day="2024-03-01"), row("A", day="2024-03-02", kind="salida"),
             row("B", product="CDT", kind="IN"), row("B", description=None, name=None)]
    second = [row("a ", day="01/03/2024", kind="ENTRADA"),
              row("A", day="02/03/2024", kind="out", amount=250.0),
              row("B", description=" ", name=None), row("Z", kind="out")]
    history, counts = run(spark, [(T, first), (T1, second)])
    assert counts == [(4, 0, 0, 0), (1, 1, 1, 2)]
    assert marts.live_state(history).count() == 4
    assert marts.tombstones(history).count() == 1
    corrected = history.filter("id_cliente = 'A' AND mov_date = DATE'2024-03-02'")
    assert sorted((r["amount"], r["is_current"], str(r["valid_to"]), r["change_type"])
                  for r in corrected.collect()) == [
        (100.0, False, "2024-11-02", "INSERT"), (250.0, True, "None", "UPDATE")]


def test_the_same_cut_again_changes_nothing(spark):
    rows = [row("A"), row("B"), row("B")]
    once, _ = run(spark, [(T, rows)])
    twice, counts = run(spark, [(T, rows), (T, rows)])
    assert counts[1] == (0, 0, 0, 3)
    assert compared(once) == compared(twice)


def test_deleted_absent_reappeared(spark):
    """The tombstone is left alone while the key is away, and closed when it is back."""
    a, b = row("A"), row("B")
    history, counts = run(spark, [(T, [a]), (T1, [b]), (T2, [b]), (T3, [a, b])])
    assert counts == [(1, 0, 0, 0), (1, 0, 1, 0), (0, 0, 0, 1), (1, 0, 0, 1)]
    got = history.filter("id_cliente = 'A'").orderBy("valid_from").collect()
    assert [(r["change_type"], str(r["valid_from"]), str(r["valid_to"]), r["is_deleted"],
             r["is_current"]) for r in got] == [
        ("INSERT", "2024-11-01", "2024-11-02", False, False),
        ("DELETE", "2024-11-02", "2024-11-05", True, False),
        ("INSERT", "2024-11-05", "None", False, True)]
    assert got[2]["prev_attr_hash"] == got[1]["attr_hash"]  # equal hash, still a new version


def test_tombstone_copies_the_last_version_but_names_the_new_cut(spark):
    history, _ = run(spark, [(T, [row("A", amount=7.0), row("B")]), (T1, [row("B")])])
    dead = marts.tombstones(history).first()
    assert (dead["amount"], dead["cut_label"], dead["source_file"]) == (7.0, "T1", "f.parquet")
    log = merge.events(history).filter("change_type = 'DELETE'").first()
    assert log["new_attr_hash"] is None and log["prev_attr_hash"] == dead["attr_hash"]


def test_unchanged_keeps_the_flags_and_lineage_of_the_version_that_stands(spark):
    history, counts = run(spark, [(T, [row(day="01/01/2024", kind="in")]), (T1, [row()])])
    assert counts[1] == (0, 0, 0, 1)
    kept = history.first()
    assert (kept["dq_date_reformatted"], kept["dq_type_recoded"], kept["cut_label"]) == (
        True, True, "T")


def test_occurrences_shift_by_position(spark):
    """Removing the smaller of two equal keys reads as a change of the first and a
    deletion of the second."""
    _, counts = run(spark, [(T, [row(amount=10.0), row(amount=20.0)]), (T1, [row(amount=20.0)])])
    assert counts[1] == (0, 1, 1, 0)
    _, counts = run(spark, [(T, [row(amount=10.0), row(amount=20.0)]),
                            (T1, [row(amount=20.0), row(amount=30.0)])])
    assert counts[1] == (0, 2, 0, 0)


def test_an_empty_cut_deletes_everything(spark):
    history, counts = run(spark, [(T, [row("A"), row("B")]), (T1, [])])
    assert counts[1] == (0, 0, 2, 0)
    assert marts.live_state(history).count() == 0


def test_negative_zero_is_another_amount(spark):
    _, counts = run(spark, [(T, [row(amount=0.0)]), (T1, [row(amount=-0.0)])])
    assert counts[1] == (0, 1, 0, 0)


def test_labels_with_quotes(spark):
    from tidemark.model import Cut
    odd = Cut("it's \\ odd", "x", T1.cut_date)
    history, _ = run(spark, [(T, [row()]), (odd, [])])
    assert marts.tombstones(history).first()["cut_label"] == odd.label

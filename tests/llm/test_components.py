"""Rounds of the components: none that changes nothing, and the same classes as by hand."""

import random

import pytest

from tidemark.llm import components as parts


@pytest.fixture
def written(monkeypatch):
    tables = []
    keep = parts.stored

    def counting(df, name):
        tables.append(name)
        return keep(df, name)

    monkeypatch.setattr(parts, "stored", counting)
    return tables


def test_stars_are_seen_without_a_further_round(spark, written):
    df = spark.createDataFrame([(1, 2), (2, 3), (7, 9)], "a long, b long")
    found = sorted(map(tuple, parts.components(df, "a", "b").collect()))
    assert found == [(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)]
    assert len(written) == 2  # the edges, and the one round that makes stars


def test_random_graphs_against_merging_by_hand(spark):
    rng = random.Random(4)
    for nodes, n in ((12, 9), (40, 30), (25, 60)):
        edges = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(n)]
        edges += [(100 + k, 101 + k) for k in range(12)] + [(None, 3), (200, 200)]
        label = {x: x for a, b in edges if None not in (a, b) and a != b for x in (a, b)}
        for _ in label:
            for a, b in edges:
                if a in label and b in label:
                    label[a] = label[b] = min(label[a], label[b])
        df = spark.createDataFrame(edges, "a long, b long")
        found = sorted(map(tuple, parts.components(df, "a", "b").collect()))
        assert found == sorted(label.items())

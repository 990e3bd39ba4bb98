"""Every registered query against its SQL twin, run by another engine."""

import os

import compare
import pytest

from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    assert compare.difference(result, duck, ORACLE[name]) is None


def test_fingerprints_tell_cuts_apart(spark):
    found = QUERIES["cut_fingerprint"](spark, SF).collect()
    assert len({r["fingerprint"] for r in found}) == len(found) == 3

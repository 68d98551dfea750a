"""Every registered query against its SQL, on the smallest tables by default."""

import os

import pytest

from oracle import connect, differences
from starfold.plans.oracles import ORACLES
from starfold.plans.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_datasets_without_a_file_are_fetched_again(spark):
    """Files are missing where the key is a multiple of 7, whatever the last state says."""
    fetch = {r.dataset_code: r.needs_fetch for r in QUERIES["needs_refetch"](spark, "/root/testdata/sf0.001").collect()}
    assert all(needed for key, needed in fetch.items() if key % 7 == 0)
    assert not all(fetch.values())

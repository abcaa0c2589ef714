"""Every registered query equals its oracle on the smallest data set."""

import os

import pytest

from __spark_entry__ import entry
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES
from oracle import compare, connect

FOLDER = os.environ.get("ORACLE_FOLDER", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, connection, name):
    assert compare(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) == ""


def test_entry(spark):
    assert entry(spark).count() > 0

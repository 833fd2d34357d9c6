"""The check queries against their SQL, at the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from tools.check import compare, duck

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    with duck(FOLDER) as connection:
        yield connection


def test_every_oracle_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0

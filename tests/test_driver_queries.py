"""Every registered query against the same query in SQL, values and all, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import compare
import pytest

import __spark_entry__ as entry_point
from gramledger.plans.driver_oracle import ORACLE
from gramledger.plans.driver_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 200 and len(df.columns) == 18


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, name):
    columns, rows = compare.spark_rows(entry_point.queries()[name](spark, FOLDER))
    wanted_columns, wanted = compare.duck_rows(con, entry_point.oracle_sql()[name])
    assert columns == wanted_columns
    assert rows == wanted

"""Every registered query against DuckDB over the smallest tables."""

import __spark_entry__ as entry_points
import pytest
from compare import duck, duck_rows, spark_rows

from samples.oracle import expected
from samples.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ORACLE = expected()


@pytest.fixture(scope="module")
def database():
    return duck(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, database, name):
    result = spark_rows(entry_points.queries()[name](spark, FOLDER))
    wanted = duck_rows(database, ORACLE[name])
    assert result[0] == wanted[0]
    assert len(result[1]) == len(wanted[1])
    assert result[1] == wanted[1]


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0

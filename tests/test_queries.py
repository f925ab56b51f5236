"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.queries import QUERIES
from verify import compare, database

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert compare(spark, db, name, SF_DIR) == ""


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["uri", "uuid", "body_md5", "found"]
    assert rows.filter("found").count() > 0

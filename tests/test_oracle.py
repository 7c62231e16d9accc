"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from newslens.plans import registry, registry_sql
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(registry_sql.SQL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


def test_entry(spark):
    report = entry.entry(spark)
    assert report.columns == ["metric_name", "key", "count", "total_length"]
    assert report.count() > 0

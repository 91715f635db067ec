"""Every registered query against its SQL oracle."""

import pytest

import __spark_entry__ as entry
from oracle_check import connect, differences
from tagloom.plans.oracle import ORACLE
from tagloom.plans.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, database, name):
    assert differences(spark, database, FOLDER, name) is None


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(REGISTRY)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["tagid", "cookieid", "tagweight", "tagranking",
                                          "reserve", "reserve1"]

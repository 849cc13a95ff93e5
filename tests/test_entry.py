"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from compare import compare, connect
from foldloom.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_flagship(spark):
    df = entry_module.entry(spark)
    assert df.dtypes == [("k", "string"), ("split", "string"), ("n_rows", "bigint")]
    assert df.count() == 15


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    problem = compare(spark, duck, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert problem is None

import pytest

from __spark_entry__ import QUERIES, entry
from catalogue.oracles import ORACLES
from tests.compare import compare, tables


@pytest.fixture(scope="module")
def con(sf_dir):
    return tables(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], sf_dir) is None


def test_entry(spark):
    assert entry(spark).columns == ["out_key", "metric", "tags", "value", "ts_sec"]

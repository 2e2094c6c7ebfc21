import pytest

from __spark_entry__ import entry, oracle_sql, queries

from snapstar.plans.oracle import ORACLE
from snapstar.plans.queries import QUERIES

from .compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    if name in ROWS_ONLY:
        assert queries()[name](spark, FOLDER).count() > 0
    else:
        assert difference(spark, con, FOLDER, name) is None


def test_registry(spark):
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0

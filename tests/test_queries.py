"""Every query with SQL agrees with it, and every other runs."""

import pytest

from docfold.plans import ORACLE, QUERIES
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLE:
        same(spark, con, QUERIES[name], ORACLE[name], SF)
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[0] == "regulation_id"
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Every query against its SQL, or at least run, on the shared tables."""

import pytest

from checks.compare import connect, differences
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert differences(df, con, ORACLE[name]) == []
    else:
        assert df.count() >= 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)

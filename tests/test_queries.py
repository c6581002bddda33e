"""Every registered query against its check SQL, on the smallest tables."""

import pytest

import __spark_entry__
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"
CHECKS = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(__spark_entry__.queries()))
def test_query(spark, con, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    if name in CHECKS:
        assert differences(con, df, CHECKS[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0

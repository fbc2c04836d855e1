"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from tests.compare import connect, differences, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    rows, problem = differences(spark, con, name, SF_DIR)
    assert problem is None
    assert rows > 0 or name in ("token_range_offenders",)

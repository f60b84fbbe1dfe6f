"""Every query of the library against its SQL, on the smallest tables."""

import pytest

from leadloom.queries.registry import REGISTRY

from . import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY.queries))
def test_query(spark, con, name):
    df = REGISTRY.queries[name](spark, SF)
    if name in REGISTRY.sql:
        oracle.assert_same(df, con, REGISTRY.sql[name])
    else:
        assert df.count() > 0

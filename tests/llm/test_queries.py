"""The training-text queries against their SQL, on the smallest tables."""

import pytest

from leadloom.llm import registry

from .. import oracle

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.SQL:
        oracle.assert_same(df, oracle.connect(SF), registry.SQL[name])
    else:
        assert df.count() > 0

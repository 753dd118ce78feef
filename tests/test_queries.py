import os

import oracle
import pytest

from strataframe.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_its_sql(spark, name):
    assert oracle.differ(spark, oracle.connect(SF), registry.QUERIES[name], registry.ORACLE[name], SF) is None


def test_flagship_is_registered():
    assert registry.FLAGSHIP in registry.QUERIES

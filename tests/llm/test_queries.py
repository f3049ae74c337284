import os

import pytest

from check_queries import differences, duck
from shopspan.llm.queries import ORACLE, REGISTRY

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(REGISTRY[name](spark, SMALL).toPandas(), duck(SMALL).execute(ORACLE[name]).df()) == []

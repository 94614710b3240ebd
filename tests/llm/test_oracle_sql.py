import pytest

from tiergrain.llm.registry import ORACLE, QUERIES
from tiergrain.plans.check import digest


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck01, key):
    df = QUERIES[key](spark, "/root/testdata/sf0.01")
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    c = duck01.execute(ORACLE[key])
    want = digest([d[0] for d in c.description], c.fetchall())
    assert got[0] == want[0] and got[2] == want[2]

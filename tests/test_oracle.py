"""Every registered key against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

from tiergrain.plans.check import compare
from tiergrain.plans.registry import REGISTRY

from conftest import SF01

KEYS = sorted(REGISTRY)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck01, key):
    q = REGISTRY[key]
    r = compare(spark, key, q.build, q.oracle, SF01, duck01)
    assert r["status"] in ("ok", "rows-only"), r
    if q.oracle is None:
        assert r["spark_rows"] >= 0

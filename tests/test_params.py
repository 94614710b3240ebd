import datetime as dt

from tiergrain.params import REFERENCE_PARAMS, Params


def test_from_conf_overrides(spark):
    keys = {"ins.max_single_risk_pct": "7.5", "ins.max_aggregate_limit_usd": "1e9", "ins.as_of": "2000-01-31T00:00:00"}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        p = Params.from_conf(spark)
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert p.max_single_risk_pct == 7.5 and p.max_aggregate_limit_usd == 1e9
    assert p.as_of == dt.datetime(2000, 1, 31) and p.as_of_date == dt.date(2000, 1, 31)
    assert p.max_peril_concentration_pct == REFERENCE_PARAMS.max_peril_concentration_pct == 25.0
    assert Params.from_conf(spark) == REFERENCE_PARAMS

"""Hand-made edge rows (FIXTURES.md §5)."""

import datetime as dt

from pyspark.sql import functions as F

from tiergrain.params import TEST_PARAMS
from tiergrain.plans import insurance as ins
from tiergrain.plans import investment as inv

MARKET = ("security_id string, price_date date, close_price double, open_price double, high_price double, "
          "low_price double, volume bigint, currency string, source string")
POLICY = ("policy_id string, lob_id string, broker_id string, insured_name string, territory string, "
          "inception_date timestamp_ntz, currency string, gross_premium double, limit_amount double, "
          "deductible double, peril string, status string, expiry_date date")


def test_open_price_zero_gives_null_return_and_is_dropped(spark):
    d = dt.date(2001, 1, 2)
    rows = [("S1", d, 10.0, 0.0, 11.0, 9.0, 5, "USD", "X"), ("S1", d, 11.0, 10.0, 12.0, 9.0, 5, "USD", "X")]
    df = spark.createDataFrame(rows, MARKET)
    un = {r.open_price: r.daily_return_pct for r in inv.market_data_unfiltered(df).collect()}
    assert un[0.0] is None and un[10.0] == 10.0
    kept = inv.silver_market_data(df).collect()
    assert len(kept) == 1 and kept[0].open_price == 10.0


def _lobs_brokers_reinsurers(spark, rate):
    lobs = spark.createDataFrame([("LOB-01", "Property", "P&C", "x")], "lob_id string, lob_name string, segment string, description string")
    brokers = spark.createDataFrame([("BRK-01", "B", "G", "US", "A")],
                                    "broker_id string, broker_name string, segment string, country string, rating string")
    re = spark.createDataFrame([("RE-1", "R", "AA", "CH", rate)],
                               "reinsurer_id string, reinsurer_name string, credit_rating string, country string, cession_rate double")
    return lobs, brokers, re


def test_zero_average_cession_takes_default(spark):
    lobs, brokers, re = _lobs_brokers_reinsurers(spark, 0.0)
    pol = spark.createDataFrame([("P1", "LOB-01", "BRK-01", "I", "T", dt.datetime(2000, 1, 1), "USD", 100.0, 1000.0,
                                  1.0, "PERIL-1", "BOUND", dt.date(2001, 1, 1))], POLICY)
    r = ins.silver_enriched_policies(pol, lobs, brokers, re, TEST_PARAMS).first()
    assert r.cession_rate == 0.30 and abs(r.net_premium - 70.0) < 1e-9 and r.rate_on_line == 10.0


def test_compliance_on_empty_book_is_empty_not_an_error(spark):
    lobs, brokers, re = _lobs_brokers_reinsurers(spark, 0.4)
    pol = spark.createDataFrame([("P1", "LOB-01", "BRK-01", "I", "T", dt.datetime(2000, 1, 1), "USD", 100.0, 1000.0,
                                  1.0, "PERIL-1", "QUOTED", dt.date(2001, 1, 1))], POLICY)
    silver = ins.silver_enriched_policies(pol, lobs, brokers, re, TEST_PARAMS)
    assert ins.gold_compliance_checks(silver, TEST_PARAMS).count() == 0
    assert ins.gold_exposure_summary(silver, spark.createDataFrame(
        [], "exposure_id string, territory string, peril string, as_of_date date, total_insured_value double, "
            "probable_max_loss double, currency string, model_source string"), TEST_PARAMS).count() == 0


def test_future_inception_dropped_but_not_quarantined(spark):
    lobs, brokers, re = _lobs_brokers_reinsurers(spark, 0.4)
    future = TEST_PARAMS.as_of + dt.timedelta(seconds=1)
    pol = spark.createDataFrame([("P1", "LOB-01", "BRK-01", "I", "T", future, "USD", 100.0, 1000.0, 1.0, "PERIL-1",
                                  "BOUND", dt.date(2002, 1, 1)),
                                 ("P2", "LOB-01", "BRK-01", "I", "T", TEST_PARAMS.as_of, "USD", 100.0, 1000.0, 1.0,
                                  "PERIL-1", "BOUND", dt.date(2002, 1, 1))], POLICY)
    kept = [r.policy_id for r in ins.silver_enriched_policies(pol, lobs, brokers, re, TEST_PARAMS).collect()]
    assert kept == ["P2"]                      # inception exactly at as_of passes
    assert ins.quarantine_policies(pol, lobs, TEST_PARAMS).count() == 0


def test_asof_fx_edges(spark):
    from tiergrain.plans.extensions import base_currency_notional
    d = dt.date
    fx = spark.createDataFrame(
        [(d(2001, 1, 2), "EUR", "USD", 1.10, "E"), (d(2001, 1, 5), "EUR", "USD", 1.20, "E"),
         (d(2001, 1, 3), "USD", "JPY", 100.0, "E")],
        "rate_date date, from_currency string, to_currency string, rate double, source string")
    trades = spark.createDataFrame(
        [("T0", dt.datetime(2001, 1, 1), "EUR", 10.0), ("T1", dt.datetime(2001, 1, 3), "EUR", 10.0),
         ("T2", dt.datetime(2001, 1, 9), "EUR", 10.0), ("T3", dt.datetime(2001, 1, 4), "JPY", 1000.0),
         ("T4", dt.datetime(2001, 1, 4), "USD", 7.0), ("T5", dt.datetime(2001, 1, 4), None, 1.0)],
        "trade_id string, trade_date timestamp_ntz, currency string, notional_value double")
    got = {r.trade_id: r.fx_rate for r in base_currency_notional(trades, fx, TEST_PARAMS).collect()}
    assert got["T0"] is None            # before the first quote
    assert got["T1"] == 1.10            # carried forward over a gap
    assert got["T2"] == 1.20            # after the last quote: the last rate
    assert got["T3"] == 1 / 100.0       # only the reciprocal pair is quoted
    assert got["T4"] == 1.0 and got["T5"] is None

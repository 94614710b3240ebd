"""Date spine: weekdays only, both ends included, every pair; no rows without quotes."""

import datetime as dt

from tiergrain.plans.synthetic import fx_date_spine

SCHEMA = "from_currency string, to_currency string, rate_date date"


def test_weekdays_of_every_pair(spark):
    first, last = dt.date(2024, 1, 4), dt.date(2024, 1, 9)          # Thursday to Tuesday
    rows = [("EUR", "USD", first), ("EUR", "USD", first), ("GBP", "USD", last), (None, "USD", first), ("EUR", None, last)]
    got = [tuple(r) for r in fx_date_spine(spark.createDataFrame(rows, SCHEMA)).collect()]
    days = [dt.date(2024, 1, d) for d in (4, 5, 8, 9)]
    assert sorted(got) == sorted((a, "USD", d) for a in ("EUR", "GBP") for d in days)


def test_no_quotes_no_days(spark):
    assert fx_date_spine(spark.createDataFrame([], SCHEMA)).count() == 0

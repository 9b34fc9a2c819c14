import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from landfall.functions import mdy_to_date, mdy_to_iso, sas_day_to_date, sas_day_to_iso


def test_day_numbers(one):
    days = [20573.0, 20573.9, 1.0, -0.5, 0.0, None, float("nan"), 1e12, -1e12]
    assert one(sas_day_to_iso, days, T.DoubleType()) == [
        "2016-04-29", "2016-04-29", "1960-01-02", "1959-12-31", "1960-01-01", None, None, None, None,
    ]


def test_day_zero_may_mean_missing(one):
    assert one(lambda c: sas_day_to_iso(c, zero_is_null=True), [0.0, 0.5, None], T.DoubleType()) == [
        None, "1960-01-01", None,
    ]


def test_first_and_last_day(one):
    first, last = (d - dt.date(1960, 1, 1) for d in (dt.date.min, dt.date.max))
    days = [first.days, last.days, last.days + 0.9, first.days - 1, last.days + 1]
    assert one(sas_day_to_date, [float(d) for d in days], T.DoubleType()) == [
        dt.date.min, dt.date.max, dt.date.max, None, None,
    ]


def test_day_numbers_from_integers(one):
    assert one(sas_day_to_iso, [20573, 0, None], T.IntegerType()) == ["2016-04-29", "1960-01-01", None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-600000, 2900000, allow_nan=False), min_size=1, max_size=50))
def test_day_numbers_equal_calendar_arithmetic(one, days):
    expected = [(dt.date(1960, 1, 1) + dt.timedelta(d // 1)).isoformat() for d in days]
    assert one(sas_day_to_iso, days, T.DoubleType()) == expected


DUE = ["10282016", "D/S", "", "1028", None, "13452016", "02292016", "02292015", "10282016\n", "abcdefgh"]


def test_due_dates(one):
    assert one(mdy_to_iso, DUE, T.StringType()) == [
        "2016-10-28", None, None, None, None, None, "2016-02-29", None, None, None,
    ]
    assert one(mdy_to_date, DUE[:3], T.StringType()) == [dt.date(2016, 10, 28), None, None]


def test_due_dates_lenient_reorders_anything(one):
    expected = [x if not x else x[4:] + "-" + x[:2] + "-" + x[2:4] for x in DUE]
    assert one(lambda c: mdy_to_iso(c, lenient=True), DUE, T.StringType()) == expected

"""Generated date and holiday dimensions (FIXTURES.md)."""
import datetime as dt

from bedflow.sources.fixtures import FIXTURE_PARAMS as P
from bedflow.sources.calendar import date_dim, holiday_dim


def test_date_dim_keys_and_names(spark):
    rows = {r.day_key: r for r in date_dim(spark, P).collect()}
    assert min(rows) == -1 and max(rows) == 2922 and len(rows) == 2924
    assert rows[1].day == dt.date(1995, 1, 1) and rows[1].day_of_week == "Sunday"
    assert rows[-1].day == dt.date(1994, 12, 30) and rows[0].day == dt.date(1994, 12, 31)
    assert rows[2922].day == dt.date(2002, 12, 31)


def test_holidays_three_per_calendar_year(spark):
    days = sorted(r.date for r in holiday_dim(spark, P).collect())
    assert len(days) == 24
    assert days[0] == dt.date(1995, 1, 1) and days[-1] == dt.date(2002, 12, 25)
    assert {(d.month, d.day) for d in days} == {(1, 1), (7, 4), (12, 25)}

"""Date helpers: every "today" is the explicit ``as_of`` of a run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from bedflow.config import HOLIDAY_DOW_CODE


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def lit_ts_ntz(d: dt.date | dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session and Python time
    zones (a Python datetime literal would pass through an instant)."""
    text = d.isoformat(sep=" ") if isinstance(d, dt.datetime) else f"{d.isoformat()} 00:00:00"
    return F.lit(text).cast("timestamp_ntz")


def months_after(d: dt.date, months: int) -> Column:
    """``d + interval 'n months'`` as a DATE (folds to a literal)."""
    return F.add_months(lit_date(d), months)


def dow_code(day: Column, is_holiday: Column) -> Column:
    """Weekday code: Spark numbering (1 = Sunday ... 7 = Saturday), 9 on holidays."""
    return F.when(is_holiday, F.lit(HOLIDAY_DOW_CODE)).otherwise(F.dayofweek(day))

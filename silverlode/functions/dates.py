"""Date and timestamp expressions; callers pass ``as_of`` instead of the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

DAYS_PER_YEAR = "365.25"


def day(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def moment(value: dt.datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def to_day(c) -> Column:
    return _c(c).try_cast("date")


def to_moment(c) -> Column:
    return _c(c).try_cast("timestamp")


def month_start(c) -> Column:
    return F.trunc(_c(c), "MM")


def days_between(later, earlier) -> Column:
    return F.datediff(_c(later), _c(earlier))


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def add_seconds(c, seconds) -> Column:
    return F.timestamp_add("SECOND", _c(seconds).cast("int"), _c(c))


def hours_before(as_of: str, hours: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(-hours), moment(as_of))


def date_key(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd")


def compact_date_key(c) -> Column:
    return F.date_format(_c(c), "yyyyMMdd")


def month_key(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM")


def hour_bucket(c) -> Column:
    return F.date_trunc("hour", _c(c)).cast("timestamp_ntz")


def five_minute_bucket(c) -> Column:
    hour = F.date_trunc("hour", _c(c)).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", (F.floor(F.minute(_c(c)) / 5) * 5).cast("int"), hour)

"""Day and hour keys. Days are ``yyyyMMdd`` texts, hours are integers.

The arithmetic is on epoch seconds and on dates, so results do not depend on the session zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def epoch_day_number(seconds: Column, zone_offset: int = 0) -> Column:
    """Days since 1970-01-01 in a zone ``zone_offset`` seconds east of UTC."""
    return F.floor((seconds + zone_offset) / DAY_SECONDS).cast("int")


def epoch_day(seconds: Column, zone_offset: int = 0) -> Column:
    """Day of epoch seconds as ``yyyyMMdd``."""
    days = epoch_day_number(seconds, zone_offset)
    return F.date_format(F.date_add(F.lit(dt.date(1970, 1, 1)), days), "yyyyMMdd")


def epoch_hour(seconds: Column, zone_offset: int = 0) -> Column:
    return F.floor(F.pmod(seconds + zone_offset, F.lit(DAY_SECONDS)) / 3600).cast("int")


def stamp_day(stamp: Column) -> Column:
    """Day of a ``yyyyMMddHH…`` text."""
    return F.substring(stamp, 1, 8)


def stamp_hour(stamp: Column) -> Column:
    return F.substring(stamp, 9, 2).try_cast("int")


def iso_day(day: Column) -> Column:
    """``yyyyMMdd`` as ``yyyy-MM-dd``."""
    return F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))


def yesterday(now: dt.datetime | None = None) -> str:
    """Default day of the daily jobs."""
    return ((now or dt.datetime.now()) - dt.timedelta(days=1)).strftime("%Y%m%d")


def previous_hour(now: dt.datetime | None = None) -> tuple[str, int]:
    """Default day and hour of the hourly jobs."""
    then = (now or dt.datetime.now()) - dt.timedelta(hours=1)
    return then.strftime("%Y%m%d"), then.hour

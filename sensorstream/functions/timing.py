"""Durations, epoch arithmetic and local time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorstream import fixed

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_us(text: str | timedelta) -> int:
    """'5 minutes' or a timedelta, in microseconds; always positive."""
    if isinstance(text, timedelta):
        us = text // timedelta(microseconds=1)
    else:
        words = text.split()
        if not words or len(words) % 2:
            raise ValueError(f"not a duration: {text!r}")
        us = 0
        for number, unit in zip(words[::2], words[1::2]):
            unit = unit.lower().removesuffix("s")
            if unit not in _UNIT_US:
                raise ValueError(f"unknown unit in duration {text!r}")
            us += int(number) * _UNIT_US[unit]
    if us <= 0:
        raise ValueError(f"a duration must be positive: {text!r}")
    return us


def floor_div(value: Column, divisor: int) -> Column:
    """Integer floor division that is also right before 1970."""
    by = F.lit(divisor).cast("bigint")
    return F.call_function("div", value - F.pmod(value, by), by)


def keeps_columns(columns: list[str]) -> Column:
    """A filter that is always true and reads these columns. Above a window it keeps two branches of a
    plan from pruning the shared shuffle in different ways, so that Spark does it once."""
    return F.hash(*columns) <= F.lit(2**31 - 1)


def local_time_text(ts: Column, zone: str = fixed.LOCAL_ZONE) -> Column:
    """The instant as wall-clock text of `zone` (needs a UTC session time zone)."""
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd HH:mm:ss")

"""Readings for tests, and the values they hold."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta, timezone

from sensorstream.schemas import READING

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"


def at(text: str) -> datetime:
    """'2025-05-31 04:00:00.000' in UTC."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def ms(value: datetime) -> int:
    """A timestamp read back from a UTC session, as epoch milliseconds."""
    if value.tzinfo is None:
        value = value.astimezone()
    return round(value.timestamp() * 1000)


def make_readings(spark, rows, sensor="SCD41", metric="co2", device="s1001"):
    """rows of (time, value[, device]) in arrival order."""
    data = []
    for offset, row in enumerate(rows):
        when, value, *rest = row
        dev = rest[0] if rest else device
        data.append((dev, sensor, metric, f"i483-sensors-{dev}-{sensor}-{metric}", when,
                     None if value is None else float(value), 0, offset))
    return spark.createDataFrame(data, READING)


START = at("2025-05-31 04:00:00")


def random_readings(spark, n=600, devices=3, span_s=20_000, seed=7, values=(300, 1100), hot=0.5, step_ms=1):
    """Readings with ties in time, and one device that has about half of them."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        device = "s1001" if rnd.random() < hot else f"s{1001 + rnd.randrange(devices)}"
        offset_ms = rnd.randrange(span_s * 1000 // step_ms) * step_ms
        rows.append((START + timedelta(milliseconds=offset_ms), rnd.randrange(*values), device))
    return make_readings(spark, rows)


def by_key(df, *columns):
    """Readings as python rows per key, in event order."""
    out = {}
    for row in sorted(df.collect(), key=lambda r: (r.ts, r.src_partition, r.src_offset)):
        out.setdefault(tuple(row[c] for c in columns), []).append(row)
    return out

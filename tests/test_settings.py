"""Settings in force, against a search through all settings of every sample."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest

from sensorstream.operators.settings import settings_in_force

T0 = datetime(2025, 5, 31, 4, tzinfo=timezone.utc)
SAMPLE = "device_id string, ts timestamp, n int, gain int, note string"
SETTING = "device_id string, since timestamp, id int, gain int, mode string"


def minutes(k):
    return None if k is None else T0 + timedelta(minutes=k)


def searched(samples, settings):
    out = []
    for device, at, n, _, note in samples:
        known = [
            (since, (id_, gain is not None, gain or 0, mode is not None, mode or ""), gain, mode)
            for dev, since, id_, gain, mode in settings
            if dev == device and since is not None and at is not None and since <= at
        ]
        gain, mode = max(known)[2:] if known else (None, None)
        out.append((n, device, note, gain, mode))
    return sorted(out, key=repr)


def found(spark, samples, settings, block):
    out = settings_in_force(
        spark.createDataFrame(samples, SAMPLE), spark.createDataFrame(settings, SETTING), ["gain", "mode"],
        tie_cols=["id"], block=block,
    )
    assert out.columns == ["device_id", "ts", "n", "note", "gain", "mode"]
    return sorted([(r.n, r.device_id, r.note, r.gain, r["mode"]) for r in out.collect()], key=repr)


@pytest.mark.parametrize("block", ["7 minutes", "1 day"])
def test_latest_settings_of_each_sample(spark, block):
    rnd = random.Random(3)
    devices = ["hot", "hot", "hot", "a", "b", None, "unset"]
    times = [None, *range(0, 300)]
    samples = [(rnd.choice(devices), minutes(rnd.choice(times)), n, -1, "x") for n in range(400)]
    settings = [
        (rnd.choice(devices[:-1]), minutes(rnd.choice(times)), rnd.randrange(5), rnd.choice([None, 1, 2, 64]), rnd.choice([None, "p", "q"]))
        for _ in range(120)
    ]
    assert found(spark, samples, settings, block) == searched(samples, settings)


def test_an_instant_before_from_it_on_and_repeated_rows(spark):
    samples = [("a", minutes(9), 1, 0, None), ("a", minutes(10), 2, 0, None), ("a", minutes(10), 2, 0, None), ("a", minutes(5000), 3, 0, None)]
    settings = [("a", minutes(10), 1, 2, "p")] * 2 + [("a", minutes(20), 1, None, "q")]
    assert found(spark, samples, settings, "1 hour") == [
        (1, "a", None, None, None), (2, "a", None, 2, "p"), (2, "a", None, 2, "p"), (3, "a", None, None, "q"),
    ]


def test_no_settings_and_no_samples(spark):
    assert found(spark, [("a", minutes(1), 1, 5, "x")], [], "1 hour") == [(1, "a", "x", None, None)]
    assert found(spark, [], [("a", minutes(1), 1, 5, "x")], "1 hour") == []


def test_clashing_names_pass_through(spark):
    samples = spark.createDataFrame([("a", minutes(1), 1, 7)], "device_id string, ts timestamp, _kind int, _row int")
    settings = spark.createDataFrame([("a", minutes(0), 3)], "device_id string, since timestamp, gain int")
    row = settings_in_force(samples, settings, ["gain"]).first()
    assert (row["_kind"], row["_row"], row.gain) == (1, 7, 3)

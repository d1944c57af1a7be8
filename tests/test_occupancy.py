import random
from datetime import timedelta

import pytest
from readings import START, at, make_readings, ms, random_readings

from sensorstream.operators import occupancy as occ
from sensorstream.operators import stats, trend


def make_events(spark, times, room="global"):
    return spark.createDataFrame([(room, t, "light") for t in times], "room string, at timestamp, kind string")


def moves(found):
    return sorted((r.room, ms(r.at), r.state, r.closed) for r in found.collect())


@pytest.mark.parametrize("block", [None, "1 hour", "10 days"])
def test_stays(spark, block):
    day = "2025-05-31 "
    events = make_events(spark, [at(day + t) for t in ("00:00:00", "01:00:00", "02:00:01")])
    wanted = [("00:00:00", occ.OCCUPIED, True), ("02:00:00", occ.UNOCCUPIED, True),
              ("02:00:01", occ.OCCUPIED, True), ("03:00:01", occ.UNOCCUPIED, False)]
    assert moves(occ.occupancy_transitions(events, block=block)) == [
        ("global", ms(at(day + t)), state, closed) for t, state, closed in wanted]


def walk(times_by_room, timeout_ms):
    out = []
    for room, times in times_by_room.items():
        times = sorted(set(times))
        for i, t in enumerate(times):
            if i == 0 or t - times[i - 1] > timeout_ms:
                out.append((room, t, occ.OCCUPIED, True))
            if i == len(times) - 1 or times[i + 1] - t > timeout_ms:
                out.append((room, t + timeout_ms, occ.UNOCCUPIED, i < len(times) - 1))
    return sorted(out)


@pytest.mark.parametrize("block", ["1 hour", "5 hours", None])
def test_stays_against_a_walk(spark, block):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "a", "b"]), START + timedelta(minutes=rnd.randrange(0, 12_000, 10))) for _ in range(250)]
    events = spark.createDataFrame(rows, "room string, at timestamp")
    by_room = {}
    for room, t in rows:
        by_room.setdefault(room, []).append(ms(t))
    assert moves(occ.occupancy_transitions(events, block=block)) == walk(by_room, 3_600_000)


def test_block_must_hold_the_timeout(spark):
    with pytest.raises(ValueError):
        occ.occupancy_transitions(make_events(spark, [START]), block="30 minutes")


def test_jump_needs_more_than_the_threshold(spark):
    first = make_readings(spark, [(START, 10), (START, 110)], "BH1750", "Illumination", "s1")
    second = make_readings(spark, [(START, 110.5), (START, 10)], "BH1750", "illumination", "s2")
    other = make_readings(spark, [(START, 1000), (START, 10)], "SCD41", "co2", "s3")
    windows = stats.sliding_stats(first.unionByName(second).unionByName(other))
    assert {r.device_id for r in occ.light_jumps(windows).collect()} == {"s2"}


def test_both_kinds_of_events_meet(spark):
    light = make_readings(spark, [(START, 10), (START, 200)], "BH1750", "illumination")
    co2 = make_readings(spark, [(START + timedelta(seconds=i), 400 + i) for i in range(4)])
    events = occ.occupancy_events(occ.light_jumps(stats.sliding_stats(light)), trend.trend_windows(co2))
    kinds = [r.kind for r in events.collect()]
    assert (kinds.count("light"), kinds.count("co2")) == (10, 5)
    transitions = moves(occ.occupancy_transitions(occ.with_global_key(events)))
    # first event: the first window end after the start; the last window ends 5 minutes after it
    assert [(t - ms(START), state) for _, t, state, _ in transitions] == [
        (30_000, occ.OCCUPIED), (300_000 + 3_600_000, occ.UNOCCUPIED)]


def test_one_room_is_not_one_task(spark):
    events = occ.with_global_key(random_readings(spark, 300).selectExpr("ts as at"))
    plan = occ.occupancy_transitions(events)._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" in plan and "Distinct" not in plan


def test_jumps_only_aggregate_their_metric(spark):
    """The metric is a key, so the filter goes below both aggregates."""
    windows = stats.sliding_stats(random_readings(spark, 50))
    plan = occ.light_jumps(windows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("lower(metric") > plan.rindex("Aggregate")

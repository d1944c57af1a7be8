"""Operators that look along a key: each against a plain walk over the same rows."""

import random
from datetime import timedelta

import pytest
from readings import START, at, by_key, make_readings, ms, random_readings
from pyspark.sql import functions as F

from sensorstream.operators import carry, changes, late, trailing, trend

KEYS = ("device_id", "sensor", "metric")

# A recorded run: 34 readings of one light sensor and, after some of them, the mean that was
# published from the readings of the last 300 s. (time, value, readings kept, published mean)
RECORDED = """
04:08:52.952 48.33 1 -
04:09:09.088 57.50 2 52.91
04:09:25.231 57.50 3 -
04:09:41.367 50.83 4 53.54
04:09:57.515 57.50 5 -
04:10:13.648 53.33 6 54.16
04:10:29.797 58.33 7 54.76
04:10:45.925 58.33 8 -
04:11:02.082 58.33 9 55.55
04:11:18.224 61.67 10 -
04:11:34.355 70.83 11 57.50
04:11:50.499 65.83 12 -
04:12:06.645 71.67 13 59.23
04:12:22.779 70.00 14 -
04:12:38.908 66.67 15 60.44
04:12:55.045 65.00 16 -
04:13:11.172 61.67 17 60.78
04:13:27.357 60.00 18 -
04:13:43.433 60.00 19 60.70
04:13:59.578 60.83 19 61.36
04:14:15.725 62.50 19 -
04:14:32.159 62.50 19 61.89
04:14:48.286 70.83 19 -
04:15:04.431 77.50 19 63.99
04:15:20.597 83.33 19 -
04:15:36.698 87.50 19 67.10
04:15:52.832 90.00 19 -
04:16:08.969 90.83 19 70.48
04:16:25.123 90.83 19 -
04:16:41.272 90.83 19 73.07
04:16:57.403 90.00 19 -
04:17:13.535 90.00 19 75.31
04:17:29.669 90.00 19 76.36
04:17:45.823 90.00 19 -
"""


def test_recorded_rolling_mean(spark):
    from sensorstream.operators.publish import rolling_mean_records

    recorded = [line.split() for line in RECORDED.strip().splitlines()]
    readings = make_readings(
        spark, [(at(f"2025-05-31 {t}"), float(v)) for t, v, _, _ in recorded], "BH1750", "illumination"
    )
    means = trailing.rolling_mean_per_reading(readings, keep=["src_offset"])
    texts = {r.src_offset: r.value for r in rolling_mean_records(means, keep=["src_offset"]).collect()}
    counts = {r.src_offset: r.n for r in means.collect()}
    assert [counts[i] for i in range(34)] == [int(n) for _, _, n, _ in recorded]
    published = {i: mean for i, (_, _, _, mean) in enumerate(recorded) if mean != "-"}
    assert len(published) == 18
    assert {i: texts[i] for i in published} == published


def test_trailing_frame(spark):
    # steps of 10 s, so many readings are exactly one width old or share a time
    readings = random_readings(spark, 500, span_s=6_000, step_ms=10_000)
    found = {
        (r.device_id, r.src_offset): (r.n, round(r.sum_value, 6), r.min_value, r.max_value)
        for r in trailing.trailing(readings, "5 minutes", keep=["src_offset"]).collect()
    }
    wanted = {}
    for key, rows in by_key(readings, "device_id").items():
        for row in rows:
            inside = [o.value for o in rows if 0 <= ms(row.ts) - ms(o.ts) < 300_000]
            wanted[(*key, row.src_offset)] = (len(inside), round(sum(inside), 6), min(inside), max(inside))
    assert found == wanted


def test_trailing_mean_keeps_small_values_beside_huge_ones(spark):
    rows = [(START, 1e17), (START + timedelta(seconds=301), 1.0), (START + timedelta(seconds=302), 2.0)]
    found = trailing.rolling_mean_per_reading(make_readings(spark, rows), "5 minutes").orderBy("ts")
    assert [r.mean_value for r in found.collect()] == [1e17, 1.0, 1.5]


def test_trailing_mean_of_missing_values(spark):
    rows = [(START, None), (START + timedelta(seconds=1), 3), (START + timedelta(seconds=2), None)]
    found = trailing.rolling_mean_per_reading(make_readings(spark, rows), "5 minutes").orderBy("ts").collect()
    assert [(r.n, r.mean_value) for r in found] == [(0, None), (1, 3.0), (1, 3.0)]


def test_sudden_increase(spark):
    rows = [(START, 10), (START + timedelta(seconds=30), 110), (START + timedelta(seconds=59), 111),
            (START + timedelta(seconds=60), 112), (START + timedelta(seconds=300), 5)]
    found = trailing.sudden_increases(make_readings(spark, rows, "BH1750", "illumination")).collect()
    assert [(ms(r.at) - ms(START), r.rise) for r in found] == [(59_000, 101.0)]


@pytest.mark.parametrize("block", ["1 minute", "1 hour", "7 days"])
def test_threshold_changes(spark, block):
    rows = [(START + timedelta(minutes=i), v) for i, v in enumerate([281, 700, 700.01, 900, 700])]
    found = changes.threshold_changes(make_readings(spark, rows), block=block).orderBy("ts")
    assert [(ms(r.ts) - ms(START), r.above) for r in found.collect()] == [
        (0, False), (120_000, True), (240_000, False)]
    records = changes.threshold_records(found)
    assert [(r.topic, r.value) for r in records.collect()] == [
        ("i483-actuators-s1001-co2_threshold_crossed", v) for v in ("no", "yes", "no")]


def test_a_level_that_stays_changes_once(spark):
    rows = [(START + timedelta(seconds=16 * i), 281) for i in range(35)]
    found = changes.threshold_changes(make_readings(spark, rows)).collect()
    assert [(r.value, r.above) for r in found] == [(281.0, False)]


def walk_changes(readings):
    out = []
    for key, rows in by_key(readings, *KEYS).items():
        last = None
        for row in rows:
            above = row.value > 700
            if above != last:
                out.append((*key, ms(row.ts), row.src_offset, above))
            last = above
    return sorted(out)


@pytest.mark.parametrize("block", ["10 seconds", "10 minutes", "30 days"])
def test_threshold_changes_against_a_walk(spark, block):
    readings = random_readings(spark, 600, step_ms=5_000)
    for shuffled in (readings, readings.orderBy(F.rand(5)).repartition(7)):
        found = changes.threshold_changes(shuffled, block=block).collect()
        assert sorted((*[r[k] for k in KEYS], ms(r.ts), r.src_offset, r.above) for r in found) == walk_changes(readings)


def test_changes_read_their_input_once(spark):
    readings = random_readings(spark, 300)
    df = changes.threshold_changes(readings)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_recorded_carry_forward(spark):
    rows = [("14:54:54", 60.83, 60.83), ("14:55:11", 65.0, 65.0), ("14:55:27", None, 65.0),
            ("14:55:43", 63.33, 63.33), ("14:56:00", None, 63.33)]
    samples = make_readings(spark, [(at(f"2025-05-31 {t}"), v) for t, v, _ in rows], "BH1750", "illumination")
    found = carry.carry_forward(samples, block="30 seconds").orderBy("ts")
    assert [r.published for r in found.collect()] == [p for _, _, p in rows]


@pytest.mark.parametrize("block", ["10 seconds", "10 minutes", "30 days"])
def test_carry_forward_against_a_walk(spark, block):
    readings = random_readings(spark, 500, step_ms=2_000)
    samples = readings.withColumn("value", F.when(F.col("src_offset") % 4 == 0, F.col("value")))
    found = carry.carry_forward(samples.orderBy(F.rand(3)), block=block)
    assert found.columns == [*samples.columns, "published"]
    wanted = {}
    for key, rows in by_key(samples, *KEYS).items():
        last = None
        for row in rows:
            last = row.value if row.value is not None else last
            wanted[row.src_offset] = last
    assert {r.src_offset: r.published for r in found.collect()} == wanted
    assert carry.published_samples(found).count() == sum(v is not None for v in wanted.values())


def test_late_rows(spark):
    rows = [(at("2025-05-31 04:10:00"), 1), (at("2025-05-31 04:09:49"), 2), (at("2025-05-31 04:09:50"), 3)]
    for block_rows in (1, 2, 1000):
        found = late.late_rows(make_readings(spark, rows), block_rows=block_rows).collect()
        assert [(r.value, r.lag_ms) for r in found] == [(2.0, 11_000)]


@pytest.mark.parametrize("block_rows", [3, 100, 10_000])
def test_late_rows_against_a_walk(spark, block_rows):
    readings = random_readings(spark, 300, span_s=600).withColumn("src_partition", (F.col("src_offset") % 3).cast("int"))
    wanted, top = [], {}
    for r in sorted(readings.collect(), key=lambda r: r.src_offset):
        lag = top.get(r.src_partition, ms(r.ts)) - ms(r.ts)
        if lag > 10_000:
            wanted.append((r.src_offset, lag))
        top[r.src_partition] = max(top.get(r.src_partition, 0), ms(r.ts))
    found = late.late_rows(readings, block_rows=block_rows).collect()
    assert sorted((r.src_offset, r.lag_ms) for r in found) == wanted


def test_null_partitions_keys_and_times_are_their_own(spark):
    rows = [(at("2025-05-31 04:10:00"), 1), (at("2025-05-31 04:00:00"), 2), (at("2025-05-31 04:09:00"), 3), (at("2025-05-31 04:08:00"), 4)]
    mixed = make_readings(spark, rows).withColumn("src_partition", F.when(F.col("src_offset") % 2 == 1, F.lit(0)))
    for block_rows in (1, 1000):
        assert [(r.value, r.src_partition, r.lag_ms) for r in late.late_rows(mixed, block_rows=block_rows).collect()] == [(3.0, None, 60_000)]
    samples = mixed.withColumns({"device_id": F.when(F.col("src_offset") != 1, F.lit("0")), "sensor": F.lit(None).cast("string"),
                                 "value": F.when(F.col("value") != 3, F.col("value")), "ts": F.when(F.col("src_offset") != 0, F.col("ts"))})
    for block in ("1 second", "1 day"):
        got = carry.carry_forward(samples, block=block).collect()
        assert sorted((r.src_offset, r.device_id, r.published) for r in got) == [(0, "0", 1.0), (1, None, 2.0), (2, "0", 4.0), (3, "0", 4.0)]


def walk_trend(readings, keys, size_ms, slide_ms, min_points=3, strict=False):
    out = []
    for key, rows in by_key(readings, *keys).items():
        starts = {(ms(r.ts) // slide_ms - i) * slide_ms for r in rows for i in range(size_ms // slide_ms)}
        for start in starts:
            values = [r.value for r in rows if start <= ms(r.ts) < start + size_ms]
            if len(values) >= min_points and all(a < b if strict else a <= b for a, b in zip(values, values[1:])):
                out.append((*key, start, len(values)))
    return sorted(out)


def trend_rows(found, keys):
    return sorted((*[r[k] for k in keys], ms(r.window_start), r.n) for r in found.collect())


@pytest.mark.parametrize("values, fires", [((1, 2, 3), True), ((2, 2, 2), True), ((1, 3, 2), False), ((1, 2), False)])
def test_trend_of_one_window(spark, values, fires):
    rows = [(START + timedelta(seconds=15 * i), v) for i, v in enumerate(values)]
    readings = make_readings(spark, rows)
    assert (trend.trend_windows(readings).count() > 0) is fires
    if values == (2, 2, 2):
        assert trend.trend_windows(readings, strict=True).count() == 0


@pytest.mark.parametrize("keys", [("sensor",), ("device_id", "sensor")])
@pytest.mark.parametrize("pane, strict", [(None, False), ("1 second", False), ("1 minute", True)])
def test_trend_against_a_walk(spark, keys, pane, strict):
    rnd = random.Random(11)
    rows, level = [], 0
    for i in range(400):
        level = level + rnd.randrange(3) if rnd.random() < 0.9 else rnd.randrange(10)
        rows.append((START + timedelta(seconds=rnd.choice([0, 15, 40]) + 40 * i), level, f"s{1001 + i % 2}"))
    readings = make_readings(spark, rows)
    found = trend.trend_windows(readings.orderBy(F.rand(1)), key_cols=keys, pane=pane, strict=strict)
    wanted = walk_trend(readings, keys, 300_000, 60_000, strict=strict)
    assert len(wanted) > 20 or strict
    assert trend_rows(found, keys) == wanted


def test_readings_at_the_same_time_keep_arrival_order(spark):
    up = make_readings(spark, [(START, 1), (START, 2), (START, 3)])
    down = make_readings(spark, [(START, 3), (START, 2), (START, 1)])
    assert trend.trend_windows(up).count() == 5
    assert trend.trend_windows(down).count() == 0


def held_by_hand(samples, tick_ms, until_ms):
    out = []
    for key, rows in by_key(samples.where("ts is not null and value is not null"), "device_id").items():
        tick = -(-ms(rows[0].ts) // tick_ms) * tick_ms
        while tick < until_ms:
            out.append((key[0] or "", tick, [r.value for r in rows if ms(r.ts) <= tick][-1]))
            tick += tick_ms
    return sorted(out)


def held_rows(df):
    return sorted((r.device_id or "", ms(r.at), r.value) for r in df.collect())


@pytest.mark.parametrize("block_ticks", [1, 4, 240])
def test_held_values(spark, block_ticks):
    samples = random_readings(spark, 150, span_s=6_000, step_ms=5_000).withColumns({
        "value": F.when(F.col("src_offset") % 3 != 0, F.col("value")),
        "device_id": F.nullif("device_id", F.lit("s1003")),
    })
    odd = samples.limit(2).withColumn("ts", F.lit(None).cast("timestamp"))
    until = START + timedelta(seconds=9_000)
    found = carry.held_values(samples.unionByName(odd), F.lit(until), "20 seconds", block_ticks=block_ticks)
    wanted = held_by_hand(samples, 20_000, ms(START) + 9_000_000)
    assert held_rows(found) == wanted and len(wanted) > 1000
    early = carry.held_values(samples, F.lit(START + timedelta(seconds=3_000)), "20 seconds", block_ticks=block_ticks)
    assert held_rows(early) == held_by_hand(samples, 20_000, ms(START) + 3_000_000)


def test_held_values_of_nothing(spark):
    none = make_readings(spark, [(START, None)])
    assert carry.held_values(none, "2030-01-01").count() == 0
    assert carry.held_values(make_readings(spark, [(START, 1)]), F.lit(START)).count() == 0


def test_windows_are_split_where_the_watermark_had_closed_them(spark):
    """On time and late together are every reading in every of its windows; a partition's first reading is never late."""
    rnd = random.Random(5)
    rows = [(START + timedelta(seconds=30 * i - rnd.choice((0, 0, 0, 200, 900))), None if i % 11 == 0 else i, f"s{i % 2}") for i in range(300)]
    readings = make_readings(spark, rows).withColumn("src_partition", F.nullif(F.col("src_offset").cast("int") % 3, F.lit(2)))
    for block_rows in (10, 10**6):
        split = late.split_windows(readings, "5 minutes", "1 minute", "30 seconds", block_rows=block_rows)
        on_time, closed, top = {}, [], {}
        for r in sorted(readings.where("value is not null").collect(), key=lambda r: r.src_offset):
            t, limit = ms(r.ts), top.get(r.src_partition, -(10**15)) - 30_000
            for end in range((t // 60_000 + 1) * 60_000, (t // 60_000 + 6) * 60_000, 60_000):
                if end <= limit:
                    closed.append((r.src_offset, end))
                else:
                    on_time.setdefault((r.device_id, end), []).append(r.value)
            top[r.src_partition] = max(top.get(r.src_partition, t), t)
        assert sorted((r.src_offset, ms(r.window_end)) for r in split.late.collect()) == sorted(closed) and len(closed) > 20
        found = {(r.device_id, ms(r.window_end)): (r.min_value, r.max_value, round(r.avg_value, 8), r.n) for r in split.on_time.collect()}
        assert found == {k: (min(v), max(v), round(sum(v) / len(v), 8), len(v)) for k, v in on_time.items()}
    assert late.split_windows(readings.limit(0)).late.count() == 0
    with pytest.raises(ValueError):
        late.split_windows(readings, "5 minutes", "2 minutes")

import random
from datetime import timedelta

import pytest
from readings import START, at, make_readings, ms, random_readings
from pyspark.sql import functions as F

from sensorstream.operators import stats

KEYS = ("device_id", "sensor", "metric")


def as_rows(windows):
    return sorted(
        (r.device_id, ms(r.window_start), ms(r.window_end), r.min_value, r.max_value, round(r.avg_value, 8), r.n)
        for r in windows.collect()
    )


def brute(readings, size_ms, slide_ms, left_open=False):
    out = {}
    for r in readings.collect():
        t = ms(r.ts)
        end = (t // slide_ms - size_ms // slide_ms) * slide_ms
        while end <= t + size_ms + slide_ms:
            inside = end - size_ms < t <= end if left_open else end - size_ms <= t < end
            if inside:
                out.setdefault((r.device_id, end - size_ms, end), []).append(r.value)
            end += slide_ms
    return sorted((*k, min(v), max(v), round(sum(v) / len(v), 8), len(v)) for k, v in out.items())


@pytest.mark.parametrize("size, slide", [("5 minutes", "30 seconds"), ("5 minutes", "5 minutes"), ("2 minutes", "1 minute")])
def test_all_methods_match_brute_force(spark, size, slide):
    readings = random_readings(spark, 400)
    wanted = brute(readings, *(stats.duration_us(x) // 1000 for x in (size, slide)))
    for method in ("rows", "panes", "edges"):
        assert as_rows(stats.sliding_stats(readings, size, slide, method=method)) == wanted


def test_left_open_windows(spark):
    readings = random_readings(spark, 300, step_ms=15_000)
    found = stats.sliding_stats(readings, "5 minutes", "30 seconds", left_open=True)
    assert as_rows(found) == brute(readings, 300_000, 30_000, left_open=True)


@pytest.mark.parametrize("span_s, n", [(300, 500), (20_000, 60)])
def test_windows_of_many_slides_are_put_together_from_block_edges(spark, span_s, n):
    """Dense and sparse readings, from before the epoch on, with null keys, values and times."""
    readings = random_readings(spark, n, span_s=span_s, seed=span_s).withColumns({
        "ts": F.timestamp_millis(F.unix_millis("ts") - ms(START) - span_s * 500),
        "device_id": F.nullif("device_id", F.lit("s1002")),
        "value": F.when(F.col("src_offset") % 7 != 0, F.col("value")),
    })
    odd = readings.limit(3).withColumn("ts", F.lit(None).cast("timestamp"))
    for left_open in (False, True):
        found = stats.sliding_stats(readings.unionByName(odd), "2 minutes", "1 second", left_open=left_open)
        wanted = stats.sliding_stats(readings, "2 minutes", "1 second", left_open=left_open, method="panes")
        plain = lambda df: sorted((r.device_id or "", *r[3:6], round(r.avg_value, 8), r.n) for r in df.collect())
        assert plain(found) == plain(wanted) and found.count() > 200
    assert stats.sliding_stats(readings.limit(0), "2 minutes", "1 second").count() == 0


def test_block_edges_shuffle_panes_only(spark):
    readings = random_readings(spark, 50)
    plan = stats.sliding_stats(readings, "1 hour", "1 second")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Window [") >= 3


def test_window_edges(spark):
    readings = make_readings(spark, [(at("2025-05-31 04:00:00"), 1), (at("2025-05-31 04:05:00"), 2)])
    windows = as_rows(stats.sliding_stats(readings))
    assert len(windows) == 20
    assert all(w[-1] == 1 for w in windows)


def test_before_the_epoch(spark):
    readings = make_readings(spark, [(at("1969-12-31 23:59:59.5"), 1), (at("1970-01-01 00:00:00"), 2)])
    assert as_rows(stats.sliding_stats(readings, method="panes")) == as_rows(stats.sliding_stats(readings, method="rows"))


def test_missing_values_do_not_count(spark):
    rows = [(START, 4), (START, None), (START + timedelta(minutes=20), None)]
    readings = make_readings(spark, rows)
    for method in ("rows", "panes"):
        found = stats.sliding_stats(readings, method=method).collect()
        assert {(r.n, r.avg_value) for r in found} == {(1, 4.0)} and len(found) == 10


def test_maximum_of_values_that_are_not_positive(spark):
    zero = make_readings(spark, [(START, 0), (START, 0)], device="s1")
    below = make_readings(spark, [(START, -5), (START, -2)], device="s2")
    for readings, wanted in ((zero, 0.0), (below, -2.0)):
        assert {r.max_value for r in stats.sliding_stats(readings).collect()} == {wanted}
        floored = stats.sliding_stats(readings, compat_max_floor=True)
        assert {r.max_value for r in floored.collect()} == {4.9e-324}


def test_order_and_partitioning_of_the_input_do_not_matter(spark):
    readings = random_readings(spark, 300)
    wanted = as_rows(stats.sliding_stats(readings))
    for seed in (1, 2):
        assert as_rows(stats.sliding_stats(readings.orderBy(F.rand(seed)).repartition(5))) == wanted


def test_completeness(spark):
    full = [(START + timedelta(seconds=15 * i), i) for i in range(40)]
    windows = stats.sliding_stats(make_readings(spark, full))
    middle = windows.where(F.col("window_start") == F.lit(START + timedelta(minutes=2))).first()
    assert (middle.n, middle.expected_n, middle.is_complete) == (20, 20, True)
    assert stats.completeness(windows).where("n = 20").count() == 0
    wider = stats.sliding_stats(make_readings(spark, full), expected_interval="16 seconds")
    assert wider.first().expected_n == 18


def test_hot_key_is_combined_before_the_shuffle_and_spread_after_it(spark):
    readings = random_readings(spark, 2000, hot=0.9)
    plan = stats.sliding_stats(readings)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 2
    assert "_block" in plan


def test_wrong_settings(spark):
    readings = random_readings(spark, 3)
    with pytest.raises(ValueError):
        stats.sliding_stats(readings, "5 minutes", "2 minutes", method="panes")
    with pytest.raises(ValueError):
        stats.sliding_stats(readings, method="magic")


def test_uneven_slide_uses_rows(spark):
    readings = random_readings(spark, 100)
    found = stats.sliding_stats(readings, "5 minutes", "2 minutes")
    assert "window" in found.columns and found.count() > 0


def test_rolling_mean_on_schedule(spark):
    rnd = random.Random(3)
    rows = [(START + timedelta(seconds=30 * rnd.randrange(100)), rnd.randrange(100)) for _ in range(50)]
    found = {ms(r.at): (round(r.mean_value, 8), r.n) for r in stats.rolling_mean(make_readings(spark, rows)).collect()}
    t0 = ms(START)
    for tick in range(t0, t0 + 4_000_000, 30_000):
        inside = [v for w, v in rows if tick - 300_000 < ms(w) <= tick]
        assert found.get(tick) == ((round(sum(inside) / len(inside), 8), len(inside)) if inside else None)

"""Windowed statistics, rolling means, changes, trends and occupancy on tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as I
from catalogue.registry import query
from sensorstream.operators import carry, changes, late, occupancy, stats, trailing, trend
from sensorstream.operators.parse import only_metric
from sensorstream.plans.analytics import AnalyticsOptions, occupancy_event_stream, transition_records

KEY = "device_id, sensor, metric"
SECOND, MINUTE, HOUR = 1000, 60_000, 3_600_000


def millis(name: str, alias: str):
    return F.unix_millis(name).alias(alias)


def sql_stats(size_ms: int, slide_ms: int, name: str = "stats") -> str:
    return f"""{name} as (
  select {KEY}, start_ms, start_ms + {size_ms} as end_ms, min(value) as min_value, max(value) as max_value,
    round(sum(value) / count(*), 8) as avg_value, count(*) as n, {size_ms // 15000} as expected_n,
    count(*) = {size_ms // 15000} as is_complete
  from (select *, (ts_ms // {slide_ms} - i) * {slide_ms} as start_ms
        from readings, generate_series(0, {size_ms // slide_ms - 1}) as g(i))
  group by {KEY}, start_ms)"""


STATS_OUT = f"{KEY}, start_ms, end_ms, min_value, max_value, avg_value, n, expected_n::bigint as expected_n, is_complete"


def stats_out(windows):
    return windows.select(
        "device_id", "sensor", "metric", millis("window_start", "start_ms"), millis("window_end", "end_ms"),
        "min_value", "max_value", F.round("avg_value", 8).alias("avg_value"), "n", "expected_n", "is_complete",
    )


@query(f"with {I.SQL_READINGS}, {sql_stats(6 * HOUR, HOUR)} select {STATS_OUT} from stats")
def sliding_stats(spark, sf_dir):
    return stats_out(stats.sliding_stats(I.readings(spark, sf_dir), "6 hours", "1 hour"))


@query(f"with {I.SQL_READINGS}, {sql_stats(5 * MINUTE, 30 * SECOND)} select {STATS_OUT} from stats")
def sliding_stats_5m30s(spark, sf_dir):
    return stats_out(stats.sliding_stats(I.readings(spark, sf_dir)))


@query(f"with {I.SQL_READINGS}, {sql_stats(6 * HOUR, 10 * MINUTE)} select {STATS_OUT} from stats")
def sliding_stats_6h10m(spark, sf_dir):
    return stats_out(stats.sliding_stats(I.readings(spark, sf_dir), "6 hours", "10 minutes"))


@query(f"with {I.SQL_READINGS}, {sql_stats(6 * HOUR, HOUR)} select {STATS_OUT} from stats")
def sliding_stats_rows(spark, sf_dir):
    return stats_out(stats.sliding_stats(I.readings(spark, sf_dir), "6 hours", "1 hour", method="rows"))


@query(f"with {I.SQL_READINGS}, {sql_stats(HOUR, HOUR)} select {KEY}, start_ms, n, 4::bigint as expected_n, "
       "n = 4 as is_complete from stats where n <> 4")
def window_completeness(spark, sf_dir):
    windows = stats.sliding_stats(I.readings(spark, sf_dir), "1 hour", "1 hour", expected_interval="15 minutes")
    return stats.completeness(windows).select(
        "device_id", "sensor", "metric", millis("window_start", "start_ms"), "n", "expected_n", "is_complete"
    )


@query(f"""with {I.SQL_READINGS}, ticks as (
  select *, ((ts_ms + {15 * MINUTE - 1}) // {15 * MINUTE} + i) * {15 * MINUTE} as at_ms
  from readings, generate_series(0, 7) as g(i) where lower(metric) = 'illumination')
select {KEY}, at_ms, round(sum(value) / count(*), 8) as mean_value, count(*) as n from ticks group by all""")
def rolling_mean_scheduled(spark, sf_dir):
    light = only_metric(I.readings(spark, sf_dir), "illumination")
    return stats.rolling_mean(light, "2 hours", "15 minutes").select(
        "device_id", "sensor", "metric", millis("at", "at_ms"), F.round("mean_value", 8).alias("mean_value"), "n"
    )


@query(f"""with {I.SQL_READINGS}
select {KEY}, ts_ms, src_partition, src_offset, value, round(sum(value) over w / count(*) over w, 8) as mean_value,
  count(*) over w as n
from readings
window w as (partition by {KEY} order by ts_ms range between {6 * HOUR - 1} preceding and current row)""")
def rolling_mean_arrival(spark, sf_dir):
    means = trailing.rolling_mean_per_reading(
        I.readings(spark, sf_dir), "6 hours", keep=["src_partition", "src_offset"]
    )
    return means.select(
        "device_id", "sensor", "metric", millis("ts", "ts_ms"), "src_partition", "src_offset", "value",
        F.round("mean_value", 8).alias("mean_value"), "n",
    )


@query(f"""with {I.SQL_READINGS}, marked as (
  select *, value > 700 as above,
    lag(value > 700) over (partition by {KEY} order by ts_ms, src_partition, src_offset) as before
  from readings where lower(metric) = 'co2')
select {KEY}, ts_ms, value, case when above then 'yes' else 'no' end as message
from marked where before is null or before <> above""")
def threshold_changes(spark, sf_dir):
    return changes_out(changes.threshold_changes(only_metric(I.readings(spark, sf_dir), "co2"), block="6 hours"))


def changes_out(found):
    return found.select(
        "device_id", "sensor", "metric", millis("ts", "ts_ms"), "value",
        F.when(F.col("above"), "yes").otherwise("no").alias("message"),
    )


def sql_trend(key: str, size_ms: int, slide_ms: int, metric: str, name: str = "trend") -> str:
    return f"""{name} as (
  select {key}, start_ms, start_ms + {size_ms} as end_ms, count(*) as n
  from (
    select *, lag(value) over (partition by {key}, start_ms order by ts_ms, src_partition, src_offset) as before
    from (select *, (ts_ms // {slide_ms} - i) * {slide_ms} as start_ms
          from readings, generate_series(0, {size_ms // slide_ms - 1}) as g(i) where lower(metric) = '{metric}'))
  group by {key}, start_ms
  having count(*) >= 3 and not coalesce(bool_or(before > value), false))"""


def trend_out(windows, *keys):
    return windows.select(*keys, millis("window_start", "start_ms"), millis("window_end", "end_ms"), "n")


@query(f"with {I.SQL_READINGS}, {sql_trend('sensor', HOUR, 15 * MINUTE, 'co2')} select sensor, start_ms, end_ms, n from trend")
def trend_windows(spark, sf_dir):
    found = trend.trend_windows(only_metric(I.readings(spark, sf_dir), "co2"), "1 hour", "15 minutes")
    return trend_out(found, "sensor")


@query(f"with {I.SQL_READINGS}, {sql_trend('device_id, sensor', 6 * HOUR, HOUR, 'illumination')} "
       "select device_id, sensor, start_ms, end_ms, n from trend")
def trend_windows_by_device(spark, sf_dir):
    light = only_metric(I.readings(spark, sf_dir), "illumination")
    found = trend.trend_windows(light, "6 hours", "1 hour", key_cols=("device_id", "sensor"))
    return trend_out(found, "device_id", "sensor")


@query(f"with {I.SQL_READINGS}, {sql_stats(6 * HOUR, HOUR)} select {KEY}, start_ms, end_ms, min_value, max_value "
       "from stats where lower(metric) = 'illumination' and max_value - min_value > 100")
def light_jump(spark, sf_dir):
    windows = stats.sliding_stats(I.readings(spark, sf_dir), "6 hours", "1 hour")
    return occupancy.light_jumps(windows).select(
        "device_id", "sensor", "metric", millis("window_start", "start_ms"), millis("window_end", "end_ms"),
        "min_value", "max_value",
    )


@query(f"""with {I.SQL_READINGS}, frames as (
  select *, min(value) over (partition by {KEY} order by ts_ms
    range between {6 * HOUR - 1} preceding and current row) as lowest
  from readings where lower(metric) = 'illumination')
select {KEY}, ts_ms as at_ms, round(value - lowest, 8) as rise from frames where value - lowest > 100""")
def light_sudden_increase(spark, sf_dir):
    light = only_metric(I.readings(spark, sf_dir), "illumination")
    return trailing.sudden_increases(light, width="6 hours").select(
        "device_id", "sensor", "metric", millis("at", "at_ms"), F.round("rise", 8).alias("rise")
    )


# Window sizes at which the test events make both kinds of event, for rooms of one device and
# for one room of all.
BY_DEVICE = AnalyticsOptions(
    owner=I.OWNER, stats_size="3 hours", stats_slide="30 minutes", trend_size="6 hours", trend_slide="1 hour",
    trend_keys=("sensor",), room_keys=("device_id",), timeout="4 hours",
)
ONE_ROOM = AnalyticsOptions(
    owner=I.OWNER, stats_size="30 minutes", stats_slide="5 minutes", trend_size="20 minutes", trend_slide="5 minutes",
)


def sql_events(stats_ms, trend_ms, room: str) -> str:
    """Both kinds of events with the room they count for."""
    in_room = "device_id as room" if room == "device_id" else "'global' as room"
    trend_key = "sensor, device_id" if room == "device_id" else "sensor"
    return f"""{sql_stats(*stats_ms)}, {sql_trend(trend_key, *trend_ms, 'co2')},
events_found as (
  select {in_room}, 'light' as kind, end_ms as at_ms from stats
  where lower(metric) = 'illumination' and max_value - min_value > 100
  union all select {in_room}, 'co2' as kind, end_ms as at_ms from trend)"""


def sql_transitions(timeout_ms: int, source: str = "events_found") -> str:
    return f"""gaps as (
  select room, at_ms, lag(at_ms) over (partition by room order by at_ms) as before,
    lead(at_ms) over (partition by room order by at_ms) as after
  from (select distinct room, at_ms from {source})),
moves as (
  select room, 'Occupied' as state, at_ms, true as closed from gaps where before is null or at_ms - before > {timeout_ms}
  union all
  select room, 'Unoccupied' as state, at_ms + {timeout_ms} as at_ms, after is not null as closed from gaps
  where after is null or after - at_ms > {timeout_ms})"""


DEVICE_EVENTS = sql_events((3 * HOUR, 30 * MINUTE), (6 * HOUR, HOUR), "device_id")
ROOM_EVENTS = sql_events((30 * MINUTE, 5 * MINUTE), (20 * MINUTE, 5 * MINUTE), "room")


def _events(spark, sf_dir, options):
    readings = I.readings(spark, sf_dir)
    windows = stats.sliding_stats(readings, options.stats_size, options.stats_slide)
    return occupancy_event_stream(readings, windows, options)


@query(f"with {I.SQL_READINGS}, {DEVICE_EVENTS} select room as device_id, kind, at_ms from events_found")
def occupancy_events(spark, sf_dir):
    return _events(spark, sf_dir, BY_DEVICE).select("device_id", "kind", millis("at", "at_ms"))


@query(f"with {I.SQL_READINGS}, {DEVICE_EVENTS}, {sql_transitions(4 * HOUR)} "
       "select room as device_id, state, at_ms, closed from moves")
def occupancy_transitions(spark, sf_dir):
    events = _events(spark, sf_dir, BY_DEVICE)
    return occupancy.occupancy_transitions(events, ("device_id",), BY_DEVICE.timeout).select(
        "device_id", "state", millis("at", "at_ms"), "closed"
    )


@query(f"""with {I.SQL_READINGS}, {DEVICE_EVENTS}, {sql_transitions(4 * HOUR)}
select at_ms, 'i483-sensors-{I.OWNER}-analytics-occupancy_detection' as topic, state as value from moves""")
def occupancy_records(spark, sf_dir):
    moves = occupancy.occupancy_transitions(_events(spark, sf_dir, BY_DEVICE), ("device_id",), BY_DEVICE.timeout)
    return transition_records(moves, I.OWNER, keep=[millis("at", "at_ms")])


@query(f"with {I.SQL_READINGS}, {ROOM_EVENTS}, {sql_transitions(HOUR)} select room, state, at_ms, closed from moves")
def occupancy_one_room(spark, sf_dir):
    return occupancy.occupancy_transitions(_events(spark, sf_dir, ONE_ROOM)).select(
        "room", "state", millis("at", "at_ms"), "closed"
    )


@query(f"""with {I.SQL_READINGS}, arrivals as (
  select * replace ((src_offset // 5) * 5 + (4 - src_offset % 5) as src_offset, nullif(src_partition, 3) as src_partition) from readings),
seen as (
  select *, max(ts_ms) over (partition by src_partition order by src_offset
    rows between unbounded preceding and 1 preceding) as top
  from arrivals)
select {KEY}, ts_ms, src_partition, src_offset, top - ts_ms as lag_ms from seen where top - ts_ms > {20 * MINUTE}""")
def late_rows(spark, sf_dir):
    found = late.late_rows(I.arrivals(spark, sf_dir), "20 minutes", block_rows=1000)
    return found.select(
        "device_id", "sensor", "metric", millis("ts", "ts_ms"), "src_partition", "src_offset", "lag_ms"
    )


@query(f"""with {I.SQL_READINGS}, gappy as (
  select * replace (case when src_offset % 11 <> 0 then device_id end as device_id), case when src_offset % 3 <> 0 then value end as sample from readings)
select {KEY}, ts_ms, src_partition, src_offset, sample,
  last_value(sample ignore nulls) over (partition by {KEY} order by ts_ms, src_partition, src_offset
    rows between unbounded preceding and current row) as published
from gappy""")
def carry_forward(spark, sf_dir):
    # some readings have lost the name of their device
    gappy = I.readings(spark, sf_dir).withColumns({
        "sample": F.when(F.col("src_offset") % 3 != 0, F.col("value")), "device_id": F.when(F.col("src_offset") % 11 != 0, F.col("device_id")),
    })
    filled = carry.carry_forward(gappy, value="sample", block="6 hours")
    return filled.select(
        "device_id", "sensor", "metric", millis("ts", "ts_ms"), "src_partition", "src_offset", "sample", "published"
    )


def sql_held(tick_ms: int, until: str) -> str:
    """Every third reading without a value, some without a device; each key's grid of ticks from its first value on."""
    return f"""gappy as (
  select * replace (case when src_offset % 11 <> 0 then device_id end as device_id, case when src_offset % 3 <> 0 then value end as value)
  from readings),
known as (
  select {KEY}, (ts_ms + {tick_ms - 1}) // {tick_ms} * {tick_ms} as tick_ms, arg_max(value, (ts_ms, src_partition, src_offset)) as value
  from gappy where value is not null group by all),
spans as (
  select *, coalesce(lead(tick_ms) over (partition by {KEY} order by tick_ms), {until}) as next_ms from known),
held as (
  select {KEY}, unnest(range(tick_ms, least(next_ms, {until}), {tick_ms})) as at_ms, value from spans)"""


def gappy_samples(readings):
    return readings.withColumns({
        "value": F.when(F.col("src_offset") % 3 != 0, F.col("value")), "device_id": F.when(F.col("src_offset") % 11 != 0, F.col("device_id")),
    })


@query(f"with {I.SQL_READINGS}, {sql_held(30 * MINUTE, '(1706659200000)')} select {KEY}, at_ms, value from held")
def held_values(spark, sf_dir):
    held = carry.held_values(gappy_samples(I.readings(spark, sf_dir)), "2024-01-31", "30 minutes")
    return held.select("device_id", "sensor", "metric", millis("at", "at_ms"), "value")


def sql_split(size_ms: int, slide_ms: int, delay_ms: int) -> str:
    return f"""arrivals as (
  select * replace ((src_offset // 5) * 5 + (4 - src_offset % 5) as src_offset, nullif(src_partition, 3) as src_partition) from readings),
seen as (
  select *, max(ts_ms) over (partition by src_partition order by src_offset rows between unbounded preceding and 1 preceding) as top
  from arrivals),
in_windows as (
  select *, (ts_ms // {slide_ms} - i) * {slide_ms} as start_ms, (ts_ms // {slide_ms} - i) * {slide_ms} + {size_ms} as end_ms,
    coalesce(end_ms <= top - {delay_ms}, false) as is_late
  from seen, generate_series(0, {size_ms // slide_ms - 1}) as g(i))"""


def _split(spark, sf_dir):
    return late.split_windows(I.arrivals(spark, sf_dir), "1 hour", "10 minutes", "20 minutes", block_rows=1000)


@query(f"""with {I.SQL_READINGS}, {sql_split(HOUR, 10 * MINUTE, 20 * MINUTE)}
select {KEY}, start_ms, end_ms, min(value) as min_value, max(value) as max_value, round(sum(value) / count(*), 8) as avg_value, count(*) as n
from in_windows where not is_late group by all""")
def windows_on_time(spark, sf_dir):
    return _split(spark, sf_dir).on_time.select(
        "device_id", "sensor", "metric", millis("window_start", "start_ms"), millis("window_end", "end_ms"),
        "min_value", "max_value", F.round("avg_value", 8).alias("avg_value"), "n",
    )


@query(f"""with {I.SQL_READINGS}, {sql_split(HOUR, 10 * MINUTE, 20 * MINUTE)}
select {KEY}, ts_ms, src_partition, src_offset, value, start_ms, end_ms from in_windows where is_late""")
def late_windows(spark, sf_dir):
    return _split(spark, sf_dir).late.select(
        "device_id", "sensor", "metric", millis("ts", "ts_ms"), "src_partition", "src_offset", "value",
        millis("window_start", "start_ms"), millis("window_end", "end_ms"),
    )

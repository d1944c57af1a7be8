"""The streaming operators, run over the whole of `events` to the end of the stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogue import inputs as I
from catalogue import messages as M
from catalogue import windows as W
from catalogue.registry import query
from sensorstream.operators import changes, samples, stats, trailing, trend
from sensorstream.operators.parse import only_metric
from sensorstream.plans import bridge as bridge_plan
from sensorstream.plans.analytics import analytics, from_windows, transition_records, window_rows
from sensorstream.sources.messages import read_stream, watermarked
from sensorstream.streaming.changes import last_status
from sensorstream.streaming.changes import threshold_changes_stream as changes_stream
from sensorstream.streaming.hold import held_values_stream as hold_stream
from sensorstream.streaming.latest import latest_to_table
from sensorstream.streaming.occupancy import occupancy_stays_stream as stays_stream
from sensorstream.streaming.run import run_to_table, shared_folder

# A window is written once the watermark, 10 s behind the last reading, has passed its end.
_WATERMARK = "(select max(ts_ms) - 10000 from readings)"


def _readings(spark, sf_dir):
    return watermarked(I.readings_of(I.record_stream(spark, sf_dir)))


@query(f"with {I.SQL_READINGS}, {W.sql_stats(6 * W.HOUR, W.HOUR)} select {W.STATS_OUT} from stats where end_ms <= {_WATERMARK}")
def stats_stream(spark, sf_dir):
    windows = stats.sliding_stats(_readings(spark, sf_dir), "6 hours", "1 hour").drop("window")
    return W.stats_out(run_to_table(windows, "stats"))


@query(f"""with {I.SQL_READINGS}, ticks as (
  select *, ((ts_ms + {15 * W.MINUTE - 1}) // {15 * W.MINUTE} + i) * {15 * W.MINUTE} as at_ms
  from readings, generate_series(0, 7) as g(i) where lower(metric) = 'illumination')
select {W.KEY}, at_ms, round(sum(value) / count(*), 8) as mean_value, count(*) as n from ticks
where at_ms < (select max(ts_ms) - 10000 from readings where lower(metric) = 'illumination') group by all""")
def rolling_mean_stream(spark, sf_dir):
    light = watermarked(only_metric(I.readings_of(I.record_stream(spark, sf_dir)), "illumination"))
    means = run_to_table(stats.rolling_mean(light, "2 hours", "15 minutes"), "means")
    return means.select(
        "device_id", "sensor", "metric", W.millis("at", "at_ms"), F.round("mean_value", 8).alias("mean_value"), "n"
    )


_SQL_CHANGES = f"""with {I.SQL_READINGS}, marked as (
  select *, value > 700 as above,
    lag(value > 700) over (partition by {W.KEY} order by ts_ms, src_partition, src_offset) as before
  from readings where lower(metric) = 'co2')
select {W.KEY}, ts_ms, value, case when above then 'yes' else 'no' end as message
from marked where (before is null or before <> above)
  and (ts_ms // 1000 + 1) * 1000 <= (select max(ts_ms) - 10000 from readings where lower(metric) = 'co2')"""


@query(_SQL_CHANGES)
def threshold_changes_stream(spark, sf_dir):
    co2 = watermarked(only_metric(I.readings_of(I.record_stream(spark, sf_dir)), "co2"))
    return W.changes_out(run_to_table(changes_stream(co2), "changes"))


@query(_SQL_CHANGES)
def threshold_changes_from_table(spark, sf_dir, handover="2024-01-16 00:00:00"):
    """What happened before the hand-over from a table, the rest from a stream that starts with the table's last status."""
    cut = F.lit(handover).cast("timestamp")
    history = only_metric(I.readings(spark, sf_dir), "co2").where(F.col("ts") < cut)
    rest = only_metric(I.readings_of(I.record_stream(spark, sf_dir)), "co2").where(F.col("ts") >= cut)
    found = run_to_table(changes_stream(watermarked(rest), initial=last_status(history)), "resumed")
    return W.changes_out(changes.threshold_changes(history, block="6 hours").unionByName(found))


@query(f"with {I.SQL_READINGS}, {W.sql_trend('sensor', W.HOUR, 15 * W.MINUTE, 'co2')} "
       "select sensor, start_ms, end_ms, n from trend "
       "where end_ms <= (select max(ts_ms) - 10000 from readings where lower(metric) = 'co2')")
def trend_stream(spark, sf_dir):
    co2 = watermarked(only_metric(I.readings_of(I.record_stream(spark, sf_dir)), "co2"))
    found = trend.trend_windows_stream(co2, "1 hour", "15 minutes").drop("window")
    return W.trend_out(run_to_table(found, "trends"), "sensor")


@query(f"""with {I.SQL_READINGS}, {W.DEVICE_EVENTS},
fired as (select * from events_found where at_ms <= {_WATERMARK}), {W.sql_transitions(4 * W.HOUR, 'fired')}
select room as device_id, state, at_ms from moves where at_ms <= {_WATERMARK} or state = 'Occupied'""")
def occupancy_stream(spark, sf_dir):
    graph = analytics(I.record_stream(spark, sf_dir), W.BY_DEVICE)
    # the event time of a window on a stream is its last microsecond
    at = F.unix_millis(F.timestamp_micros(F.unix_micros("at") + 1))
    return run_to_table(graph.transitions, "occupancy").select("device_id", "state", at.alias("at_ms"))


@query(f"""with {I.SQL_READINGS}, {W.DEVICE_EVENTS},
fired as (select * from events_found where at_ms <= {_WATERMARK}), {W.sql_transitions(4 * W.HOUR, 'fired')}
select at_ms, 'i483-sensors-{I.OWNER}-analytics-occupancy_detection' as topic, state as value from moves
where at_ms <= {_WATERMARK} or state = 'Occupied'""")
def occupancy_records_stream(spark, sf_dir):
    graph = analytics(I.record_stream(spark, sf_dir), W.BY_DEVICE)
    at = F.unix_millis(F.timestamp_micros(F.unix_micros("at") + 1)).alias("at_ms")
    return run_to_table(transition_records(graph.transitions, I.OWNER, keep=[at]), "occupancy-records")


# Windows that the windows query has written when its stream ends; those that follow it see no later time
# than the last end among them.
_CLOSED = f"closed as (select max(end_ms) as last_ms from stats where end_ms <= {_WATERMARK})"


def _followed(spark, sf_dir):
    """The windows table of the whole stream, and the results of a second stream that follows it."""
    folder = f"{shared_folder(spark)}/windows-{uuid.uuid4().hex}"
    written = run_to_table(window_rows(I.record_stream(spark, sf_dir), W.BY_DEVICE), "windows", folder=folder)
    return from_windows(read_stream(spark, f"{folder}/rows", written.schema), W.BY_DEVICE)


@query(f"""with {I.SQL_READINGS}, {W.DEVICE_EVENTS}, {_CLOSED},
fired as (select * from events_found where at_ms <= (select last_ms from closed)), {W.sql_transitions(4 * W.HOUR, 'fired')}
select room as device_id, state, at_ms from moves where at_ms <= (select last_ms from closed) or state = 'Occupied'""")
def occupancy_from_windows_stream(spark, sf_dir):
    moves = run_to_table(_followed(spark, sf_dir).transitions, "followed")
    return moves.select("device_id", "state", W.millis("at", "at_ms"))


@query(f"with {I.SQL_READINGS}, {W.sql_stats(3 * W.HOUR, 30 * W.MINUTE)} select {W.STATS_OUT} from stats where end_ms <= {_WATERMARK}")
def stats_from_windows_stream(spark, sf_dir):
    return W.stats_out(run_to_table(_followed(spark, sf_dir).stats, "followed-stats"))


@query(f"""with {I.SQL_READINGS}, bright as (
  select device_id, ts_ms, ts_ms - lag(ts_ms) over (partition by device_id order by ts_ms) as gap
  from readings where lower(metric) = 'illumination' and value > 100),
numbered as (
  select *, count(*) filter (where gap is null or gap > {2 * W.HOUR}) over (partition by device_id order by ts_ms) as stay
  from bright)
select device_id, min(ts_ms) as since_ms, max(ts_ms) + {2 * W.HOUR} as until_ms, count(*) as n from numbered
group by device_id, stay having max(ts_ms) + {2 * W.HOUR} + 1 <= (
  select max(ts_ms) - 10000 from bright)""")
def occupancy_stays_stream(spark, sf_dir):
    light = only_metric(I.readings_of(I.record_stream(spark, sf_dir)), "illumination").where(F.col("value") > 100)
    stays = stays_stream(watermarked(light).withColumnRenamed("ts", "at"), ("device_id",), "2 hours")
    return run_to_table(stays, "stays").select("device_id", W.millis("since", "since_ms"), W.millis("until", "until_ms"), "n")


@query(f"with {I.SQL_READINGS}, {W.sql_held(30 * W.MINUTE, _WATERMARK)} select {W.KEY}, at_ms, value from held")
def held_values_stream(spark, sf_dir):
    samples = W.gappy_samples(_readings(spark, sf_dir))
    held = run_to_table(hold_stream(samples, "30 minutes"), "held")
    return held.select("device_id", "sensor", "metric", W.millis("at", "at_ms"), "value")


# Six hours of readings show when the watermark has passed them.
_SHOWN = f"(ts_ms // {6 * W.HOUR} + 1) * {6 * W.HOUR}"


@query(f"""with {I.SQL_READINGS}, means as (
  select *, sum(value) over w / count(*) over w as mean, count(*) over w as n from readings
  window w as (partition by {W.KEY} order by ts_ms range between {6 * W.HOUR - 1} preceding and current row))
select {W.KEY}, ts_ms, src_partition, src_offset, value, round(mean, 8) as mean_value, n from means where {_SHOWN} <= {_WATERMARK}""")
def rolling_mean_arrival_stream(spark, sf_dir):
    means = trailing.rolling_mean_per_reading(_readings(spark, sf_dir), "6 hours", keep=["src_partition", "src_offset"])
    return run_to_table(means, "arrivals").select(
        "device_id", "sensor", "metric", W.millis("ts", "ts_ms"), "src_partition", "src_offset", "value",
        F.round("mean_value", 8).alias("mean_value"), "n",
    )


@query(f"""with {I.SQL_READINGS}, frames as (
  select *, min(value) over (partition by {W.KEY} order by ts_ms range between {6 * W.HOUR - 1} preceding and current row) as lowest
  from readings where lower(metric) = 'illumination')
select {W.KEY}, ts_ms as at_ms, round(value - lowest, 8) as rise from frames where value - lowest > 100
  and {_SHOWN} <= (select max(ts_ms) - 10000 from readings where lower(metric) = 'illumination')""")
def light_sudden_increase_stream(spark, sf_dir):
    light = watermarked(only_metric(I.readings_of(I.record_stream(spark, sf_dir)), "illumination"))
    found = run_to_table(trailing.sudden_increases(light, width="6 hours"), "rises")
    return found.select("device_id", "sensor", "metric", W.millis("at", "at_ms"), F.round("rise", 8).alias("rise"))


@query(f"with {M._SQL_ROUTED} select case when error is null then kafka_topic else 'i483-dead-messages' end as topic, "
       f"case when error is null then payload else cast({M._SQL_LETTER} as varchar) end as value from routed")
def bridge_stream(spark, sf_dir):
    landed = I.as_messages(I.record_stream(spark, sf_dir))
    return run_to_table(bridge_plan.bridge(landed, M._BRIDGE, M._failed_at()), "bridge")


@query(f"with {M._SQL_COMMANDS} select topic, arg_max(is_on, (ts_ms, src_partition, src_offset)) as is_on, "
       "max(ts_ms) as since_ms from commands group by topic")
def actuator_stream(spark, sf_dir):
    commands = samples.actuator_commands(M.command_messages(I.readings_of(I.record_stream(spark, sf_dir))))
    kept = latest_to_table(commands, f"{shared_folder(spark)}/actuators-{uuid.uuid4().hex}", ["topic"])
    return kept.select("topic", F.col("on").alias("is_on"), F.unix_millis("ts").alias("since_ms"))

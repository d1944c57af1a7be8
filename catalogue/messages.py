"""Sources, parsing, topics, bridge and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as I
from catalogue.registry import query
from sensorstream.functions.timing import local_time_text
from sensorstream.functions.topics import own_device_pattern, strip_prefix, to_kafka_topic
from sensorstream.operators import changes, parse, publish, samples, stats
from sensorstream.operators.parse import only_metric
from sensorstream.plans import analytics, collectors
from sensorstream.plans import bridge as plan
from sensorstream.plans.collectors import sensor_topic
from sensorstream.sinks import records as sinks
from sensorstream.sources import messages as src

PLACE = ("src_partition", "src_offset")
READING_OUT = ("device_id", "sensor", "metric", "topic", "ts_ms", "value", *PLACE)


def _reading_out(df):
    return df.withColumn("ts_ms", F.unix_millis("ts")).select(*READING_OUT)


@query(f"with {I.SQL_READINGS} select device_id, sensor, metric, topic, ts_ms, value, src_partition, src_offset from readings")
def parse_readings(spark, sf_dir):
    return _reading_out(I.readings(spark, sf_dir))


_SQL_PARSED = I.SQL_LINES + r""",
parts as (
  select *, string_split(raw, ',') as p from lines),
typed as (
  select *, p[1] as topic, string_split(p[1], '-') as t,
    case when regexp_full_match(p[2], '[+-]?[0-9]+')
          and try_cast(p[2] as bigint) between -62135596800000 and 253402300799999 then try_cast(p[2] as bigint) end as ts_ms,
    case when regexp_full_match(p[3], '\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*')
         then try_cast(p[3] as double) end as value
  from parts),
parsed as (
  select *, case when len(p) < 3 then 'too few parts' when ts_ms is null then 'bad timestamp'
    when value is null or not isfinite(value) then 'bad value'
    when len(t) <> 5 or t[1] <> 'i483' or t[2] <> 'sensors' then 'bad topic' end as reject_reason
  from typed)"""


def _parsed_lines(spark, sf_dir):
    return parse.parse_envelopes(I.lines(spark, sf_dir))


@query(f"with {_SQL_PARSED} select t[3] as device_id, t[4] as sensor, t[5] as metric, topic, ts_ms, value, "
       "src_partition, src_offset from parsed where reject_reason is null")
def parse_envelope_lines(spark, sf_dir):
    return _reading_out(parse.readings(_parsed_lines(spark, sf_dir)))


@query(f"with {_SQL_PARSED} select raw, reject_reason, src_partition, src_offset from parsed where reject_reason is not null")
def parse_rejects(spark, sf_dir):
    return parse.rejects(_parsed_lines(spark, sf_dir)).select("raw", "reject_reason", *PLACE)


@query(f"with {_SQL_PARSED} select reject_reason, count(*) as n from parsed where reject_reason is not null group by 1")
def reject_report(spark, sf_dir):
    return parse.reject_report(_parsed_lines(spark, sf_dir))


@query(f"with {I.SQL_RECORDS} select topic || ',' || ts_ms || ',' || coalesce(value, 'null') as raw, src_partition, src_offset from rec")
def decode_envelopes(spark, sf_dir):
    return parse.to_envelopes(parse.decode_records(I.records(spark, sf_dir)))


@query(f"with {I.SQL_RECORDS} select event_id, topic from rec "
       "where regexp_full_match(topic, 'i483-sensors-s[0-9]+-[A-Z0-9]+-[a-zA-Z0-9_]+')")
def topic_pattern_filter(spark, sf_dir):
    return parse.only_topics(I.records(spark, sf_dir)).select("event_id", "topic")


@query(f"with {I.SQL_RECORDS} select event_id, topic from rec "
       f"where regexp_full_match(topic, 'i483-sensors-{I.OWNER}-[A-Z0-9]+-[a-zA-Z0-9_]+')")
def own_topic_filter(spark, sf_dir):
    return parse.only_topics(I.records(spark, sf_dir), own_device_pattern(I.OWNER)).select("event_id", "topic")


@query(f"with {I.SQL_RECORDS} select event_id, value from rec where topic = 'i483-sensors-{I.OWNER}-BH1750-illumination'")
def fixed_topic(spark, sf_dir):
    chosen = src.from_topic(I.records(spark, sf_dir), sensor_topic(I.OWNER, "BH1750/illumination"))
    return chosen.select("event_id", "value")


@query(f"with {I.SQL_MESSAGES} select event_id, topic from messages where topic in ("
       + ", ".join(f"'i483/sensors/{I.OWNER}/{m}'" for m in (
           # fixed values: the topics of one device
           "SCD41/co2", "SCD41/temperature", "SCD41/humidity", "BH1750/illumination", "RPR0521RS/ambient_light",
           "RPR0521RS/proximity", "RPR0521RS/illumination", "RPR0521RS/infrared_illumination",
           "DPS310/temperature", "DPS310/air_pressure", "DPS310/altitude")) + ")")
def device_topic_list(spark, sf_dir):
    return src.from_device(I.messages(spark, sf_dir), I.OWNER).select("event_id", "topic")


@query(f"with {I.SQL_MESSAGES} select event_id, topic from messages where starts_with(topic, 'i483/sensors/{I.OWNER}/') "
       f"or topic = 'i483/sensors/{I.OWNER}' or regexp_full_match(topic, 'i483/sensors/[^/]*/SCD41/co2')")
def mqtt_filter(spark, sf_dir):
    filters = f"i483/sensors/{I.OWNER}/#  i483/sensors/+/SCD41/co2"
    return src.from_mqtt_filters(I.messages(spark, sf_dir), filters).select("event_id", "topic")


@query(f"with {I.SQL_MESSAGES} select event_id, replace(topic, '/', '-') as kafka_topic, payload from messages")
def mqtt_to_kafka_topic(spark, sf_dir):
    return I.messages(spark, sf_dir).select("event_id", to_kafka_topic(F.col("topic")).alias("kafka_topic"), "payload")


@query(f"with {I.SQL_MESSAGES} select event_id, case when starts_with(topic, 'i483/sensors/{I.OWNER}/') "
       f"then substr(topic, {len(I.OWNER) + 15}) else topic end as metric_key from messages")
def strip_topic_prefix(spark, sf_dir):
    key = strip_prefix(F.col("topic"), f"i483/sensors/{I.OWNER}/")
    return I.messages(spark, sf_dir).select("event_id", key.alias("metric_key"))


@query(f"with {I.SQL_MESSAGES} select substr(topic, {len(I.OWNER) + 15}) || ' = ' || payload as line from messages "
       f"where topic in ('i483/sensors/{I.OWNER}/SCD41/co2', 'i483/sensors/{I.OWNER}/BH1750/illumination', "
       f"'i483/sensors/{I.OWNER}/DPS310/temperature', 'i483/sensors/{I.OWNER}/RPR0521RS/proximity', "
       f"'i483/sensors/{I.OWNER}/RPR0521RS/infrared_illumination')")
def receive_log(spark, sf_dir):
    return publish.receive_log(src.from_device(I.messages(spark, sf_dir), I.OWNER), f"i483/sensors/{I.OWNER}/")


_BRIDGE = plan.BridgeOptions.from_properties({
    "mqtt.server": "tcp://broker.example:1883",
    "mqtt.topics.subscribe": "i483/sensors/#",
    "bootstrap.servers": "kafka.example:9092",
})

_SQL_ROUTED = I.SQL_MESSAGES + """,
routed as (
  select *, replace(topic, '/', '-') as kafka_topic,
    case when not regexp_full_match(replace(topic, '/', '-'), '[a-zA-Z0-9._-]{1,249}') then 'illegal topic name'
         when payload is null then 'no payload' end as error
  from messages where starts_with(topic, 'i483/sensors/'))"""
_SQL_LETTER = ("json_object('error', error, 'originalTopic', topic, 'originalPayload', payload, "
               "'timestamp', '1700000000000')")


def _failed_at():
    return F.timestamp_millis(F.lit(1700000000000))


@query(f"with {_SQL_ROUTED} select kafka_topic as topic, payload as value from routed where error is null")
def bridge_forwarded(spark, sf_dir):
    return plan.forwarded(plan.route(I.messages(spark, sf_dir), _BRIDGE))


@query(f"with {_SQL_ROUTED} select 'i483-dead-messages' as topic, cast({_SQL_LETTER} as varchar) as value "
       "from routed where error is not null")
def dead_letters(spark, sf_dir):
    return plan.dead(plan.route(I.messages(spark, sf_dir), _BRIDGE), _BRIDGE, _failed_at())


@query(f"with {_SQL_ROUTED} select case when error is null then kafka_topic else 'i483-dead-messages' end as topic, "
       f"case when error is null then payload else cast({_SQL_LETTER} as varchar) end as value from routed")
def bridge_records(spark, sf_dir):
    return plan.bridge(I.messages(spark, sf_dir), _BRIDGE, _failed_at())


@query(f"with {_SQL_PARSED} select src_partition, src_offset, 'i483-dead-messages' as topic, "
       "cast(json_object('error', reject_reason, 'originalTopic', topic, 'originalPayload', raw, "
       "'timestamp', '1700000000000') as varchar) as value from parsed where reject_reason is not null")
def reject_letters(spark, sf_dir):
    rejected = parse.rejects(_parsed_lines(spark, sf_dir))
    return sinks.reject_letters(rejected, _failed_at(), "raw", keep=PLACE)


def _sql_device_stats(size_ms: int, slide_ms: int) -> str:
    return I.SQL_READINGS + f""",
w as (
  select *, (ts_ms // {slide_ms} - i) * {slide_ms} as start_ms
  from readings, generate_series(0, {size_ms // slide_ms - 1}) as g(i)),
stats as (
  select device_id, sensor, metric, start_ms, min(value) as min_value, max(value) as max_value,
    sum(value) / count(*) as avg_value, count(*) as n
  from w group by all)"""


@query(f"""with {_sql_device_stats(21600000, 3600000)},
named as (
  select *, unnest(case when device_id = '{I.OWNER}' then [sensor, device_id || '_' || sensor]
                        else [device_id || '_' || sensor] end) as name from stats),
each as (
  select *, unnest(['min', 'max', 'avg']) as part from named)
select start_ms, 'i483-sensors-{I.OWNER}-analytics-' || name || '_' || part || '-' || metric as topic,
  round(case part when 'min' then min_value when 'max' then max_value else avg_value end, 8) as number
from each""")
def publish_records(spark, sf_dir):
    windows = stats.sliding_stats(I.readings(spark, sf_dir), "6 hours", "1 hour")
    windows = windows.withColumn("start_ms", F.unix_millis("window_start"))
    return publish.stats_records(windows, I.OWNER, keep=["start_ms"]).select(
        "start_ms", "topic", F.round("number", 8).alias("number")
    )


def _sql_means(source: str) -> str:
    """Means of five minutes, every half minute, as two-decimal records."""
    return f"""ticks as (
  select *, ((ts_ms + 29999) // 30000 + i) * 30000 as at_ms from {source}, generate_series(0, 9) as g(i)),
means as (
  select device_id, at_ms, sum(value) / count(*) as mean_value from ticks group by all)
select at_ms, 'i483-sensors-' || device_id || '-BH1750_avg-illumination' as topic, printf('%.2f', mean_value) as value from means"""


@query(f"""with {I.SQL_READINGS}, light as (select * from readings where lower(metric) = 'illumination'), {_sql_means('light')}""")
def two_decimal_records(spark, sf_dir):
    means = stats.rolling_mean(only_metric(I.readings(spark, sf_dir), "illumination"))
    return publish.rolling_mean_records(means, keep=[F.unix_millis("at").alias("at_ms")])


# The collectors of all devices: payloads are taken whole.
_DEVICES = [f"s{1000 + i}" for i in range(10)]
_TOPICS = ", ".join(f"'i483-sensors-{d}-{m}'" for m in ("BH1750-illumination", "SCD41-co2") for d in _DEVICES)
_SQL_NUMBER = r"'\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*'"
_SQL_COLLECTED = I.SQL_RECORDS + f""",
wanted as (
  select *, string_split(topic, '-') as t, coalesce(value, 'null') as payload from rec where topic in ({_TOPICS})),
taken as (
  select t[3] as device_id, t[4] as sensor, t[5] as metric, topic, ts_ms, src_partition, src_offset, payload,
    case when regexp_full_match(payload, {_SQL_NUMBER}) and payload <> '1e999' then cast(payload as double) end as value
  from wanted)"""


@query(f"""with {_SQL_COLLECTED}, light as (select * from taken where metric = 'illumination' and value is not null), {_sql_means('light')}""")
def collector_rolling_means(spark, sf_dir):
    means = collectors.rolling_means(I.records(spark, sf_dir), _DEVICES)
    return publish.rolling_mean_records(means, keep=[F.unix_millis("at").alias("at_ms")])


@query(f"""with {_SQL_COLLECTED}, marked as (
  select *, value > 700 as above, lag(value > 700) over (partition by device_id order by ts_ms, src_partition, src_offset) as before
  from taken where metric = 'co2' and value is not null)
select ts_ms, 'i483-actuators-' || device_id || '-co2_threshold_crossed' as topic, case when above then 'yes' else 'no' end as value
from marked where before is null or before <> above""")
def collector_crossings(spark, sf_dir):
    edges = collectors.crossings(I.records(spark, sf_dir), _DEVICES)
    return changes.threshold_records(edges, keep=[F.unix_millis("ts").alias("ts_ms")])


@query(f"""with {_SQL_COLLECTED}
select topic as source_topic, ts_ms, src_partition, src_offset, payload, 'bad value' as reject_reason from taken where value is null""")
def collector_rejects(spark, sf_dir):
    found = collectors.collected_rejects(I.records(spark, sf_dir), _DEVICES)
    return found.select(
        F.col("topic").alias("source_topic"), F.unix_millis("ts").alias("ts_ms"), *PLACE,
        F.col("value_text").alias("payload"), "reject_reason",
    )


@query(f"""with {I.SQL_RECORDS}, wanted as (
  select *, split_part(coalesce(value, 'null'), ',', 1) as v from rec
  where regexp_full_match(topic, 'i483-sensors-s[0-9]+-[A-Z0-9]+-[a-zA-Z0-9_]+'))
select src_partition, src_offset, 'i483-dead-messages' as topic, cast(json_object('error', 'bad value', 'originalTopic', topic,
  'originalPayload', coalesce(value, 'null'), 'timestamp', '1700000000000') as varchar) as value
from wanted where v = '1e999' or not regexp_full_match(v, {_SQL_NUMBER})""")
def analytics_rejects(spark, sf_dir):
    graph = analytics.analytics(I.records(spark, sf_dir), analytics.AnalyticsOptions(owner=I.OWNER))
    return sinks.reject_letters(graph.rejects, _failed_at(), "value_text", keep=PLACE)


_METRICS = {
    "SCD41": ("co2", "temperature", "humidity"),
    "BH1750": ("illumination",),
    "RPR0521RS": ("proximity",),
    "DPS310": ("temperature", "air_pressure"),
}


def _samples(spark, sf_dir):
    return I.table(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("sample_id"),
        F.expr("concat('s', cast(1000 + l_suppkey % 10 as string))").alias("device_id"),
        F.expr("cast(400 + l_partkey % 2000 as bigint)").alias("scd41_co2"),
        F.expr("l_tax * l_extendedprice").alias("scd41_temperature"),
        F.expr("l_discount * l_quantity").alias("scd41_humidity"),
        F.expr("case when l_linenumber % 3 <> 0 then l_extendedprice / cast(8 as double) end").alias("bh1750_illumination"),
        F.expr("cast(l_quantity as bigint)").alias("rpr0521rs_proximity"),
        F.expr("l_quantity - cast(25 as double)").alias("dps310_temperature"),
        F.expr("l_extendedprice / cast(100 as double)").alias("dps310_air_pressure"),
    )


@query("""
with s as (
  select l_orderkey * 8 + l_linenumber as sample_id, 's' || cast(1000 + l_suppkey % 10 as varchar) as device_id, *
  from lineitem),
m as (
  select sample_id, device_id, unnest(['SCD41/co2', 'SCD41/temperature', 'SCD41/humidity', 'BH1750/illumination',
      'RPR0521RS/proximity', 'DPS310/temperature', 'DPS310/air_pressure']) as name,
    unnest([cast(400 + l_partkey % 2000 as varchar), printf('%.2f', l_tax * l_extendedprice),
      printf('%.2f', l_discount * l_quantity),
      case when l_linenumber % 3 <> 0 then printf('%.2f', l_extendedprice / cast(8 as double)) end,
      cast(cast(l_quantity as bigint) as varchar), printf('%.2f', l_quantity - cast(25 as double)),
      printf('%.2f', l_extendedprice / cast(100 as double))]) as payload
  from s)
select sample_id, 'i483/sensors/' || device_id || '/' || name as topic, payload from m where payload is not null""")
def samples_unpivot(spark, sf_dir):
    return samples.samples_to_messages(_samples(spark, sf_dir), _METRICS, keep=["sample_id"])


_SQL_COMMANDS = I.SQL_READINGS + """,
commands as (
  select 'i483/actuators/' || device_id || '/co2_threshold_crossed' as topic, value > 700 as is_on,
    ts_ms, src_partition, src_offset
  from readings where lower(metric) = 'co2')"""


def command_messages(readings):
    return readings.select(
        F.when(F.lower("metric") == "co2",
               F.concat(F.lit("i483/actuators/"), "device_id", F.lit("/co2_threshold_crossed")))
        .otherwise(F.col("topic")).alias("topic"),
        F.when(F.col("value") > 700, "yes").otherwise("no").alias("payload"),
        "ts", *PLACE,
    )


@query(f"with {_SQL_COMMANDS} select topic, arg_max(is_on, (ts_ms, src_partition, src_offset)) as is_on, "
       "max(ts_ms) as since_ms from commands group by topic")
def actuator_latest(spark, sf_dir):
    commands = samples.actuator_commands(command_messages(I.readings(spark, sf_dir)))
    return samples.actuator_latest(commands).select(
        "topic", F.col("on").alias("is_on"), F.unix_millis("since").alias("since_ms")
    )


@query("select event_id, strftime(ts + interval 9 hour, '%Y-%m-%d %H:%M:%S') as local_text from events")
def local_time(spark, sf_dir):
    events = I.table(spark, sf_dir, "events")
    return events.select("event_id", local_time_text(F.col("ts").cast("timestamp")).alias("local_text"))

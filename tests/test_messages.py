"""Publishing, samples, commands, the bridge and the sinks."""

import json
from datetime import timedelta

import pytest
from readings import START, at, make_readings, ms
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.operators import publish, samples, stats
from sensorstream.plans import bridge as plan
from sensorstream.sinks import records as sinks

PROPERTIES = {
    "mqtt.server": "tcp://localhost:1883",
    "mqtt.topics.subscribe": "topic1",
    "bootstrap.servers": "localhost:9092",
}


def test_records_of_the_owner_and_of_others(spark):
    mine = make_readings(spark, [(START, 1), (START, 2)], "BH1750", "illumination", "s1001")
    other = make_readings(spark, [(START, 3)], "BH1750", "illumination", "s1002")
    windows = stats.sliding_stats(mine.unionByName(other), "30 seconds", "30 seconds")
    found = {r.topic: r.value for r in publish.stats_records(windows, "s1001").collect()}
    base = "i483-sensors-s1001-analytics-"
    assert found == {
        base + "BH1750_min-illumination": "1.0", base + "BH1750_max-illumination": "2.0",
        base + "BH1750_avg-illumination": "1.5", base + "s1001_BH1750_min-illumination": "1.0",
        base + "s1001_BH1750_max-illumination": "2.0", base + "s1001_BH1750_avg-illumination": "1.5",
        base + "s1002_BH1750_min-illumination": "3.0", base + "s1002_BH1750_max-illumination": "3.0",
        base + "s1002_BH1750_avg-illumination": "3.0",
    }


def test_occupancy_messages(spark):
    df = spark.createDataFrame([(True,), (False,)], "occupied boolean")
    assert [tuple(r) for r in publish.occupancy_records(df, "s1001").collect()] == [
        ("i483-sensors-s1001-analytics-occupancy_detection", v) for v in ("Occupied", "Unoccupied")]


def test_samples_become_messages(spark):
    df = spark.createDataFrame(
        [("s1001", 1, 1306, 22.465, "ok", True), ("s1002", 2, None, float("nan"), None, False)],
        "device_id string, n int, scd41_co2 int, scd41_temperature double, scd41_note string, scd41_flag boolean",
    )
    metrics = {"SCD41": ("co2", "temperature", "note", "flag")}
    found = sorted((r.n, r.topic, r.payload) for r in samples.samples_to_messages(df, metrics, keep=["n"]).collect())
    assert found == [
        (1, "i483/sensors/s1001/SCD41/co2", "1306"),
        (1, "i483/sensors/s1001/SCD41/flag", "true"),
        (1, "i483/sensors/s1001/SCD41/note", "ok"),
        (1, "i483/sensors/s1001/SCD41/temperature", f"{22.465:.2f}"),
        (2, "i483/sensors/s1002/SCD41/flag", "false"),
        (2, "i483/sensors/s1002/SCD41/temperature", "NaN"),
    ]
    with pytest.raises(TypeError):
        samples.samples_to_messages(df.selectExpr("device_id", "cast(1.5 as decimal(3,1)) scd41_co2"), {"SCD41": ("co2",)})


def test_latest_command_wins(spark):
    topic = "i483/actuators/s1001/co2_threshold_crossed"
    rows = [(topic, "no", START, 0, 1), (topic, "yes", START + timedelta(seconds=5), 0, 2),
            (topic, "Yes", START + timedelta(seconds=5), 0, 3), ("i483/other/s1001", "yes", START, 0, 4),
            (topic.replace("s1001", "s1002"), "yes", START, 0, 5)]
    df = spark.createDataFrame(
        rows, "topic string, payload string, ts timestamp, src_partition int, src_offset bigint")
    found = samples.actuator_latest(samples.actuator_commands(df.orderBy(F.rand(1))))
    assert {r.topic: r.on for r in found.collect()} == {topic: False, topic.replace("s1001", "s1002"): True}


def test_receive_log(spark):
    df = spark.createDataFrame([("i483/sensors/s1001/SCD41/co2", "1306")], "topic string, payload string")
    assert publish.receive_log(df, "i483/sensors/s1001/").first().line == "SCD41/co2 = 1306"


def test_bridge_options():
    options = plan.BridgeOptions.from_properties(PROPERTIES | {
        "mqtt.topics.subscribe": "topic1 topic2 topic3", "kafka.topic.separator": "_", "kafka.deadchannel": "test-dead"})
    assert options.mqtt_server == "tcp://localhost:1883"
    assert options.mqtt_filters == ("topic1", "topic2", "topic3")
    assert (options.topic_separator, options.dead_topic) == ("_", "test-dead")


def test_bridge_option_defaults():
    options = plan.BridgeOptions.from_properties(PROPERTIES)
    assert (options.topic_separator, options.dead_topic) == ("-", "i483-dead-messages")
    for name, value in {"linger.ms": "10", "delivery.timeout.ms": "1000", "request.timeout.ms": "500",
                        "partitioner.ignore.keys": "true", "metadata.max.age.ms": "5000"}.items():
        assert options.producer[name] == value
    changed = plan.BridgeOptions.from_properties(PROPERTIES | {"linger.ms": "50"})
    assert changed.producer["linger.ms"] == "50"
    assert changed.sink_options()["kafka.linger.ms"] == "50"
    assert changed.sink_options()["kafka.bootstrap.servers"] == "localhost:9092"


@pytest.mark.parametrize("missing", list(PROPERTIES))
def test_required_bridge_options(missing):
    with pytest.raises(ValueError):
        plan.BridgeOptions.from_properties({k: v for k, v in PROPERTIES.items() if k != missing})


def test_bridge_filters_by_any_blank():
    options = plan.BridgeOptions.from_properties(
        PROPERTIES | {"mqtt.topics.subscribe": "topic1   topic2\ttopic3\n\ttopic4"})
    assert options.mqtt_filters == ("topic1", "topic2", "topic3", "topic4")


MESSAGES = [
    ("a/b", "1"), ("a/c", ""), ("a/ä", 'quote " slash \\ line\nend'), ("a/d", None), ("other/x", "2"), ("a/" + "x" * 300, "3"),
]


def _bridge(spark):
    df = spark.createDataFrame([(t, p, START) for t, p in MESSAGES], "topic string, payload string, ts timestamp")
    return df, plan.BridgeOptions.from_properties(PROPERTIES | {"mqtt.topics.subscribe": "a/#"})


def test_bridge_loses_no_message(spark):
    df, options = _bridge(spark)
    routed = plan.route(df, options)
    assert sorted(tuple(r) for r in plan.forwarded(routed).collect()) == [("a-b", "1"), ("a-c", "")]
    failed_at = F.lit(at("2025-05-31 04:00:00"))
    letters = [json.loads(r.value) for r in plan.dead(routed, options, failed_at).collect()]
    assert {(x["error"], x["originalTopic"], x["originalPayload"], x["timestamp"]) for x in letters} == {
        (sinks.ILLEGAL_TOPIC, "a/ä", 'quote " slash \\ line\nend', str(ms(START))),
        (sinks.NO_PAYLOAD, "a/d", None, str(ms(START))),
        (sinks.ILLEGAL_TOPIC, "a/" + "x" * 300, "3", str(ms(START))),
    }
    whole = plan.bridge(df, options, failed_at)
    assert sorted(r.topic for r in whole.collect()) == ["a-b", "a-c"] + ["i483-dead-messages"] * 3


def test_sink_options():
    assert sinks.kafka_sink_options("k:9092", "t", **{"linger.ms": "5"}) == {
        "kafka.bootstrap.servers": "k:9092", "topic": "t", "kafka.linger.ms": "5"}
    assert "topic" not in sinks.kafka_sink_options("k:9092")


def test_one_record(spark):
    assert tuple(sinks.one_record(spark, "t", "yes").first()) == ("t", "yes")


def test_table_by_topic(spark, tmp_path):
    rows = [("hot", f"{i}-{'x' * (i % 50)}") for i in range(20_000)] + [("rare", "x")]
    path = str(tmp_path / "by_topic")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.createDataFrame(rows, "topic string, value string").repartition(8)
        sinks.write_by_topic(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    table = spark.read.parquet(path)
    assert sorted((r.topic, r.value) for r in table.collect()) == sorted(rows)
    assert len(list((tmp_path / "by_topic" / "topic=hot").glob("*.parquet"))) > 1
    assert len(list((tmp_path / "by_topic" / "topic=rare").glob("*.parquet"))) == 1


def test_fixed_metric_list():
    assert len(fixed.DEVICE_METRICS) == 11

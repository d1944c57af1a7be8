"""Landed MQTT messages to Kafka records, failures to the dead topic."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sensorstream import fixed
from sensorstream.functions.topics import split_filters, to_kafka_topic
from sensorstream.sinks import records as sinks
from sensorstream.sources.messages import from_mqtt_filters


@dataclass(frozen=True)
class BridgeOptions:
    mqtt_server: str
    mqtt_filters: tuple[str, ...]
    topic_separator: str = fixed.TOPIC_SEPARATOR
    dead_topic: str = fixed.DEAD_TOPIC
    producer: Mapping[str, str] = field(default_factory=dict)

    # fixed values: option names
    SERVER = "mqtt.server"
    FILTERS = "mqtt.topics.subscribe"
    SEPARATOR = "kafka.topic.separator"
    DEAD = "kafka.deadchannel"
    BOOTSTRAP = "bootstrap.servers"

    @classmethod
    def from_properties(cls, properties: Mapping[str, str]) -> BridgeOptions:
        missing = [name for name in (cls.SERVER, cls.FILTERS, cls.BOOTSTRAP) if properties.get(name) is None]
        if missing:
            raise ValueError(f"missing options: {', '.join(missing)}")
        own = {cls.SERVER, cls.FILTERS, cls.SEPARATOR, cls.DEAD}
        given = {name: value for name, value in properties.items() if name not in own}
        return cls(
            mqtt_server=properties[cls.SERVER],
            mqtt_filters=tuple(split_filters(properties[cls.FILTERS])),
            topic_separator=properties.get(cls.SEPARATOR, fixed.TOPIC_SEPARATOR),
            dead_topic=properties.get(cls.DEAD, fixed.DEAD_TOPIC),
            producer=fixed.PRODUCER_DEFAULTS | given,
        )

    def sink_options(self) -> dict[str, str]:
        """Producer options for the Spark sink, which sets the serializers itself."""
        own = {self.BOOTSTRAP, "key.serializer", "value.serializer"}
        passed = {name: value for name, value in self.producer.items() if name not in own}
        return sinks.kafka_sink_options(self.producer[self.BOOTSTRAP], **passed)


def route(messages: DataFrame, options: BridgeOptions) -> DataFrame:
    """Subscribed messages with the Kafka topic they map to and `error` where they cannot go.

    `error` comes out of a one-element generator, which keeps a filter on it from being moved
    down and checked a second time.
    """
    chosen = from_mqtt_filters(messages, " ".join(options.mqtt_filters))
    mapped = chosen.withColumn("kafka_topic", to_kafka_topic(F.col("topic"), options.topic_separator))
    error = sinks.bridge_error(F.col("kafka_topic"), F.col("payload"))
    return mapped.select("*", F.explode(F.array(error)).alias("error"))


def forwarded(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("error").isNull()).select(
        F.col("kafka_topic").alias("topic"), F.col("payload").alias("value")
    )


def dead(routed: DataFrame, options: BridgeOptions, at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if at is None else at
    return sinks.dead_letters(
        routed.where(F.col("error").isNotNull()),
        F.col("error"), F.col("topic"), F.col("payload"), at, options.dead_topic,
    )


def bridge(messages: DataFrame, options: BridgeOptions, at: Column | None = None) -> DataFrame:
    """All records in one frame, each with its topic: ready for one Kafka sink. One scan: every
    message becomes exactly one record."""
    routed = route(messages, options)
    at = F.current_timestamp() if at is None else at
    letter = sinks.letter(F.col("error"), F.col("topic"), F.col("payload"), at)
    return routed.select(
        F.when(F.col("error").isNull(), F.col("kafka_topic")).otherwise(options.dead_topic).alias("topic"),
        F.when(F.col("error").isNull(), F.col("payload")).otherwise(letter).alias("value"),
    )


def bridge_to_kafka(messages: DataFrame, options: BridgeOptions, checkpoint: str,
                    period: str | None = fixed.CHECKPOINT_PERIOD) -> DataStreamWriter:
    writer = bridge(messages, options).writeStream.format("kafka").options(**options.sink_options())
    return sinks.checkpointed(writer, checkpoint, period)


def bridge_to_tables(messages: DataFrame, options: BridgeOptions, forward_path: str, dead_path: str,
                     checkpoint: str, period: str | None = None) -> DataStreamWriter:
    """The same bridge into two tables, from one pass of the stream."""
    return sinks.to_tables(
        route(messages, options),
        checkpoint,
        {forward_path: forwarded, dead_path: lambda routed: dead(routed, options)},
        period,
    )

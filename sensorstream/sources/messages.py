"""Kafka options, table readers, and which messages to take."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream import fixed
from sensorstream.functions.topics import device_topics, mqtt_matches


def kafka_options(
    bootstrap_servers: str,
    pattern: str | None = None,
    topics: str | Iterable[str] | None = None,
    starting_offsets: str = "latest",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options for one subscription, by topic pattern or by name."""
    if (pattern is None) == (topics is None):
        raise ValueError("give either a topic pattern or topic names")
    options = {"kafka.bootstrap.servers": bootstrap_servers, "startingOffsets": starting_offsets}
    if pattern is not None:
        options["subscribePattern"] = pattern
    else:
        options["subscribe"] = topics if isinstance(topics, str) else ",".join(topics)
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options | extra


def read_kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """Needs the Spark Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load()


def read_kafka_table(spark: SparkSession, **options) -> DataFrame:
    """A bounded replay of the same topics."""
    options.setdefault("starting_offsets", "earliest")
    return spark.read.format("kafka").options(**kafka_options(**options)).load()


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Landed files as a stream."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Text files of `topic,timestampMs,value` lines."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def from_topic(messages: DataFrame, topic: str) -> DataFrame:
    """One fixed topic."""
    return messages.where(F.col("topic") == topic)


def from_topics(messages: DataFrame, topics: Iterable[str]) -> DataFrame:
    """A list of topics; a plain IN, so it reaches the scan and prunes partitions."""
    return messages.where(F.col("topic").isin(*topics))


def from_device(messages: DataFrame, device: str, metrics=fixed.DEVICE_METRICS) -> DataFrame:
    """The MQTT topics of one device."""
    return from_topics(messages, device_topics(device, metrics))


def from_mqtt_filters(messages: DataFrame, filters: str) -> DataFrame:
    """A white-space separated list of MQTT filters with `+` and `#`."""
    return messages.where(mqtt_matches(F.col("topic"), filters))


def watermarked(readings: DataFrame, delay: str = fixed.OUT_OF_ORDERNESS) -> DataFrame:
    """Event time with bounded disorder."""
    return readings.withWatermark("ts", delay)


def idle_source_settings(spark: SparkSession) -> None:
    """With several streaming sources, do not let a silent one hold the watermark back."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")

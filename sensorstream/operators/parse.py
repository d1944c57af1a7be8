"""Raw messages to typed readings, with a reason for every row that is not one.

All functions are projections and filters: no shuffle, and the same on batch and stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.text import parse_decimal, parse_integer
from sensorstream.functions.topics import topic_matches
from sensorstream.schemas import READING

TOO_FEW_PARTS = "too few parts"
BAD_TIMESTAMP = "bad timestamp"
BAD_VALUE = "bad value"
BAD_TOPIC = "bad topic"

# fixed values: the first and last millisecond of years 1 to 9999, what a Spark timestamp is meant to hold
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def decode_records(records: DataFrame) -> DataFrame:
    """Kafka rows to text records: a missing value becomes the text `null`.

    Takes topic, timestamp and value (binary or string), and partition and offset where
    the source has them.
    """
    have = set(records.columns)
    partition = F.col("partition") if "partition" in have else F.lit(0)
    offset = F.col("offset") if "offset" in have else F.lit(None)
    return records.select(
        "topic",
        F.unix_millis("timestamp").alias("ts_ms"),
        F.coalesce(F.col("value").cast("string"), F.lit("null")).alias("value_text"),
        partition.cast("int").alias("src_partition"),
        offset.cast("bigint").alias("src_offset"),
    )


def to_envelopes(decoded: DataFrame) -> DataFrame:
    """Decoded records as `topic,timestampMs,value` lines."""
    return decoded.select(
        F.concat_ws(",", "topic", F.col("ts_ms").cast("string"), "value_text").alias("raw"),
        "src_partition",
        "src_offset",
    )


def _judge(fields: DataFrame, keep: list[str]) -> DataFrame:
    """Typed columns with the reason a row is not a reading, null if it is one.

    A time outside of the years 1 to 9999 is a bad timestamp: conversion and windows further on
    would overflow and fail the job, so it is judged as a number, before it is converted.

    `fields` has topic, ts_ms, value, enough and the place in the source. Value and reason come
    out of a one-element generator: Spark would otherwise move a filter on them below the
    parsing and do all of it a second time inside the filter.
    """
    parts = F.col("_parts")
    known_topic = (
        (F.size(parts) == 5)
        & (F.get(parts, F.lit(0)) == fixed.TOPIC_ROOT)
        & (F.get(parts, F.lit(1)) == fixed.SENSOR_BRANCH)
    )
    typed = fields.withColumn("_parts", F.split("topic", fixed.TOPIC_SEPARATOR)).select(
        *keep,
        F.get(parts, F.lit(2)).alias("device_id"),
        F.get(parts, F.lit(3)).alias("sensor"),
        F.get(parts, F.lit(4)).alias("metric"),
        "topic",
        F.timestamp_millis(F.when(F.col("ts_ms").between(FIRST_MS, LAST_MS), F.col("ts_ms"))).alias("ts"),
        "src_partition",
        "src_offset",
        F.col("value").alias("_value"),
        "enough",
        F.coalesce(known_topic, F.lit(False)).alias("_known_topic"),
    )
    reason = (
        F.when(~F.col("enough"), TOO_FEW_PARTS)
        .when(F.col("ts").isNull(), BAD_TIMESTAMP)
        .when(F.col("_value").isNull(), BAD_VALUE)
        .when(~F.col("_known_topic"), BAD_TOPIC)
    )
    judged = F.struct(F.col("_value").alias("value"), reason.alias("reject_reason"))
    return typed.select("*", F.inline(F.array(judged))).drop("_value", "enough", "_known_topic")


def parse_envelopes(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """`topic,timestampMs,value` text; parts after the third are ignored."""
    have = set(lines.columns)
    if "src_partition" not in have:
        lines = lines.withColumn("src_partition", F.lit(0))
    if "src_offset" not in have:
        lines = lines.withColumn("src_offset", F.lit(None).cast("bigint"))
    line = F.col("_line")
    fields = (
        lines.withColumn("_line", F.split(F.col(raw), ","))
        .select(
            raw,
            "src_partition",
            "src_offset",
            F.get(line, F.lit(0)).alias("topic"),
            F.get(line, F.lit(1)).alias("_ts_text"),
            F.get(line, F.lit(2)).alias("_value_text"),
            (F.coalesce(F.size(line), F.lit(0)) >= 3).alias("enough"),
        )
        .withColumns({
            "ts_ms": parse_integer(F.col("_ts_text")),
            "value": parse_decimal(F.col("_value_text")),
        })
    )
    return _judge(fields, keep=[raw])


def parse_records(decoded: DataFrame, whole: bool = False) -> DataFrame:
    """Decoded records, without building the text line first.

    As in a line, a value ends at its first comma. With `whole` it is the whole text, blanks
    around it aside: `900,1` is then a bad value.
    """
    text = F.col("value_text") if whole else F.substring_index("value_text", ",", 1)
    fields = decoded.withColumn("_value_text", text).withColumns({
        "value": parse_decimal(F.col("_value_text")),
        "enough": F.lit(True),
    })
    return _judge(fields, keep=["value_text"])


def only_topics(df: DataFrame, pattern: str = fixed.ALL_DEVICES_PATTERN, topic: str = "topic") -> DataFrame:
    """Keep rows whose whole topic matches; apply before parsing.

    The parser alone would take result topics of five parts back in as readings.
    """
    return df.where(topic_matches(F.col(topic), pattern))


def readings(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).select(*READING.fieldNames())


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull())


def reject_report(parsed: DataFrame) -> DataFrame:
    return rejects(parsed).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def only_metric(df: DataFrame, metric: str) -> DataFrame:
    """Readings or stats of one metric, whatever the case of the name."""
    return df.where(F.lower("metric") == metric.lower())

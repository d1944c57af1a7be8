"""Rolling mean of one sensor and threshold changes of another, for one device or many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorstream import fixed
from sensorstream.operators import changes, parse, publish, stats
from sensorstream.schemas import READING_KEY
from sensorstream.sinks import records as sinks
from sensorstream.sources.messages import from_topics, watermarked
from sensorstream.streaming.changes import threshold_changes_stream
from sensorstream.streaming.run import stream_settings


ALL_METRICS = ("BH1750/illumination", "SCD41/co2")


def sensor_topic(device: str, sensor_metric: str) -> str:
    """'s1001', 'BH1750/illumination' to the Kafka topic of that metric."""
    return fixed.TOPIC_SEPARATOR.join(
        [fixed.TOPIC_ROOT, fixed.SENSOR_BRANCH, device, sensor_metric.replace("/", fixed.TOPIC_SEPARATOR)]
    )


def collect(source: DataFrame, devices: list[str], sensor_metric: str) -> DataFrame:
    """Readings of one metric of the given devices; a topic IN list prunes the source."""
    return parse.readings(_parsed(source, devices, [sensor_metric]))


def collected_rejects(source: DataFrame, devices: list[str], sensor_metrics: Sequence[str] = ALL_METRICS) -> DataFrame:
    """Messages of these metrics whose payload, taken whole, is no number."""
    return parse.rejects(_parsed(source, devices, sensor_metrics))


def _parsed(source: DataFrame, devices: list[str], sensor_metrics: Sequence[str]) -> DataFrame:
    chosen = from_topics(source, [sensor_topic(d, m) for m in sensor_metrics for d in devices])
    return parse.parse_records(parse.decode_records(chosen), whole=True)


def rolling_means(
    source: DataFrame,
    devices: list[str],
    sensor_metric: str = "BH1750/illumination",
    width: str = fixed.ROLLING_WIDTH,
    period: str = fixed.ROLLING_PERIOD,
    delay: str = fixed.OUT_OF_ORDERNESS,
) -> DataFrame:
    readings = collect(source, devices, sensor_metric)
    if readings.isStreaming:
        readings = watermarked(readings, delay)
    return stats.rolling_mean(readings, width, period, READING_KEY)


def crossings(
    source: DataFrame,
    devices: list[str],
    sensor_metric: str = "SCD41/co2",
    threshold: float = fixed.CO2_THRESHOLD,
    delay: str = fixed.OUT_OF_ORDERNESS,
) -> DataFrame:
    readings = collect(source, devices, sensor_metric)
    if readings.isStreaming:
        return threshold_changes_stream(watermarked(readings, delay), threshold)
    return changes.threshold_changes(readings, threshold)


def start_collectors(
    source: DataFrame,
    devices: list[str],
    checkpoint: str,
    bootstrap_servers: str,
    period: str | None = fixed.CHECKPOINT_PERIOD,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    means = publish.rolling_mean_records(rolling_means(source, devices))
    edges = changes.threshold_records(crossings(source, devices))
    letters = sinks.reject_letters(collected_rejects(source, devices), F.current_timestamp(), "value_text")
    with stream_settings(source.sparkSession, state_partitions):
        return [
            sinks.to_kafka(means, f"{checkpoint}/means", bootstrap_servers, period=period).start(),
            sinks.to_kafka(edges, f"{checkpoint}/crossings", bootstrap_servers, period=period).start(),
            sinks.to_kafka(letters, f"{checkpoint}/rejects", bootstrap_servers, period=period).start(),
        ]

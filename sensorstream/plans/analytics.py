"""Readings in, statistics and occupancy out: one graph, on tables and on streams."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorstream import fixed
from sensorstream.operators import occupancy as occ
from sensorstream.operators import parse, publish, stats, trend
from sensorstream.operators.parse import only_metric
from sensorstream.schemas import READING_KEY
from sensorstream.sinks import records as sinks
from sensorstream.sources.messages import read_stream, watermarked
from sensorstream.streaming.occupancy import occupancy_transitions_stream
from sensorstream.streaming.run import stream_settings

# kinds of rows in the windows table
STATS, TREND = "stats", "trend"


@dataclass(frozen=True)
class AnalyticsOptions:
    owner: str
    topic_pattern: str = fixed.ALL_DEVICES_PATTERN
    stats_size: str = fixed.STATS_SIZE
    stats_slide: str = fixed.STATS_SLIDE
    trend_size: str = fixed.TREND_SIZE
    trend_slide: str = fixed.TREND_SLIDE
    trend_metric: str = "co2"
    trend_keys: tuple[str, ...] = ("sensor",)
    jump_metric: str = "illumination"
    jump_threshold: float = fixed.JUMP_THRESHOLD
    timeout: str = fixed.OCCUPANCY_TIMEOUT
    delay: str = fixed.OUT_OF_ORDERNESS
    # empty: one room for all devices
    room_keys: tuple[str, ...] = field(default=())


@dataclass(frozen=True)
class Analytics:
    """The graph's outputs, lazily. `rejects` are the wanted messages that are no readings."""

    readings: DataFrame
    rejects: DataFrame
    stats: DataFrame
    records: DataFrame
    transitions: DataFrame


def parsed_messages(source: DataFrame, options: AnalyticsOptions) -> DataFrame:
    """Source rows (topic, timestamp, value, ...) of the wanted topics, parsed and judged."""
    wanted = parse.only_topics(source, options.topic_pattern)
    return parse.parse_records(parse.decode_records(wanted))


def found_trends(readings: DataFrame, options: AnalyticsOptions) -> DataFrame:
    find = trend.trend_windows_stream if readings.isStreaming else trend.trend_windows
    return find(
        only_metric(readings, options.trend_metric),
        options.trend_size,
        options.trend_slide,
        key_cols=tuple(dict.fromkeys([*options.trend_keys, *options.room_keys])),
    )


def occupancy_event_stream(readings: DataFrame, windows: DataFrame, options: AnalyticsOptions) -> DataFrame:
    """Light and trend events with the room they count for."""
    rooms = list(options.room_keys)
    trends = found_trends(readings, options)
    jumps = occ.light_jumps(windows, options.jump_threshold, options.jump_metric)
    events = occ.occupancy_events(jumps, trends, rooms)
    return events if rooms else occ.with_global_key(events)


def analytics(source: DataFrame, options: AnalyticsOptions) -> Analytics:
    """The whole graph over a table or a stream of source rows."""
    parsed = parsed_messages(source, options)
    readings = parse.readings(parsed)
    streaming = readings.isStreaming
    if streaming:
        readings = watermarked(readings, options.delay)
    windows = stats.sliding_stats(readings, options.stats_size, options.stats_slide, READING_KEY)
    events = occupancy_event_stream(readings, windows, options)
    rooms = options.room_keys or ("room",)
    follow = occupancy_transitions_stream if streaming else occ.occupancy_transitions
    return Analytics(
        readings=readings,
        rejects=parse.rejects(parsed),
        stats=windows,
        records=publish.stats_records(windows, options.owner),
        transitions=follow(events, rooms, options.timeout),
    )


def transition_records(transitions: DataFrame, owner: str, keep=()) -> DataFrame:
    occupied = transitions.withColumn("occupied", F.col("state") == occ.OCCUPIED)
    return publish.occupancy_records(occupied, owner, keep=keep)


def window_rows(source: DataFrame, options: AnalyticsOptions) -> DataFrame:
    """Statistics and trends of a stream or table as rows of one windows table, told apart by `kind`.

    On a stream this is the only query that keeps windows: records, lines and occupancy follow the table
    it appends to (`from_windows`), so the statistics have one state however many sinks there are.
    """
    readings = parse.readings(parsed_messages(source, options))
    if readings.isStreaming:
        readings = watermarked(readings, options.delay)
    windows = stats.sliding_stats(readings, options.stats_size, options.stats_slide, READING_KEY)
    tagged = [
        rows.drop("window").select(F.lit(kind).alias("kind"), "*")
        for kind, rows in ((STATS, windows), (TREND, found_trends(readings, options)))
    ]
    return tagged[0].unionByName(tagged[1], allowMissingColumns=True)


@dataclass(frozen=True)
class WindowResults:
    """What follows from a windows table, lazily."""

    stats: DataFrame
    records: DataFrame
    transitions: DataFrame


def from_windows(table: DataFrame, options: AnalyticsOptions) -> WindowResults:
    """The sinks' rows from the windows table, read as a table or followed as a stream.

    A stream of the table must bring what one batch of the windows query wrote in one micro-batch, as
    a file source without a limit of files does: windows come in the order in which they closed, so
    occupancy's watermark is the latest window's end, moved on by every window and not only by those
    that are events.
    """
    windows = table.where(F.col("kind") == STATS).drop("kind")
    rooms = list(options.room_keys)
    ordered = table.withWatermark("window_end", "0 seconds") if table.isStreaming else table
    is_jump = (
        (F.col("kind") == STATS)
        & (F.lower("metric") == options.jump_metric.lower())
        & (F.col("max_value") - F.col("min_value") > options.jump_threshold)
    )
    # out of a generator: a filter would be moved below the watermark and hide the other windows from it
    fired = F.when(is_jump, F.array(F.lit("light"))).when(F.col("kind") == TREND, F.array(F.lit("co2")))
    events = ordered.select(*rooms, F.col("window_end").alias("at"), F.explode(fired).alias("kind"))
    follow = occupancy_transitions_stream if table.isStreaming else occ.occupancy_transitions
    return WindowResults(
        stats=windows,
        records=publish.stats_records(windows, options.owner),
        transitions=follow(events if rooms else occ.with_global_key(events), rooms or ("room",), options.timeout),
    )


def start_analytics(
    source: DataFrame,
    options: AnalyticsOptions,
    checkpoint: str,
    bootstrap_servers: str,
    period: str | None = fixed.CHECKPOINT_PERIOD,
    state_partitions: int | None = None,
    console: bool = False,
) -> list[StreamingQuery]:
    """Start the streaming job. One query keeps the windows and appends them to a table below the
    checkpoint folder, whose log names the files of each batch once; the queries of the sinks follow
    that table, each with its own checkpoint. Rejects go to the dead topic; `console` also
    writes every result line below the checkpoint folder."""
    spark = source.sparkSession
    rows = window_rows(source, options)
    rejects = parse.rejects(parsed_messages(source, options))
    with stream_settings(spark, state_partitions):
        # the windows first: a follower must find the table's log
        started = [sinks.to_table(rows, f"{checkpoint}/windows", f"{checkpoint}/windows-query", period).start()]
        graph = from_windows(read_stream(spark, f"{checkpoint}/windows", rows.schema), options)
        started += [
            sinks.to_kafka(graph.records.select("topic", "value"), f"{checkpoint}/stats",
                           bootstrap_servers, period=period).start(),
            sinks.to_kafka(transition_records(graph.transitions, options.owner),
                           f"{checkpoint}/occupancy", bootstrap_servers, period=period).start(),
            sinks.to_kafka(sinks.reject_letters(rejects, F.current_timestamp(), "value_text"),
                           f"{checkpoint}/rejects", bootstrap_servers, period=period).start(),
        ]
        if console:
            for name, result in (("stats", graph.stats), ("occupancy", graph.transitions)):
                lines = sinks.to_lines(result, f"{checkpoint}/lines-{name}", f"{checkpoint}/console-{name}", period)
                started.append(lines.start())
    return started

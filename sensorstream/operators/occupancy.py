"""Occupancy events and the occupied/unoccupied state they drive, on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.timing import duration_us, floor_div
from sensorstream.operators.parse import only_metric
from sensorstream.operators.stats import event_time

OCCUPIED = "Occupied"
UNOCCUPIED = "Unoccupied"
GLOBAL_KEY = "global"
# Blocks are this many timeouts long.
BLOCK_TIMEOUTS = 24


def light_jumps(
    stats: DataFrame, threshold: float = fixed.JUMP_THRESHOLD, metric: str = "illumination"
) -> DataFrame:
    """Stats windows whose range exceeds the threshold; a drop counts like a rise."""
    return only_metric(stats, metric).where(F.col("max_value") - F.col("min_value") > threshold)


def as_events(windows: DataFrame, kind: str, key_cols=()) -> DataFrame:
    """Windows that fired, as occupancy events at their event time."""
    return windows.select(*key_cols, event_time(windows).alias("at"), F.lit(kind).alias("kind"))


def occupancy_events(jumps: DataFrame, trends: DataFrame, key_cols=()) -> DataFrame:
    """Both event sources as one table or stream."""
    return as_events(jumps, "light", key_cols).unionByName(as_events(trends, "co2", key_cols))


def with_global_key(events: DataFrame, name: str = "room") -> DataFrame:
    return events.withColumn(name, F.lit(GLOBAL_KEY))


def occupancy_transitions(
    events: DataFrame,
    key_cols=("room",),
    timeout: str = fixed.OCCUPANCY_TIMEOUT,
    block: str | None = None,
) -> DataFrame:
    """key_cols, state, at, closed.

    Occupied at an event with none in the `timeout` before it (exactly `timeout` apart is the
    same stay), Unoccupied `timeout` after an event with none in the `timeout` that follows.
    `closed` is false for the last Unoccupied of a key: more events may still put it off.

    Both questions look no further than `timeout`, so even the single global key is answered
    block by block: events are made distinct before the shuffle, and each goes to its own
    block and to a neighbour if it is within `timeout` of the border. Only the transitions,
    at most two per `timeout` and key, meet in one window per key for `closed`.
    """
    timeout_us = duration_us(timeout)
    block_us = duration_us(block) if block else BLOCK_TIMEOUTS * timeout_us
    if block_us < timeout_us:
        raise ValueError("a block must be at least as long as the timeout")
    keys = list(key_cols)
    at = F.col("_at")
    placed = (
        events.select(*keys, F.unix_micros("at").alias("_at"))
        .distinct()
        .withColumn(
            "_block",
            F.explode(F.sequence(floor_div(at - timeout_us, block_us), floor_div(at + timeout_us, block_us))),
        )
    )
    in_block = Window.partitionBy(*keys, "_block").orderBy("_at")
    gaps = (
        placed.withColumn("_since", at - F.lag("_at").over(in_block))
        .withColumn("_until", F.lead("_at").over(in_block) - at)
        .where(F.col("_block") == floor_div(at, block_us))
    )

    def far(gap):
        return F.coalesce(F.col(gap) > timeout_us, F.lit(True))

    found = F.array_compact(
        F.array(
            F.when(far("_since"), F.struct(F.lit(OCCUPIED).alias("state"), at.alias("_when"))),
            F.when(far("_until"), F.struct(F.lit(UNOCCUPIED).alias("state"), (at + timeout_us).alias("_when"))),
        )
    )
    moves = gaps.select(*keys, F.inline(found))
    along_key = Window.partitionBy(*keys).orderBy("_when")
    return moves.withColumn("_next", F.lead("_when").over(along_key)).select(
        *keys,
        "state",
        F.timestamp_micros("_when").alias("at"),
        ((F.col("state") == OCCUPIED) | F.col("_next").isNotNull()).alias("closed"),
    )

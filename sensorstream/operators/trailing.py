"""Aggregates over the readings of the last `width`, one result per reading.

A range frame over the whole key would sort a hot key in one task and re-add the frame for
every row. Here time is cut into blocks as long as the frame, so a frame is the end of one
block plus the start of the next. Every reading is sent to its own block and, moved forward
by `width`, to the next one. Inside a block the frame at position t is then

    own readings at or before t   (running aggregate, ascending)
  + moved readings after t        (running aggregate, descending)

which needs one shuffle, two sorts and one pass each, whatever the density, and never
subtracts, so no rounding error builds up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.timing import duration_us, floor_div
from sensorstream.schemas import READING_KEY
from sensorstream.streaming.trailing import trailing_stream


def trailing(readings: DataFrame, width: str, key_cols=READING_KEY, keep=()) -> DataFrame:
    """key_cols, ts, value, `keep`, and n, sum_value, min_value, max_value of (ts - width, ts]. A watermarked
    stream gives the same rows, once the watermark has passed a block of `width`."""
    if readings.isStreaming:
        return trailing_stream(readings, width, key_cols, keep)
    width_us = duration_us(width)
    keys = list(key_cols)
    columns = list(dict.fromkeys([*keys, "ts", "value", *keep]))
    at = F.unix_micros("ts")
    block = floor_div(at, width_us)

    def copy(home: bool):
        moved = 0 if home else 1
        return F.struct(
            F.lit(home).alias("_home"),
            (block + F.lit(moved)).alias("_block"),
            (at + F.lit(moved * width_us)).alias("_at"),
        )

    copies = readings.select(*columns, F.inline(F.array(copy(True), copy(False))))
    by_block = Window.partitionBy(*keys, "_block")
    so_far = by_block.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    later = by_block.orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("_home"), F.col("value"))
    before = F.when(~F.col("_home"), F.col("value"))
    out = copies.select(
        *columns,
        "_home",
        F.count(own).over(so_far).alias("_n1"),
        F.sum(own).over(so_far).alias("_s1"),
        F.min(own).over(so_far).alias("_l1"),
        F.max(own).over(so_far).alias("_h1"),
        F.count(before).over(later).alias("_n2"),
        F.sum(before).over(later).alias("_s2"),
        F.min(before).over(later).alias("_l2"),
        F.max(before).over(later).alias("_h2"),
    ).where("_home")
    return out.select(
        *columns,
        (F.col("_n1") + F.col("_n2")).alias("n"),
        (F.coalesce("_s1", F.lit(0.0)) + F.coalesce("_s2", F.lit(0.0))).alias("sum_value"),
        F.least("_l1", "_l2").alias("min_value"),
        F.greatest("_h1", "_h2").alias("max_value"),
    )


def rolling_mean_per_reading(
    readings: DataFrame, width: str = fixed.ROLLING_WIDTH, key_cols=READING_KEY, keep=()
) -> DataFrame:
    """At every reading, the mean of the readings newer than `width`, itself included.

    Missing values do not count; where there is nothing else, the mean is null.
    """
    frame = trailing(readings, width, key_cols, keep)
    return frame.withColumn("mean_value", F.try_divide("sum_value", "n")).drop(
        "sum_value", "min_value", "max_value"
    )


def sudden_increases(
    readings: DataFrame,
    threshold: float = fixed.JUMP_THRESHOLD,
    width: str = "1 minute",
    key_cols=READING_KEY,
) -> DataFrame:
    """Readings more than `threshold` above the lowest one of the last `width`."""
    frame = trailing(readings, width, key_cols)
    rise = F.col("value") - F.col("min_value")
    return frame.where(rise > threshold).select(*key_cols, F.col("ts").alias("at"), rise.alias("rise"))

"""Which rows, and which of their windows, a watermark would find late, on a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.timing import duration_us, floor_div, keeps_columns
from sensorstream.operators.stats import expand_panes, with_bounds
from sensorstream.schemas import READING_KEY


def with_arrival_top(readings: DataFrame, source_col: str, offset_col: str, block_rows: int) -> DataFrame:
    """All rows with `_at` and `_top_us`, the highest timestamp read before them, in microseconds; null for the first.

    Arrival order exists per source partition. It is cut into blocks of offsets, of equal
    size even when one partition holds most rows; per block only the highest timestamp
    travels on, from the block's last row in the same exchange, so the input is read once.
    Rows without an offset have no order: they make the query fail rather than pass unseen. Rows
    without a partition are one partition of their own.
    """
    offset = F.coalesce(F.col(offset_col), F.raise_error(f"late_rows: {offset_col} is null").cast("bigint"))
    # A structure is never null itself, and its null fields are equal to each other.
    place = F.struct(F.col(source_col).alias("source"), floor_div(offset, block_rows).alias("block"))
    placed = readings.withColumn("_at", F.unix_micros("ts")).withColumn("_place", place)
    before_block = (
        Window.partitionBy("_place.source").orderBy("_place.block").rowsBetween(Window.unboundedPreceding, -1)
    )
    in_block = Window.partitionBy("_place").orderBy(offset_col)
    seen = placed.withColumn("_seen", F.max("_at").over(in_block.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "_last", F.lead(F.lit(1)).over(in_block).isNull()
    ).where(keeps_columns(readings.columns))
    handed = (
        seen.where("_last")
        .withColumn("_top", F.greatest("_seen", "_at"))
        .select("_place", F.max("_top").over(before_block).alias("_handed"))
    )
    joined = seen.join(handed, "_place", "left").withColumn("_top_us", F.greatest("_seen", "_handed"))
    return joined.select(*readings.columns, "_at", "_top_us")


def late_rows(
    readings: DataFrame,
    delay: str = fixed.OUT_OF_ORDERNESS,
    source_col: str = "src_partition",
    offset_col: str = "src_offset",
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Rows that lag more than `delay` behind the highest timestamp read before them in their source partition."""
    lag_us = F.col("_top_us") - F.col("_at")
    return (
        with_arrival_top(readings, source_col, offset_col, block_rows)
        .where(lag_us > duration_us(delay))
        .select(*readings.columns, floor_div(lag_us, 1000).alias("lag_ms"))
    )


@dataclass(frozen=True)
class SplitWindows:
    """`on_time`: statistics of the windows' timely readings. `late`: a reading and window per row for what came
    after the window was closed. Together they are every reading in every of its windows, once."""

    on_time: DataFrame
    late: DataFrame


def split_windows(
    readings: DataFrame,
    size: str = fixed.STATS_SIZE,
    slide: str = fixed.STATS_SLIDE,
    delay: str = fixed.OUT_OF_ORDERNESS,
    key_cols=READING_KEY,
    source_col: str = "src_partition",
    offset_col: str = "src_offset",
    block_rows: int = 1_000_000,
) -> SplitWindows:
    """A window is closed for a reading when the highest timestamp read before it in its source partition, less `delay`, has
    reached the window's end. Whether a reading is late is thus a matter of the window: one that lags is still in time for the windows that
    are open, and only its closed ones go to `late`. Missing values and times count for nothing.

    Readings are combined into panes by key, slide and number of closed windows, which is 0 for nearly all,
    before windows are made of them; only late readings are expanded by themselves.
    """
    size_us, slide_us, delay_us = duration_us(size), duration_us(slide), duration_us(delay)
    if size_us % slide_us:
        raise ValueError("the slide must divide the size")
    per_window = size_us // slide_us
    keys = list(key_cols)
    known = readings.where(F.col("value").isNotNull() & F.col("ts").isNotNull())
    pane: Column = floor_div(F.col("_at"), slide_us)
    first = F.col("_pane") - (per_window - 1)
    # the last window whose end the watermark had reached
    shut = F.coalesce(floor_div(F.col("_top_us") - delay_us - size_us, slide_us) - first + 1, F.lit(0))
    judged = (
        with_arrival_top(known, source_col, offset_col, block_rows)
        .withColumn("_pane", pane)
        .withColumn("_shut", F.least(F.greatest(shut, F.lit(0)), F.lit(per_window)))
    )
    panes = judged.where(F.col("_shut") < per_window).groupBy(*keys, "_pane", "_shut").agg(
        F.min("value").alias("_min"), F.max("value").alias("_max"), F.sum("value").alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    open_ = expand_panes(panes, keys, size_us, slide_us).where(F.col("_window") >= first + F.col("_shut"))
    merged = open_.groupBy(*keys, "_block", "_window").agg(
        F.min("_min").alias("min_value"), F.max("_max").alias("max_value"),
        (F.sum("_sum") / F.sum("_n")).alias("avg_value"), F.sum("_n").alias("n"),
    )
    names = ["window_start", "window_end"]
    late = judged.where(F.col("_shut") > 0).withColumn("_window", F.explode(F.sequence(first, first + F.col("_shut") - 1)))
    return SplitWindows(
        on_time=with_bounds(merged, size_us, slide_us).select(*keys, *names, "min_value", "max_value", "avg_value", "n"),
        late=with_bounds(late, size_us, slide_us).select(*readings.columns, *names),
    )

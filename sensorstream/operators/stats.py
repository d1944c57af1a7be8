"""Sliding event-time statistics.

Windows are start-inclusive, end-exclusive and aligned to the epoch, as `F.window` makes
them. Three bodies give the same rows:

* `rows`: `F.window` and one aggregate. Every row is expanded into size/slide windows
  before the partial aggregate. This is what a stream uses: one state store.
* `panes`: rows are first combined into panes one slide long (map-side combine applies),
  panes are sent to the time block that owns their windows, and only there expanded. The
  shuffles carry panes, about once, where `rows` carries window partials up to size/slide
  times. A hot key is spread over its blocks, and its rows are combined before any shuffle.
* `edges`: for windows of many slides. Time is cut into blocks one window long; a window is the end
  of one block and the beginning of the next, so with running aggregates from both sides each
  window costs the same however many panes it spans. Nothing is subtracted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.timing import duration_us, floor_div
from sensorstream.schemas import READING_KEY

# Windows per block, in multiples of size/slide: the copies at block edges cost 1/BLOCK_SPAN.
BLOCK_SPAN = 20
# From so many slides per window on, windows are put together from the edges of blocks.
EDGES_FROM = 32


def sliding_stats(
    readings: DataFrame,
    size: str = fixed.STATS_SIZE,
    slide: str = fixed.STATS_SLIDE,
    key_cols=READING_KEY,
    expected_interval: str = fixed.EXPECTED_INTERVAL,
    compat_max_floor: bool = False,
    method: str = "auto",
    left_open: bool = False,
) -> DataFrame:
    """min, max, avg and count per key and sliding window; missing values do not count.

    `compat_max_floor` never reports a maximum below the smallest positive double.
    `left_open` makes windows (start, end] where the default is [start, end).
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    if method == "auto":
        if readings.isStreaming or size_us % slide_us:
            method = "rows"
        else:
            method = "edges" if size_us // slide_us >= EDGES_FROM else "panes"

    keys = list(key_cols)
    readings = readings.where(F.col("value").isNotNull())
    if method == "rows":
        merged = _by_rows(readings, keys, size, slide, left_open)
    elif method in ("panes", "edges"):
        if readings.isStreaming or size_us % slide_us:
            raise ValueError("panes need a batch table and a slide that divides the size")
        merged = (_by_panes if method == "panes" else _by_edges)(readings, keys, size_us, slide_us, left_open)
    else:
        raise ValueError(f"unknown method {method!r}")

    highest = F.col("max_value")
    if compat_max_floor:
        highest = F.greatest(highest, F.lit(fixed.SMALLEST_POSITIVE_DOUBLE))
    expected = size_us // duration_us(expected_interval)
    window_col = ["window"] if method == "rows" else []
    return merged.select(
        *keys,
        *window_col,
        "window_start",
        "window_end",
        "min_value",
        highest.alias("max_value"),
        "avg_value",
        "n",
        F.lit(expected).cast("bigint").alias("expected_n"),
        (F.col("n") == expected).alias("is_complete"),
    )


def _by_rows(readings: DataFrame, keys: list[str], size: str, slide: str, left_open: bool) -> DataFrame:
    """With `left_open` windows start a microsecond late, the smallest step of a timestamp, which makes
    them (start, end]; their bounds are named without it. `window` itself keeps it."""
    late = 1 if left_open else 0

    def bound(name):
        return F.timestamp_micros(F.unix_micros(f"window.{name}") - late) if late else F.col(f"window.{name}")

    return (
        readings.groupBy(F.window("ts", size, slide, f"{late} microseconds") if late else F.window("ts", size, slide), *keys)
        .agg(
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.avg("value").alias("avg_value"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn("window_start", bound("start"))
        .withColumn("window_end", bound("end"))
    )


def _panes(readings, keys, slide_us, left_open) -> DataFrame:
    at = F.unix_micros("ts") - (1 if left_open else 0)
    return readings.groupBy(*keys, floor_div(at, slide_us).alias("_pane")).agg(
        F.min("value").alias("_min"),
        F.max("value").alias("_max"),
        F.sum("value").alias("_sum"),
        F.count(F.lit(1)).alias("_n"),
    )


def _by_panes(readings, keys, size_us, slide_us, left_open) -> DataFrame:
    panes = _panes(readings, keys, slide_us, left_open)
    windows = expand_panes(panes, keys, size_us, slide_us)
    merged = windows.groupBy(*keys, "_block", "_window").agg(
        F.min("_min").alias("min_value"),
        F.max("_max").alias("max_value"),
        (F.sum("_sum") / F.sum("_n")).alias("avg_value"),
        F.sum("_n").alias("n"),
    )
    return with_bounds(merged, size_us, slide_us)


def _by_edges(readings, keys, size_us, slide_us, left_open) -> DataFrame:
    """A task for block c has the panes of c and c + 1 and makes the windows that start in c: each pane makes
    those it is the first pane of, so every window with a reading is made once and no other. Panes
    are shuffled twice, windows never."""
    per_window = size_us // slide_us
    pane, block = F.col("_pane"), floor_div(F.col("_pane"), per_window)
    placed = (
        _panes(readings.where(F.col("ts").isNotNull()), keys, slide_us, left_open)
        .withColumn("_block", F.explode(F.array(block - 1, block)))
        .repartition(*keys, "_block")
    )
    in_block = Window.partitionBy(*keys, "_block")
    combine = {"_min": F.min, "_max": F.max, "_sum": F.sum, "_n": F.sum}
    own = block == F.col("_block")
    # from the block's end back to this pane; the next block's panes come first and do not count
    back = in_block.orderBy(pane.desc()).rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.select(
        *keys, "_block", "_pane", *combine,
        F.lag("_pane").over(in_block.orderBy("_pane")).alias("_before"),
        *[how(F.when(own, F.col(name))).over(back).alias("_end" + name) for name, how in combine.items()],
    )
    start = F.col("_block") * per_window
    first = F.greatest(F.col("_before") + 1, pane - (per_window - 1), start)
    last = F.least(pane, start + (per_window - 1))
    nothing = {name: F.when(F.lit(False), F.col(name)) for name in combine}
    windows = F.when(first <= last, F.transform(F.sequence(first, F.greatest(first, last)), lambda w: F.struct(
        (w + (per_window - 1)).alias("_upto"), w.alias("_window"),
        *[nothing[name].alias(name) for name in combine],
        *[F.when(own, F.col("_end" + name)).alias("_end" + name) for name in combine],
    )))
    itself = F.when(~own, F.array(F.struct(
        pane.alias("_upto"), F.lit(None).cast("long").alias("_window"),
        *[F.col(name) for name in combine],
        *[nothing[name].alias("_end" + name) for name in combine],
    )))
    # the next block's panes and the windows that ask for what they come to, in one order
    steps = ends.select(*keys, "_block", F.explode(F.concat(
        F.coalesce(windows, F.array()), F.coalesce(itself, F.array()))).alias("_step")).select(*keys, "_block", "_step.*")
    along = in_block.orderBy("_upto", F.col("_window").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    begun = steps.select(
        *keys, "_block", "_window", *["_end" + name for name in combine],
        *[how(name).over(along).alias("_begin" + name) for name, how in combine.items()],
    ).where(F.col("_window").isNotNull())

    def total(name):
        return F.coalesce(F.col("_end" + name), F.lit(0)) + F.coalesce(F.col("_begin" + name), F.lit(0))

    merged = begun.select(
        *keys, "_window",
        F.least("_end_min", "_begin_min").alias("min_value"),
        F.greatest("_end_max", "_begin_max").alias("max_value"),
        (total("_sum") / total("_n")).alias("avg_value"),
        total("_n").alias("n"),
    )
    return with_bounds(merged, size_us, slide_us)


def expand_panes(panes: DataFrame, keys: list[str], size_us: int, slide_us: int) -> DataFrame:
    """Pane rows (`_pane` = index of the slide) to one row per window they belong to.

    The result is hash-partitioned by key and `_block`, so grouping it by key, `_block` and
    `_window` needs no further exchange.
    """
    per_window = size_us // slide_us
    span = per_window * BLOCK_SPAN
    pane = F.col("_pane")
    blocks = F.sequence(floor_div(pane - (per_window - 1), span), floor_div(pane, span))
    placed = panes.withColumn("_block", F.explode(blocks)).repartition(*keys, "_block")
    first = F.greatest(pane - (per_window - 1), F.col("_block") * span)
    last = F.least(pane, F.col("_block") * span + (span - 1))
    return placed.withColumn("_window", F.explode(F.sequence(first, last)))


def with_bounds(merged: DataFrame, size_us: int, slide_us: int) -> DataFrame:
    start_us = F.col("_window") * F.lit(slide_us).cast("bigint")
    return merged.withColumn("window_start", F.timestamp_micros(start_us)).withColumn(
        "window_end", F.timestamp_micros(start_us + F.lit(size_us).cast("bigint"))
    )


def completeness(stats: DataFrame) -> DataFrame:
    """Windows whose count is not the expected one."""
    return stats.where(~F.col("is_complete"))


def rolling_mean(
    readings: DataFrame,
    width: str = fixed.ROLLING_WIDTH,
    period: str = fixed.ROLLING_PERIOD,
    key_cols=READING_KEY,
) -> DataFrame:
    """Every `period`, the mean of the readings newer than `width`; silence gives no row.

    A reading exactly `width` old is out and one at the tick is in, on tables and on streams.
    """
    stats = sliding_stats(readings, width, period, key_cols, left_open=True)
    return stats.select(*key_cols, F.col("window_end").alias("at"), F.col("avg_value").alias("mean_value"), "n")


def event_time(stats: DataFrame) -> Column:
    """The event time of a stats row, usable after a streaming aggregate too."""
    return F.window_time("window") if "window" in stats.columns else F.col("window_end")

"""Sliding windows in which the readings never fall.

A run of readings is summarised as (count, first, last, never falls). Summaries of adjoining
stretches of time combine into one, so nothing has to be gathered per window: readings are
summarised per short pane, neighbouring panes are compared once, and windows only add up
counts and look for a fall.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.timing import duration_us, floor_div
from sensorstream.schemas import ARRIVAL_ORDER

# Windows per block, in multiples of size/slide.
BLOCK_SPAN = 20
# Panes per slide unless the caller says otherwise.
PANES_PER_SLIDE = 12
# Grains per pane on a stream.
GRAINS_PER_PANE = 50


def pane_us(slide_us: int, pane: str | None) -> int:
    if pane is None:
        return slide_us // PANES_PER_SLIDE if slide_us % PANES_PER_SLIDE == 0 else slide_us
    chosen = duration_us(pane)
    if slide_us % chosen:
        raise ValueError("the pane must divide the slide")
    return chosen


def trend_windows(
    readings: DataFrame,
    size: str = fixed.TREND_SIZE,
    slide: str = fixed.TREND_SLIDE,
    key_cols=("sensor",),
    min_points: int = fixed.TREND_MIN_POINTS,
    strict: bool = False,
    order_cols=ARRIVAL_ORDER,
    pane: str | None = None,
) -> DataFrame:
    """key_cols, window_start, window_end, n of windows with `min_points` or more readings,
    each at least as high as (`strict`: higher than) the one before.

    The default key is the sensor name alone, across devices; pass `key_cols` to separate
    them. One task holds at most the readings of one key in one pane at a time.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us % slide_us:
        raise ValueError("the slide must divide the size")
    step_us = pane_us(slide_us, pane)
    keys, order = list(key_cols), list(order_cols)

    def falls(before, after):
        return before >= after if strict else before > after

    # 1. one summary per key and pane
    in_pane = Window.partitionBy(*keys, "_pane").orderBy(*order)
    runs = (
        readings.where(F.col("value").isNotNull())
        .select(*dict.fromkeys([*keys, *order, "value"]))
        .withColumn("_pane", floor_div(F.unix_micros("ts"), step_us))
        .withColumn("_before", F.lag("value").over(in_pane))
        .withColumn("_end", F.lead("value").over(in_pane).isNull())
        .groupBy(*keys, "_pane")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max(F.when(F.col("_before").isNull(), F.col("value"))).alias("_first"),
            F.max(F.when(F.col("_end"), F.col("value"))).alias("_last"),
            F.max(F.coalesce(falls(F.col("_before"), F.col("value")), F.lit(False))).alias("_falls"),
        )
    )

    # 2. panes go to the blocks that own the windows they are in; a block owns the windows
    #    whose last slide lies in it, so it holds all panes of each of them
    per_slide, per_window = slide_us // step_us, size_us // slide_us
    span = per_window * BLOCK_SPAN
    slide_no = floor_div(F.col("_pane"), per_slide)
    blocks = F.sequence(floor_div(slide_no, span), floor_div(slide_no + (per_window - 1), span))
    in_block = Window.partitionBy(*keys, "_block").orderBy("_pane")
    joined = (
        runs.withColumn("_block", F.explode(blocks))
        .withColumn("_prev_pane", F.lag("_pane").over(in_block))
        .withColumn("_step_falls", falls(F.lag("_last").over(in_block), F.col("_first")))
    )

    # 3. windows, named by their last slide; a fall between panes counts where both are inside
    first = F.greatest(slide_no, F.col("_block") * span)
    last = F.least(slide_no + (per_window - 1), F.col("_block") * span + (span - 1))
    window_first_pane = (F.col("_slide") - (per_window - 1)) * per_slide
    falls_here = F.col("_falls") | (
        F.coalesce(F.col("_step_falls"), F.lit(False)) & (F.col("_prev_pane") >= window_first_pane)
    )
    windows = (
        joined.withColumn("_slide", F.explode(F.sequence(first, last)))
        .groupBy(*keys, "_block", "_slide")
        .agg(F.sum("_n").alias("n"), F.max(falls_here).alias("_any_fall"))
        .where((F.col("n") >= min_points) & ~F.col("_any_fall"))
    )
    end_us = (F.col("_slide") + 1) * F.lit(slide_us).cast("bigint")
    return windows.select(
        *keys,
        F.timestamp_micros(end_us - F.lit(size_us).cast("bigint")).alias("window_start"),
        F.timestamp_micros(end_us).alias("window_end"),
        "n",
    )


def trend_windows_stream(
    readings: DataFrame,
    size: str = fixed.TREND_SIZE,
    slide: str = fixed.TREND_SLIDE,
    key_cols=("sensor",),
    min_points: int = fixed.TREND_MIN_POINTS,
    strict: bool = False,
    order_cols=ARRIVAL_ORDER,
    pane: str | None = None,
) -> DataFrame:
    """The same windows on a watermarked stream: three chained windowed aggregates.

    Readings are gathered per grain, a fiftieth of a pane; grains become summaries, which are
    gathered per pane, and those per window. No list is longer than the readings of one key in
    one grain, the grains of a pane, or the panes of a window; the number of devices counts for
    the first only.
    """
    slide_us = duration_us(slide)
    step_us = pane_us(slide_us, pane)
    grain_us = step_us // GRAINS_PER_PANE if step_us % GRAINS_PER_PANE == 0 else step_us
    keys = list(key_cols)

    def never_falls(items, before, after):
        pairs = F.zip_with(
            F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0))),
            F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0))),
            lambda a, b: (before(a) < after(b)) if strict else (before(a) <= after(b)),
        )
        return F.forall(pairs, lambda ok: ok)

    def total(runs):
        return F.aggregate(runs, F.lit(0).cast("bigint"), lambda n, r: n + r["n"])

    def rises(runs):
        """Summaries in order: each of them rises, and none begins below the end of the one before."""
        return F.forall(runs, lambda r: r["ok"]) & never_falls(runs, lambda a: a["last"], lambda b: b["first"])

    reading = F.struct(*[F.col(c) for c in order_cols], F.col("value").alias("v"))
    grains = (
        readings.where(F.col("value").isNotNull())
        .groupBy(F.window("ts", f"{grain_us} microseconds").alias("grain"), *keys)
        .agg(F.array_sort(F.collect_list(reading)).alias("run"))
        .select(
            "grain",
            *keys,
            F.struct(
                F.col("grain.start").alias("at"),
                F.element_at("run", 1)["v"].alias("first"),
                F.element_at("run", -1)["v"].alias("last"),
                F.size("run").cast("bigint").alias("n"),
                never_falls(F.col("run"), lambda a: a["v"], lambda b: b["v"]).alias("ok"),
            ).alias("summary"),
        )
    )
    panes = (
        grains.groupBy(F.window("grain", f"{step_us} microseconds").alias("pane"), *keys)
        .agg(F.array_sort(F.collect_list("summary")).alias("run"))
        .select(
            "pane",
            *keys,
            F.struct(
                F.col("pane.start").alias("at"),
                F.element_at("run", 1)["first"].alias("first"),
                F.element_at("run", -1)["last"].alias("last"),
                total(F.col("run")).alias("n"),
                rises(F.col("run")).alias("ok"),
            ).alias("summary"),
        )
    )
    windows = (
        panes.groupBy(F.window("pane", size, slide), *keys)
        .agg(F.array_sort(F.collect_list("summary")).alias("runs"))
        .withColumn("n", total(F.col("runs")))
    )
    return windows.where((F.col("n") >= min_points) & rises(F.col("runs"))).select(
        "window", *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n"
    )

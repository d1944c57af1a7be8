"""Carry the last known value forward: over missing samples, and over silence at the ticks of a clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.timing import duration_us, floor_div, keeps_columns
from sensorstream.schemas import ARRIVAL_ORDER, READING_KEY


def carry_forward(
    samples: DataFrame,
    key_cols=READING_KEY,
    order_cols=ARRIVAL_ORDER,
    value: str = "value",
    out: str = "published",
    block: str = "5 minutes",
) -> DataFrame:
    """Every sample with `out` = its value, or the latest earlier one; null before the first.

    Filled inside time blocks first. Samples still empty after that look up what the earlier
    blocks of their key hand over: the last filled sample of each block, taken from the same
    exchange, so the input is read once. They are joined on key and block, which is how the
    samples are partitioned already. Null keys are keys like any other; samples without a time
    come before all others of their key.
    """
    keys, order = list(key_cols), list(order_cols)
    # A structure is never null itself, and its null fields are equal to each other.
    place = F.struct(F.struct(*keys).alias("key"), floor_div(F.unix_micros("ts"), duration_us(block)).alias("block"))
    placed = samples.withColumn("_place", place)
    in_block = Window.partitionBy("_place").orderBy(*order)
    filled = placed.withColumn(
        out, F.last(value, ignorenulls=True).over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    )
    filled = filled.withColumn("_last", F.lead(F.lit(1)).over(in_block).isNull())
    filled = filled.where(keeps_columns(samples.columns))
    earlier = Window.partitionBy("_place.key").orderBy("_place.block").rowsBetween(Window.unboundedPreceding, -1)
    handed = (
        filled.where("_last")
        .select("_place", F.last(out, ignorenulls=True).over(earlier).alias("_handed"))
        .where(F.col("_handed").isNotNull())
    )
    return (
        filled.join(handed, "_place", "left")
        .withColumn(out, F.coalesce(out, "_handed"))
        .select(*samples.columns, out)
    )


def published_samples(carried: DataFrame, out: str = "published") -> DataFrame:
    """What a device would send: nothing until there has been a first value."""
    return carried.where(F.col(out).isNotNull())


def tick_after(ts, tick_us: int):
    """The first tick at or after an instant, in microseconds."""
    return (floor_div(F.unix_micros(ts) - 1, tick_us) + 1) * F.lit(tick_us).cast("bigint")


def hold_ranges(rows: DataFrame, keys: list[str], tick_us: int) -> DataFrame:
    """A row per tick out of rows with `_from_us` and `_to_us`, the first and the last tick at which `value` holds."""
    ticks = F.sequence("_from_us", "_to_us", F.lit(tick_us).cast("bigint"))
    placed = rows.where(F.col("_from_us") <= F.col("_to_us")).select(*keys, F.explode(ticks).alias("_at_us"), "value")
    return placed.select(*keys, F.timestamp_micros("_at_us").alias("at"), "value")


def held_values(
    samples: DataFrame,
    until,
    tick: str = fixed.EXPECTED_INTERVAL,
    key_cols=READING_KEY,
    order_cols=ARRIVAL_ORDER,
    block_ticks: int = 240,
) -> DataFrame:
    """key_cols, at, value: at every tick before `until` (a timestamp column or value) the latest value
    of the key up to and at the tick, from its first value on. A sensor that misses samples or falls silent repeats its
    last value. Samples without value or time count for nothing; null keys are keys like any other.

    Samples are combined to the last one per key and tick before the shuffle. What a value reaches to is the next
    tick with one: inside blocks of `block_ticks` ticks, and for the last tick of a block the first of the
    key's next block, for which one row per block meets in a window per key.
    """
    tick_us = duration_us(tick)
    keys = list(key_cols)
    known = samples.where(F.col("value").isNotNull() & F.col("ts").isNotNull())
    newest = known.groupBy(*keys, tick_after("ts", tick_us).alias("_from_us")).agg(
        F.max_by("value", F.struct(*order_cols)).alias("value")
    )
    limit_us = F.unix_micros(until if not isinstance(until, str) else F.lit(until).cast("timestamp"))
    place = F.struct(F.struct(*keys).alias("key"), floor_div(F.col("_from_us"), tick_us * block_ticks).alias("block"))
    in_block = Window.partitionBy("_place").orderBy("_from_us")
    placed = (
        newest.where(F.col("_from_us") < limit_us)
        .withColumn("_place", place)
        .withColumns({
            "_next_us": F.lead("_from_us").over(in_block),
            "_is_first": F.lag("_from_us").over(in_block).isNull(),
        })
        .where(keeps_columns([*keys, "value"]))
    )
    of_key = Window.partitionBy("_place.key").orderBy("_place.block")
    later = placed.where("_is_first").select("_place", F.lead("_from_us").over(of_key).alias("_later_us"))
    # the last tick before the limit, where no further value comes
    last_us = floor_div(limit_us - 1, tick_us) * F.lit(tick_us).cast("bigint")
    step = F.lit(tick_us).cast("bigint")
    ranges = placed.join(later, "_place", "left").withColumn(
        "_to_us", F.coalesce(F.col("_next_us") - step, F.col("_later_us") - step, last_us)
    )
    return hold_ranges(ranges, keys, tick_us)

"""Edges of a two-valued status along each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.timing import duration_us, floor_div
from sensorstream.functions.topics import fill_name
from sensorstream.schemas import ARRIVAL_ORDER, READING_KEY


def is_above(value: Column, threshold: float = fixed.CO2_THRESHOLD) -> Column:
    """The threshold itself counts as below."""
    return value > F.lit(threshold)


def threshold_changes(
    readings: DataFrame,
    threshold: float = fixed.CO2_THRESHOLD,
    key_cols=READING_KEY,
    order_cols=ARRIVAL_ORDER,
    block: str = "5 minutes",
) -> DataFrame:
    """Readings whose status differs from the one before; the first of a key always shows.

    A key is cut into time blocks, so its readings are compared in many tasks. Only the
    first and the last reading of every block, at most two per block, meet in one window
    per key to settle the edges between blocks. Both branches read the same exchange.

    `block` sets the largest unit of work: the readings of one key in one block. A year in
    blocks of 5 minutes leaves about 200 000 rows per key for the edges.
    """
    keys, order = list(key_cols), list(order_cols)
    columns = list(dict.fromkeys([*keys, *order, "value"]))
    in_block = Window.partitionBy(*keys, "_block").orderBy(*order)
    marked = (
        readings.where(F.col("value").isNotNull())
        .select(*columns, is_above(F.col("value"), threshold).alias("above"))
        .withColumn("_block", floor_div(F.unix_micros("ts"), duration_us(block)))
        .withColumn("_before", F.lag("above").over(in_block))
        .withColumn("_last", F.lead("above").over(in_block).isNull())
    )
    inside = marked.where(F.col("_before").isNotNull() & (F.col("_before") != F.col("above")))
    along_key = Window.partitionBy(*keys).orderBy("_block", *order)
    edges = (
        marked.where(F.col("_before").isNull() | F.col("_last"))
        .withColumn("_first", F.col("_before").isNull())
        .withColumn("_before", F.lag("above").over(along_key))
        .where(F.col("_first") & (F.col("_before").isNull() | (F.col("_before") != F.col("above"))))
    )
    return inside.select(*columns, "above").unionByName(edges.select(*columns, "above"))


def threshold_records(changes: DataFrame, template: str = fixed.THRESHOLD_TOPIC, keep=()) -> DataFrame:
    """One `yes`/`no` message per change, addressed to the device's actuator topic."""
    return changes.select(
        *keep,
        fill_name(template, device=F.col("device_id")).alias("topic"),
        F.when(F.col("above"), "yes").otherwise("no").alias("value"),
    )

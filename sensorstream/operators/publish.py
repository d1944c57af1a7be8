"""Results as (topic, value) records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.text import with_fixed2
from sensorstream.functions.topics import fill_name, strip_prefix
from sensorstream.operators.occupancy import OCCUPIED, UNOCCUPIED

STATS_PARTS = ("min", "max", "avg")


def stats_records(stats: DataFrame, owner: str, keep=()) -> DataFrame:
    """Three records per stats row, named by device and sensor; a row of the owner gives three
    more under the short name. One generator per row, no shuffle.

    Columns: `keep`, topic, value (text as `Double.toString` writes it), number (the same value).
    """
    prefix = fixed.RESULT_PREFIX.format(owner=owner)

    def records(name):
        return [
            F.struct(
                F.concat(F.lit(prefix + "-"), name, F.lit(f"_{part}-"), F.col("metric")).alias("topic"),
                F.col(f"{part}_value").cast("string").alias("value"),
                F.col(f"{part}_value").alias("number"),
            )
            for part in STATS_PARTS
        ]

    for_all = records(F.concat_ws("_", "device_id", "sensor"))
    for_owner = records(F.col("sensor"))
    chosen = F.when(F.col("device_id") == owner, F.array(*for_owner, *for_all)).otherwise(F.array(*for_all))
    return stats.select(*keep, F.inline(chosen))


def rolling_mean_records(
    means: DataFrame, template: str = fixed.ROLLING_MEAN_TOPIC, keep=()
) -> DataFrame:
    """Rolling means as two-decimal text."""
    return with_fixed2(means, {"_text": F.col("mean_value")}).select(
        *keep,
        fill_name(
            template, device=F.col("device_id"), sensor=F.col("sensor"), metric=F.col("metric")
        ).alias("topic"),
        F.col("_text").alias("value"),
    )


def occupancy_records(occupied: DataFrame, owner: str, flag: str = "occupied", keep=()) -> DataFrame:
    """A boolean state column as messages on the one occupancy topic."""
    return occupied.select(
        *keep,
        F.lit(fixed.OCCUPANCY_TOPIC.format(owner=owner)).alias("topic"),
        F.when(F.col(flag), OCCUPIED).otherwise(UNOCCUPIED).alias("value"),
    )


def receive_log(messages: DataFrame, base: str) -> DataFrame:
    """`key = payload` lines, the key being the topic without the base prefix."""
    return messages.select(
        F.concat(strip_prefix(F.col("topic"), base), F.lit(" = "), F.col("payload")).alias("line")
    )

"""Wide device samples to messages, and commands back to devices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream import fixed
from sensorstream.functions.text import with_fixed2
from sensorstream.functions.topics import fill_name
from sensorstream.schemas import ARRIVAL_ORDER


def samples_to_messages(
    samples: DataFrame,
    metrics: Mapping[str, Sequence[str]],
    device: str = "device_id",
    keep: Sequence[str] = (),
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """One message per sensor and metric that has a value.

    `metrics` maps a sensor name to its metrics; `columns` maps `sensor/metric` to the sample
    column where that differs from `sensor_metric` in lower case. Floats are written with two
    decimals, integers, booleans and text as they are; a column of another type raises. One
    generator, no shuffle.
    """
    messages = []
    for sensor, names in metrics.items():
        for name in names:
            metric = f"{sensor}/{name}"
            column = (columns or {}).get(metric, f"{sensor}_{name}".lower())
            kind = samples.schema[column].dataType
            number = text = F.lit(None)
            if isinstance(kind, (T.DoubleType, T.FloatType)):
                number = F.col(column)
            elif isinstance(kind, (T.IntegralType, T.StringType, T.BooleanType)):
                text = F.col(column)
            else:
                raise TypeError(f"{metric}: a column of type {kind.simpleString()} cannot be sent")
            messages.append(F.struct(
                F.lit(metric).alias("_metric"),
                number.cast("double").alias("_number"),
                text.cast("string").alias("_text"),
            ))
    if not messages:
        raise ValueError("no metric is named")
    kept = list(dict.fromkeys(keep))
    base = fill_name(fixed.MQTT_BASE, device=F.col(device))
    # rows first, then text: one formatter in the generated code, not one per metric
    rows = samples.select(*kept, base.alias("_base"), F.inline(F.array(*messages))).where(
        F.col("_number").isNotNull() | F.col("_text").isNotNull()
    )
    return with_fixed2(rows, {"_decimals": F.col("_number")}).select(
        *kept,
        F.concat("_base", "_metric").alias("topic"),
        F.coalesce("_text", "_decimals").alias("payload"),
    )


def actuator_commands(messages: DataFrame, suffix: str = fixed.THRESHOLD_TOPIC_SUFFIX) -> DataFrame:
    """Messages on the threshold topic with `on` = the payload is exactly `yes`."""
    return messages.where(F.endswith(F.col("topic"), F.lit(suffix))).withColumn(
        "on", F.coalesce(F.col("payload") == "yes", F.lit(False))
    )


def actuator_latest(commands: DataFrame, key_cols=("topic",), order_cols=ARRIVAL_ORDER) -> DataFrame:
    """The state each actuator is in: its latest command.

    A partial aggregate reduces every task to one row per actuator before the shuffle. In
    update mode the same aggregate follows a stream.
    """
    return commands.groupBy(*key_cols).agg(
        F.max_by("on", F.struct(*order_cols)).alias("on"), F.max("ts").alias("since")
    )

"""Settings that change while a device measures: each sample gets those in force at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstream.operators.carry import carry_forward


def settings_in_force(
    samples: DataFrame,
    settings: DataFrame,
    names: Sequence[str],
    key_cols: Sequence[str] = ("device_id",),
    at: str = "ts",
    since: str = "since",
    tie_cols: Sequence[str] = (),
    block: str = "1 day",
) -> DataFrame:
    """The samples with the columns `names` of the latest row of `settings` for their key whose `since` is
    not after `at`. Columns of these names that samples bring are replaced.

    A row of settings replaces the one before as a whole, also where it holds nulls. Of rows with the same key and
    `since` the greatest by `tie_cols` counts, then by `names`. Every sample stays, once: before
    the first settings, without a time, or for an unknown key the columns are null. Settings without
    a time are never in force. Null keys are keys like any other.

    Both sides go through `carry_forward` as one sequence per key, settings before samples of the same
    instant: one shuffle by key and time block, and one row per block is handed on to later blocks, so no
    key is in one task. Equal settings are combined before they meet the samples.
    """
    keys, names = list(key_cols), list(names)
    nothing = F.lit(None)
    setting = F.struct(*names)
    known = (
        settings.where(F.col(since).isNotNull())
        .groupBy(*keys, F.col(since).alias("_at"))
        .agg(F.max(F.struct(*tie_cols, setting.alias("_set")))["_set"].alias("_set"))
    )
    row_type = samples.select(F.struct(*samples.columns).alias("r")).schema["r"].dataType
    set_type = known.schema["_set"].dataType
    key = F.struct(*keys)
    both = known.select(
        key.alias("_key"), F.col("_at").cast("timestamp").alias("ts"), F.lit(0).alias("_kind"), "_set",
        nothing.cast(row_type).alias("_row"),
    ).unionByName(
        samples.select(
            key.alias("_key"), F.col(at).cast("timestamp").alias("ts"), F.lit(1).alias("_kind"),
            nothing.cast(set_type).alias("_set"), F.struct(*samples.columns).alias("_row"),
        )
    )
    carried = carry_forward(both, ("_key",), ("ts", "_kind"), value="_set", out="_in_force", block=block)
    kept = [c for c in samples.columns if c not in names]
    return carried.where(F.col("_kind") == 1).select(
        *[F.col("_row")[c].alias(c) for c in kept], *[F.col("_in_force")[name].alias(name) for name in names]
    )

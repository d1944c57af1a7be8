"""Mixing sources to target weights by pivotal rounding.

Every document gets an expected number of copies, its source's target over its source's size. The
fractional parts become whole by the pivotal method, weighted by document size: two documents trade
words until the part of one of them is 0 or 1, in a direction drawn so that expectations stay. The sum
of words never changes, so a source misses its target by less than one document.

Documents are dealt by hash into groups of about a thousand, rounded there, and each group leaves one
document with a fractional part at most. These meet in groups of groups, and so on up the tree until
one per source is left, which is drawn alone. Draws depend on the rows of a group and its place in
the tree, not on partitions: reruns agree.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorstream.llm.common import table

WEIGHTS = (3.0, 1.0, 2.0)
GROUP_ROWS, FAN_IN = 1024, 64
EDGE = 1e-9


def source_targets(sizes: DataFrame, share: float, cap: float, weights: tuple[float, ...]) -> DataFrame:
    """From (source, source_size, units): one row per source with its target. Weights repeat over sources by code
    point, null last. `share` of all sizes is dealt by weight; no target passes `cap` times its source's
    size, and what is above goes to the others by weight: in ascending order of cap per weight,
    sources are capped as long as the level of the rest is above them. The table has a row per source."""
    every = Window.partitionBy()
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights)))
    weighted = weighted.withColumn("limit", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("limit") / F.col("weight"))
    line = every.orderBy("ratio", F.col("source").asc_nulls_last())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    ranked = weighted.withColumn("level", level).withColumn("place", F.row_number().over(line))
    ranked = ranked.withColumn("open", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("place", "level"))).over(every))
    target = F.when(F.col("open").isNull() | (F.col("place") < F.col("open")["place"]), F.col("limit")).otherwise(F.col("open")["level"] * F.col("weight"))
    return ranked.select("source", "source_size", "units", target.alias("target"))


def pivot(part: np.ndarray, size: np.ndarray, draws: np.ndarray) -> int | None:
    """Round fractional parts in place, one after the other; returns who stays fractional, if anyone.
    `part * size` keeps its sum but for the last one."""
    held = None
    for i in range(len(part)):
        if part[i] <= EDGE or part[i] >= 1 - EDGE:
            part[i] = round(part[i])
            continue
        if held is None:
            held = i
            continue
        a, b = part[held] * size[held], part[i] * size[i]
        up, down = min(size[held] - a, b), min(a, size[i] - b)
        a, b = (a + up, b - up) if draws[i] * (up + down) < down else (a - down, b + down)
        part[held], part[i] = a / size[held], b / size[i]
        if EDGE < part[i] < 1 - EDGE:
            part[held] = round(part[held])
            held = i
        else:
            part[i] = round(part[i])
            if not EDGE < part[held] < 1 - EDGE:
                part[held] = round(part[held])
                held = None
    return held


def _rounder(level: int, last: bool, seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "unit", "size"], kind="stable")
        place = repr((seed, level, group["source"].iloc[0], int(group["bucket"].iloc[0])))
        random = np.random.default_rng([zlib.crc32(place.encode()), zlib.crc32(place[::-1].encode())])
        part, size = group["part"].to_numpy(float).copy(), group["size"].to_numpy(float)
        draws = random.random(len(part) + 1)
        none = size <= 0
        part[none] = draws[:-1][none] < part[none]
        held = pivot(part, size, draws)
        if held is not None and last:
            part[held] = float(draws[-1] < part[held])
            held = None
        open_ = np.zeros(len(part), bool)
        if held is not None:
            open_[held] = True
        return group.assign(part=part, open=open_)

    return run


def mix_copies(
    df: DataFrame, size: Column, source: str = "source", keys: tuple[str, ...] = ("doc_id", "text"), *,
    share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS, seed: int = 0,
) -> DataFrame:
    """Add size, source_size, target (of the row's source) and copies (how often the mix takes the row);
    existing columns of these names are replaced.

    Rows equal in `keys` and source are one unit and get the same number of copies. Null sources are one
    source, null keys are values of their own. Rows of size 0 are drawn one by one. A source of size 0 has
    target 0 and its rows no copies. An empty table gives an empty table."""
    rows = df.drop("size", "source_size", "target", "copies").withColumn("size", size.cast("long"))
    rows = rows.withColumn("_unit", F.xxhash64(F.lit(seed), F.col(source), *(F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys)))
    units = rows.groupBy(F.col(source).alias("source"), F.col("_unit").alias("unit")).agg(F.sum("size").cast("double").alias("size"))
    units = table(units, "mix-units")
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("units"))
    targets = table(source_targets(sizes, share, cap, weights), "mix-targets")
    most = targets.agg(F.max("units")).first()[0] or 1
    levels = math.ceil(math.log(max(1, math.ceil(most / GROUP_ROWS)), FAN_IN) - 1e-9)

    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(F.lit(0.0))
    buckets = F.ceil(F.col("units") / GROUP_ROWS)
    state = units.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", "unit", "size", F.xxhash64("unit", F.lit(seed + 1)).alias("draw"), F.floor(rate).cast("long").alias("whole"),
        (rate - F.floor(rate)).alias("part"), F.pmod(F.xxhash64("unit"), buckets).cast("long").alias("bucket"), F.lit(True).alias("open"),
    )
    schema, settled = state.schema, []
    for level in range(levels + 1):
        if level:
            state = state.where("open").withColumn("bucket", F.expr(f"bucket div {FAN_IN}"))
        rounded = state.groupBy("source", "bucket").applyInPandas(_rounder(level, level == levels, seed), schema)
        state = table(rounded, "mix-level")
        settled.append(state.where("not open"))
    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    done = done.select(F.col("source").alias("_source"), F.col("unit").alias("_decided"), (F.col("whole") + F.col("part").cast("long")).alias("copies"))
    found = targets.select(F.col("source").alias("_source"), F.col("source_size").cast("long").alias("source_size"), "target")
    out = rows.join(done, (F.col("_unit") == F.col("_decided")) & F.col(source).eqNullSafe(F.col("_source"))).drop("_source", "_decided", "_unit")
    return out.join(found, F.col(source).eqNullSafe(F.col("_source"))).drop("_source")

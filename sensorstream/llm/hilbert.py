"""Shards cut from a Hilbert curve over several metadata dimensions, in DataFrame operations only.

Each dimension is quantised at its own quantiles, the cells' curve index orders the rows, and runs of
equal row counts become shards. Neighbours on the curve are neighbours in every dimension, so each
shard (and each file and row group inside it) covers a small box and filters on any of the dimensions
prune files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.llm.common import table

QUANTILE_ACCURACY = 10_000


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """For every state and every corner of the unit cube: the corner's place on the curve, and the next
    state. A state is (entry corner, direction); the rule is that of Gray codes turned by the state."""
    size = 1 << dims

    def turn(x: int, k: int) -> int:
        k %= dims
        return ((x << k) | (x >> (dims - k))) & (size - 1)

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    rank = {gray(x): x for x in range(size)}
    place, following = [], []
    for entry in range(size):
        for direction in range(dims):
            for corner in range(size):
                w = rank[turn(corner ^ entry, -(direction + 1))]
                begin = 0 if w == 0 else gray(2 * ((w - 1) // 2))
                odd = w if w % 2 else max(w - 1, 0)
                ones = (odd ^ (odd + 1)).bit_length() - 1 if w else 0
                place.append(w)
                following.append((entry ^ turn(begin, direction + 1)) * dims + (direction + ones + 1) % dims)
    return place, following


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index (long) of the point `cells` (each in [0, 2^bits)) on the Hilbert curve."""
    dims = len(cells)
    if dims * bits > 62:
        raise ValueError("dimensions times bits must stay within 62")
    place, following = (F.array(*map(F.lit, x)) for x in curve_tables(dims))

    def step(acc: Column, level: Column) -> Column:
        corner = F.lit(0)
        for j, cell in enumerate(cells):
            corner = corner + F.call_function("shiftright", cell.cast("int"), level).bitwiseAND(1) * (1 << j)
        at = acc["state"] * (1 << dims) + corner
        return F.struct((acc["index"] * (1 << dims) + F.get(place, at)).cast("long").alias("index"), F.get(following, at).cast("int").alias("state"))

    levels = F.array(*(F.lit(i) for i in range(bits - 1, -1, -1)))
    return F.aggregate(levels, F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state")), step, lambda acc: acc["index"])


def order_key(column: Column, kind: T.DataType) -> Column:
    """A number in the order of the column: numbers as they are, times as seconds, strings by their first seven bytes."""
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long").cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    return column.cast("timestamp").cast("double")


def hilbert_order(df: DataFrame, dims: list[str], bits: int = 5, index: str = "hilbert_index") -> DataFrame:
    """Add the curve index over the columns `dims`. Quantiles (2^bits - 1 numbers per dimension, the only
    thing that passes the driver) are taken over all rows; nulls and NaN fall into the lowest cell."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    keys = {c: order_key(F.col(c), kinds[c]) for c in dims}
    keys = {c: F.when(~F.isnan(k), k) for c, k in keys.items()}
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*(F.percentile_approx(k, shares, QUANTILE_ACCURACY).alias(f"q{i}") for i, k in enumerate(keys.values()))).first()
    cells = []
    for i, k in enumerate(keys.values()):
        bounds = sorted(set(found[i] or []))
        cell = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b, k=k: b < k)) if bounds else F.lit(0)
        cells.append(F.coalesce(F.when(k.isNull(), F.lit(0)).otherwise(cell), F.lit(0)))
    names = [f"_cell{i}" for i in range(len(cells))]
    placed = df.drop(index, *names).withColumns(dict(zip(names, cells, strict=True)))
    return placed.withColumn(index, hilbert_index([F.col(n) for n in names], bits)).drop(*names)


def hilbert_shards(df: DataFrame, dims: list[str], shards: int, ties: list[str], bits: int = 5) -> DataFrame:
    """Add hilbert_index, shard (0 to shards - 1) and slot (gapless from 0 in each shard); existing columns
    of these names are replaced. Shards are runs of the order by curve index and then `ties`, and their
    row counts differ by one at most. However many rows one cell holds, range partitioning splits it
    by `ties`; rows equal in all of these are interchangeable. An empty table gives an empty table; with
    fewer rows than shards some shards stay empty."""
    placed = hilbert_order(df.drop("shard", "slot"), dims, bits)
    order = ["hilbert_index", *ties]
    row = F.monotonically_increasing_id()
    run = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    run = table(run.withColumn("_part", F.shiftright(row, 33)).withColumn("_pos", row.bitwiseAND((1 << 33) - 1)), "hilbert")
    every = Window.partitionBy()
    parts = run.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.sum("_n").over(every.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)).alias("_end"), "_n", F.sum("_n").over(every).alias("_all"),
    )
    ranked = run.join(parts, "_part").withColumn("_rank", F.col("_end") - F.col("_n") + F.col("_pos"))
    ranked = ranked.withColumn("shard", F.expr(f"int(_rank * {shards} div _all)"))
    first = F.expr(f"(shard * _all + {shards - 1}) div {shards}")
    return ranked.withColumn("slot", F.col("_rank") - first).drop("_part", "_pos", "_n", "_end", "_all", "_rank")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order; parquet's own statistics then prune by every dimension."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def shard_boxes(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """What each shard covers: rows and the least and greatest value of every dimension."""
    ends = [f(c).alias(f"{n}_{c}") for c in dims for n, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)

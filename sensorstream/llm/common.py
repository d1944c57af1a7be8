"""Helpers that the operators of this subpackage share: scratch tables, text arrays, links."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the array code of one Python worker looks at together (a longer text goes alone).
SLICE_BYTES = 2 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below `spark.checkpoint.dir`; where that is unset, below the warehouse of a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    # A path without scheme is one of the cluster's default file system.
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    whole = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()
    return f"file://{whole[5:]}" if whole.startswith("file:/") and not whole.startswith("file://") else whole


def table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: work is kept when executors go, lineage ends."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables made by `table` that nothing will read again."""
    for df in tables:
        spark, path = df.sparkSession, df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Deal few rows that stand for much work (byte ranges, blocks) to as many tasks; Spark would pack them by their own size."""
    most = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(rows, most)))


#: Bits of the filter that `rows_of` broadcasts: half a megabyte, whatever the tables' sizes.
FILTER_BITS, CHUNK_BITS = 1 << 22, 1 << 15


def rows_of(df: DataFrame, ids: DataFrame, key: str = "key") -> DataFrame:
    """The rows of `df` whose `key` is in `ids` (one column of that name, not null): a left semi join, before which a
    bitmap of hashed ids of fixed size drops most other rows where they lie. Wide rows that nobody wants
    then do not travel; with more ids than bits it drops less, and the join alone decides."""
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    bits = ids.select(F.expr(f"pmod(xxhash64({key}), {FILTER_BITS}) div {CHUNK_BITS}").alias("_chunk"), (place % CHUNK_BITS).alias("_bit"))
    filled = bits.groupBy("_chunk").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    marked = df.withColumn("_at", place).withColumn("_own", F.expr(f"_at div {CHUNK_BITS}"))
    byte = F.conv(F.hex(F.substring("_bits", F.expr(f"int(_at % {CHUNK_BITS} div 8) + 1"), F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (F.col("_at") % 8).cast("int")).bitwiseAND(1) == 1
    likely = marked.join(F.broadcast(filled), F.col("_own") == F.col("_chunk")).where(is_set).select(*df.columns)
    # An inner join on distinct ids: a semi join would be moved below the bitmap, to where all rows are.
    return likely.join(ids.distinct(), key).select(*df.columns)


def crc32_utf8(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


# ---- texts as arrays -------------------------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix1(*values: int) -> int:
    out = 0
    for v in values:
        out = int(mix(np.array([(out * 0x9E3779B97F4A7C15 + v + 0x632BE59BD9B4E019) & (2**64 - 1)], np.uint64))[0])
    return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins; null is empty."""
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds, body = texts.buffers()[1], texts.buffers()[2]
    at = np.frombuffer(bounds, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(body, np.uint8)[at[0] : at[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about `limit` bytes of text each; whole rows, in order."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cell = np.cumsum(size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(size)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


#: Rows that hold texts, two perhaps, which go to a Python worker together.
BATCH_ROWS = 1000


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """While tables are written in here, Python workers get at most `BATCH_ROWS` rows at once. Of wide rows Spark's 10,000 are some 70 MB,
    which the executor and its worker both hold, and more while they are filled. The session's own value comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def hand_back() -> None:
    """At the end of a task: give memory that its arrays have left free back to the system. A Python worker waits for further tasks,
    and what it still holds adds to what these need."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 64, 2 * len(_POWERS))
        steps = np.full(size, 0x9E3779B97F4A7C15 | 1, np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def hashed_words(data: np.ndarray, at: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of bytes that are not `space`), and the index of each word's text."""
    gap = space[data]
    before = np.empty(len(data), bool)
    before[1:] = gap[:-1]
    firsts = at[:-1]
    before[firsts[firsts < len(data)]] = True
    inside = np.flatnonzero(~gap)
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begins = before[inside]
    heads = np.flatnonzero(begins)
    starts = inside[heads]
    place = np.arange(len(inside)) - np.repeat(heads, np.diff(np.append(heads, len(inside))))
    values = (data[inside].astype(np.uint64) + np.uint64(1)) * _powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(values, heads)), np.searchsorted(at, starts, side="right") - 1


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its `width`-word shingles over ASCII-lower-cased words.
    A text with fewer words has its whole word sequence as its only shingle; one without words has none."""
    data, at = text_bytes(texts)
    words, owner = hashed_words(LOWER[data], at)
    n = len(at) - 1
    bounds = np.searchsorted(owner, np.arange(n + 1))
    rolled = np.zeros(len(words), np.uint64)
    for i in range(width):
        part = np.zeros(len(words), np.uint64)
        if i < len(words):
            part[: len(words) - i] = words[i:]
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + part
        if i < width - 1:
            rolled = mix(rolled)
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            out.append(np.array([mix1(b - a, *words[a:b].tolist())], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


# ---- links -----------------------------------------------------------------------------------


def components(links: DataFrame, left: str = "a", right: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over `links`, for every node that has a link.

    Large-star and small-star steps in turn: each step groups by node with map-side minima and writes
    its links as a table, so neither a hub nor the lineage grows. The number of rounds grows with
    the logarithm of the longest chain."""
    spark = links.sparkSession
    edge = links.select(F.least(left, right).alias("v"), F.greatest(left, right).alias("u")).where("u <> v").distinct()
    edge = table(edge, "links")
    before = None
    for _ in range(rounds):
        both = edge.select("u", "v").unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edge = table(small.where("u <> v").distinct(), "links")
        state = edge.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = edge.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(edge.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Near duplicates among embeddings by an inverted multi-index.

The halves of the unit vectors get a codebook each, fitted apart; a pair of codewords is a cell, and every
vector is listed under its cell. A vector looks for partners in cells by the multi-sequence
order. What a cell costs is the squared distance from the vector to it: per half, the
distance to the plane that parts the cell's codeword from the vector's own. A partner within squared
distance 2 - 2t lies in no cell that costs more, so the search stops there and misses no pair of cosine t.

In many dimensions that stop reaches a large part of all cells. So neighbouring cells share a shelf, and a
vector travels once to each shelf that has a cell in reach, not to every cell; of two shelves the later one is asked by
the vectors of the earlier one only. Candidates meet in blocks of bounded size, where products in double
precision decide. A block gives back counts and spanning links, not pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.llm.common import components, table

#: Rows that codebooks are fitted on, passes of the fit, recall of the stop: all pairs, nothing lower is offered.
SAMPLE, FIT_PASSES, RECALL = 4096, 12, 1.0
#: Rows per cell that the codebooks' size aims at, most codewords.
CELL_ROWS, MOST_WORDS = 48, 512
#: Rows of either side in a block, and of a shelf: the table's share, but no fewer and no more than these.
BLOCK_ROWS, BLOCK_SHARE, MOST_BLOCK_ROWS = 512, 16, 8192
#: Rows multiplied at a time; allowance for rounding of costs, which only adds cells.
STRIP_ROWS, SLACK = 256, 1e-9


@dataclass
class MultiIndex:
    """Two codebooks, and how much a visited cell may cost (squared distance)."""

    words: tuple[np.ndarray, np.ndarray]
    threshold: float
    stop: float = 0.0

    def costs(self, x: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Of each row and half: the nearest codeword, and the squared distance to every codeword's side."""
        half = self.words[0].shape[1]
        own, cost = [], []
        for words, part in zip(self.words, (x[:, :half], x[:, half:]), strict=True):
            d = (part * part).sum(1)[:, None] - 2 * part @ words.T + (words * words).sum(1)
            near = d.argmin(1)
            gap = np.sqrt(np.maximum(((words[:, None] - words[None]) ** 2).sum(2), 1e-300))[near]
            over = np.maximum(d - d[np.arange(len(d)), near][:, None], 0) / (2 * gap)
            over[np.arange(len(d)), near] = 0
            own.append(near)
            cost.append(over**2)
        return tuple(own), tuple(cost)

    def visits(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
        """Multi-sequence traversal: cells by rising cost until the stop."""
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        heap, seen = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
        while heap:
            cost, i, j = heapq.heappop(heap)
            if cost > self.stop:
                return
            yield int(a[i]), int(b[j])
            for i2, j2 in ((i + 1, j), (i, j + 1)):
                if i2 < len(a) and j2 < len(b) and (i2, j2) not in seen:
                    seen.add((i2, j2))
                    heapq.heappush(heap, (first[a[i2]] + second[b[j2]], i2, j2))


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit rows of a list column without nulls, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(1))[:, None]


def fit_codebook(x: np.ndarray, words: int) -> np.ndarray:
    """Lloyd's algorithm from evenly drawn rows; an emptied codeword keeps its place."""
    centres = x[np.linspace(0, len(x) - 1, min(words, len(x))).astype(int)].copy()
    for _ in range(FIT_PASSES):
        near = ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)
        for k in range(len(centres)):
            own = x[near == k]
            if len(own):
                centres[k] = own.mean(0)
    return np.unique(centres, axis=0)


def fit(vectors: DataFrame, rows: int, threshold: float) -> MultiIndex:
    """Codebooks from at most `SAMPLE` rows of (h, vec) by hash order; the stop is the full radius."""
    sample = vectors.orderBy(F.xxhash64("h"), "h").limit(SAMPLE).select("vec").toArrow()
    x = _matrix(sample.column("vec"))
    words = int(np.clip(np.ceil(np.sqrt(rows / CELL_ROWS)), 2, MOST_WORDS))
    half = x.shape[1] // 2
    return MultiIndex((fit_codebook(x[:, :half], words), fit_codebook(x[:, half:], words)), threshold, 2 - 2 * threshold + SLACK)


def _local(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each node's component, by passing minima along links until they rest."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _block(threshold: float):
    schema = pa.schema([("h", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        side = group.column("probe").to_numpy()
        if side.all() or not side.any():
            return schema.empty_table()
        h, node = np.unique(group.column("h").to_numpy(), return_inverse=True)
        weight, x = group.column("rows").to_numpy(), _matrix(group.column("vec"))
        # Vectors of the shelf itself ask each other from both sides; from another shelf one side asks for both.
        both = group.column("own").to_numpy() != group.column("shelf").to_numpy()
        q = np.flatnonzero(~side)
        got, low = np.zeros(len(h), np.int64), np.arange(len(h))
        for k in range(0, len(side), STRIP_ROWS):
            p = np.flatnonzero(side[k : k + STRIP_ROWS]) + k
            i, j = np.nonzero(x[p] @ x[q].T >= threshold)
            i, j = p[i], q[j]
            other = node[i] != node[j]
            i, j = i[other], j[other]
            if len(i):
                np.add.at(got, node[i], weight[j])
                np.add.at(got, node[j[both[i]]], weight[i[both[i]]])
                low = _local(len(h), np.append(node[i], np.arange(len(h))), np.append(node[j], low))
        out = np.flatnonzero((got > 0) | (low != np.arange(len(h))) | np.isin(np.arange(len(h)), low[low != np.arange(len(h))]))
        return pa.table([pa.array(h[out]), pa.array(got[out]), pa.array(h[low[out]])], schema=schema)

    return run


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: n_links counts the other rows whose cosine, in double precision, is
    at least `threshold`, component_id is the least key reachable.

    Rows with equal vectors are one class and link with each other. Null vectors, zero vectors, vectors with null
    or non-finite components, vectors of another length than most, and rows with a null key link with nothing:
    n_links 0 and their own key as component. An empty table gives an empty table. Other columns are not read."""
    rows = embeddings.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    norm = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v)
    good = F.coalesce(F.col("id").isNotNull() & ~bad & (norm > 0) & (norm < float("inf")), F.lit(False))
    lengths = rows.where(good).groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if not lengths:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    fits = good & (F.size("vec") == lengths["d"])
    classes = rows.where(fits).withColumn("h", F.xxhash64("vec")).groupBy("h", "vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    classes = table(classes, "index-classes")
    if lengths["d"] < 2:
        classes = classes.withColumn("vec", F.concat("vec", F.array(F.lit(0.0))))
    n = classes.count()
    index = fit(classes.select("h", "vec"), n, threshold)
    # Floats travel as floats.
    kind = "float" if isinstance(embeddings.schema[vector].dataType.elementType, T.FloatType) else "double"
    vec = F.col("vec").cast(f"array<{kind}>").alias("vec")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 2048):
                part = batch.slice(k, 2048)
                (i, j), _ = index.costs(_matrix(part.column("vec")))
                own = pa.array(i * MOST_WORDS + j, pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("h", "vec", "rows")), own], names=["h", "vec", "rows", "cell"])

    placed = table(classes.select("h", vec, "rows").mapInArrow(place, f"h long, vec array<{kind}>, rows long, cell long"), "index-cells")
    block = int(np.clip(-(-n // BLOCK_SHARE), BLOCK_ROWS, MOST_BLOCK_ROWS))
    # At most MOST_WORDS squared cells, in order of their codewords; cells without rows are on no shelf.
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").toArrow()
    counts = cells.column("n").to_numpy()
    shelf_of = np.full((MOST_WORDS, MOST_WORDS), -1, np.int32)
    shelf_of.ravel()[cells.column("cell").to_numpy()] = (np.cumsum(counts) - counts) // block

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shelf_of.ravel()[batch.column("cell").to_numpy()]
            shelves = []
            for k in range(0, len(batch), 2048):
                _, cost = index.costs(_matrix(batch.column("vec").slice(k, 2048)))
                for mine, a, b in zip(own[k : k + 2048].tolist(), *cost, strict=True):
                    last, met = last_shelf - mine + 1, set()
                    for i, j in index.visits(a, b):
                        if shelf_of[i, j] >= mine:
                            met.add(int(shelf_of[i, j]))
                            if len(met) == last:
                                break
                    shelves.append(sorted(met))
            columns = [*(batch.column(c) for c in ("h", "vec", "rows")), pa.array(own, pa.int64()), pa.array(shelves, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "vec", "rows", "own", "visits"])

    last_shelf = int(shelf_of.max())
    asked = table(placed.mapInArrow(ask, f"h long, vec array<{kind}>, rows long, own long, visits array<long>"), "index-shelves")
    listed = asked.select("h", "vec", "rows", "own", F.col("own").alias("shelf"))
    probes = asked.select("h", "vec", "rows", "own", F.explode("visits").alias("shelf"))
    share = lambda name: F.ceil(F.count(F.lit(1)) / block).cast("long").alias(name)
    sizes = listed.groupBy("shelf").agg(share("lists")).join(probes.groupBy("shelf").agg(share("asks")), "shelf")
    number = lambda seed, n: F.pmod(F.xxhash64("h", F.lit(seed)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = probes.join(F.broadcast(sizes), "shelf").withColumn("ask", number(1, "asks")).withColumn("list", every("lists")).withColumn("probe", F.lit(True))
    right = listed.join(F.broadcast(sizes), "shelf").withColumn("list", number(2, "lists")).withColumn("ask", every("asks")).withColumn("probe", F.lit(False))
    both = left.unionByName(right).select("shelf", "ask", "list", "probe", "own", "h", "rows", "vec")
    found = table(both.groupBy("shelf", "ask", "list").applyInArrow(_block(threshold), "h long, links long, low long"), "index-links")

    counted = found.groupBy("h").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("h").alias("a"), F.col("low").alias("b")))
    named = classes.select("h", "rep", "rows").groupBy("h").agg(F.min("rep").alias("rep"), F.sum("rows").alias("rows"))
    named = named.join(joined.withColumnRenamed("node", "h"), "h", "left").withColumn("component", F.coalesce("component", "h"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").join(counted, "h", "left").select("h", (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    keyed = rows.select("id", F.when(fits, F.xxhash64("vec")).alias("h")).join(named, "h", "left")
    component = F.coalesce("component_id", "id")
    return keyed.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )

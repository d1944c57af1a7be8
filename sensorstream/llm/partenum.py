"""Jaccard join on word n-grams with PartEnum signatures.

Sets whose similarity reaches the threshold have sizes within its ratio and differ in a bounded number
k of elements. Sizes are cut into bands, each band overlapping the next by one ratio, so that two such
sets meet in a band; k follows from the band's largest size. The element domain is hashed into parts,
so many that two sets within k differ by one element at most in at least two parts; each part is hashed into
cells, and leaving out one cell in turn, one choice leaves the difference out. So similar sets
share a signature for certain: the hash of what a set has in a part without one of its cells. What is left may be
nothing, which many sets share: a set in which that can happen in one part only goes without such signatures, as another part
remains.

Equal sets are one class before anything is joined. Of the classes under one signature only links to
the least one are tried first (a star, in each batch and then over all batches). What then still lies in several components under one signature is
compared across components, signature by signature: in pairs where it has few members, else in blocks of bounded
size that meet two at a time in a task and give back links only. Before any text moves, candidates are held against each other by sketches, a bit or
two for every element: the bits in which they differ are no more than the elements in which the sets differ, so none that are
similar is lost. What remains is compared exactly, on sets made anew from the texts. Signatures, blocks and pairs of blocks are found on
rows without sketches, which travel once, to where they are compared. Nothing is capped and
no group is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorstream.llm.common import components, discard, hand_back, mix, mix1, pieces, rows_of, shingle_sets, short_batches, table

#: Bytes of text whose shingle sets are made together (a longer text goes alone); making them takes some 80 times that.
#: Signatures that go back to Spark together (a set with more goes alone).
SET_BYTES, OUT_SIGS = 256 << 10, 1 << 18
#: Rows of a task whose signatures are combined.
COMBINED_ROWS = 10_000

#: Ratios that a band spans; the next band starts one ratio before its end.
BAND = 1
CELLS = 3
#: Parts beyond those that the pigeonhole asks for: in so many a set may go without signatures of nothing.
SPARE = 1
#: Members of a signature up to which they are paired; rows, bytes of sketches and shingles per block beyond.
FEW, BLOCK_ROWS, BLOCK_BYTES, BLOCK_SHINGLES = 32, 256, 400_000, 200_000


@lru_cache(maxsize=128)
def bands(percent: int, upto: int) -> tuple[tuple[int, int, int], ...]:
    """(least size, greatest size, k) of every band that begins at or below `upto`. Two sets whose Jaccard similarity
    is `percent` / 100 or more lie in a common band and differ in k elements at most."""
    ratios = [1]
    while ratios[-1] <= upto:
        ratios.append(ratios[-1] * 100 // percent + 1)
    while (len(ratios) - 1) % BAND or len(ratios) < BAND + 2:
        ratios.append(ratios[-1] * 100 // percent + 1)
    ratios += [ratios[-1] * 100 // percent + 1, ratios[-1] * 100 // percent * 100 // percent + 2]
    out = []
    for i in range(0, len(ratios) - BAND - 1, BAND):
        low, high = ratios[i], ratios[i + BAND + 1] - 1
        out.append((low, high, 2 * high * (100 - percent) // (100 + percent)))
    return tuple(out)


def signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """PartEnum signatures of one set (distinct hashes). A band with k = 0 needs none: there only equal sets are similar."""
    n, found = len(elements), []
    if not n:
        return np.zeros(0, np.uint64)
    for number, (low, high, k) in enumerate(bands(percent, 1 << max(6, n.bit_length()))):
        if not low <= n <= high or not k:
            continue
        parts = k // 2 + 1 + SPARE
        place = mix(elements ^ np.uint64(mix1(number)))
        part = ((place >> np.uint64(34)) * np.uint64(parts) >> np.uint64(30)).astype(np.int64)
        cell = (place & np.uint64(0xFFFF)).astype(np.int64) % CELLS
        at = part * CELLS + cell
        size = parts * CELLS
        value = mix(place + np.uint64(0x51))
        high_half = np.bincount(at, (value >> np.uint64(32)).astype(np.float64), size).astype(np.uint64)
        low_half = np.bincount(at, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size).astype(np.uint64)
        sums = ((high_half << np.uint64(32)) + low_half).reshape(parts, CELLS)
        left = sums.sum(1, keepdims=True, dtype=np.uint64) - sums
        label = np.arange(size, dtype=np.uint64).reshape(parts, CELLS) + np.uint64((number + 1) << 32)
        held = np.bincount(at, minlength=size).reshape(parts, CELLS)
        nothing = held.sum(1, keepdims=True) == held
        own = mix(left ^ mix(label))
        found.append(own.ravel() if nothing.any(1).sum() > SPARE else own[~nothing])
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def sketch(elements: np.ndarray) -> bytes:
    """A bit per cell of the element domain, twice as many cells (eight at least) as the greatest power of two up to the set's size: whether
    the cell holds an odd number of elements. Sets whose sketches differ in c bits differ in c elements at least."""
    if not len(elements):
        return b""
    cells = max(8, 2 << (len(elements).bit_length() - 1))
    cell = (mix(elements ^ np.uint64(0xA24BAED4963EE407)) >> np.uint64(32)).astype(np.int64) & (cells - 1)
    return np.packbits((np.bincount(cell, minlength=cells) & 1).astype(np.uint8)).tobytes()


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def may_be_similar(a: bytes, b: bytes, na: int, nb: int, percent: int) -> bool:
    """False only for sets that are not similar."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    differ = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
    return differ * (100 + percent) <= (100 - percent) * (na + nb)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


SETS = "key long, n_shingles long, h1 long, h2 long, sketch binary, near array<struct<sig: long, low: long>>"
HEADS = "h1 long, sigs array<long>"


def _least(sig: np.ndarray, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of signatures, their rows and the rows' hashes: which stand for their equals, as the first with the least hash; the places of
    those whose equals have a lesser hash, ascending; and that hash. Sorted a sixteenth at a time, by the highest bits."""
    cell = sig.view(np.uint8)[7::8] >> 4
    head, near, low = np.zeros(len(sig), bool), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for c in range(16):
        at = np.flatnonzero(cell == c)
        if not len(at):
            continue
        own = h[row[at]]
        order = np.lexsort((own, sig[at]))
        at, own = at[order], own[order]
        value = sig[at]
        first = np.append(True, value[1:] != value[:-1])
        least = own[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        head[at[first]] = True
        more = least != own
        near.append(at[more])
        low.append(least[more])
    near, low = np.concatenate(near), np.concatenate(low)
    order = np.argsort(near)
    return head, near[order], low[order]


def shingled(docs: DataFrame, percent: int, width: int, heads: bool = False) -> DataFrame:
    """Of every row (key, text): size, 128-bit hash and sketch of its shingle set, and its PartEnum signatures. A signature that
    several sets of the same `COMBINED_ROWS` rows of a task have stands in `sigs` of the set with the least h1 only; the others have it in
    `near`, with that h1. So what is shuffled by signature is combined before: a signature has a row per so many,
    however many near copies share it. Copies of a set in them have their signatures once. Rows without a key are linked
    with nothing: they have no signatures and hold none for others. `sigs` is most of the bytes, so it is not written: with `heads` only h1 and
    `sigs` are returned, made anew on their way into a shuffle."""

    def combined(keys: list, sizes: list, h1: list, h2: list, sketches: list, counts: list, held: bytearray) -> Iterator[pa.RecordBatch]:
        sig, h = np.frombuffer(held, np.int64) if held else np.zeros(0, np.int64), np.array(h1, np.uint64).view(np.int64)
        head, near, low = _least(sig, np.repeat(np.arange(len(h), dtype=np.int32), np.array(counts, np.int64)), h)
        bounds = np.append(0, np.cumsum(counts, dtype=np.int64))
        # Back to Spark in short stretches of rows: as many signatures as OUT_SIGS at a time, or one row's.
        cuts = [0, *(np.flatnonzero(np.diff(bounds[:-1] // OUT_SIGS)) + 1).tolist(), len(h)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            begin, end = bounds[a], bounds[b]
            if heads:
                picked = head[begin:end]
                ends = np.append(0, np.cumsum(picked))[bounds[a : b + 1] - begin]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sig[begin:end][picked]))
                yield pa.RecordBatch.from_arrays([pa.array(h[a:b]), lists], names=["h1", "sigs"])
                continue
            first, last = np.searchsorted(near, [begin, end])
            pairs = pa.StructArray.from_arrays([pa.array(sig[near[first:last]]), pa.array(low[first:last])], names=["sig", "low"])
            near_lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(near, bounds[a : b + 1]) - first, pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[a:b], pa.int64()), pa.array(sizes[a:b], pa.int64()), pa.array(h[a:b]), _long(np.array(h2[a:b], np.uint64)), pa.array(sketches[a:b], pa.binary()), near_lists],
                names=["key", "n_shingles", "h1", "h2", "sketch", "near"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, h1, h2, sketches, counts, held = [], [], [], [], [], [], bytearray()
        met: set[tuple[int, int]] = set()
        for batch in batches:
            for part in pieces(batch, "text", SET_BYTES):
                own_keys = part.column("key").to_pylist()
                keys += own_keys
                for s, key in zip(shingle_sets(part.column("text"), width), own_keys, strict=True):
                    has_key = key is not None
                    own = mix1(len(s), int(s.sum(dtype=np.uint64))), mix1(len(s) + 1, int(mix(s).sum(dtype=np.uint64)))
                    sigs = signatures(s, percent) if has_key and own not in met else np.zeros(0, np.uint64)
                    held += sigs.tobytes()
                    counts.append(len(sigs))
                    if has_key:
                        met.add(own)
                    sketches.append(sketch(s) if has_key and not heads else None)
                    sizes.append(len(s))
                    h1.append(own[0])
                    h2.append(own[1])
            if len(keys) >= COMBINED_ROWS:
                yield from combined(keys, sizes, h1, h2, sketches, counts, held)
                keys, sizes, h1, h2, sketches, counts, held = [], [], [], [], [], [], bytearray()
                met.clear()
        yield from combined(keys, sizes, h1, h2, sketches, counts, held)
        hand_back()

    return docs.select("key", "text").mapInArrow(run, HEADS if heads else SETS)


def _wanted(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of the wanted keys, repeated rows once."""
    return rows_of(texts, ids).withColumn("_same", F.xxhash64("text")).dropDuplicates(["key", "_same"]).drop("_same")


def _similar(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Those (a, b) of `pairs` whose shingle sets reach the threshold. Only texts that occur in a pair travel."""
    ids = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = table(_wanted(texts, ids), "join-texts")
    full = pairs.join(wanted.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a").join(wanted.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, "ta", SET_BYTES):
                a = part.column("a").to_pylist()
                fresh = [i for i, x in enumerate(a) if x not in kept and x not in a[:i]]
                if len(kept) > 64:
                    kept.clear()
                    fresh = [i for i, x in enumerate(a) if x not in a[:i]]
                kept.update(zip((a[i] for i in fresh), shingle_sets(part.column("ta").take(pa.array(fresh, pa.int64())), width), strict=True))
                right = shingle_sets(part.column("tb"), width)
                good = []
                for x, s in zip(a, right, strict=True):
                    both = len(np.intersect1d(kept[x], s, assume_unique=True))
                    good.append(100 * both >= percent * (len(kept[x]) + len(s) - both))
                yield part.filter(pa.array(good, pa.bool_())).select(["a", "b"])
        hand_back()

    links = table(full.mapInArrow(run, "a long, b long"), "join-links")
    discard(wanted)
    return links


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) of `pairs` whose sketches do not rule them out."""
    own = lambda side: classes.select(F.col("rep").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}"))
    full = pairs.join(own("a"), "a").where(F.col("na") > 0).join(own("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(*(batch.column(c).to_pylist() for c in ("sa", "sb", "na", "nb")), strict=True)
            yield batch.filter(pa.array([may_be_similar(*s, percent) for s in sides], pa.bool_())).select(["a", "b"])

    return full.mapInArrow(run, "a long, b long").distinct()


def _near_labels(links: DataFrame) -> DataFrame:
    """(node, component): the least label within two links, in two rounds of minima. Equal labels mean connected nodes, and
    a star has one label throughout; that is enough to spare comparisons, the final components come later."""
    both = table(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))), "join-both")
    once = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
    twice = both.join(once.select(F.col("u").alias("v"), "low"), "v").groupBy("u").agg(F.min("low").alias("near"))
    return twice.join(once, "u").select(F.col("u").alias("node"), F.least("near", "low").alias("component"))


def _block_links(nodes: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) between different components of the same cluster, from `nodes` (rep, component, cluster, n), at least
    one for each pair of components that has any. Blocks are filled by hash: components of some size have
    blocks of their own, which are not held against each other, all others of a cluster share blocks."""
    weight = [F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")]
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("shingles") / BLOCK_SHINGLES)).cast("long")
    wide = nodes.groupBy("cluster", "component").agg(*weight).where(F.col("rows") * 2 >= BLOCK_ROWS).select("cluster", "component", F.col("component").alias("label"))
    named = nodes.join(wide, ["cluster", "component"], "left").withColumn("label", F.coalesce("label", F.lit(-(2**63))))
    fill = named.groupBy("cluster", "label").agg(*weight).select("cluster", "label", blocks.alias("blocks"))
    dealt = named.join(fill, ["cluster", "label"]).select("cluster", "label", "rep", "component", F.pmod(F.xxhash64("rep"), "blocks").alias("block"))
    dealt = table(dealt, "join-blocks")
    have = dealt.select("cluster", F.struct("label", "block").alias("at")).distinct()
    meet = have.alias("l").join(have.alias("r"), "cluster").where("l.at <= r.at and (l.at.label <> r.at.label or l.at.label = -9223372036854775808L)")
    meet = meet.select("cluster", F.col("l.at").alias("at0"), F.col("r.at").alias("at1"), F.xxhash64("cluster", "l.at", "r.at").alias("pair"))
    sides = _sides(dealt.withColumn("at", F.struct("label", "block")), meet, "cluster").select("pair", "side", "rep", "component")
    ids = dealt.select(F.col("rep").alias("key")).distinct()
    wanted = table(_wanted(texts, ids).withColumnRenamed("key", "rep"), "join-texts")
    full = sides.join(wanted, "rep")

    def compare(group):
        import pandas as pd

        side = [group[group["side"].isin((i, 2))].sort_values("rep") for i in (0, 1)]
        sets = [shingle_sets(pa.array(side[0]["text"], pa.string()), width)]
        sets.append(sets[0] if (group["side"] == 2).all() else shingle_sets(pa.array(side[1]["text"], pa.string()), width))
        size = np.array([len(x) for x in sets[1]], np.int64)
        flat = np.concatenate(sets[1]) if sets[1] else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], np.repeat(np.arange(len(size)), size)[order]
        reps, parts = side[1]["rep"].to_numpy(), side[1]["component"].to_numpy()
        found = []
        for rep, part, own in zip(side[0]["rep"], side[0]["component"], sets[0], strict=True):
            low, high = np.searchsorted(flat, own), np.searchsorted(flat, own, side="right")
            n = high - low
            place = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            both = np.bincount(owner[place], minlength=len(size))
            good = np.flatnonzero((100 * both >= percent * (len(own) + size - both)) & (parts != part))
            _, first = np.unique(parts[good], return_index=True)
            found += [(rep, reps[i]) for i in good[first]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    links = table(full.groupBy("pair").applyInPandas(compare, "a long, b long").distinct(), "join-block-links")
    discard(dealt, wanted)
    return links


def _sides(dealt: DataFrame, meet: DataFrame, by: str) -> DataFrame:
    """The rows of `dealt` (`by`, at) for each `pair` of blocks (`by`, at0, at1) in `meet`, with their side of it: 0 or 1, or 2 where a block meets
    itself, whose rows come once."""
    own = F.when(F.col("at0") == F.col("at1"), 2)
    left = meet.select(by, F.col("at0").alias("at"), "pair", own.otherwise(0).alias("side"))
    right = meet.where("at0 <> at1").select(by, F.col("at1").alias("at"), "pair", F.lit(1).alias("side"))
    return dealt.join(left.unionByName(right), [by, "at"])


def _block_clusters(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(rep, cluster) of all that have a partner in another component under one of their signatures that sketches do not rule out,
    from `members` (sig, rep, component, n) and `sketches` (rep, sketch); such partners are in one cluster. A task hands on a row for each of its sets, however many pairs there are. Blocks are filled by hash: components of some size have blocks of their own, which are not held against each other, all
    others of a signature share blocks. Sketches join when it is known which blocks meet."""
    # A sketch has a byte for four elements at most, and one at least.
    weight = [F.count(F.lit(1)).alias("rows"), F.sum(F.greatest(F.col("n") / 4, F.lit(1))).alias("bytes")]
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("bytes") / BLOCK_BYTES)).cast("long")
    wide = members.groupBy("sig", "component").agg(*weight).where(F.col("rows") * 2 >= BLOCK_ROWS).select("sig", "component", F.col("component").alias("label"))
    named = members.join(wide, ["sig", "component"], "left").withColumn("label", F.coalesce("label", F.lit(-(2**63))))
    fill = named.groupBy("sig", "label").agg(*weight).select("sig", "label", blocks.alias("blocks"))
    dealt = named.join(fill, ["sig", "label"]).withColumn("at", F.struct("label", F.pmod(F.xxhash64("rep"), "blocks").alias("block")))
    dealt = table(dealt.select("sig", "at", "rep", "component", "n"), "join-blocks")
    have = dealt.select("sig", "at").distinct()
    meet = have.alias("l").join(have.alias("r"), "sig").where("l.at <= r.at and (l.at.label <> r.at.label or l.at.label = -9223372036854775808L)")
    meet = meet.select("sig", F.col("l.at").alias("at0"), F.col("r.at").alias("at1"), F.xxhash64("sig", "l.at", "r.at").alias("pair"))
    full = _sides(dealt, meet, "sig").select("pair", "side", "rep", "component", "n").join(sketches, "rep")

    def compare(group: pa.Table) -> pa.Table:
        side, rep = group.column("side").to_numpy(), group.column("rep").to_numpy()
        part, n = group.column("component").to_numpy(), group.column("n").to_numpy()
        raw = [np.frombuffer(s, np.uint8) for s in group.column("sketch").to_pylist()]
        size = min(map(len, raw))
        flat = np.stack([_folded(s, size) for s in raw])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        known, node = np.unique(rep, return_inverse=True)
        low = np.arange(len(known))
        paired = np.zeros(len(known), bool)
        for i in left.tolist():
            differ = np.bitwise_count(flat[right] ^ flat[i]).sum(1, dtype=np.int64)
            own = n[right]
            good = (differ * (100 + percent) <= (100 - percent) * (n[i] + own)) & (part[right] != part[i]) & (100 * np.minimum(own, n[i]) >= percent * np.maximum(own, n[i]))
            if good.any():
                joined = np.append(node[right[good]], node[i])
                paired[joined] = True
                low[np.isin(low, low[joined])] = low[joined].min()
        return pa.table({"a": known[paired], "b": known[low[paired]]})

    edges = table(full.groupBy("pair").applyInArrow(compare, "a long, b long").distinct(), "join-edges")
    discard(dealt)
    return components(edges).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))


def similar_components(docs: DataFrame, percent: int = 80, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) for every row: documents whose sets of `width`-word shingles have a Jaccard similarity
    of `percent` / 100 or more are linked, and component_id is the least key reachable over links.

    Words are runs of other than white space with A-Z lower-cased. A text of fewer words is one shingle; null,
    empty and blank texts have none and are linked with nothing. Rows with equal keys are separate rows of
    one document: they get the least component of any of them. Null keys are never linked and have a null component. Other
    columns are not read; an empty table gives an empty table."""
    with short_batches(docs.sparkSession):
        return _similar_components(docs, percent, width, key, text)


def _similar_components(docs: DataFrame, percent: int, width: int, key: str, text: str) -> DataFrame:
    plain = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    full = table(shingled(plain, percent, width), "join-sets")
    rows = table(full.select("key", "n_shingles", "h1", "h2"), "join-rows")
    known = full.where("n_shingles > 0 and key is not null")
    classes = known.groupBy("h1", "h2").agg(F.min("key").alias("rep"), F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch"))
    classes = table(classes, "join-classes")

    # Of each signature: the least set over all batches, beside every batch's least one.
    every = Window.partitionBy("sig")
    heads = shingled(plain, percent, width, heads=True).select("h1", F.explode("sigs").alias("sig")).select(
        "sig", "h1", F.min("h1").over(every).alias("low"), F.max("h1").over(every).alias("high")
    )
    heads = table(heads.where("low <> high").select("sig", "low", "h1"), "join-heads")
    inside = table(known.select("h1", F.explode("near").alias("n")).select("n.sig", "n.low", "h1"), "join-near")
    discard(full)
    known = rows.where("n_shingles > 0 and key is not null")
    members = heads.select("sig", "h1").unionByName(inside.select("sig", "h1")).unionByName(inside.select("sig", F.col("low").alias("h1")))
    members = table(members.distinct(), "join-members")

    ids = classes.select("h1", "rep", "n")
    stars = heads.where("h1 <> low").select("low", "h1").unionByName(inside.select("low", "h1")).distinct()
    # Sizes alone decide against many candidates, sketches against nearly all others that are not similar.
    near = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    stars = stars.join(ids.select(F.col("h1").alias("low"), F.col("rep").alias("x"), F.col("n").alias("nx")), "low")
    stars = stars.join(ids.select("h1", F.col("rep").alias("y"), F.col("n").alias("ny")), "h1").where(near)
    twins = ids.groupBy("h1").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y").select("x", "y")
    stars = stars.select("x", "y").unionByName(twins).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct()
    stars = table(_likely(stars, classes, percent), "join-stars")
    discard(heads, inside)
    links = _similar(stars, plain, percent, width)
    found = table(_near_labels(links), "join-labels")

    # What lies in several components under one signature, as far as known.
    placed = members.join(ids, "h1").select("sig", "rep", "n").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    placed = placed.select("sig", "rep", "n", F.coalesce("component", "rep").alias("component"))
    several = placed.groupBy("sig").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count(F.lit(1)).alias("rows"))
    rest = table(placed.join(several.where("c0 <> c1 and rows > 2").select("sig", "rows"), "sig"), "join-rest")
    discard(members, found)
    few = rest.where(F.col("rows") <= FEW)
    left, right = few.alias("l"), few.alias("r")
    across = left.join(right, F.col("l.sig") == F.col("r.sig")).where("l.rep < r.rep and l.component <> r.component")
    across = across.where(100 * F.least("l.n", "r.n") >= percent * F.greatest("l.n", "r.n")).select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b")).distinct()
    across = _likely(across, classes, percent)
    across = table(across.join(stars, ["a", "b"], "left_anti"), "join-across")
    more = _similar(across, plain, percent, width)
    many = rest.where(F.col("rows") > FEW)
    if many.head(1):
        clusters = table(_block_clusters(many, classes.select("rep", "sketch"), percent), "join-clusters")
        nodes = many.select("rep", "component").distinct().join(clusters, "rep").join(classes.groupBy("rep").agg(F.max("n").alias("n")), "rep")
        more = table(more.unionByName(_block_links(nodes, plain, percent, width)), "join-more")
    found = table(components(links.unionByName(more)), "join-components")
    discard(rest, across, stars, links, more)

    own = known.select("key", "h1", "h2").join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).join(found.withColumnRenamed("node", "rep"), "rep", "left")
    own = own.groupBy("key").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    out = rows.select("key", "n_shingles").join(own, "key", "left").select(F.col("key").alias(key), "n_shingles", F.coalesce("component", "key").alias("component_id"))
    return out

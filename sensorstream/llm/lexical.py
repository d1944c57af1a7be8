"""Ranked lexical search by presence masks.

Documents are cut once into terms; of each document only its length and its counts of the items' terms
are kept. Blocks of documents of similar length are then searched in their tasks: presence bitmaps of an item's
terms are combined into one mask per document, documents are grouped by mask, and a mask's greatest
possible score is the sum, over its terms, of the most any document of the block gets for a term. Masks are evaluated by
descending greatest score until it falls below the item's least kept score, which a task carries from
block to block. A task hands on its best rows of each item only, so what is shuffled does not grow with the matches.

Items are dealt to blocks of bounded vocabulary; each block of items is held against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorstream.llm.common import LOWER, hashed_words, pieces, table, text_bytes

#: Bytes that no term holds: all ASCII but digits and letters.
BETWEEN = np.zeros(256, bool)
BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
#: Item terms per block of items, as dealt by hash; cells of presence (documents x terms) per block of documents.
BLOCK_TERMS, BLOCK_CELLS = 20_000, 1 << 23
#: Documents evaluated before the bound is looked at again; it doubles from here.
FIRST_LOOK = 128
#: Ranges of candidates of an item that are cut to the best before they meet.
SALTS = 64

POSTINGS = "id long, n long, terms array<int>, tfs array<int>"


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of all texts, A-Z lower-cased, and the index of each term's text. Everything beyond ASCII is
    part of a term, so terms end at single bytes."""
    data, at = text_bytes(texts)
    # Upper-case letters are no separators here: they are lower-cased before.
    return hashed_words(LOWER[data], at, BETWEEN)


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term): the distinct term hashes of every item. Rows with equal keys are one item and pool their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                words, owner = _terms(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(owner)), pa.array(words.view(np.int64))], names=["item", "term"])

    plain = items.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text"))
    return plain.mapInArrow(run, "item long, term long").distinct()


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(id, n, terms, tfs) of every row (id, text) with at least one term: how many terms it has, and which of the sorted
    `vocabulary` occur how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, len(vocabulary))
        for batch in batches:
            for part in pieces(batch, "text"):
                words, owner = _terms(part.column("text"))
                n = np.bincount(owner, minlength=len(part))
                place = np.minimum(np.searchsorted(vocabulary, words), size - 1)
                known = vocabulary[place] == words
                cell, tf = np.unique(owner[known] * size + place[known], return_counts=True)
                has = np.flatnonzero(n)
                ends = np.append(0, np.cumsum(np.bincount(cell // size, minlength=len(part))[has]))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (cell % size, tf)]
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(has)), pa.array(n[has], pa.int64()), *lists], names=["id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, POSTINGS)


def _frequencies(found: DataFrame, size: int) -> np.ndarray:
    """Documents per term of the vocabulary: counted by task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(count[has])], names=["term", "df"])

    total = found.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[total.column("term").to_numpy()] = total.column("df").to_numpy()
    return out


class _Best:
    """The best rows of one item: highest scores, equal ones by ascending id, null ids last."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """A row below this score changes nothing."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.least()
        score, ids, null = (np.append(a, b[good]) for a, b in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, null, -score))[: self.top]
        self.score, self.id, self.null = score[order], ids[order], null[order]


def _masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (columns of the presence bitmaps) in order of their masks, and where each distinct mask begins."""
    words = []
    for k in range(0, len(present), 64):
        word = np.zeros(present.shape[1], np.uint64)
        for bit, row in enumerate(present[k : k + 64]):
            word |= row.astype(np.uint64) << np.uint64(bit)
        words.append(word)
    order = np.argsort(words[0], kind="stable") if len(words) == 1 else np.lexsort(words)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for word in words:
        new[1:] |= word[order[1:]] != word[order[:-1]]
    return order, np.flatnonzero(new)


class _Block:
    """Documents of similar length with what each of their postings adds to a score."""

    def __init__(self, ids, null, row, term, gain, size: int):
        self.ids, self.null = ids, null
        order = np.lexsort((term, row))
        self.term, self.gain = term[order], gain[order]
        self.ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(ids))))
        self.present = np.zeros((size, len(ids)), bool)
        self.present[term, row] = True
        self.most = np.zeros(size, np.int64)
        np.maximum.at(self.most, term, gain)

    def scores(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        n = self.ends[rows + 1] - self.ends[rows]
        place = np.repeat(self.ends[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
        gain = np.where(wanted[self.term[place]], self.gain[place], 0)
        total = np.append(0, np.cumsum(gain))
        ends = np.cumsum(n)
        return total[ends] - total[ends - n]

    def search(self, terms: np.ndarray, wanted: np.ndarray, best: _Best) -> None:
        most = self.most[terms]
        if most.sum() < best.least():
            return
        present = self.present[terms]
        order, heads = _masks(present)
        bound = most @ present[:, order[heads]]
        falling = np.argsort(-bound, kind="stable")
        bound = bound[falling]
        begin = heads[falling]
        ends = np.append(heads[1:], len(order))[falling]
        done, look = 0, FIRST_LOOK
        while done < len(falling):
            safe = int(np.searchsorted(-bound, -best.least(), side="right"))
            if done >= safe:
                return
            upto = min(safe, done + max(1, int(np.searchsorted(np.cumsum((ends - begin)[done:safe]), look))))
            n = (ends - begin)[done:upto]
            place = np.repeat(begin[done:upto] - np.cumsum(n) + n, n) + np.arange(n.sum())
            rows = order[place]
            best.add(self.scores(rows, wanted), self.ids[rows], self.null[rows])
            done, look = upto, 2 * look


def _search(found: DataFrame, items: dict, weight: np.ndarray, documents: int, length: int, top: int) -> DataFrame:
    """(item, id, score): the best rows of each item in each task."""
    size = len(weight)
    named = list(items.items())
    rows_a_block = max(64, BLOCK_CELLS // max(1, size))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
        for batch in batches:
            ids = batch.column("id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            n = batch.column("n").to_numpy()
            lists = batch.column("terms")
            count = np.diff(lists.offsets.to_numpy())
            first = np.cumsum(count) - count
            term, tf = lists.flatten().to_numpy(), batch.column("tfs").flatten().to_numpy().astype(np.int64)
            m = 50 + (50 * n * documents) // length
            gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, count)))
            order = np.argsort(n, kind="stable")
            for k in range(0, len(order), rows_a_block):
                rows = order[k : k + rows_a_block]
                own = count[rows]
                place = np.repeat(first[rows] - np.cumsum(own) + own, own) + np.arange(own.sum())
                yield _Block(ids[rows], null[rows], np.repeat(np.arange(len(rows)), own), term[place], gain[place], size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(top) for _ in named]
        for block in blocks(batches):
            wanted = np.zeros(size, bool)
            for (_, terms), kept in zip(named, best, strict=True):
                wanted[terms] = True
                block.search(terms, wanted, kept)
                wanted[terms] = False
        for (item, _), kept in zip(named, best, strict=True):
            if len(kept.id):
                ids = pa.array(kept.id, pa.int64(), mask=kept.null)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(ids), pa.int64()), ids, pa.array(kept.score)], names=["item", "id", "score"])

    return found.mapInArrow(run, "item long, id long, score long")


def _first(rows: DataFrame, top: int, *keys) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = 50, key: str = "doc_id", item_key: str = "item_id", text: str = "text"
) -> DataFrame:
    """(item_key, rank, key, score): the `top` rows of `docs` with the highest score above 0 for each item, equal scores by
    ascending key.

    A term is a run of letters, digits and anything beyond ASCII, with A-Z lower-cased; terms are compared by hashes of 64
    bits. Null and empty texts have no terms: such documents count nowhere and such items get no rows.
    Repeated documents are documents of their own and take a rank each. Documents with a null key count
    and are ranked after all others of their score. Items with equal keys (also null) are one item with the terms of
    all. Tables without rows, or items without terms, give an empty table. Other columns are not read."""
    spark = docs.sparkSession
    asked = table(item_terms(items, item_key, text), "search-items")
    plain = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    out = spark.createDataFrame([], "item long, id long, score long")
    blocks = -(-asked.count() // BLOCK_TERMS)
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        vocabulary, place = np.unique(mine.column("term").to_numpy().view(np.uint64), return_inverse=True)
        if not len(vocabulary):
            continue
        of_item: dict = {}
        for item, term in zip(mine.column("item").to_pylist(), place.tolist(), strict=True):
            of_item.setdefault(item, []).append(term)
        found = table(postings(plain, vocabulary), "search-postings")
        counted = found.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
        if not counted["documents"]:
            continue
        n = counted["documents"]
        df = _frequencies(found, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        every = {item: np.array(sorted(terms), np.int64) for item, terms in of_item.items()}
        out = out.unionByName(table(_search(found, every, weight, n, counted["length"], top), "search-best"))
    # Tasks' best rows meet in salted ranges first: an item's last step reads a bounded number.
    cut = _first(out.withColumn("salt", F.pmod(F.xxhash64("id", "score"), F.lit(SALTS))), top, "item", "salt")
    cut = _first(cut.drop("rank"), top, "item")
    return cut.select(F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score")

"""Token ids as binary files coded by a range asymmetric numeral system with static tables.

A task turns its run of documents (a range of the order key) into one or more files. A file is

    magic, blocks, frequency table, block index, footer

The frequency table is counted over all ids of the file and shared by its blocks. A block holds whole
documents; its ids are dealt to interleaved lanes, each with a 64-bit state that sheds 32-bit words,
and it can be decoded without any other block. The index is the list of checkpoints: for every block
its byte range, the document and id it starts at, and checksums of its bytes and of its ids. Readers
deal blocks, not files, to tasks.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorstream.llm.common import SPACE, pieces, spread, table, text_bytes
from sensorstream.llm.files import make_folder, open_file, publish

MAGIC = b"RANSIDS1"
#: log2 of the sum of a table's frequencies; lower bound of a state.
SCALE, LOW = 18, 1 << 31
#: Ids per block and per file (a document is never cut, so both may be exceeded by one document), most lanes.
BLOCK_IDS, FILE_IDS, LANES = 1 << 19, 1 << 23, 4096
#: Stretches (in arrays, some 30 bytes each) and parts (in a dictionary, some 250 bytes each) that a worker remembers.
MEMO_ENTRIES, PART_ENTRIES = 1_200_000, 600_000
#: Bytes of text that are tokenized together.
SLICE_BYTES = 4 << 20

# ---- coding ----------------------------------------------------------------------------------


class Table:
    """Frequencies of the ids of a file: symbols in ascending order, every one with at least one slot."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray):
        self.symbols, self.freq = symbols.astype(np.uint32), freq.astype(np.uint64)
        self.start = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.freq)[:-1]])

    @classmethod
    def count(cls, ids: np.ndarray) -> Table:
        counts = np.zeros(int(ids.max()) + 1, np.int64)
        for begin in range(0, len(ids), BLOCK_IDS):
            counts += np.bincount(ids[begin : begin + BLOCK_IDS], minlength=len(counts))
        symbols = np.flatnonzero(counts)
        counts, slots = counts[symbols], 1 << SCALE
        if len(symbols) > slots:
            raise ValueError(f"more than {slots} different ids in one file")
        freq = 1 + counts * (slots - len(symbols)) // counts.sum()
        freq[np.argmax(freq)] += slots - freq.sum()
        return cls(symbols, freq)

    def places(self) -> np.ndarray:
        """Where each symbol stands in the table, by symbol."""
        out = np.zeros(int(self.symbols[-1]) + 1, np.int32)
        out[self.symbols] = np.arange(len(self.symbols), dtype=np.int32)
        return out

    def pack(self) -> bytes:
        gaps = np.diff(self.symbols.astype(np.int64), prepend=0)
        return zlib.compress(struct.pack("<I", len(gaps)) + gaps.astype("<u4").tobytes() + self.freq.astype("<u4").tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        raw = zlib.decompress(data)
        n = struct.unpack_from("<I", raw)[0]
        gaps = np.frombuffer(raw, "<u4", n, 4)
        return cls(np.cumsum(gaps.astype(np.int64)), np.frombuffer(raw, "<u4", n, 4 + 4 * n))


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """Lanes take ids in turn; coding runs from the last id to the first so that decoding runs forward."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 256))
    place = table.places()[ids]
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    shift, full = np.uint64(SCALE), np.uint64((LOW >> SCALE) << 32)
    for begin in range((n - 1) // lanes * lanes, -1, -lanes):
        own = place[begin : begin + lanes]
        freq, x = table.freq[own], state[: len(own)]
        spill = x >= full * freq
        words.append(x[spill].astype(np.uint32))
        x = np.where(spill, x >> np.uint64(32), x)
        whole = x // freq
        state[: len(own)] = (whole << shift) + (x - whole * freq) + table.start[own]
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    return struct.pack("<II", n, lanes) + state.astype("<u8").tobytes() + stream.astype("<u4").tobytes()


def decode_block(data: bytes, table: Table, slots: np.ndarray) -> np.ndarray:
    n, lanes = struct.unpack_from("<II", data)
    state = np.frombuffer(data, "<u8", lanes, 8).astype(np.uint64)
    stream = np.frombuffer(data, "<u4", offset=8 + 8 * lanes).astype(np.uint64)
    out = np.empty(n, np.uint32)
    at, mask, shift = 0, np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for begin in range(0, n, lanes):
        m = min(lanes, n - begin)
        x = state[:m]
        slot = x & mask
        own = slots[slot.astype(np.int64)]
        x = table.freq[own] * (x >> shift) + slot - table.start[own]
        need = np.flatnonzero(x < np.uint64(LOW))
        x[need] = (x[need] << np.uint64(32)) | stream[at : at + len(need)]
        at += len(need)
        state[:m] = x
        out[begin : begin + m] = table.symbols[own]
    if at != len(stream) or (state != np.uint64(LOW)).any():
        raise ValueError("block does not end where its coding began")
    return out


def slot_table(table: Table) -> np.ndarray:
    return np.repeat(np.arange(len(table.freq), dtype=np.int32), table.freq.astype(np.int64))


# ---- tokenizing ------------------------------------------------------------------------------

_ASCII_SPACE = " \t\n\r\x0b\x0c"
_WIDE = re.compile("[^\x00-\xff]")
#: Parts of a text that the tokenizer treats alone: a run of letters before white space or plain
#: punctuation, plain punctuation before white space, and else whatever stands between white space.
_PARTS = re.compile(rf"[A-Za-zÀ-ÖØ-öø-ÿ]+(?![^{_ASCII_SPACE}!-&(-/:;=?@\[-`{{}}~])|[!-&(-/:;=?@\[-`{{}}~]+(?=[{_ASCII_SPACE}]|$(?![\n]))|[^{_ASCII_SPACE}]+")


class WordEncoder:
    """`Tokenizer.encode(text, add_special_tokens=False)` for tokenizers whose words end at white space
    and between letters and punctuation: the library encodes each different part once, all new parts of
    a slice of texts together, and texts are joined from stretches of parts. Only stretches of Latin-1 characters are
    lower-cased first, where that is one character for one; others leave it to the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.ends = np.zeros(self.library.get_vocab_size() + 1, bool)
        for token, i in self.library.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.memo: dict[str, bytes] = {}
        self._forget()

    def _whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _ids(self, text: str) -> np.ndarray:
        """By the library's form without offsets; a batch of one text, so one thread."""
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def __call__(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is empty. Stretches between white space met
        before are looked up, new ones are cut into parts, and new parts of all texts are learnt together."""
        data, at = text_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        gap = SPACE[data]
        begins = ~gap
        begins[1:] &= gap[:-1]
        firsts = at[:-1][at[:-1] < len(data)]
        begins[firsts] = ~gap[firsts]
        begins = np.flatnonzero(begins)
        if not len(begins):
            return [b""] * len(texts)
        body = data[~gap]
        bounds = np.append(begins - np.cumsum(gap, dtype=np.int32 if len(gap) < 1 << 31 else np.int64)[begins], len(body))
        stretches = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(body)]).dictionary_encode()
        place = self._places(stretches.dictionary)[stretches.indices.to_numpy()]
        n = np.diff(self.start)[place]
        ends = np.cumsum(n)
        ids = self.pool[np.repeat(self.start[place] - (ends - n), n) + np.arange(ends[-1])].tobytes()
        cuts = 4 * np.append(0, ends)[np.searchsorted(begins, at)]
        return [ids[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _forget(self) -> None:
        self.known, self.pool, self.start = pa.array([], pa.large_string()), np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _places(self, stretches: pa.Array) -> np.ndarray:
        """Places of different stretches among the known ones; those not known before are added."""
        if len(self.known) > MEMO_ENTRIES:
            self._forget()
        place = pc.fill_null(pc.index_in(stretches, value_set=self.known), -1).to_numpy().copy()
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = len(self.known) + np.arange(len(new))
            fresh = stretches.take(pa.array(new))
            coded = self._encode(fresh.to_pylist())
            self.known = pa.concat_arrays([self.known, fresh])
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(coded), "<u4")])
            self.start = np.append(self.start, self.start[-1] + np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) // 4))
        return place

    def _encode(self, stretches: list[str]) -> list[bytes]:
        parts = []
        for text in stretches:
            if text.isascii() and text.isalpha():
                parts.append((text.lower(),))
                continue
            if not _WIDE.search(text) and "<|" not in text:
                text = text.lower()
            parts.append(_PARTS.findall(text))
        memo = self.memo
        if len(memo) > PART_ENTRIES:
            memo.clear()
        fresh = set(chain.from_iterable(parts)).difference(memo)
        if fresh:
            self._learn(list(fresh))
        return [b"".join(map(memo.__getitem__, own)) for own in parts]

    def _learn(self, parts: list[str]) -> None:
        plain = [p for p in parts if p.isalpha()]
        ids = self._ids(" ".join(plain)) if plain else np.zeros(0, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(plain):
            raw, begin = ids.tobytes(), 0
            for p, end in zip(plain, cuts.tolist(), strict=True):
                self.memo[p] = raw[4 * begin : 4 * end]
                begin = end
        else:
            self.memo.update((p, self._whole(p)) for p in plain)
        self.memo.update((p, self._whole(p)) for p in parts if not p.isalpha())


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# ---- files -----------------------------------------------------------------------------------


class _Writer:
    """Collects the documents of one file; `close` counts, codes and publishes it."""

    def __init__(self, folder: str, run: int):
        self.folder, self.run, self.seq = folder, run, 0
        self.clear()

    def clear(self) -> None:
        self.raw = bytearray()
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.n = 0

    def add(self, doc: int | None, ids: bytes) -> None:
        self.raw += ids
        self.docs.append(doc)
        self.sizes.append(len(ids) // 4)
        self.n += len(ids) // 4

    def close(self) -> tuple[str, int, int]:
        table = Table.count(np.frombuffer(self.raw, "<u4"))
        name = f"{self.folder}/ids-{self.run:06d}-{self.seq:06d}.rans"
        index, at = [], len(MAGIC)
        with publish(name) as out:
            out.write(MAGIC)
            k, first = 0, 0
            while k < len(self.sizes):
                begin, n = k, 0
                while k < len(self.sizes) and (k == begin or n + self.sizes[k] <= BLOCK_IDS):
                    n += self.sizes[k]
                    k += 1
                raw = memoryview(self.raw)[4 * first : 4 * (first + n)]
                coded = encode_block(np.frombuffer(raw, "<u4"), table)
                out.write(coded)
                index.append({
                    "at": at, "bytes": len(coded), "crc": zlib.crc32(coded), "ids_crc": zlib.crc32(raw), "first_doc": begin,
                    "first_id": first, "ids": n, "docs": self.docs[begin:k], "sizes": self.sizes[begin:k],
                })
                at, first = at + len(coded), first + n
            packed, listed = table.pack(), zlib.compress(json.dumps(index).encode(), 6)
            out.write(packed)
            out.write(listed)
            out.write(struct.pack("<QIQII", at, len(packed), at + len(packed), len(listed), zlib.crc32(packed + listed)) + MAGIC)
        done = (name, len(self.docs), self.n)
        self.seq += 1
        self.clear()
        return done


_FOOTER = struct.calcsize("<QIQII") + len(MAGIC)


def write_ids(df: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """Write the ids of every whole `text`, each followed by `end_id`, below `folder` in ascending `key`
    order: by file name, then inside files. Returns one row per file (path, docs, ids); running that
    plan writes the files, and a task that runs again writes the same files again.

    Null keys come first; rows with equal keys are ordered by text; null texts count as empty and have
    the end id alone. An empty table writes nothing. Only `key` and `text` are read, so other
    columns cannot clash. `folder` and `tokenizer` are paths that all executors see."""
    plain = df.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    make_folder(folder)
    ranged = plain.repartitionByRange(F.col("key")).sortWithinPartitions("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = word_encoder(tokenizer), struct.pack("<I", end_id)
        writer, done = _Writer(folder, TaskContext.get().partitionId()), []
        for batch in batches:
            for part in pieces(batch, "text", SLICE_BYTES):
                for doc, own in zip(part.column("key").to_pylist(), encode(part.column("text")), strict=True):
                    writer.add(doc, own + tail)
                    if writer.n >= FILE_IDS:
                        done.append(writer.close())
        if writer.docs:
            done.append(writer.close())
        columns = list(zip(*done, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["path", "docs", "ids"])

    return ranged.mapInArrow(run, "path string, docs long, ids long")


def _footer(path: str) -> tuple[bytes, list[dict]]:
    with open_file(path) as f:
        f.seek(f.size() - _FOOTER)
        raw = f.read()
        if raw[-len(MAGIC) :] != MAGIC:
            raise ValueError(f"{path} is no id file")
        table_at, table_n, list_at, list_n, crc = struct.unpack_from("<QIQII", raw)
        f.seek(table_at)
        packed, listed = f.read(table_n), f.read(list_n)
    if zlib.crc32(packed + listed) != crc:
        raise ValueError(f"tables of {path} are damaged")
    return packed, json.loads(zlib.decompress(listed))


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """One row per block of every file below `folder`, from the files' indexes: path, block, place, ids before it in the file."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.rans").load(folder).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                _, index = _footer(path)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(index)), pa.array(range(len(index)), pa.int32()), *(pa.array([b[k] for b in index], pa.int64()) for k in ("first_id", "ids"))],
                    names=["path", "block", "first_id", "ids"],
                )

    return listed.mapInArrow(run, "path string, block int, first_id long, ids long")


def read_ids(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """Decode all blocks below `folder`: doc (null for a null key), start (ids of all documents before
    it), n_tokens, ids_crc32 and, if `ids`, the ids as array of long. Wrong checksums raise. A folder
    without files gives an empty table."""
    blocks = table(read_blocks(spark, folder), "id-blocks")
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("path").agg(F.sum("ids").alias("n")).select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    dealt = spread(blocks.join(files, "path").select("path", "block", (F.col("base") + F.col("first_id")).alias("start")), blocks.count())
    schema = "doc long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, table, slots, index = None, None, None, []
        for batch in batches:
            for path, block, start in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "start")), strict=True):
                if path != seen:
                    packed, index = _footer(path)
                    seen, table = path, Table.unpack(packed)
                    slots = slot_table(table)
                entry = index[block]
                with open_file(path) as f:
                    f.seek(entry["at"])
                    coded = f.read(entry["bytes"])
                if zlib.crc32(coded) != entry["crc"]:
                    raise ValueError(f"block {block} of {path} is damaged")
                found = decode_block(coded, table, slots)
                raw = memoryview(found.astype("<u4").tobytes())
                if zlib.crc32(raw) != entry["ids_crc"]:
                    raise ValueError(f"block {block} of {path} decodes to other ids")
                sizes = np.array(entry["sizes"], np.int64)
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(entry["docs"], pa.int64()), pa.array(start + ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64())]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(found.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return dealt.mapInArrow(run, schema)

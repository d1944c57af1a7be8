from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sensorstream.llm import queries, rans
from sensorstream.llm.common import shared_path

LIBRARY = Tokenizer.from_file(queries.WORD_TOKENIZER)
PARTS = ["a", "B", " ", "The", "'s", "don't", "\n", "é", "É", "中", "😀", "\x00", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "…", "a-b", "0", "ß", "́", "Σ", "İ", "K", "\x1c", "\x85", "\xa0", "_", "''", "~", ">", "½", "µ"]


def of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_blocks_decode_to_their_ids():
    rnd = np.random.default_rng(1)
    ids = np.minimum(rnd.zipf(1.3, 40_000), 49_000).astype(np.uint32)
    coded = rans.Table.count(ids)
    slots = rans.slot_table(rans.Table.unpack(coded.pack()))
    for n in (1, 2, 255, 256, 257, 5000, 40_000):
        assert (rans.decode_block(rans.encode_block(ids[:n], coded), coded, slots) == ids[:n]).all()
    entropy = -sum(p * np.log2(p) for p in np.unique(ids, return_counts=True)[1] / len(ids)) * len(ids) / 8
    assert len(rans.encode_block(ids, coded)) < 1.03 * entropy + 2000


def test_words_are_encoded_as_by_the_library():
    rnd, encode = random.Random(2), rans.word_encoder(queries.WORD_TOKENIZER)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 9))) for _ in range(3000)]
    for text, raw in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == of(text), repr(text)


def test_known_stretches_are_not_cut_again(monkeypatch):
    rnd, encode = random.Random(3), rans.WordEncoder(queries.WORD_TOKENIZER)
    words = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    texts = [None, "", " \n ", *("\t".join(rnd.choices(words, k=40)) for _ in range(200))]
    cut, encode._encode = [], lambda new, before=encode._encode: cut.extend(new) or before(new)
    first = encode(pa.array(texts))
    assert len(cut) == len(set(cut))
    seen = len(cut)
    assert encode(pa.array(texts, pa.large_string()).slice(2)) == first[2:] and len(cut) == seen
    assert [np.frombuffer(raw, "<u4").tolist() for raw in first] == [of(t) for t in texts]
    monkeypatch.setattr(rans, "MEMO_ENTRIES", 10)
    assert encode(pa.array(texts)) == first and encode(pa.array(texts[100:])) == first[100:]
    assert len(cut) > seen and len(encode.known) <= seen


def wanted(rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*of(text), 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_files_hold_all_rows_in_order(spark, edges, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_IDS", 64)
    folder = shared_path(spark, "ids")
    files = rans.write_ids(edges, folder, queries.WORD_TOKENIZER).collect()
    assert sum(f.docs for f in files) == edges.count()
    found = sorted(tuple(r) for r in rans.read_ids(spark, folder).select("start", "doc", "n_tokens", "ids_crc32", "ids").collect())
    assert [(d, s, n, c, list(i)) for s, d, n, c, i in found] == wanted([(r.doc_id, r.text) for r in edges.collect()])


def test_no_rows(spark, nothing):
    folder = shared_path(spark, "ids")
    assert rans.write_ids(nothing, folder, queries.WORD_TOKENIZER).count() == 0
    assert rans.read_ids(spark, folder).count() == 0


def test_damage_is_noticed(spark, edges):
    folder = shared_path(spark, "ids")
    rans.write_ids(edges.where("doc_id = 5"), folder, queries.WORD_TOKENIZER).collect()
    path = glob.glob(folder.removeprefix("file://") + "/*.rans")[0]
    data = bytearray(open(path, "rb").read())
    data[len(rans.MAGIC) + 5000] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="is damaged"):
        rans.read_ids(spark, folder).collect()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()]
    found = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op3_rans_ids"](spark, sf).collect())
    assert found == [w[:4] for w in wanted(rows)]

from __future__ import annotations

import hashlib
import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import types as T

from sensorstream.llm import queries
from sensorstream.llm.piece import decode_pieces, encode_pieces, piece_model

MODEL = queries.PIECE_MODEL
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
PARTS = ["a", "b", " ", "  ", "the", " th", "ing", "\n", "\t", "▁", "é", "中", "😀", "\x00", "<0x41>", "<s>", "…", "aaaa", "-----", "12", "ß", "́", "x" * 30]


def test_ids_and_texts_are_the_librarys():
    model, rnd = piece_model(MODEL), random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))
        ids = LIBRARY.encode(text)
        assert model.encode(text) == ids
        assert model.decode(ids) == LIBRARY.decode(ids)


def test_any_ids_decode_as_in_the_library():
    model, rnd = piece_model(MODEL), random.Random(2)
    for _ in range(3000):
        ids = [rnd.choice([0, 1, 2, 3, 131, 187, 198, 228, 230, 259, 300, 13, 28705, 31000]) for _ in range(rnd.randint(0, 6))]
        assert model.decode(ids) == LIBRARY.decode(ids)


def test_a_long_run_without_spaces():
    rnd = random.Random(3)
    text = "".join(rnd.choice("etaoinshrdlu") for _ in range(20_000))
    assert piece_model(MODEL).encode(text) == LIBRARY.encode(text)


def test_edges(edges, nothing):
    coded = encode_pieces(edges, MODEL, decoded="decoded")
    assert coded.columns.count("ids") == 1
    rows = coded.collect()
    assert len(rows) == edges.count()
    for r in rows:
        assert list(r.ids) == LIBRARY.encode(r.text or "")
        assert r.decoded == (r.text or "")
    again = decode_pieces(coded.drop("text"), MODEL).collect()
    assert sorted(r.text for r in again) == sorted(r.text or "" for r in rows)
    assert encode_pieces(nothing, MODEL).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in queries.documents(spark, sf).collect()}
    for r in queries.QUERIES["op9_pieces"](spark, sf).collect():
        ids = LIBRARY.encode(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_a_worker_keeps_the_model_only():
    class Docs:
        schema = T.StructType([T.StructField("text", T.StringType())])

        def mapInArrow(self, run, schema):
            return run

    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(5, 12))) for _ in range(300)) for _ in range(100)]
    batch = pa.RecordBatch.from_pydict({"text": [*texts, None, ""]})
    model = piece_model(MODEL)
    model.encode(texts[0])
    tracemalloc.start()
    rows = sum(out.num_rows for out in encode_pieces(Docs(), MODEL, decoded="decoded")(iter([batch])))
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == 102 and peak > 2e6
    assert held < 1e6
    assert model.encode(texts[0]) == LIBRARY.encode(texts[0])

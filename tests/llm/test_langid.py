from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.llm import langid, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in queries.QUERIES["op5_language"](spark, sf).collect()}
    docs = queries.documents(spark, sf).collect()
    assert len(found) == len(docs)
    for d in docs:
        assert found[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
    test = [d for d in docs if found[d.doc_id].held_out and d.lang]
    assert np.mean([found[d.doc_id].lang_pred == d.lang for d in test]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_held_out_labels_are_not_learnt_from(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.001")
    wrong = docs.withColumn("lang", F.when(langid.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    a, b = langid.fit(docs, ~langid.held_out()), langid.fit(wrong, ~langid.held_out())
    assert a.families == b.families and (a.weights == b.weights).all()


def test_the_sample_is_bounded(spark):
    rows = [(i, "ein Haus am See" if i % 2 else "a house by the lake", "de" if i % 2 else "en") for i in range(3000)]
    seen = []
    fit_rows = langid.fit_rows
    langid.fit_rows = lambda x, y: seen.append(len(y)) or fit_rows(x, y)
    try:
        model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), train_rows=50)
    finally:
        langid.fit_rows = fit_rows
    assert seen[0] <= 100
    assert model.predict(pa.array(["ein Haus", "a house"]))[0] == ["de", "en"]


def test_family_then_language():
    texts = {"en": "the house with this thing", "de": "das haus und der hund", "fr": "une maison avec des chiens", "es": "una casa con perros grandes", "ru": "дом и собака здесь", "xx": "zzq qqz zqz"}
    rows, langs = [], []
    for lang, text in texts.items():
        for k in range(6):
            words = text.split()
            bucket, _ = langid.grams(pa.array([" ".join(words[k % 3 :] + words[: k % 3])]))
            rows.append(np.bincount(bucket, minlength=langid.BUCKETS) * langid.SCALE / len(bucket))
            langs.append(lang)
    model = langid.fit_rows(np.array(rows, np.float32), np.array(langs, object))
    assert model.families == [["de", "en"], ["es", "fr"], ["ru"], ["xx"]]
    assert model.predict(pa.array(list(texts.values())))[0] == list(texts)


def test_edges(edges, nothing):
    model = langid.fit(edges, ~langid.held_out())
    found = langid.identify(edges, model).collect()
    assert len(found) == edges.count()
    for r in found:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and (lettered or r.score == 0)
    empty = langid.fit(nothing, F.lit(True))
    assert langid.identify(nothing, model).count() == 0
    assert {r.lang_pred for r in langid.identify(edges, empty).collect()} == {"und"}


def test_scoring_a_batch_holds_little():
    class Docs:
        schema = T.StructType([T.StructField("text", T.StringType())])

        def mapInArrow(self, run, schema):
            return run

    model = langid.LanguageModel([["de", "en"], ["fr"]], [[(0, 1, 1)], []], np.ones((langid.BUCKETS, 2), np.float32), np.zeros(2))
    batch = pa.RecordBatch.from_pydict({"text": ["ein Haus am See und " * 500, None, ""] * 400})
    tracemalloc.start()
    found = pa.Table.from_batches(langid.identify(Docs(), model)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 1200 and found.column("lang_pred").null_count == 0
    assert peak < 40e6


def test_grams_stand_text_by_text_and_order_by_order():
    texts = ["ab", None, "", "é 1 2  3", "a house by the lake"]
    bucket, at = langid.grams(pa.array(texts))
    alone = [langid.grams(pa.array([t], pa.string()))[0].tolist() for t in texts]
    assert [bucket[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == alone
    assert len(alone[0]) == 6 and len(alone[4]) == 3 * 21 - 6

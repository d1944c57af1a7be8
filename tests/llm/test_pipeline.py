from __future__ import annotations

import corpus_pipeline as pipeline
import sentencepiece
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_rejects_what_has_no_letter(spark, edges):
    kept = pipeline.language(spark, edges, "")
    assert kept.columns == edges.columns
    wanted = sorted((r.doc_id or -1, r.text) for r in edges.collect() if any(c.isalpha() for c in r.text or ""))
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == wanted


def test_documents_with_letters_stay_where_no_language_is_known(spark, edges):
    wanted = sorted((r.doc_id or -1, r.text) for r in edges.collect() if any(c.isalpha() for c in r.text or ""))
    for lang in (F.lit(None).cast("string"), F.when(~F.col("text").rlike(r"\p{L}"), "en")):
        kept = pipeline.language(spark, edges.withColumn("lang", lang), "")
        assert kept.columns == edges.columns
        assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == wanted


def test_one_document_of_each_group_stays(spark, edges):
    base = [f"w{i}" for i in range(400)]
    near = [*base[:200], "other", *base[201:]]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (8, " ".join(base)), (9, " ".join(base[:200])), (10, "else"), (10, "else")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in pipeline.duplicates(spark, docs, "").collect()) == [3, 9, 10]
    kept = pipeline.duplicates(spark, edges, "")
    assert kept.columns == edges.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 1, 2, 3, 4, 5, 6, 9, 10]


def test_the_mix_repeats_whole_rows(spark, edges):
    mixed = pipeline.mix(spark, edges, "")
    assert mixed.columns == edges.columns
    known = {tuple(r) for r in edges.collect()}
    assert {tuple(r) for r in mixed.collect()} <= known


def test_pieces_are_the_librarys(spark, edges):
    library = sentencepiece.SentencePieceProcessor(model_file=pipeline.PIECE_MODEL)
    rows = pipeline.pieces(spark, edges, "").collect()
    assert len(rows) == edges.count() and all(r.round_trip for r in rows)
    assert sorted(list(r.ids) for r in rows) == sorted(library.encode(r.text or "") for r in edges.collect())


def test_no_documents(spark, nothing):
    docs = nothing.select(*COLUMNS)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_run(spark):
    sf = "/root/testdata/sf0.001"
    out = pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert out.agg(F.min(F.col("round_trip").cast("int"))).first()[0] == 1
    assert out.join(docs, "doc_id", "left_anti").count() == 0
    assert out.count() > 0.5 * docs.count()

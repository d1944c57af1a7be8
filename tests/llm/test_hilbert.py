from __future__ import annotations

import itertools
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorstream.llm import hilbert, queries
from sensorstream.llm.common import shared_path


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 3), (3, 2), (4, 1)])
def test_the_curve_visits_every_cell_and_moves_by_one(spark, dims, bits):
    names = [f"x{i}" for i in range(dims)]
    points = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(points, ", ".join(f"{n} int" for n in names))
    found = sorted((r.h, r[:dims]) for r in df.select(*names, hilbert.hilbert_index([F.col(n) for n in names], bits).alias("h")).collect())
    assert [h for h, _ in found] == list(range(len(points)))
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for (_, p), (_, q) in zip(found, found[1:], strict=False))


def check(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min([counts.get(s, 0) for s in range(shards)]) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert_index for r in ordered] == sorted(r.hilbert_index for r in rows)


def test_edges(edges, nothing):
    for shards in (1, 5, 24):
        found = hilbert.hilbert_shards(edges, ["lang", "source", "n_chars"], shards, ["doc_id", "text"]).collect()
        assert len(found) == edges.count()
        check(found, shards)
    assert hilbert.hilbert_shards(nothing, ["lang", "n_chars"], 3, ["doc_id"]).count() == 0


def test_one_cell_is_split(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    check(hilbert.hilbert_shards(df, ["source"], 7, ["doc_id"]).collect(), 7)


def test_files_cover_small_boxes(spark):
    df = spark.range(4096).select((F.col("id") % 64).alias("x"), (F.col("id") / 64).cast("int").alias("y"))
    cut = hilbert.hilbert_shards(df, ["x", "y"], 16, ["x", "y"])
    boxes = hilbert.shard_boxes(cut, ["x", "y"]).collect()
    area = [(b.max_x - b.min_x + 1) * (b.max_y - b.min_y + 1) for b in boxes]
    assert len(boxes) == 16 and sum(area) < 3 * 4096
    path = shared_path(spark, "shards")
    hilbert.write_shards(cut, path)
    assert hilbert.read_shards(spark, path).count() == 4096


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in queries.documents(spark, sf).collect()}
    found = queries.QUERIES["op6_hilbert_shards"](spark, sf).collect()
    check(found, 24)
    for r in found:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]), "rows", None)

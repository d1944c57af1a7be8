from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorstream.llm import mixing, queries


def brute_targets(sizes, share=1.5, cap=2.0, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return target


def test_targets(spark):
    for sizes in ({"a": 100, "b": 5, "c": 900, None: 40, "é": 3, "Z": 0}, {"one": 7}, {"a": 10, "b": 1000, "c": 10, "d": 10}):
        df = spark.createDataFrame([(k, float(v), 1) for k, v in sizes.items()], "source string, source_size double, units long")
        found = {r.source: r.target for r in mixing.source_targets(df, 1.5, 2.0, mixing.WEIGHTS).collect()}
        assert found == pytest.approx(brute_targets(sizes))


def test_pivot_keeps_the_sum_and_the_expectation():
    size = np.array([5.0, 1, 9, 3, 3, 7, 2, 8])
    start = np.array([0.5, 0.2, 0.7, 0.1, 0.9, 0.33, 0.5, 0.6])
    total, rnd = np.zeros(8), np.random.default_rng(1)
    for _ in range(4000):
        part = start.copy()
        held = mixing.pivot(part, size, rnd.random(9))
        assert (part * size).sum() == pytest.approx((start * size).sum())
        assert all(p in (0, 1) for i, p in enumerate(part) if i != held)
        total += part
    assert total / 4000 == pytest.approx(start, abs=0.04)


def test_a_tree_of_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 8)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), (F.pmod(F.xxhash64("id"), F.lit(90)) + 1).alias("words"))
    found = mixing.mix_copies(df, F.col("words"), keys=("doc_id",)).collect()
    assert len(found) == 3000
    sums = {}
    for r in found:
        s = sums.setdefault(r.source, [r.target, 0])
        s[1] += r.copies * r.size
        assert 0 <= r.copies <= 2
    assert all(abs(target - taken) <= 90 for target, taken in sums.values())
    again = mixing.mix_copies(df.repartition(7), F.col("words"), keys=("doc_id",)).collect()
    assert {r.doc_id: r.copies for r in again} == {r.doc_id: r.copies for r in found}


def test_edges(edges, nothing):
    from sensorstream.llm.common import word_count

    found = mixing.mix_copies(edges, word_count(F.col("text"))).collect()
    assert len(found) == edges.count()
    same = [r.copies for r in found if r.doc_id == 6]
    assert len(same) == 2 and len(set(same)) == 1
    assert all(r.target is not None and r.copies is not None for r in found)
    assert mixing.mix_copies(nothing, F.lit(1)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in queries.documents(spark, sf).collect()}
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for k, r in docs.items()}
    sources = {}
    for k, r in docs.items():
        sources[r.source] = sources.get(r.source, 0) + size[k]
    targets, taken = brute_targets(sources), dict.fromkeys(sources, 0)
    found = queries.QUERIES["op7_pivotal_mix"](spark, sf).collect()
    assert len(found) == len(docs)
    for r in found:
        own = docs[r.doc_id].source
        assert (r.size, r.source_size) == (size[r.doc_id], sources[own]) and r.taken <= 2 * r.size
        assert r.target == pytest.approx(targets[own])
        taken[own] += r.taken
    most = max(size.values())
    assert all(abs(taken[s] - targets[s]) <= most for s in sources)

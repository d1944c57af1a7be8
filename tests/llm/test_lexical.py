from __future__ import annotations

import math
import random
import re
from collections import Counter

from sensorstream.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, score string, rank string, id string, n string"
DOCS = "doc_id long, text string, score string, rank string, terms string, tfs string"


def terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute(docs, items, top):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    pooled = {}
    for i, t in items:
        pooled.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in pooled.items():
        scored = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n // length
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, top, parts=3):
    d = spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in docs], DOCS).repartition(parts)
    q = spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in items], ITEMS)
    ranked = lexical.rank_documents(d, q, top)
    assert ranked.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in ranked.collect()), key=repr)


def corpus(seed, n, vocabulary=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Über", "über", "ÉTÉ", "x9", "9", "中文"]
    pick = lambda k: rnd.choice([" ", ", ", "-", "\n"]).join(words[min(len(words) - 1, int(rnd.expovariate(0.05)))] for _ in range(k))
    return [(i, pick(rnd.choice([1, 3, 20, 80, 400]))) for i in range(n)], [(i, pick(rnd.choice([1, 10, 40, 200]))) for i in range(12)]


def test_ranks_are_those_of_brute_force(spark, monkeypatch):
    docs, items = corpus(1, 700)
    wanted = brute(docs, items, 50)
    assert found(spark, docs, items, 50) == wanted
    # small blocks of documents and of items, early looks at the bound: the same rows
    monkeypatch.setattr(lexical, "BLOCK_CELLS", 64 * 100)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 90)
    monkeypatch.setattr(lexical, "FIRST_LOOK", 1)
    assert found(spark, docs, items, 50) == wanted
    assert found(spark, docs, items, 3) == brute(docs, items, 3)


def test_masks_of_more_than_64_terms_separate_documents(spark):
    docs = [(i, " ".join(f"t{j}" for j in range(150) if (i >> (j % 5)) & 1) + " z") for i in range(1, 40)]
    items = [(1, " ".join(f"t{j}" for j in range(150)))]
    assert found(spark, docs, items, 7) == brute(docs, items, 7)


def test_nulls_ties_repeats_and_very_long_texts(spark, edges):
    long = " ".join(f"long{i % 9} tail" for i in range(100_000))
    docs = [
        (1, None), (2, ""), (3, " .,- "), (4, "same words here"), (5, "same words here"), (5, "same words here"), (None, "same words here"), (7, long),
        (8, "SAME Words\x00here"), (9, "other"), (None, None),
    ]
    items = [(1, "same words"), (1, "long3"), (2, None), (3, "-- "), (None, "other tail"), (4, "nothing of this kind")]
    got = found(spark, docs, items, 4)
    assert got == brute(docs, items, 4)
    assert {r[0] for r in got} == {1, None}
    # any table with the two columns will do
    assert lexical.rank_documents(edges, edges.withColumnRenamed("doc_id", "item_id"), 5).count() > 0


def test_tables_without_rows(spark, nothing):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.rank_documents(nothing, items).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lexical.rank_documents(docs, items.limit(0)).count() == 0
    assert lexical.rank_documents(docs.limit(0), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_one_text_everywhere_does_not_grow_what_tasks_hand_on(spark):
    docs = [(i, "the same text") for i in range(3000)] + [(5000 + i, f"the other text {i}") for i in range(50)]
    items = [(1, "same text"), (2, "other 17")]
    assert found(spark, docs, items, 50) == brute(docs, items, 50)


def test_query_has_the_columns_of_its_contract(spark):
    rows = queries.op12_presence_masks(spark, "/root/testdata/sf0.001")
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]

from __future__ import annotations

import hashlib
import itertools
import random

import pyarrow as pa

from sensorstream.llm import queries, spotsigs


def signatures(text):
    return spotsigs.signature_sets(pa.array([text]))[0]


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        a, b, c = map(signatures, (text, edited, after))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), spotsigs.to_text(a), spotsigs.to_text(b), spotsigs.likeness(a, b), spotsigs.likeness(a, c)))
    return sorted(out, key=repr)


def test_chains_follow_anchors():
    same = signatures("He said: the Quick, brown fox of Old town is gone now")
    assert len(same) == 4
    assert spotsigs.likeness(same, signatures("THE quick brown fox of old town is gone now")) == 3 / 4
    assert not len(signatures("")) and len(signatures("***")) == 1 and len(signatures("word other")) == 2


def test_likeness_prunes_by_length():
    a, b = signatures("the big dog of small house"), signatures("the big dog of small house in my yard now the end comes soon")
    assert spotsigs.likeness(a, b) > 0 and spotsigs.likeness(a, b, 0.9) == 0
    assert spotsigs.likeness(a[:0], b[:0]) == 1 and spotsigs.likeness(a, b[:0]) == 0


def test_edited_texts(spark, edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    for buckets in (1, 3, 40):
        found = spotsigs.edited_fingerprints(edges, buckets=buckets).collect()
        assert sorted((tuple(r) for r in found), key=repr) == expected(rows)
    assert spotsigs.edited_fingerprints(nothing).count() == 0
    alone = spotsigs.edited_fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"abca").hexdigest()


def test_similar_pairs(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "is"] * 60
    rows = []
    for base in range(8):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([40, 120, 300]))]
        for _ in range(5):
            own = list(words)
            for _ in range(rnd.randint(0, 6)):
                own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    found = spotsigs.similar_pairs(spotsigs.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")), 0.7).collect()
    first = {}
    for i, t in rows:
        first.setdefault(spotsigs.to_text(signatures(t)), (i, signatures(t)))
    wanted = {(a[0], b[0]) for a, b in itertools.combinations(sorted(first.values(), key=lambda x: x[0]), 2) if spotsigs.likeness(a[1], b[1]) >= 0.7}
    assert {(r.a, r.b) for r in found} == wanted and wanted


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.QUERIES["op4_spotsigs"](spark, sf).collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected([(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()])

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from sensorstream.llm import partenum, queries
from sensorstream.llm.common import pieces, shingle_sets


def sets_of(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, percent, width):
    sets = [sets_of(t, width) for _, t in rows]
    low = [k for k, _ in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None
        and (rows[i][0] == rows[j][0] or 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]))
    ]
    for _ in rows:
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
    return sorted(((k, len(s), c) for (k, _), s, c in zip(rows, sets, low, strict=True)), key=repr)


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_a_signature(percent):
    rnd, tried = np.random.default_rng(percent), 0
    for _ in range(1500):
        a = rnd.integers(0, 2**63, int(rnd.integers(3, 500))).astype(np.uint64)
        gone = int(rnd.integers(0, max(1, len(a) // 5) + 1))
        b = np.concatenate([a[: len(a) - gone], rnd.integers(0, 2**63, int(rnd.integers(0, gone + 1))).astype(np.uint64)])
        both = len(a) - gone
        if gone and 100 * both >= percent * (len(a) + len(b) - both):
            tried += 1
            assert len(np.intersect1d(partenum.signatures(a, percent), partenum.signatures(b, percent)))
    assert tried > 300


def near_copies(rnd, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize(("percent", "width"), [(90, 3), (80, 5)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, percent, width):
    monkeypatch.setattr(partenum, "FEW", 3)
    monkeypatch.setattr(partenum, "BLOCK_ROWS", 8)
    rnd = random.Random(percent)
    texts = []
    for size, n, edits in ((300, 40, 9), (120, 25, 4), (60, 12, 3), (20, 6, 1), (8, 5, 1), (4, 3, 1), (2, 3, 1)):
        base = [f"w{rnd.randrange(5000)}" for _ in range(size)]
        texts += near_copies(rnd, base, n, edits)
    texts += [texts[0], texts[0].upper().lower(), texts[3], *(" ".join(f"u{rnd.randrange(9999)}" for _ in range(rnd.randrange(1, 80))) for _ in range(60))]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    found = partenum.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), percent, width).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows, percent, width)


def test_rows_without_a_key_take_no_links_from_others(spark):
    rnd = random.Random(4)
    edited = lambda words: " ".join([*words[:50], f"e{rnd.randrange(10**9)}", *words[51:]])
    first, second = [], []
    for g in range(8):
        a, b = ([f"w{rnd.randrange(10**6)}" for _ in range(100)] for _ in range(2))
        copy = edited(a)
        first += [(None, copy), (10 * g, copy), (10 * g + 1, edited(a))]
        near = [edited(b) for _ in range(4)]
        first += [(None, near[0]), (10 * g + 2, near[1]), (10 * g + 3, near[2])]
        second.append((10 * g + 4, near[3]))
    one, two = (spark.createDataFrame(rows, "doc_id long, text string").coalesce(1) for rows in (first, second))
    found = partenum.similar_components(one.union(two), 80, 5).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(first + second, 80, 5)


def test_edges(edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    found = partenum.similar_components(edges, 90, 3).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows, 90, 3)
    assert partenum.similar_components(nothing).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()]
    found = queries.QUERIES["op1_partenum_join"](spark, sf).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows, 90, 3)


def test_candidates_are_few_beside_links(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    asked = []
    similar = partenum._similar
    monkeypatch.setattr(partenum, "_similar", lambda pairs, *rest: (asked.append(pairs.count()), similar(pairs, *rest))[1])
    found = partenum.similar_components(docs, percent=80, width=5).collect()
    linked = sum(r.component_id != r.doc_id for r in found)
    assert linked > 20 and sum(asked) <= 4 * linked


def test_sketches_rule_out_no_similar_sets():
    rnd = np.random.default_rng(4)
    for n in (1, 2, 7, 63, 64, 300, 5000):
        a = rnd.integers(0, 2**63, n).astype(np.uint64)
        for change in (0, n // 20, n // 10, n // 9):
            b = np.unique(np.append(a[change:], rnd.integers(0, 2**63, change).astype(np.uint64)))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert partenum.may_be_similar(partenum.sketch(a), partenum.sketch(b), len(a), len(b), 80)
        other = rnd.integers(0, 2**63, n).astype(np.uint64)
        assert n < 60 or not partenum.may_be_similar(partenum.sketch(a), partenum.sketch(other), n, n, 80)


def test_sketches_are_a_quarter_byte_per_element_at_most():
    rnd = np.random.default_rng(5)
    for n in (1, 3, 4, 8, 63, 64, 1000):
        assert 0 < len(partenum.sketch(rnd.integers(0, 2**63, n).astype(np.uint64))) <= max(1, n // 4)


def test_a_block_that_meets_itself_comes_once(spark):
    dealt = spark.createDataFrame([(1, 0, 10), (1, 0, 11), (1, 1, 12)], "sig long, at long, rep long")
    meet = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 1, 6)], "sig long, at0 long, at1 long, pair long")
    found = partenum._sides(dealt, meet, "sig").select("pair", "side", "rep").collect()
    assert sorted(tuple(r) for r in found) == [(5, 2, 10), (5, 2, 11), (6, 0, 10), (6, 0, 11), (6, 1, 12)]


def test_sets_of_a_batch_are_made_in_small_slices():
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(f"w{i * k % 997}" for i in range(1, 2000)) for k in range(1, 400)]})
    tracemalloc.start()
    found = sum(len(s) for part in pieces(batch, "text", partenum.SET_BYTES) for s in shingle_sets(part.column("text"), 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == sum(map(len, shingle_sets(batch.column("text"), 5))) and peak < 40e6


class Frame:
    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


@pytest.mark.parametrize("heads", [False, True])
def test_signatures_of_a_batch_are_combined_in_little_memory(heads):
    texts = [" ".join(f"w{k // 2}-{i}" for i in range(150 + k % 2)) for k in range(4000)]
    batch = pa.RecordBatch.from_pydict({"key": pa.array([*range(3999), None], pa.int64()), "text": texts})
    sigs = sum(len(partenum.signatures(s, 80)) for s in shingle_sets(batch.column("text"), 5))
    tracemalloc.start()
    rows = most = 0
    for out in partenum.shingled(Frame(), 80, 5, heads=heads)(iter([batch])):
        rows, most = rows + out.num_rows, max(most, out.nbytes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 4000 and sigs > 500_000
    assert most < 6 << 20 and peak < 45 * sigs


def test_signatures_of_a_batch_stand_with_the_least_set(monkeypatch):
    monkeypatch.setattr(partenum, "OUT_SIGS", 1000, raising=False)
    rnd = random.Random(9)
    base = [f"v{i}" for i in range(60)]
    texts = [None, "", "a b", *(" ".join(w if rnd.random() > 0.03 else "x" for w in base) for _ in range(80)), "a b"]
    batch = pa.RecordBatch.from_pydict({"key": pa.array([k if k % 9 else None for k in range(len(texts))], pa.int64()), "text": texts})
    sets = pa.Table.from_batches(partenum.shingled(Frame(), 80, 5)(iter([batch, batch.slice(0, 2), batch.slice(0, 0)]))).to_pylist()
    found = pa.Table.from_batches(partenum.shingled(Frame(), 80, 5, heads=True)(iter([batch, batch.slice(0, 2), batch.slice(0, 0)]))).to_pylist()
    assert [r["h1"] for r in sets] == [r["h1"] for r in found] and len(sets) == len(texts) + 2
    least, own = {}, []
    for r, s in zip(sets, shingle_sets(batch.column("text"), 5), strict=False):
        first = r["key"] is not None and r["h1"] not in [h for h, _ in own]
        own.append((r["h1"] if r["key"] is not None else None, set(partenum.signatures(s, 80).view(np.int64).tolist()) if first else set()))
        for x in own[-1][1]:
            least[x] = min(least.get(x, r["h1"]), r["h1"])
    for (h, signs), r, f in zip(own, sets, found, strict=False):
        assert {(x["sig"], x["low"]) for x in r["near"]} == {(x, least[x]) for x in signs if least[x] != h}
        assert set(f["sigs"]) == {x for x in signs if least[x] == h}


def test_batches_are_short_inside_only(spark):
    from sensorstream.llm.common import BATCH_ROWS, short_batches

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    rows = spark.range(0, 3000, 1, 1)
    with pytest.raises(KeyError), short_batches(spark):
        sizes = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
        assert sum(r.n for r in sizes) == 3000 and max(r.n for r in sizes) <= BATCH_ROWS
        raise KeyError
    assert spark.conf.get(name) == before

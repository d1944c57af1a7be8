from __future__ import annotations

import numpy as np

from sensorstream.llm import multiindex, queries

KIND = "vec_id long, embedding array<float>, label int, h long, cell string"


def brute(rows, threshold=0.95):
    x = {i: np.array(v, float) for i, v in rows}
    unit = {i: v / np.linalg.norm(v) for i, v in x.items()}
    low, links = {i: i for i in x}, dict.fromkeys(x, 0)
    near = [(i, j) for i in x for j in x if i != j and (unit[i] @ unit[j] >= threshold or (x[i] == x[j]).all())]
    for i, _ in near:
        links[i] += 1
    for _ in x:
        for i, j in near:
            low[i] = min(low[i], low[j])
    return {i: (links[i], low[i], i == low[i]) for i in x}


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if a is None else float(a) for a in v], 0, 1, "x") for i, v in rows], KIND)


def clustered(seed, n, copies, dims=16):
    rnd, rows = np.random.default_rng(seed), []
    for _ in range(n):
        base = rnd.normal(size=dims)
        for _ in range(rnd.integers(1, copies + 1)):
            noise = rnd.normal(size=dims) * rnd.choice([0, 0.02, 0.1, 0.25])
            rows.append((len(rows), (base + noise).astype(np.float32).tolist()))
    return rows


def test_links_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "BLOCK_ROWS", 16)
    rows = clustered(1, 60, 8)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multiindex.near_duplicates(table(spark, rows)).collect()}
    wanted = brute(rows)
    assert sum(w[0] for w in wanted.values()) > 100
    assert sum(f[0] for f in found.values()) >= 0.98 * sum(w[0] for w in wanted.values())
    assert all(found[i][0] <= wanted[i][0] for i in wanted)
    assert np.mean([found[i] == wanted[i] for i in wanted]) > 0.97


def test_stopping_at_the_full_radius_misses_nothing(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "RECALL", 2.0)
    rows = clustered(2, 40, 6)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multiindex.near_duplicates(table(spark, rows)).collect()}
    assert found == brute(rows)


def test_a_tight_hot_group_leaves_the_looser_pairs_of_others(spark):
    rnd = np.random.default_rng(5)
    hot = rnd.normal(size=16)
    rows = [hot + rnd.normal(size=16) * 0.001 for _ in range(500)]
    for _ in range(500):
        base = rnd.normal(size=16)
        rows += [base, base + rnd.normal(size=16) * 0.25]
    rows = list(enumerate(r.astype(np.float32).tolist() for r in rows))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multiindex.near_duplicates(table(spark, rows)).collect()}
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = x @ x.T >= 0.95
    assert [found[i][0] for i in range(len(rows))] == (close.sum(1) - 1).tolist()
    assert all(found[i][1] == 0 for i in range(500)) and 100 < sum(close[i, i + 1] for i in range(500, 1500, 2)) < 500
    assert all(found[i + 1][2] != close[i, i + 1] for i in range(500, 1500, 2) if close[i + 1].sum() <= 2)


def test_cells_come_by_rising_cost():
    index = multiindex.MultiIndex((np.zeros((4, 1)), np.zeros((4, 1))), 0.95, 9.0)
    rnd = np.random.default_rng(3)
    a, b = rnd.random(4), rnd.random(4)
    cells = list(index.visits(a, b))
    costs = [a[i] + b[j] for i, j in cells]
    assert len(set(cells)) == 16 and costs == sorted(costs)


def test_edges(spark):
    rows = [(1, [1, 0, 0]), (2, [2, 0, 0]), (3, [1, 0, 0]), (4, None), (5, [0, 0, 0]), (6, [float("nan"), 1, 0]), (7, [float("inf"), 1, 0]), (8, [None, 1, 0]), (9, []), (10, [1, 0]), (None, [1, 0, 0]), (11, [0, 1, 0]), (3, [1, 0, 0])]
    found = multiindex.near_duplicates(table(spark, rows)).collect()
    assert len(found) == len(rows)
    links = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in found if r.vec_id)
    assert [x for x in links if x[0] in (1, 2, 3)] == [(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (3, 3, 1, False)]
    assert all(x[1:] == (0, x[0], True) for x in links if x[0] not in (1, 2, 3))
    assert [(r.n_links, r.component_id) for r in found if r.vec_id is None] == [(0, None)]
    assert multiindex.near_duplicates(table(spark, [])).count() == 0
    assert multiindex.near_duplicates(table(spark, [(1, None)])).count() == 1


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.QUERIES["op8_multi_index"](spark, sf).collect()}
    assert found == brute(rows)

"""Embedding near-dedup against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from lakeloom.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, node int, cell string, weight int, id int, x int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, "c", 2, 3, 4) for i, v, g in rows], SCHEMA)


def brute(rows, similarity=ed.SIMILARITY):
    """{position: (n_links, component)} of (id, vector, label)."""
    units = []
    for _, v, g in rows:
        x = None if v is None or g is None or any(y is None for y in v) else np.array(v, np.float32).astype(float)
        units.append(x / np.linalg.norm(x) if x is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    links = [
        [j for j, y in enumerate(units) if j != i and x is not None and y is not None and rows[i][2] == rows[j][2] and len(x) == len(y) and x @ y >= similarity]
        for i, x in enumerate(units)
    ]
    out = []
    for i in range(len(rows)):
        seen, edge = {i}, [i]
        while edge:
            edge = [j for k in edge for j in links[k] if j not in seen and not seen.add(j)]
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((rows[i][0], len(links[i]), min(ids) if ids else None))
    return out


def result(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def expected(rows):
    return sorted(((i, n, c, i == c) for i, n, c in brute(rows)), key=repr)


def noisy(rng, centre, n, spread):
    return centre + rng.normal(size=(n, len(centre))) * spread / np.sqrt(len(centre))


def test_all_pairs_on_random_groups(spark):
    rng = np.random.default_rng(5)
    rows = []
    for label in range(3):
        vectors = [rng.normal(size=(150, 16))]
        vectors += [noisy(rng, rng.normal(size=16) * 4, n, spread) for n, spread in ((40, 1.0), (25, 1.4), (2, 0.5), (10, 1.2))]
        rows += [(0, v.tolist(), label) for v in np.concatenate(vectors)]
    rows = [(i, v, g) for i, (_, v, g) in enumerate(rows)]
    found, want = result(ed.label(table(spark, rows))), expected(rows)
    exact = {w[0]: w for w in want}
    assert sum(f[1] for f in found) >= 0.97 * sum(w[1] for w in want)
    assert all(f[1] <= exact[f[0]][1] for f in found)
    assert sum(f[2] == exact[f[0]][2] for f in found) >= 0.98 * len(found)


def test_shards_split_and_dense_shards_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ed, "SHARD", 60)
    monkeypatch.setattr(ed, "TARGET", 30)
    monkeypatch.setattr(ed, "BLOCK", 40)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16) * 4
    # A tight group that is a ball, a wide one whose members stand around it, and others.
    vectors = np.concatenate([noisy(rng, centre, 150, 0.4), noisy(rng, centre, 60, 1.9), rng.normal(size=(200, 16))])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    _, nodes = ed.prepared(table(spark, rows), "vec_id", "embedding", "label")
    _, dense = ed.shards(nodes)
    assert dense.count() > 100
    found, want = result(ed.label(table(spark, rows))), expected(rows)
    exact = {w[0]: w for w in want}
    assert all(f[1] <= exact[f[0]][1] for f in found)
    assert sum(f[1] for f in found) >= 0.97 * sum(w[1] for w in want)
    assert {f[2] for f in found if f[0] < 150} == {exact[0][2]}


def test_messy_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 1),
        (11, [1.0, 0.0, 0.0], 1), (12, [1e-30, 0.0], 1), (13, [3e38, 3e38], 1), (14, [1.0, 1.0], 1), (15, [-1.0, 0.0], 1), (16, [-0.0, 1.0], 2),
    ]
    assert result(ed.label(table(spark, rows))) == expected(rows)
    assert result(ed.label(table(spark, []))) == []


def test_recall_sees_what_is_missing(spark):
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(noisy(rng, rng.normal(size=16) * 4, 50, 0.5))]
    _, nodes = ed.prepared(table(spark, rows), "vec_id", "embedding", "label")
    found = ed.links(nodes)
    assert ed.recall(nodes, found) == 1
    assert ed.recall(nodes, found.where("node % 2 = 0 and false")) == 0


def test_graph_is_reachable_and_pruned():
    rng = np.random.default_rng(8)
    vectors = np.concatenate([rng.normal(size=(300, 24)), noisy(rng, rng.normal(size=24) * 4, 80, 0.5)])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    graph = ed.flat_graph(vectors)
    seen = set(ed.medoids(vectors).tolist())
    edge = list(seen)
    while edge:
        edge = [int(j) for i in edge for j in graph[i] if j not in seen and not seen.add(int(j))]
    assert len(seen) == len(vectors)
    assert np.mean([len(x) for x in graph]) < 2 * ed.DEGREE
    kept = ed.robust_pruned(vectors, 0, np.arange(len(vectors)))
    angle = lambda a, b: np.arccos(np.clip(vectors[a] @ vectors[b], -1, 1))
    assert all(ed.SLACK * angle(a, b) > angle(0, b) for i, b in enumerate(kept) for a in kept[:i])


@pytest.mark.parametrize("name", ["sf0.001"])
def test_all_rows_of_the_table(spark, name):
    df = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert result(ed.label(df)) == expected(rows)

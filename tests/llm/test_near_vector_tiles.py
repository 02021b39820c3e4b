"""Graphs as tables of nodes, and searches dealt over shards and blocks of queries."""

import numpy as np

from tablewright.llm import neighbors


def test_graph_comes_back_from_its_links():
    x = np.random.default_rng(6).normal(size=(700, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = neighbors.Graph(x)
    links, ends = [], []
    for lo in range(0, len(x), 150):
        part, end = graph.adjacency(lo, min(len(x), lo + 150))
        ends.append(end + sum(len(p) for p in links))
        links.append(part)
    again = neighbors.Graph.of_links(x[graph.order], np.concatenate(links), np.concatenate(ends))
    assert again.sizes == graph.sizes and len(graph.sizes) > 1
    assert all((a == b).all() for a, b in zip(graph.links, again.links, strict=True))


def test_doubles_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "ASKED", 40)
    monkeypatch.setattr(neighbors, "TASKS", 7)
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=(100, 12)), rng.normal(size=12) + rng.normal(size=(100, 12)) * 0.05])
    # a pair whose cosine is below the threshold by less than single precision shows
    angle = np.arccos(0.95) + 1e-9
    pair = [[1.0, 0.0, 0.0], [float(np.cos(angle)), float(np.sin(angle)), 0.0]]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(200 + i, v) for i, v in enumerate(pair)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in neighbors.near_duplicates(frame).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    assert [got[i][0] for i in range(200)] == (near.sum(1) - 1).tolist()
    assert got[200] == (0, 200) and got[201] == (0, 201)

"""Dense groups inside one graph: exact, and in time."""

import time

import numpy as np

from barsignal.llm import embedding_dedup, hnsw


def unit(x):
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_dense_groups_are_found_whole_and_isolated_pairs_beside_them():
    rng = np.random.default_rng(2)
    for dense in (0, 250, 1000, 2000):
        loose = unit(rng.normal(size=(2000 - dense, 64)))
        group = unit(rng.normal(size=64) + rng.normal(0, 0.01, (dense, 64)))
        pairs = unit(loose[:200] + rng.normal(0, 0.005, (len(loose[:200]), 64)))
        x = np.concatenate([loose, group, pairs])
        x = x[rng.permutation(len(x))]
        graph = hnsw.Graph(x)
        began = time.time()
        rows, points = graph.within(x, 0.98, embedding_dedup.BEAM)
        taken = time.time() - began
        want = np.argwhere(x @ x.T >= 0.98)
        got = set(zip(rows.tolist(), points.tolist(), strict=True))
        assert len(got) == len(rows) and got <= set(map(tuple, want.tolist()))
        few = np.bincount(want[:, 0], minlength=len(x)) < 5
        assert sum(few[r] for r in rows) >= 0.99 * few[want[:, 0]].sum()
        assert len(got) >= 0.999 * len(want)
        assert taken < 20


def test_small_and_empty_graphs_are_exact():
    rng = np.random.default_rng(4)
    none = np.zeros((0, 8), np.float32)
    for n in (1, 2, 17):
        x = unit(rng.normal(size=(n, 8)))
        rows, points = hnsw.Graph(x).within(x, 0.3, 64)
        assert sorted(zip(rows.tolist(), points.tolist(), strict=True)) == sorted(map(tuple, np.argwhere(x @ x.T >= 0.3).tolist()))
        assert len(hnsw.Graph(x).within(none, 0.3, 64)[0]) == len(hnsw.Graph(none).within(x, 0.3, 64)[0]) == 0

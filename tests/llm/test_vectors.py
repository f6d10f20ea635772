from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from lexmill.llm import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, n int"


def brute(rows, threshold=near_vectors.THRESHOLD):
    """(links, component) per vec_id."""
    good = [(k, np.array(v, float), y) for k, v, y in rows
            if y is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = defaultdict(set)
    for i, (k, v, y) in enumerate(good):
        for m, w, z in good[i + 1:]:
            if y == z and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                links[k].add(m), links[m].add(k)
    root = {}
    for k, *_ in sorted(rows, key=lambda r: r[0]):
        todo = [k]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = k
                todo += links[x]
    return {k: (len(links[k]), root[k]) for k, *_ in rows}


def run(spark, rows):
    out = near_vectors.near_vectors(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}


def planted(n, cosine, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = r.normal(size=(n, 32))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine ** 2) * z


def test_finds_links_next_to_the_threshold(spark):
    x, y = planted(300, 0.9805)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(np.concatenate([x, y]))]
    want, got = brute(rows), run(spark, rows)
    total = sum(n for n, _ in want.values())
    assert total >= 598
    assert sum(got[k][0] for k in got) >= 0.9 * total
    assert all(got[k][0] <= want[k][0] for k in got)


def test_odd_vectors_labels_copies_and_scale(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
            (6, [], 1), (7, [0.0, 0.0], 1), (8, [float("nan"), 1.0], 1), (9, [float("inf"), 1.0], 1), (10, [None, 1.0], 1),
            (11, [-1.0, 0.0], 1), (12, [1.0, 0.0, 0.0], 1), (13, [1e30, 1e28], 1), (14, [1.0, 0.0], None), (15, [5.0], 1), (16, [7.0], 1)]
    want, got = brute(rows), run(spark, rows)
    assert {k: v[:2] for k, v in got.items()} == want
    assert all(v[2] == (v[1] == k) for k, v in got.items())


def test_a_group_larger_than_a_block_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    r = np.random.default_rng(3)
    base = r.normal(size=32)
    rows = [(i, (base + r.normal(size=32) * 0.02).tolist(), 0) for i in range(100)]
    rows += [(100 + i, base.tolist(), 0) for i in range(20)] + [(200 + i, r.normal(size=32).tolist(), 0) for i in range(50)]
    rows = [(k, np.float32(v).tolist(), y) for k, v, y in rows]
    assert {k: v[:2] for k, v in run(spark, rows).items()} == brute(rows)


@pytest.mark.parametrize("size", [3, 64])
def test_a_third_of_the_rows_in_one_group_and_the_whole_sample_for_pivots(spark, monkeypatch, size):
    monkeypatch.setattr(near_vectors, "n_pivots", lambda n: near_vectors.MOST_PIVOTS)
    r = np.random.default_rng(5)
    base, noise = r.normal(size=(2, 1, size)), r.normal(size=(200, size))
    base /= np.linalg.norm(base, axis=-1, keepdims=True)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    vectors = np.concatenate([base[0] + 0.125 * noise, r.normal(size=(400, size))])
    rows = [(i, np.float32(v).tolist(), 0) for i, v in enumerate(vectors)]
    want, got = brute(rows), run(spark, rows)
    total = sum(want[k][0] for k in range(200))
    assert total >= 10_000
    assert sum(got[k][0] for k in range(200)) >= 0.999 * total
    assert all(got[k][0] <= want[k][0] for k in got)


@pytest.mark.parametrize("common", [0.0, 0.8, 0.9, 0.95])
@pytest.mark.parametrize("size", [16, 64])
def test_pivots_of_vectors_with_a_common_direction(common, size):
    """Recall of planted pairs, and the share of all pairs that the shared pivots make candidates, off the centre and in it. At 0.95 most pairs are nearly links."""
    r = np.random.default_rng(7)
    x = near_vectors.unit(r.normal(size=(2000, size)))
    x = math.sqrt(1 - common) * x
    x[:, 0] += math.sqrt(common)
    x = near_vectors.unit(x)
    z = near_vectors.unit(r.normal(size=x.shape))
    z = near_vectors.unit(z - (z * x).sum(1, keepdims=True) * x)
    y = 0.9805 * x + math.sqrt(1 - 0.9805 ** 2) * z
    vectors = np.concatenate([x, y])
    index = near_vectors.fit(vectors[r.permutation(len(vectors))], near_vectors.n_pivots(len(vectors)), near_vectors.THRESHOLD)
    seen = near_vectors.nearest_pivots(vectors, index.mean, index.pivots, index.nearest)
    held = np.zeros((len(vectors), len(index.pivots)), np.float32)
    held[np.arange(len(vectors))[:, None], seen] = 1
    candidate = held @ held.T >= index.shared
    assert candidate[np.arange(2000), np.arange(2000, 4000)].mean() >= 0.99
    if common < 0.95:
        assert candidate.mean() <= 0.1


def test_an_empty_table(spark):
    assert run(spark, []) == {}

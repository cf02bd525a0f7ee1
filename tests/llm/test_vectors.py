"""Near-duplicate vectors against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tallyshelf.llm import embedding_codes, shared


def by_hand(rows, threshold):
    good = {}
    for n, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            good[n] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    links, root = Counter(), list(range(len(rows)))
    for i in good:
        for j in good:
            if i < j and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for r, (i, _) in zip(root, rows):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return Counter((i, links[n], least.get(root[n]), least.get(root[n]) == i) for n, (i, _) in enumerate(rows))


def vectors(dims):
    rng = np.random.default_rng(3)
    rows = [(n, rng.standard_normal(dims).tolist()) for n in range(120)]
    for n in range(10):
        centre = rng.standard_normal(dims)
        for k in range(12):
            x = centre + rng.standard_normal(dims) * np.linalg.norm(centre) / np.sqrt(dims) * 0.12 * k / 12
            rows.append((1000 + 20 * n + k, (x * rng.uniform(0.1, 9)).tolist()))
    rows += [(3000 + k, rows[130][1]) for k in range(6)] + [(130, rows[130][1]), (None, rows[150][1])]
    rows += [(4000, None), (4001, []), (4002, [0.0] * dims), (4003, [None] + [1.0] * (dims - 1)), (4004, [float("nan")] * dims)]
    rows += [(4005, [float("inf")] + [1.0] * (dims - 1)), (4006, [1.0]), (4007, [2.0]), (4008, [1e300] * dims), (4009, [1e-300] * dims)]
    return rows


@pytest.mark.parametrize("dims, block", [(64, 2048), (64, 4), (7, 2048)])
def test_links_and_components(spark, dims, block):
    shared.ready(spark)
    rows = vectors(dims)
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, vector string, node int")
    settings = embedding_codes.Settings(block=block, missed=1e-5, bucket=16 if block > 4 else 128)
    found = embedding_codes.near_duplicates(frame, settings).collect()
    assert Counter(tuple(r) for r in found) == by_hand(rows, 0.95)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    errors = []
    for seed in range(20):
        code, factor, level, low, step = embedding_codes.encode(x, seed)
        signs = np.unpackbits(code, axis=1, count=64) * 2.0 - 1
        turned = np.stack((level >> 4, level & 15), axis=2).reshape(300, -1) * step[:, None] + low[:, None]
        estimate = signs @ turned.T / (8 * factor[:, None])
        errors.append((estimate - x @ x.T)[np.triu_indices(300, 1)])
    errors = np.concatenate(errors)
    assert abs(errors.mean()) < 0.01 and np.abs(errors).max() < 0.6


def test_empty_table(spark):
    shared.ready(spark)
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_codes.near_duplicates(frame).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    shared.ready(spark)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    frame = spark.createDataFrame(edges[::-1] + edges[:5], "u long, v long")
    found = {r["node"]: r["root"] for r in shared.components(frame, shared.Scratch(spark, "test")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200, 202: 200}

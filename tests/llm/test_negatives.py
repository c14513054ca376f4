"""Cover trees and hard negatives against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sharedsignal.llm import covertree


def brute(rows, anchors, positives=5, negatives=5, low=80, high=100):
    """rows: (id, label, tuple of ints), distinct."""
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, label, v in anchors:
        known = [(-dot(v, w), j, m) for j, m, w in rows if len(w) == len(v)]
        own = sorted((s, j) for s, j, m in known if m == label and j != i)[:positives]
        for s, j in own:
            near = sorted((t, k) for t, k, m in known if m != label and low * -s <= 100 * -t <= high * -s)[:negatives]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(near, 1)]
    return sorted(out)


def cloud(rng, n, dim, copies):
    points = rng.integers(-90, 90, (n, dim))
    points[rng.random(n) < copies] = points[0]
    points[rng.random(n) < 0.2] += rng.integers(-2, 3, dim)
    points[rng.random(n) < 0.1] = 0
    return points


@pytest.mark.parametrize("n,dim,copies", [(1, 3, 0), (700, 2, 0.1), (900, 16, 0.4), (300, 64, 0), (50, 4, 1.0), (20, 0, 0)])
def test_search_equals_all_products(rng, n, dim, copies):
    points, ids = cloud(rng, n, dim, copies).astype(np.int64), rng.permutation(n)
    tree = covertree.CoverTree.build(ids, points)
    by_id = points[np.argsort(ids)]
    assert (tree.points == by_id[tree.ids]).all() and sorted(tree.ids) == list(range(n))
    for k in range(25):
        q = points[rng.integers(n)] if k % 2 else rng.integers(-90, 90, dim)
        scores = by_id @ q
        low, high = sorted(rng.choice(np.append(scores, [0, 10 ** 6]), 2).tolist())
        w, top = covertree.Window5(low, high, 5), covertree.Window5(-(1 << 63), (1 << 63) - 1, 5)
        tree.search(q, [w, top], 3)
        order = [i for i in np.lexsort((np.arange(n), -scores)) if i != 3]
        assert top.ids.tolist() == order[:5]
        assert w.ids.tolist() == [i for i in order if low <= scores[i] <= high][:5]


def test_tree_covers_and_separates(rng):
    points = cloud(rng, 400, 8, 0.05)
    tree = covertree.CoverTree.build(np.arange(400), points.astype(np.int64))
    norms = (tree.points.astype(float) ** 2).sum(1)
    lifted = np.column_stack([tree.points, np.sqrt(norms.max() - norms)])
    for k in range(len(tree.lo)):
        away = np.sqrt(((lifted[tree.lo[k]:tree.hi[k]] - lifted[tree.lo[k]]) ** 2).sum(1))
        assert away.max() <= tree.radius[k] + 1e-9
        below = range(tree.child[k], tree.child[k] + tree.children[k])
        if len(below):
            assert [tree.lo[c] for c in below] == [tree.lo[k], *[tree.hi[c] for c in below][:-1]] and tree.hi[below[-1]] == tree.hi[k]
            assert all(tree.radius[c] <= tree.radius[k] / 2 * (1 + 1e-9) for c in below)
            centres = lifted[[tree.lo[c] for c in below]]
            gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))[np.triu_indices(len(centres), 1)]
            assert gaps.min(initial=math.inf) > tree.radius[k] / 2 * (1 - 1e-9)


def test_tight_clusters_are_skipped(rng):
    centres = rng.integers(-2000, 2000, (40, 16))
    points = np.repeat(centres, 50, 0) + rng.integers(-3, 4, (2000, 16))
    tree = covertree.CoverTree.build(np.arange(2000), points.astype(np.int64))
    seen = [tree.search(points[k], [covertree.Window5(-(1 << 63), (1 << 63) - 1, 5)]) for k in range(0, 2000, 100)]
    assert np.mean(seen) < 400  # of 2,000 points


def test_rows_beyond_exact_doubles():
    points = np.array([[(1 << 30) + 1, 1], [(1 << 30) + 1, 0], [-(1 << 30), 3]] * 5, np.int64)
    tree = covertree.CoverTree.build(np.arange(15), points)
    w = covertree.Window5(-(1 << 63), (1 << 63) - 1, 5)
    tree.search(points[0], [w])
    assert w.ids.tolist() == [0, 3, 6, 9, 12] and w.score[0] == ((1 << 30) + 1) ** 2 + 1


@pytest.mark.parametrize("shard,block", [(4096, 16384), (30, 4)])
def test_mining_equals_brute_force(spark, rng, shard, block):
    points = cloud(rng, 260, 6, 0.2)
    rows = [(int(i), int(rng.integers(0, 4)) if i > 30 else 0, tuple(int(x) for x in p)) for i, p in enumerate(points)]
    rows += [(5, 3, (1, 2, 3, 4, 5, 6)), (6, 1, (7, 8)), (10, 1, (9, 9)), (11, 2, (8, 9)), (12, 1, (9, 8)), (13, 1, ())]  # shared ids, other lengths
    frame = spark.createDataFrame([(*r[:2], list(r[2])) for r in [*rows, rows[0], rows[-1]]], "id bigint, label bigint, vec array<bigint>")
    asked = [r for r in rows if r[0] % 10 == 0]
    found = covertree.mine(frame.distinct(), frame.filter("id % 10 = 0"), shard=shard, block=block)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, asked)


def test_rows_that_take_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001], 1), (1, [0.5, -0.001], 1), (2, None, 1), (3, [0.5, None], 1), (4, [nan, 0.0], 1), (5, [inf, 0.0], 1),
            (None, [1.0, 1.0], 1), (6, [1.0, 1.0], None), (7, [], 2), (8, [1e30, 0.0], 1)]
    frame = spark.createDataFrame([(*r, "x", [1]) for r in rows], "vec_id bigint, e array<float>, label int, id string, vec array<int>")
    found = covertree.integer_rows(frame, "vec_id", "e", "label").collect()
    assert sorted((r.id, r.label, r.vec) for r in found) == [(1, 1, [128, -1]), (7, 2, [])]


def test_empty_tables_and_no_anchor(spark):
    empty = spark.createDataFrame([], "id bigint, label bigint, vec array<bigint>")
    some = spark.createDataFrame([(1, 1, [1, 2]), (2, 1, [1, 2])], empty.schema)
    assert covertree.mine(empty, empty).count() == 0
    assert covertree.mine(some, empty).count() == 0
    assert covertree.mine(some, some.filter(F.col("id") == 1)).count() == 0

"""Hard negatives against all scores."""

import math

import numpy as np
import pytest

from viewloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, gid long, hash string, v int, norm double, cell int"


def plain(rows, every=50, positives=5, worse=3, low=50, high=95):
    good = []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(y is None or not math.isfinite(y) for y in x):
            continue
        good.append((i, [math.floor(256 * float(np.float32(y))) for y in x], label))
    out = []
    for n, (i, x, label) in enumerate(good):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for m, (j, y, other) in enumerate(good) if m != n and len(x) == len(y))
        for s, j, _ in [r for r in scored if r[2] == label][:positives]:
            found = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:worse]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(found, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "h", 2, 0.5, 3) for r in rows], SCHEMA).repartition(4)


def clustered(seed, n=400, dims=6):
    """Clusters, equal vectors, equal scores, one frequent vector, nulls, and two lengths."""
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(8, dims))
    rows = []
    for i in range(n):
        x = middles[rng.integers(8)] + 0.2 * rng.normal(size=dims)
        if i % 3 == 0:
            x = middles[0]
        if i % 7 == 1:
            x = np.round(x)
        rows.append((i, x.tolist(), int(rng.integers(4))))
    rows += [(i, r[1], r[2]) for i, r in zip(range(n, n + 30), rows)] + rows[:12] + [(50, rows[9][1], 3), (100, rows[100][1], 9)]
    rows += [(n + 50 + i, rng.normal(size=3).tolist(), i % 2) for i in range(101)]
    none = [(None, [1.0] * dims, 1), (700, None, 1), (750, [1.0] * dims, None), (800, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (850, [float("nan")] * dims, 1), (900, [float("inf")] * dims, 1)]
    return [*rows, *none, (950, [0.0] * dims, 2), (951, [0.0] * dims, 1), (952, [0.0] * dims, 2), (1000, [], 1), (1001, [], 1), (1002, [], 2)]


@pytest.mark.parametrize("seed, shard_rows, every", [(1, 16_384, 50), (2, 24, 10)])
def test_hard_negatives(spark, monkeypatch, seed, shard_rows, every):
    monkeypatch.setattr(negatives, "BLOCK_ASKS", 30)
    rows = clustered(seed)
    found = negatives.hard_negatives(table(spark, rows), every=every, shard_rows=shard_rows)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, every)


def test_empty_and_too_long(spark):
    assert negatives.hard_negatives(table(spark, clustered(1)).limit(0)).collect() == []
    nothing = [(None, None, None), (50, None, 1)]
    assert negatives.hard_negatives(table(spark, nothing)).collect() == []
    with pytest.raises(ArithmeticError):
        negatives.hard_negatives(table(spark, [(50, [1e30, 1.0], 1)]))


@pytest.mark.parametrize("leaf_rows, same, scale", [(4, True, 1), (16, False, 1), (16, False, 1 << 22)])
def test_shards_find_all(leaf_rows, same, scale):
    rng = np.random.default_rng(leaf_rows)
    x = rng.integers(-40, 40, (300, 5)) * scale
    x[:60] = x[0]
    labels = rng.integers(0, 3, 300)
    shard = negatives.Shard.load(negatives.Shard.build(x, labels, [[i, 1000 + i] for i in range(300)], leaf_rows).dump())
    queries, own = x[::9], labels[::9]
    query = np.repeat(np.arange(len(queries)), 2)
    top = queries.astype(object) @ x.T.astype(object)
    low = np.array([int(np.percentile([int(s) for s in row], p)) for row in top for p in (0, 40)])
    high = np.array([int(max(row)) // (1 + i) for row in top for i in (0, 1)])
    ask, score, ids = shard.search(queries, own, query, low, high, 4, same)
    for a in range(len(query)):
        row = top[query[a]]
        right = sorted((-int(row[j]), i) for j in range(300) for i in (j, 1000 + j) if low[a] <= row[j] <= high[a] and (labels[j] == own[query[a]]) == same)[:4]
        assert [(-s, i) for s, i in zip(score[ask == a].tolist(), ids[ask == a].tolist())] == right


def test_trees_prune_clusters():
    """Leaves that cannot meet the window are not scored."""
    rng = np.random.default_rng(0)
    middles = rng.normal(size=(16, 8)) * 1000
    x = (middles[rng.integers(0, 16, 4000)] + rng.normal(size=(4000, 8))).astype(np.int64)
    tree = negatives.Tree.build(x.astype(float), float((x * x).sum(axis=1).max()), 64)
    least, most = tree.bounds(x[:20].astype(float))
    scores = x[:20] @ x.T
    for i, leaf in enumerate(tree.leaves.tolist()):
        s = scores[:, tree.order[tree.start[leaf] : tree.end[leaf]]]
        assert (s.max(axis=1) <= most[:, i]).all() and (s.min(axis=1) >= least[:, i]).all()
    best = np.sort(scores, axis=1)[:, -5]
    assert (most >= best[:, None]).mean() < 0.35

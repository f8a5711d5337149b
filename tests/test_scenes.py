"""Retrieval kernels and guarded tracks against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewloom.functions import geometry as geo
from viewloom.operators import canonical, flows, footprints, fusion, graphs, kernels, refine, retrieval, spectral, tiling, tracks
from viewloom.sources import files
from viewloom.sources.shared import sums_before


def features(spark, n=90, dims=70, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i // 7, i, np.round(rng.normal(size=dims), 3).tolist()) for i in range(n)]
    rows += [(40, 200, rows[0][2]), (40, 201, rows[0][2])]
    return rows, spark.createDataFrame(rows, "image_id long, id long, v array<double>").repartition(3)


def plain_nearest(x, book, k):
    d = [(sum((a - b) ** 2 for a, b in zip(x, v)), w) for w, v in book]
    return [w for _, w in sorted(d)[:k]]


@pytest.mark.parametrize("limit", [0, kernels.BROADCAST])
def test_codebook_and_signatures(spark, monkeypatch, limit):
    monkeypatch.setattr(kernels, "BROADCAST", limit)
    monkeypatch.setattr(kernels, "HELD", 300)
    rows, df = features(spark)
    book = [(w, rows[w * 9][2]) for w in range(8)] + [(99, [50.0] * 70)]
    start = spark.createDataFrame(book, "word long, v array<double>")
    for _ in range(2):
        members = {w: [x for _, _, x in rows if plain_nearest(x, book, 1) == [w]] for w, _ in book}
        book = [(w, np.mean(members[w], axis=0).tolist() if members[w] else v) for w, v in book]
    found = {r.word: r for r in kernels.train_codebook(df, start, 2).collect()}
    assert {w: r.n for w, r in found.items()} == {w: len(m) for w, m in members.items()} and found[99].n == 0
    for w, v in book:
        assert np.allclose(found[w].v, v, atol=1e-12)
    trained = spark.createDataFrame(book, "word long, v array<double>")
    signed, expected = kernels.image_words(df, trained, 3), {}
    for image, _, x in rows:
        for w in plain_nearest(x, book, 3):
            n, r = expected.get((image, w), (0, np.zeros(70)))
            expected[image, w] = n + 1, r + np.array(x) - np.array(dict(book)[w])
    bits = lambda r: "".join("1" if x > 1e-9 else "0" for x in r)
    got = {(r.image_id, r.word): (r.n, r.s) for r in signed.withColumn("s", F.concat(F.lpad(F.bin(F.col("bits")[0]), 64, "0"), F.lpad(F.bin(F.col("bits")[1]), 6, "0"))).collect()}
    assert got == {k: (n, bits(r)) for k, (n, r) in expected.items()}


def test_words_are_found_and_added_up_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(kernels, "SENT", 2, raising=False)
    rows, df = features(spark)
    start = spark.createDataFrame([(w, rows[w * 9][2]) for w in range(8)], "word long, v array<double>")
    plan = kernels.image_words(df, start, 3)._jdf.queryExecution().optimizedPlan().toString()
    # one of Python for words and sums, one where sums of a key meet
    assert plan.count("MapInArrow") == 2
    keys = ["word", "image_id"]
    one, two = ({tuple(r[k] for k in keys): (r.n, r.total) for r in d.collect()} for d in (kernels.nearest_sums(df, start, keys, 3), kernels.vector_sums(kernels.nearest_words(df, start, 3), keys)))
    assert one.keys() == two.keys() and sum(n for n, _ in one.values()) == 3 * len(rows)
    assert all(one[k][0] == two[k][0] and np.allclose(one[k][1], two[k][1]) for k in one)


def test_kernel_scores(spark):
    rows = [(i, w, [i * 37 % 251 << 20, w * i], 128) for i in range(12) for w in range(4) if (i + w) % 3]
    words = spark.createDataFrame(rows, "image_id long, word long, bits array<long>, dims int")
    score, size = {}, {}
    for i, w, x, _ in rows:
        size[i] = size.get(i, 0) + 1
        for j, u, y, _ in rows:
            sim = 1 - 2 * sum((a ^ b).bit_count() for a, b in zip(x, y)) / 128
            if w == u and sim > 0.2:
                score[i, j] = score.get((i, j), 0) + sim**3
    for posting in (2, 4096):
        got = {(r.i, r.j): r.s for r in kernels.kernel_scores(words, words, threshold=0.2, posting=posting).collect()}
        assert got.keys() == score.keys()
        assert all(math.isclose(got[i, j], s / math.sqrt(size[i] * size[j])) for (i, j), s in score.items())


def test_first_words_and_empty(spark):
    rows, df = features(spark)
    words = kernels.first_words(df, 10).collect()
    assert [r.word for r in words] == list(range(10)) and len({tuple(r.v) for r in words}) == 10
    assert kernels.first_words(df, 500).count() == len({tuple(r[2]) for r in rows})
    none = df.limit(0)
    assert kernels.first_words(none, 3).count() == 0
    start = spark.createDataFrame([(1, [0.0, 1.0])], "word long, v array<double>")
    kept = kernels.train_codebook(none, start).collect()
    assert [(r.word, r.n, r.v) for r in kept] == [(1, 0, [0.0, 1.0])]
    assert kernels.image_words(none, start).count() == 0


def plain_tracks(edges):
    """Edges one by one."""
    canonical = sorted({tuple(sorted(((s, a), (d, b)))) for s, a, d, b in edges})
    track = {v: {v} for e in canonical for v in e}
    for x, y in canonical:
        one, two = track[x], track[y]
        if one is not two and not {i for i, _ in one} & {i for i, _ in two}:
            one |= two
            for v in two:
                track[v] = one
    return sorted((*v, "{:012d}:{:012d}".format(*min(t))) for v, t in track.items())


@pytest.mark.parametrize("seed, group_edges", [(0, 200_000), (1, 40), (2, 9)])
def test_guarded_tracks(spark, seed, group_edges):
    rng = random.Random(seed)
    edges = [(rng.randrange(6), rng.randrange(9), rng.randrange(6), rng.randrange(9)) for _ in range(110)]
    edges += edges[:9] + [(20, 1, 20, 1), (21, 1, 21, 2), (30, 0, 31, 0)]
    df = spark.createDataFrame(edges, "src long, a_kp long, dst long, b_kp long")
    found = sorted(tuple(r) for r in tracks.guarded_tracks(df, group_edges).select("image_id", "kp_id", "track_id").collect())
    assert found == plain_tracks(edges)


def test_guarded_tracks_rounds(spark, monkeypatch):
    """Rounds go with merges, not with edges: 900 edges between 60 keypoints, 15 merging edges at a time."""
    edges = [(i, a, j, b) for i in range(2) for j in range(2, 4) for a in range(15) for b in range(15)]
    folders = []
    kept = tracks.stash
    monkeypatch.setattr(tracks, "stash", lambda df, name: folders.append(name) or kept(df, name))
    df = spark.createDataFrame(edges, "src long, a_kp long, dst long, b_kp long")
    found = sorted(tuple(r) for r in tracks.guarded_tracks(df, 15).select("image_id", "kp_id", "track_id").collect())
    assert found == plain_tracks(edges)
    assert folders.count("merged") <= 4


# --- footprints

def test_footprint_candidates_of_all_sizes(spark):
    """Boxes from tiny to huge, against all pairs."""
    rng = random.Random(5)
    boxes = []
    for i in range(70):
        x, y, w = rng.uniform(-500, 500), rng.uniform(-500, 500), 10 ** rng.uniform(-1, 3)
        boxes.append((i, x, y, x + w, y + w * rng.uniform(0.01, 1)))
    ring = lambda b: [b[1], b[2], b[3], b[2], b[3], b[4], b[1], b[4]]
    df = spark.createDataFrame([(b[0], ring(b), [0.0, 1.0, 0.0, 0.0, 0.0, -1.0]) for b in boxes], "image_id long, ring array<double>, geo array<double>")
    got = sorted(tuple(sorted((r.a.image_id, r.b.image_id))) for r in footprints.footprint_candidates(df).collect())
    share = lambda p, q: max(p[1], q[1]) < min(p[3], q[3]) and max(p[2], q[2]) < min(p[4], q[4])
    assert got == [(p[0], q[0]) for p in boxes for q in boxes if p[0] < q[0] and share(p, q)]


def test_footprint_pairs(spark):
    square = [0.0, 0.0, 4.0, 0.0, 4.0, 4.0, 0.0, 4.0]
    rows = [
        (1, square, [0.0, 1.0, 0.0, 4.0, 0.0, -1.0]),
        (2, [2.0, 2.0, 2.0, 6.0, 6.0, 6.0, 6.0, 2.0, 2.0, 2.0], [2.0, 0.5, 0.0, 6.0, 0.0, -0.5]),  # clockwise and closed
        (3, [4.0, 0.0, 8.0, 0.0, 8.0, 2.0, 4.0, 2.0], [4.0, 1.0, 0.0, 2.0, 0.0, -1.0]),  # touches 1 and 2 only
        (4, [1.0, 1.0, 1.5, 1.0, 1.5, 1.5], [1.0, 0.1, 0.0, 1.5, 0.0, -0.1]),  # inside 1
        (5, [9.0, 9.0, 9.0], None), (6, None, None),
    ]
    found = {(r.src, r.dst): r for r in footprints.footprint_pairs(spark.createDataFrame(rows, "image_id long, ring array<double>, geo array<double>")).collect()}
    assert set(found) == {(1, 2), (2, 1), (1, 4), (4, 1)}
    assert found[1, 2].area == found[2, 1].area == 4.0 and found[1, 4].area == 0.125
    # pixel (u, v) of 1 is at (u, 4 - v); that of 2 at (2 + u / 2, 6 - v / 2)
    assert np.allclose(found[1, 2].m, [2, 0, -4, 0, 2, 4]) and np.allclose(found[2, 1].m, [0.5, 0, 2, 0, 0.5, -2])


# --- depth refinement

@pytest.mark.parametrize("rounds, weighted", [(1, True), (2, False)])
def test_refined_depths(spark, rounds, weighted):
    rng = np.random.default_rng(1)
    w, h, samples, threshold, seed = 5, 4, 6, 1.0, 3
    turn = np.array([[0.8, 0, 0.6], [0, 1, 0], [-0.6, 0, 0.8]])
    cameras = {1: (4.0, 2.0, 1.5, np.eye(3), np.zeros(3)), 2: (4.0, 2.0, 1.5, np.eye(3), np.array([0.5, 0, 0])), 9: (3.0, 2.0, 1.5, turn, np.array([-3.0, 0, 1.0]))}
    maps = {i: {(x, y): (float(5 + rng.random()), float(rng.random())) for x in range(w) for y in range(h) if rng.random() < 0.85} for i in cameras}
    partners = {1: [1, 2, 9], 2: [2, 1], 9: [9, 1]}
    expected = {}
    for i, own in maps.items():
        focal, cx, cy, rotation, t = cameras[i]
        for (x, y), (depth, _) in own.items():
            for r in range(rounds):
                limit, tried = (rounds - r) * threshold, []
                for s in range(samples):
                    noise = refine.normal_noise(np.int64(seed + r), np.int64(i), np.array([y * w + x]), np.array([s]))[0]
                    z = depth + (noise - 1) * limit
                    p = rotation @ np.array([(x - cx) / focal * z, (y - cy) / focal * z, z]) + t
                    total = weight = 0.0
                    for j in partners[i]:
                        f, u0, v0, q, o = cameras[j]
                        c = q.T @ (p - o)
                        at = (round(f * c[0] / c[2] + u0), round(f * c[1] / c[2] + v0))
                        if at in maps[j] and maps[j][at][0] - c[2] >= -limit:
                            k = math.exp(maps[j][at][1]) if weighted else 1.0
                            total, weight = total + k * max(maps[j][at][0] - c[2], -limit), weight + k
                    tried.append((abs(total / weight) if weight else math.inf, s, z))
                if any(d < math.inf for d, *_ in tried) and not all(d == limit for d, *_ in tried):
                    depth = min(tried)[2]
            expected[i, x, y] = depth
    d = spark.createDataFrame([(i, x, y, *v) for i, m in maps.items() for (x, y), v in m.items()], "image_id long, x int, y int, depth double, conf double")
    c = spark.createDataFrame([(i, f, cx, cy, r.ravel().tolist(), t.tolist(), w, h) for i, (f, cx, cy, r, t) in cameras.items()], "image_id long, focal double, cx double, cy double, rotation array<double>, t array<double>, width int, height int")
    pairs = spark.createDataFrame([(1, 2), (9, 1), (2, 1)], "src long, dst long")
    found = {(r.image_id, r.x, r.y): r.depth for r in refine.refined_depths(d, c, pairs, threshold, samples, rounds, weighted, seed).collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[k], v, abs_tol=1e-9) for k, v in expected.items())
    assert refine.refined_depths(d.limit(0), c, pairs, threshold).collect() == []


# --- canonical maps

def test_focal_of_points(spark):
    """Points of a known camera, with a few far off."""
    rows = [(1, x, y, z * (x - 8) / 20.0, z * (y - 6) / 20.0, z) for x in range(16) for y in range(12) for z in (2.0 + (x * y) % 3,)]
    rows += [(1, 3, 4, 2.0, -1.0, 1.0), (1, 9, 2, -1.0, 1.0, 3.0)] + [(2, x, y, 9.0 * (x - 8), 9.0 * (y - 6), 1.0) for x in range(4) for y in range(3)]
    points = spark.createDataFrame(rows, "image_id long, px int, py int, x3 double, y3 double, z3 double")
    cameras = spark.createDataFrame([(1, 8.0, 6.0, 16, 12), (2, 8.0, 6.0, 16, 12)], "image_id long, cx double, cy double, width int, height int")
    found = {r.image_id: r.focal for r in canonical.focal_of_points(points, cameras, 10).collect()}
    assert abs(found[1] - 20) < 0.2 and math.isclose(found[2], 0.5 * 16 / (2 * math.tan(math.radians(30))))


def test_canonical_maps_of_a_plane(spark):
    """All views agree, so canonical depths are theirs, and dense points lie where they were."""
    w, h, stride = 10, 6, 4
    depth = lambda x, y: 5.0 + 0.1 * x + 0.2 * y
    rows = [(i, j, s, x, y, depth(x, y) * (x - 5) / 12.0, depth(x, y) * (y - 3) / 12.0, depth(x, y), 2.0 + s) for i, j in ((1, 2), (3, 1)) for s in (1, 2) for x in range(w) for y in range(h)]
    pairs = spark.createDataFrame(rows, "src long, dst long, side int, px int, py int, x3 double, y3 double, z3 double, conf double")
    views = canonical.exploded_views(pairs)
    assert sorted({(r.image_id, r.other_id) for r in views.collect()}) == [(1, 2), (1, 3), (2, 1), (3, 1)]
    cameras = spark.createDataFrame([(i, 5.0, 3.0, w, h, 12.0, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0], [0.0, 0.0, 0.0]) for i in (1, 2, 3)], "image_id long, cx double, cy double, width int, height int, focal double, rotation array<double>, t array<double>")
    for mode in ("depth", "angle"):
        pixels, anchors = canonical.canonical_maps(views, cameras, stride, mode)
        found = {(r.image_id, r.px, r.py): r for r in pixels.collect()}
        # blocks that are cut before their centre have no anchor
        assert set(found) == {(i, x, y) for i in (1, 2, 3) for x in range(8) for y in range(4)}
        assert all(abs(r.base_focal - 12) < 1e-6 and math.isclose(r.z3, depth(r.px, r.py)) for r in found.values())
        assert sorted((r.image_id, r.anchor) for r in anchors.collect()) == [(i, a) for i in (1, 2, 3) for a in (0, 1)]
        dense = canonical.dense_points(pixels, anchors, cameras).collect()
        assert len(dense) == len(found)
        for r in dense:
            assert math.isclose(r.depth, depth(r.px, r.py), rel_tol=1e-6) and math.isclose(r.wx, r.depth * (r.px - 5) / 12, abs_tol=1e-6)


def test_partner_scores(spark):
    df = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.7), (3, 1, 0.1)], "src long, dst long, score double")
    assert sorted(tuple(r) for r in canonical.partner_scores(df).collect()) == [(1, 2, 0.7, 2), (1, 3, 0.1, 2), (2, 1, 0.7, 1), (3, 1, 0.1, 1)]


# --- coarse to fine

def test_coarse_to_fine(spark):
    """Two crops of either image show the same point; the better match stays."""
    rows = [(10, 1, 2.0, 3.0, [1.0, 0.0], 1.0), (11, 2, 0.0, 1.0, [0.9, 0.1], 1.0), (20, 3, 5.0, 5.0, [2.0, 0.0], 1.0), (21, 4, 7.0, 7.0, [0.0, 3.0], 0.1), (11, 5, 9.0, 9.0, [0.0, 5.0], 1.0)]
    d = spark.createDataFrame(rows, "crop_id long, kp long, u double, v double, vector array<double>, conf double")
    shift = lambda x, y, w=1.0: [1.0, 0.0, x, 0.0, 1.0, y, 0.0, 0.0, w]
    crops = spark.createDataFrame([(10, 1, shift(0.0, 0.0)), (11, 1, shift(2.0, 2.0)), (20, 2, shift(1.0, 1.0)), (21, 2, shift(0.0, 0.0, 0.0))], "crop_id long, image_id long, m array<double>")
    pairs = spark.createDataFrame([(10, 20), (11, 20), (11, 21), (10, 20)], "crop1 long, crop2 long")
    found = [tuple(r) for r in flows.coarse_to_fine(d, crops, pairs, 0.5).collect()]
    assert found == [(1, 2, 2.0, 3.0, 6.0, 6.0, 2.0, 2)]
    everything = flows.coarse_to_fine(d, crops, pairs).collect()
    assert len(everything) == 1, "crop 21 sends its pixels to infinity"


# --- low-rank depths

def test_low_rank_depths(spark):
    """Against pseudo-inverses; smooth maps need few vectors; other targets give other coefficients."""
    rows = [(i, x, y, 4.0 + 0.3 * x + 0.2 * i + 0.05 * x * y) for i in (1, 2) for x in range(7) for y in range(5)] + [(1, 0, 0, None), (3, 2, 2, 5.0), (3, 1, 2, -1.0)]
    rows = [r for r in rows if r[1:3] != (0, 0) or r[3] is not None]
    depths = spark.createDataFrame(rows, "image_id long, x int, y int, depth double")
    cameras = spark.createDataFrame([(i, 7, 6.0, 3.0, 2.0) for i in (1, 2, 3)], "image_id long, width int, focal double, cx double, cy double")
    models = spectral.low_rank_depths(depths, cameras, 10)
    for r in models.collect():
        own = sorted((y * 7 + x, d) for i, x, y, d in rows if i == r.image_id and d is not None and d > 0)
        assert r.pix == [p for p, _ in own] and r.n == len(own) and r.rank == min(10, len(own)) == len(r.coeffs)
        d = np.array([v for _, v in own])
        points = np.column_stack([d * (np.array(r.pix) % 7 - 3) / 6, d * (np.array(r.pix) // 7 - 2) / 6, d])
        w = np.exp(-7 * (np.linalg.norm(points[:, None] - points[None], axis=2) / (d[:, None] + d[None])) ** 2) * (1 - np.eye(len(d)))
        if len(d) > 1:
            root = np.diag(1 / np.sqrt(w.sum(1)))
            first = np.linalg.eigh(root @ (np.diag(w.sum(1)) - w) @ root)[1][:, : r.rank]
            scaled = first * np.maximum(np.abs(np.linalg.pinv(first) @ d), 5.0)
            expected = scaled @ (np.linalg.pinv(scaled) @ d)
            basis = np.array(r.basis).reshape(r.n, r.rank)
            assert np.allclose(basis @ r.coeffs, expected, atol=1e-8) and np.allclose(np.linalg.norm(basis, axis=0), np.linalg.norm(scaled, axis=0), atol=1e-8)
            assert np.abs(expected - d).max() < 0.6
    back = {(r.image_id, r.pix): r.depth for r in spectral.depths_of(models).collect()}
    assert math.isclose(back[3, 16], 5.0) and len(back) == 71
    targets = depths.where("depth > 0").select("image_id", (F.col("y") * 7 + F.col("x")).cast("long").alias("pix"), (2 * F.col("depth")).alias("depth"), F.lit(0.5).alias("weight"))
    steps = {r.image_id: r.coeffs for r in spectral.coefficient_step(models, targets.where("image_id <> 2 OR pix < 5")).collect()}
    one = {r.image_id: r.coeffs for r in models.collect()}
    assert np.allclose(steps[1], 2 * np.array(one[1])) and steps[2] is None and np.allclose(steps[3], 2 * np.array(one[3]))


# --- what was done in one task, whole blocks or nine rows a pixel before

def test_gradient_confidence_in_blocks(spark):
    rng = random.Random(4)
    pixels = {(i, x, y): (rng.random() / 20, 1 + rng.random()) for i in (1, 2) for x in range(-3, 9) for y in range(7) if rng.random() < 0.9}
    df = spark.createDataFrame([(f"n{i}", i, x, y, *v) for (i, x, y), v in pixels.items()], "name string, image_id long, x long, y int, depth double, conf double")
    at = lambda i, x, y: pixels.get((i, x, y), (0.0, 0.0))[0]
    expected = {}
    for (i, x, y), (_, conf) in pixels.items():
        g = [sum(k * (4 if j == 0 else 2) * (at(i, x + k, y + j) if axis == 0 else at(i, x + j, y + k)) for k in (-1, 1) for j in (-1, 0, 1)) for axis in (0, 1)]
        expected[i, x, y] = conf * max(0.0, 1 - math.hypot(*g))
    for block in (1, 3, 256):
        found = fusion.gradient_confidence(df, block)
        assert found.columns == df.columns
        got = {(r.image_id, r.x, r.y): r.conf for r in found.collect()}
        assert got.keys() == expected.keys() and all(math.isclose(got[k], v, abs_tol=1e-12) for k, v in expected.items())


def test_strips_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, k, rng.integers(-3, 4, 3).astype(float).tolist()) for i in (1, 2) for k in range(40)]
    df = spark.createDataFrame(rows, "image_id long, kp long, v array<double>")
    pairs = spark.createDataFrame([(1, 2)], "src long, dst long")
    from viewloom.operators import matching

    for metric in ("dot", "l2"):
        value = lambda x, y: sum(a * b for a, b in zip(x, y)) if metric == "dot" else -math.dist(x, y)  # noqa: B023, E731
        expected = set()
        for own, other, forward in ((1, 2, True), (2, 1, False)):
            for i, k, x in rows:
                if i == own:
                    best = min((round(-value(x, y), 9), m) for j, m, y in rows if j == other)[1]
                    expected.add((k, best, True) if forward else (best, k, False))
        vectors = {(i, k): x for i, k, x in rows}
        for strip in (7, 512):
            monkeypatch.setattr(matching, "STRIP", strip)
            found = matching.nearest_both_ways(df, pairs, metric, block=16).collect()
            assert len(found) == 80
            if metric == "dot":
                assert {(r.a, r.b, r.forward) for r in found} == expected
            for r in found:
                own = vectors[1, r.a] if r.forward else vectors[2, r.b]
                best = max(value(own, vectors[2 if r.forward else 1, k]) for k in range(40))
                assert math.isclose(r.score, best, abs_tol=1e-6) and math.isclose(value(vectors[1, r.a], vectors[2, r.b]), best, abs_tol=1e-6)


def test_sums_before(spark):
    df = spark.createDataFrame([(i * 7 % 50, i) for i in range(50)], "k long, n long")
    got = {r.k: r.before for r in sums_before(df, "n", "k").collect()}
    n = {i * 7 % 50: i for i in range(50)}
    assert got == {k: sum(n[j] for j in range(k)) for k in range(50)}
    assert sums_before(df.limit(0), "n", "k").collect() == []


def test_top_by_norm(spark):
    from viewloom.operators import matching

    df = spark.createDataFrame([(1, 0, [3.0, 4.0]), (1, 1, [0.0, 5.0]), (1, 2, [1.0, 1.0]), (2, 0, [0.0, 0.0])], "image_id long, pos long, feat array<double>")
    assert sorted((r.image_id, r.pos, r.norm, r["rank"]) for r in matching.top_by_norm(df, 2).collect()) == [(1, 0, 5.0, 1), (1, 1, 5.0, 2), (2, 0, 0.0, 1)]


def test_crop_to_size(spark):
    crop = geo.rectified_crop(*[F.lit(v) for v in (100.0, 80.0, 60.0, 100.2, 20.0, 160.0, 58.0)])
    r = spark.range(1).select(crop.alias("c")).select("c", geo.crop_to_size(F.col("c"), F.lit(100.0), F.lit(90), F.lit(90)).alias("s")).first()
    assert (r.s.width, r.s.height) == (90, 90) and math.isclose(r.s.focal, 150.0)
    k = np.array([[100, 0, 80], [0, 100, 60], [0, 0, 1.0]])
    k2 = np.array([[150, 0, 45], [0, 150, 45], [0, 0, 1.0]])
    assert np.allclose(np.array(r.s.m).reshape(3, 3), k @ np.array(r.s.rotation).reshape(3, 3) @ np.linalg.inv(k2))


def test_image_numbers_with_gaps(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big") + b"\x08\0\0\0\0" + b"\0" * 8
    for name, content in (("a.png", png), ("b.png", b"broken"), ("c.png", png), ("notes.txt", b"x")):
        (tmp_path / name).write_bytes(content)
    got = lambda **k: sorted(tuple(r) for r in files.read_images(spark, str(tmp_path), gaps=True, **k).collect())
    assert got() == [("a.png", 7, 5, 0), ("c.png", 7, 5, 2)] and got(suffixes=None) == got()


def test_blocks_bound_copies_and_tasks(spark):
    """A vector is sent to a fixed number of blocks until these are full; every two meet once, in strips."""
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(300)], "id long, v array<double>")

    def sums(a, x, b, y):
        for at in retrieval.in_strips(x, 16):
            yield [len(a)], [(x[at] @ y.T - 1).sum()]

    for size, blocks in ((64, 25), (300, 1), (16384, 1)):
        found = retrieval.in_blocks(rows, sums, "n long, s double", size).collect()
        assert sum(r.s for r in found) == sum(range(300)) ** 2 and len(found) >= max(blocks, 300 // 16)
        assert sum(r.n for r in found) > 0


def test_inverted_file_in_blocks(spark):
    """Words of several blocks and images of several parts add up; no pair of residuals becomes a row."""
    data = [(k % 5, k % 3, [math.sin(k), math.cos(3 * k), 0.1 * (k % 7)]) for k in range(60)]
    words = spark.createDataFrame(data, "image_id long, word long, v array<double>")
    got = {(r.i, r.j): r.s for r in retrieval.inverted_file_scores(words, words, size=4).collect()}
    kernel, own = {}, {}
    for i, w, x in data:
        own[i] = own.get(i, 0.0) + sum(c * c for c in x) ** 3
        for j, u, y in data:
            if w == u:
                kernel[i, j] = kernel.get((i, j), 0.0) + max(0.0, sum(c * d for c, d in zip(x, y))) ** 3
    assert got == pytest.approx({k: s / math.sqrt(own[k[0]] * own[k[1]]) for k, s in kernel.items()})


def test_points_on_a_line_as_the_complete_table(spark):
    """Neighbours, keys and trees of points on a line are those of the table of all distances, which they do not make;
    places with many points, ties on both sides and distances that rounding makes equal among them."""
    xs = [5.0, 1.0, 5.0, 3.0, 7.0, 5.0, 1.0, 5.0, 5.0, 5.0, -0.0, 0.0, 40.0, 39.5, 1e16, 1e16 + 2, 1e16 + 4, -3.0]
    points = spark.createDataFrame([((k * 7) % 19, x) for k, x in enumerate(xs)], "i long, x double")
    coarse = lambda x, y: F.floor(F.abs(x - y) / 4) + 0.5 * F.least(F.abs(x - y), F.lit(1.0))
    other = points.select(F.col("i").alias("j"), F.col("x").alias("y"))
    pairs = lambda d: {tuple(r) for r in d.collect()}
    for metric in (lambda x, y: F.abs(x - y) / 20000, coarse):
        dist = points.crossJoin(other).select("i", "j", metric(F.col("x"), F.col("y")).cast("double").alias("d"))
        for k in (1, 4, 25):
            assert pairs(graphs.knn_edges(graphs.near_on_line(points, k, metric), k)) == pairs(graphs.knn_edges(dist, k))
        assert graphs.farthest_on_line(points, 5, metric) == graphs.farthest_points(dist, 5)
    metric = lambda x, y: F.abs(x - y) / 20000
    near = points.where("x < 1000")
    dist = near.crossJoin(other.where("y < 1000")).select("i", "j", (1 - metric(F.col("x"), F.col("y"))).alias("s"))
    assert graphs.spanning_tree_on_line(near, metric) == graphs.spanning_tree(dist)
    assert pairs(graphs.retrieval_graph_on_line(near, 3, 2, lambda x, y: 1 - (1 - metric(x, y)))) == pairs(graphs.retrieval_graph(dist, 3, 2))
    assert graphs.spanning_tree_on_line(spark.createDataFrame([(0, 0.0), (1, 20000.0)], "i long, x double"), metric) is None


def test_footprints_are_joined_by_key_and_clipped_once(spark):
    """No side of the join goes through the driver, however small the files look, and pairs are clipped once for both ways."""
    rows = spark.createDataFrame([(k, [float(k), 0.0, k + 3.0, 0.0, k + 3.0, 2.0, float(k), 2.0], [float(k), 1.0, 0.0, 2.0, 0.0, -1.0]) for k in range(6)], "image_id long, ring array<double>, geo array<double>")
    found = footprints.footprint_pairs(rows)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("MapInArrow") == 1
    assert {(r.src, r.dst, r.area) for r in found.collect()} == {(a, b, 6.0 - 2 * abs(a - b)) for a in range(6) for b in range(6) if 0 < abs(a - b) < 3}


def test_suppression_reaches_into_few_cells(spark):
    """A point makes four rows, or nine at a cell's edge; the radius itself counts, at cell edges and far out too."""
    rng = random.Random(5)
    points = [(7, k, rng.choice([0.0, 6.0, 12.0, -6.0, 1e9]) + rng.choice([0.0, 3.0, 6.0, 0.5 * rng.random()]), rng.choice([0.0, 6.0, 11.5])) for k in range(60)]
    points.append((8, 0, 0.0, 0.0))
    frame = spark.createDataFrame(points, "image_id long, kp_idx long, x double, y double")
    want = [p for p in points if not any(o[0] == p[0] and o[1] < p[1] and math.hypot(o[2] - p[2], o[3] - p[3]) <= 6 for o in points)]
    kept = tracks.suppress_close(frame, 6.0)
    assert sorted(map(tuple, kept.collect())) == sorted(want)
    assert "- 1)" not in kept._jdf.queryExecution().analyzed().toString()


def test_boxes_of_full_cells_are_dealt(spark):
    """A cell with many boxes is more than one group, with the same pairs."""
    rng = random.Random(2)
    box = lambda k: (k, x := rng.uniform(0, 30), y := rng.uniform(0, 30), x + rng.uniform(0, 20), y + rng.uniform(0, 20))
    names = lambda s: f"{s}_id long, {s}_x0 double, {s}_y0 double, {s}_x1 double, {s}_y1 double"
    a, b = [box(k) for k in range(80)], [box(k) for k in range(40)]
    one, two = spark.createDataFrame(a, names("a")), spark.createDataFrame(b, names("b"))
    pairs = lambda d: sorted((r.a_id, r.b_id) for r in d.collect())
    want = sorted((p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    for most in (1, 7, 8192):
        assert pairs(tiling.box_join(one, two, 16.0, most=most)) == want

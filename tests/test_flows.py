"""Flows, the sparse model and database, losses' edges and crops, against hand-made cases."""

import math
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewloom.functions import geometry as geo
from viewloom.operators import flows, graphs, losses, retrieval, tracks
from viewloom.plans import more
from viewloom.sources import files, model, readers
from viewloom.sources.shared import placed


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_placed(spark):
    d = spark.createDataFrame([(i * 37 % 101, "x") for i in range(101)], "v long, place string")
    assert rows(placed(d, "v", name="n"), "v", "n") == [(i, i) for i in range(101)]
    assert placed(d.limit(0), "v").collect() == []


RAW = [
    (0, 1, 0, 10.0, 10.0, 20.0, 20.0), (1, 2, 1, 20.5, 20.0, 30.0, 30.0), (0, 2, 2, 10.0, 10.0, 30.0, 30.2),
    (0, 1, 3, 50.0, 50.0, 60.0, 60.0), (0, 1, 4, 90.0, 90.0, 20.0, 20.0),
]
MATCHES = "src long, dst long, pos long, x1 double, y1 double, x2 double, y2 double"


def test_format_tracks(spark):
    """A track of three images stays with its keypoints numbered anew; a pair does not, nor a second one of an image."""
    keypoints, pairs = flows.format_tracks(spark.createDataFrame(RAW, MATCHES), least=3, radius=0.1)
    assert rows(keypoints, "image_id", "kp_idx", "x", "y") == [(0, 0, 10.0, 10.0), (1, 0, 20.0, 20.0), (2, 0, 30.0, 30.2)]
    keypoints, pairs = flows.format_tracks(spark.createDataFrame(RAW, MATCHES), least=2, radius=0.1)
    assert rows(pairs, "src", "dst") == [(0, 1), (0, 1), (0, 2), (1, 2), (1, 2)]
    merged = [(*r[:3], *(round(v) for v in r[3:])) for r in RAW]
    keypoints, pairs = flows.format_tracks(spark.createDataFrame([(*r[:3], *map(float, r[3:])) for r in merged], MATCHES), least=3)
    assert rows(keypoints, "image_id", "kp_idx", "x") == [(0, 0, 10.0), (1, 0, 20.0), (2, 0, 30.0)]
    assert rows(pairs, "src", "dst", "kp_idx1", "kp_idx2") == [(0, 1, 0, 0), (0, 2, 0, 0), (1, 2, 0, 0)]


def test_sparse_matching_agrees_with_dense(spark):
    """Seeds on every keypoint converge to pairs that are each other's nearest; a threshold takes uncertain ones out."""
    x = np.random.default_rng(0).normal(size=(2, 64, 8))
    x /= np.linalg.norm(x, axis=2, keepdims=True)
    d = spark.createDataFrame([(i, k, x[i, k].tolist(), float(k % 3)) for i in (0, 1) for k in range(64)], "image_id long, kp long, v array<double>, conf double")
    p = spark.createDataFrame([(0, 1)], "src long, dst long")
    s = x[0] @ x[1].T
    mutual = {(a, int(s[a].argmax())) for a in range(64) if s[:, s[a].argmax()].argmax() == a}
    dense = set(rows(flows.match_pairs(d, p, 0.0, sparse=False), "a", "b"))
    sparse = set(rows(flows.match_pairs(d, p, 0.0, stride=1), "a", "b"))
    assert dense == mutual and sparse == mutual
    sure = set(rows(flows.match_pairs(d, p, 1.0, stride=1), "a", "b"))
    assert sure == {(a, b) for a, b in mutual if a % 3 and b % 3}
    near = set(rows(flows.match_pairs(d, p, 0.0, stride=1, width=8, tolerance=0.5), "a", "b"))
    assert near == mutual


def test_sampled_matches(spark):
    m = spark.createDataFrame([(1, i, 99 - i) for i in range(40)] + [(2, 0, 0)], "pair_id long, pix1 long, pix2 long")
    found = flows.sampled_matches(m, 100, 20, negative=0.5).collect()
    one = [r for r in found if r.pair_id == 1]
    assert len(one) == 20 and sum(r.valid for r in one) == 10 and all((r.pix1 < 40) == r.valid for r in one)
    two = [r for r in found if r.pair_id == 2]
    assert len(two) == 20 and sum(r.valid for r in two) == 1
    few = flows.sampled_matches(m.where("pair_id = 1"), 45, 20, negative=0.5).collect()
    assert len(few) == 20 and sum(not r.valid for r in few) == 5


def test_evenly_spaced(spark):
    d = spark.createDataFrame([(g, i) for g, n in (("a", 11), ("b", 2)) for i in range(n)], "g string, i long")
    found = rows(flows.evenly_spaced(d, 5, ("g",), "i"), "g", "i")
    assert found == [("a", i) for i in np.round(np.linspace(0, 10, 5)).astype(int)] + [("b", i) for i in np.round(np.linspace(0, 1, 5)).astype(int)]


def test_rectified_crop(spark):
    """The corner farthest from the principal point stays, the new middle lies on the rotated axis, and M = K R K2^-1."""
    one = spark.range(1).select(geo.rectified_crop(*[F.lit(v) for v in (100.0, 80.0, 60.0, 100.2, 20.0, 160.0, 58.0)]).alias("c")).first().c
    assert (one.width, one.height) == (60, 38)
    m, r = np.array(one.m).reshape(3, 3), np.array(one.rotation).reshape(3, 3)
    assert np.allclose(r @ r.T, np.eye(3)) and np.isclose(np.linalg.det(r), 1)
    k, k2 = np.array([[100, 0, 80], [0, 100, 60], [0, 0, 1.0]]), np.array([[100, 0, 30], [0, 100, 19], [0, 0, 1.0]])
    assert np.allclose(m, k @ r @ np.linalg.inv(k2))
    corner = m @ [60, 0, 1]
    assert np.allclose(corner[:2] / corner[2], [160, 20])


def test_random_crop_stays_inside(spark):
    d = spark.range(500).select("id", geo.random_crop(F.col("id"), F.lit(640), F.lit(480), 200, 100).alias("c")).select("id", "c.*")
    for r in d.collect():
        assert 0 <= r.x0 < r.x1 <= 640 and 0 <= r.y0 < r.y1 <= 480 and abs((r.x1 - r.x0) - 2 * (r.y1 - r.y0)) <= 2
    assert rows(d, "id", "x0") == rows(d.repartition(3), "id", "x0")


def test_normal_window_forced(spark):
    p = spark.createDataFrame([(600.0, 400.0, 640.0, 480.0, 640, 480), (-5.0, -5.0, 20.0, 20.0, 640, 480)], "a double, b double, c double, d double, w int, h int")
    found = p.select(geo.normal_window(*[F.col(c) for c in "abcdwh"], forced=(100, 80)).alias("b")).select("b.*").collect()
    assert [(r.x1 - r.x0, r.y1 - r.y0) for r in found] == [(100, 80)] * 2
    assert all(0 <= r.x0 and r.x1 <= 640 and 0 <= r.y0 and r.y1 <= 480 for r in found)


def test_loss_without_rows(spark):
    none = spark.createDataFrame([], "loss double, conf double")
    assert losses.matching_confidence_loss(none, none, 0.2, 0.9).first().loss == 0.0


def test_nearest_distance(spark):
    """Far outliers, cameras of one place, one camera, none."""
    x = np.vstack([np.random.default_rng(1).normal(size=(60, 3)), [[900, 0, 0], [0, -5000, 3], [7, 7, 7], [7, 7, 7]]])
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    np.fill_diagonal(d, np.inf)
    want = np.sort(d.min(1))[(len(x) - 1) // 2]
    frame = lambda v: spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(v)], "image_id long, x double, y double, z double")
    assert abs(retrieval.nearest_distance(frame(x)).first().size - want) < 1e-9
    assert retrieval.nearest_distance(frame(x[:1])).first().size is None and retrieval.nearest_distance(frame(x[:0])).first().size is None
    assert retrieval.nearest_distance(frame(x[-2:])).first().size == 0.0


def test_database(spark, tmp_path):
    path = str(tmp_path / "model.db")
    cameras = spark.createDataFrame([(1, 1, 64, 48, [50.0, 50.0, 32.0, 24.0], False)], "camera_id int, model_id int, width int, height int, params array<double>, prior_focal boolean")
    images = spark.createDataFrame([(1, "a.png", 1, None, None), (2, "b.png", 1, [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 2.0])], "image_id int, name string, camera_id int, qvec array<double>, tvec array<double>")
    keypoints = spark.createDataFrame([(1, 1, 3.5, 4.5), (1, 0, 1.5, 2.5), (2, 0, 9.0, 8.0)], "image_id long, kp_idx long, x double, y double")
    matches = spark.createDataFrame([(2, 1, 0, 1), (1, 2, 0, 0)], "src long, dst long, kp_idx1 long, kp_idx2 long")
    model.write_database(path, cameras, images, keypoints, matches, verified=True)
    back = readers.read_database(spark, path, rows=1)
    assert rows(back["keypoints"], "image_id", "kp_idx", "x", "y") == [(1, 0, 1.5, 2.5), (1, 1, 3.5, 4.5), (2, 0, 9.0, 8.0)]
    assert rows(back["matches"], "src", "dst", "kp_idx1", "kp_idx2") == [(1, 2, 0, 0), (1, 2, 1, 0)]
    named = spark.createDataFrame([("a.png", "b.png"), ("a.png", "c.png")], "src string, dst string")
    assert rows(model.named_ids(named, back["images"]), "src", "dst") == [(1, 2)]
    with sqlite3.connect(path) as con:
        assert con.execute("SELECT pair_id, config FROM two_view_geometries").fetchall() == [(2147483647 + 2, 2)]
        assert struct.unpack("<4d", con.execute("SELECT params FROM cameras").fetchone()[0]) == (50.0, 50.0, 32.0, 24.0)
        assert con.execute("SELECT prior_qw, prior_tz FROM images ORDER BY image_id").fetchall() == [(None, None), (1.0, 2.0)]
    with pytest.raises(FileExistsError):
        model.write_database(path, cameras, images, keypoints, matches)


def test_sparse_model_files(spark, tmp_path):
    """Points seen once go; what is left is numbered from 1, and tracks point at the lines that are written."""
    cameras = spark.createDataFrame([(1, "PINHOLE", 64, 48, [50.0, 50.0, 32.0, 24.0])], "camera_id long, model string, width int, height int, params array<double>")
    poses = spark.createDataFrame([(i, [1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.5], 1, f"{i}.png") for i in (1, 2)], "image_id long, qvec array<double>, tvec array<double>, camera_id long, name string")
    points = spark.createDataFrame([(5, 1.0, 2.0, 3.0, 9, 8, 7), (6, 0.5, 0.5, 0.5, 1, 1, 1), (9, 4.0, 4.0, 4.0, 2, 2, 2)], "point_id long, x double, y double, z double, r int, g int, b int")
    seen = spark.createDataFrame([(5, 1, 10.0, 11.0), (6, 1, 1.0, 1.5), (9, 1, 20.0, 21.0), (5, 2, 12.0, 13.0), (9, 2, 22.0, 23.0)], "point_id long, image_id long, x double, y double")
    model.write_sparse_model(str(tmp_path), cameras, poses, points, seen)
    text = {n: [line for f in sorted((tmp_path / n).glob("part-*")) for line in f.read_text().split("\n")[:-1] if not line.startswith("#")] for n in ("cameras", "images", "points3D")}
    assert text["cameras"] == ["1 PINHOLE 64 48 50 50 32 24"]
    assert text["images"] == ["1 1 0 0 0 0 0 0.5 1 1.png", "10 11 1 1 1.5 -1 20 21 2", "2 1 0 0 0 0 0 0.5 1 2.png", "12 13 1 22 23 2"]
    assert text["points3D"] == ["1 1 2 3 9 8 7 0 1 0 2 0", "2 4 4 4 2 2 2 0 1 2 2 1"]


def test_binary_cloud(spark, tmp_path):
    path = str(tmp_path / "cloud.ply")
    points = spark.createDataFrame([(1.5, 2.0, 3.0, 0.0, 1.0, 0.0, 255, 0, 7), (0.5, 2.0, 3.0, 0.0, 1.0, 0.0, 1, 2, 3)], "x double, y double, z double, nx double, ny double, nz double, r int, g int, b int")
    model.write_ply_binary(points, path)
    head, _, body = open(path, "rb").read().partition(b"end_header\n")
    assert b"element vertex 2" in head and struct.unpack("<6f3B", body[:27]) == (0.5, 2.0, 3.0, 0.0, 1.0, 0.0, 1, 2, 3) and len(body) == 54


def test_text_cloud(spark):
    points = spark.createDataFrame([(1, 1.5, 2.0, 3.0, 255, 0, 7)], "point_id long, x double, y double, z double, r int, g int, b int")
    head, one = (r.value for r in files.ply_text(points).orderBy("point_id").collect())
    assert head.startswith("ply") and head.endswith("end_header") and "element vertex 1" in head and one == "1.5 2 3 0 1 0 255 0 7"


def test_mixture_and_footprints(spark):
    a, b = spark.range(50).withColumnRenamed("id", "k"), spark.range(50, 60).withColumnRenamed("id", "k")
    found = files.mixture({"a": a, "b": b}, {"a": 7, "b": 3}, "k")
    assert rows(found.groupBy("dataset").count(), "dataset", "count") == [("a", 7), ("b", 3)] and found.distinct().count() == 10
    prints = spark.createDataFrame([("p1",), ("p2",)], "image_id string")
    paths = spark.createDataFrame([("x/p1.tif",), ("p2.jpg",)], "path string")
    assert rows(files.footprints_with_files(prints, paths), "image_id") == [("p1",)]


def test_footprint_affine(spark):
    square = [0.0, 0.0, 4.0, 0.0, 4.0, 4.0, 0.0, 4.0]
    moved = [v + 1.0 for v in square]
    d = spark.createDataFrame([(square, moved), (square, [v + 50 for v in square]), (None, square)], "a array<double>, b array<double>")
    found = [r.m for r in d.select(geo.footprint_affine("a", "b").alias("m")).collect()]
    assert np.allclose(found[0], [1, 0, -1, 0, 1, -1]) and found[1] is None and found[2] is None


def test_spectral_embedding_parts_two_clusters():
    x = np.concatenate([np.zeros(5), np.full(5, 10.0)]) + np.arange(10) * 0.01
    v = graphs.spectral_embedding(np.abs(x[:, None] - x[None]), 1)[:, 0]
    assert len({*np.sign(v[:5])}) == 1 and np.sign(v[0]) != np.sign(v[9])


def test_one_camera(spark):
    same = spark.createDataFrame([(640, 480)] * 3, "width int, height int")
    assert files.one_camera(same).first().width == 640
    with pytest.raises(Exception, match="differ in size"):
        files.one_camera(same.union(spark.createDataFrame([(1, 2)], "width int, height int"))).collect()


def test_guarded_tracks_of_ids(spark):
    """A track's id is its first vertex; an edge that would put two keypoints of an image together is refused."""
    e = spark.createDataFrame([(0, 5, 1, 7), (1, 7, 2, 9), (0, 6, 2, 9)], "src long, a_kp long, dst long, b_kp long")
    found = rows(tracks.guarded_tracks(e), "image_id", "kp_id", "track_id")
    one, two = f"{0:012d}:{5:012d}", f"{0:012d}:{6:012d}"
    assert found in ([(0, 5, one), (0, 6, two), (1, 7, one), (2, 9, two)], [(0, 5, one), (0, 6, two), (1, 7, one), (2, 9, one)])


def test_crop_pairs(spark):
    """Crops lie inside their images, in order of falling gain, and together show the share asked for."""
    rng = np.random.default_rng(5)
    images = spark.createDataFrame([(0, 1600, 1200), (1, 1200, 1600)], "image_id long, width int, height int")
    x = rng.uniform(100, 1100, (400, 2))
    m = spark.createDataFrame([(0, 1, i, *map(float, p), float(p[0] * 0.9 + 20), float(p[1] * 0.9 + 40)) for i, p in enumerate(x)], MATCHES)
    found = flows.crop_pairs(images, m).orderBy("ord").collect()
    assert found and [r.ord for r in found] == list(range(len(found)))
    gains = [r.gain for r in found]
    assert gains == sorted(gains, reverse=True)
    for r in found:
        assert 0 <= r.x0_1 < r.x1_1 <= 1600 and 0 <= r.y0_1 < r.y1_1 <= 1200 and 0 <= r.x0_2 < r.x1_2 <= 1200 and 0 <= r.y0_2 < r.y1_2 <= 1600
    every = flows.crop_pairs(images, m, target=1.0).collect()
    assert len(every) > len(found) and 0.9 <= sum(gains) / sum(r.gain for r in every) <= 1
    assert flows.crop_pairs(images, m.limit(5)).collect() == []


def test_image_paths(spark, tmp_path):
    (tmp_path / "list.txt").write_text("a.png\n# no\n\nb.png\n")
    assert rows(files.image_paths(spark, str(tmp_path / "list.txt")), "path") == rows(files.image_paths(spark, ["b.png", "a.png"]), "path") == [("a.png",), ("b.png",)]


def test_blocks_are_exact(spark):
    parts = sorted(r["count"] for r in retrieval.blocks_by_hash(spark.range(1050), "id", 100).groupBy("block").count().collect())
    assert parts == [50] + [100] * 10


def test_closure_of_long_tracks(spark):
    """The pairs of one long track are made in several tasks."""
    kept = spark.createDataFrame([(t, k % 5, k) for t, n in (("a", 200), ("b", 3)) for k in range(n)], "track_id string, image_id long, kp_idx long")
    pairs = tracks.closure_pairs(kept, 20)
    found = rows(pairs, "src", "dst", "kp_idx1", "kp_idx2")
    assert found == sorted((a % 5, b % 5, a, b) for n in (200, 3) for a in range(n) for b in range(n) if a % 5 < b % 5)
    assert max(r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()) < len(found) / 2


def test_parts_of_a_track_meet_once(spark):
    """A keypoint is sent once for each part and once more, not twice for each; all pairs come once, of either order of parts."""
    kept = spark.createDataFrame([("a", k % 7, k // 7) for k in range(400)], "track_id string, image_id long, kp_idx long")
    one, two = tracks._met_parts(kept, 50)
    assert one.count() + two.count() == 400 * 9 and one.where("p1 > p2").isEmpty() and two.where("p1 > p2").isEmpty()
    found = rows(tracks.closure_pairs(kept, 50), "src", "dst", "kp_idx1", "kp_idx2")
    assert found == sorted((a % 7, b % 7, a // 7, b // 7) for a in range(400) for b in range(400) if a % 7 < b % 7)


@pytest.mark.parametrize("radius", [2.0, 0.8])
def test_rounded_matches_are_tied_to_the_nearest_keypoint(spark, radius):
    rng = np.random.default_rng(5)
    at = np.round(rng.uniform(-4, 4, (300, 4)) * 4) / 4
    rows = [(int(a), int(a) + 1, n, *map(float, p)) for n, (a, p) in enumerate(zip(rng.integers(0, 2, 300), at))]
    odd = [math.nan, math.inf, None, 2.0**60, -0.5]
    rows += [(0, 1, 300 + n, x, 1.0, 2.0, 1.25) for n, x in enumerate(odd)]
    points, pairs = flows.format_rounded(spark.createDataFrame(rows, MATCHES), radius)
    own = {}
    for p in points.collect():
        own.setdefault(p.image_id, []).append((p.kp_idx, p.x, p.y))

    def nearest(image, x, y):
        if x is None or not math.isfinite(x):
            return None
        near = [(math.sqrt((x - kx) ** 2 + (y - ky) ** 2), kp) for kp, kx, ky in own[image] if kx is not None and math.isfinite(kx)]
        return min(((d, kp) for d, kp in near if d < radius), default=(0, None))[1]

    want = {(s, d, nearest(s, x1, y1), nearest(d, x2, y2)) for s, d, _, x1, y1, x2, y2 in rows}
    found = [tuple(r) for r in pairs.collect()]
    assert len(found) == len(set(found)) and set(found) == {w for w in want if None not in w}
    # an end meets its candidates once, and is not joined back to itself
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


def test_reprojected_matches_take_cameras_without_a_sort_of_all_rows(spark, tmp_path):
    rng, width, height, rows, seen = np.random.default_rng(6), 5, 4, [], {}
    for pair in range(3):
        for side in (1, 2):
            c, s = np.cos(0.1 * pair * side), np.sin(0.1 * pair * side)
            focal, cx, cy, r, t = 4.0 + pair, 2.0, 1.5 + 0.1 * side, np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]]), np.array([0.1 * side, -0.1 * pair, 0.0])
            points = np.stack([(np.arange(20) % width - cx) / focal, (np.arange(20) // width - cy) / focal, np.ones(20)], 1) * rng.uniform(2, 2.2, (20, 1)) @ r.T + t
            points[3] = t
            seen[pair, side] = (focal, cx, cy, r, t, points)
            rows += [(pair, side, i, *map(float, p), focal, cx, cy, r.ravel().tolist(), t.tolist()) for i, p in enumerate(points)]

    def falls(pair, side, i):
        focal, cx, cy, r, t, _ = seen[pair, 3 - side]
        x, y, z = r.T @ (seen[pair, side][5][i] - t)
        return None if z == 0 else int(np.clip(np.rint(focal * x / z + cx), 0, width - 1) + width * np.clip(np.rint(focal * y / z + cy), 0, height - 1))

    views = spark.createDataFrame(rows, "pair_id long, side long, pix long, x double, y double, z double, focal double, cx double, cy double, rotation array<double>, t array<double>")
    found = flows.reprojected_matches(views, (width, height))
    want = [(p, i, falls(p, 1, i)) for p in range(3) for i in range(20) if falls(p, 1, i) is not None and falls(p, 2, falls(p, 1, i)) == i]
    assert len(want) > 10 and sorted(map(tuple, found.collect())) == sorted(want)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    spark.range(1, 10, 1, 1).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    assert more._views(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().count() > 1

"""Hand-made cases of the operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewloom.functions import geometry as geo
from viewloom.operators import fusion, graphs, matching, pairs, retrieval, tiling, tracks
from viewloom.operators.components import connected_components
from viewloom.sources import files


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "image_id")


def edges(df):
    return sorted((r.src, r.dst) for r in df.collect())


def test_windows(spark):
    assert edges(pairs.sliding(ids(spark, 4), 1)) == [(0, 1), (0, 3), (1, 2), (2, 3)]
    assert edges(pairs.sliding(ids(spark, 4), 1, cyclic=False)) == [(0, 1), (1, 2), (2, 3)]
    assert edges(pairs.sliding(ids(spark, 3), 3)) == [(0, 1), (0, 2), (1, 2)]
    assert edges(pairs.sliding(ids(spark, 3), 3, compat_self_pairs=True)) == [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
    assert edges(pairs.log_window(ids(spark, 5), 3, cyclic=False)) == [(0, 1), (0, 2), (0, 4), (1, 2), (1, 3), (2, 3), (2, 4), (3, 4)]
    assert len(edges(pairs.log_window(ids(spark, 5), 3))) == 10
    assert edges(pairs.sliding(ids(spark, 0), 2)) == []


def test_spec():
    assert pairs.parse_spec("swin-noncyclic") == {"kind": "swin", "window": 3, "cyclic": False}
    assert pairs.parse_spec("retrieval-20-10") == {"kind": "retrieval", "keys": 20, "neighbours": 10}
    for bad in ("retrieval-20-1-10-1", "oneref-x", "star", "complete-3", "oneref-noncyclic"):
        with pytest.raises(ValueError):
            pairs.parse_spec(bad)
    for spec in ("complete", "swin-5", "logwin-2-noncyclic", "oneref-4", "retrieval-3-2"):
        assert pairs.build_spec(**pairs.parse_spec(spec)) == spec


def test_frame_gap(spark):
    e = spark.createDataFrame([(0, 1), (0, 9), (2, 5), (8, 1)], "src long, dst long")
    assert edges(pairs.frame_gap(e, 2)) == [(0, 1)]
    assert len(edges(pairs.frame_gap(e, 3, cyclic=True))) == 4


@pytest.mark.parametrize("w,h,xs,ys", [(1300, 900, [0, 384, 768, 788], [0, 384, 388]), (896, 600, [0, 384], [0, 88]), (513, 513, [0, 1], [0, 1]), (2000, 500, [0, 384, 768, 1152, 1488], [0])])
def test_edge_aligned(spark, w, h, xs, ys):
    rows = tiling.edge_aligned(spark.createDataFrame([(1, w, h)], "image_id long, width int, height int")).collect()
    assert sorted({r.x0 for r in rows}) == xs and sorted({r.y0 for r in rows}) == ys and len(rows) == len(xs) * len(ys)
    assert max(r.x1 for r in rows) == w and max(r.y1 for r in rows) == h and rows[0].tile_id == "1_tile_0000"


def test_edge_aligned_compat(spark):
    rows = tiling.edge_aligned(spark.createDataFrame([(1, 2000, 500)], "image_id long, width int, height int"), compat_single=True).collect()
    assert [(r.x0, r.y0, r.x1, r.y1) for r in rows] == [(0, 0, 2000, 500)]


def test_clipped(spark):
    rows = tiling.clipped(spark.createDataFrame([(1, 1300, 900), (2, 2000, 1100)], "image_id long, width int, height int")).collect()
    assert [(r.x0, r.y0, r.x1, r.y1) for r in rows if r.image_id == 1] == [(0, 0, 1024, 900), (768, 0, 1300, 900)]
    assert [(r.x0, r.y0, r.x1, r.y1) for r in rows if r.image_id == 2][-1] == (1536, 768, 2000, 1100) and len(rows) == 8


def test_window_starts(spark):
    found = [spark.range(1).select(tiling.window_starts(t, w, o)).first()[0] for t, w, o in ((1000, 512, 0.5), (512, 512, 0.5), (600, 400, 0.5))]
    assert found == [[0, 244, 488], [0], [0, 200]]


def test_one_to_one(spark):
    a = [("A0", 0, 0, 10, 10), ("A1", 5, 0, 15, 10), ("A2", 100, 100, 110, 110)]
    b = [("B0", 0, 0, 10, 10), ("B1", 12, 0, 22, 10)]
    tiles = spark.createDataFrame([(t, 0, *x) for t, *x in a] + [(t, 1, *x) for t, *x in b], "tile_id string, image_id long, x0 int, y0 int, x1 int, y1 int")
    for shift, want in ((0.0, [("A0", "B0", 100.0)]), (2.0, [("A0", "B0", 80.0), ("A1", "B1", 50.0)])):
        maps = spark.createDataFrame([(0, 1, [1.0, 0.0, shift, 0.0, 1.0, 0.0])], "src long, dst long, m array<double>")
        assert sorted((r.a_tile, r.b_tile, r.area) for r in tiling.best_tiles(tiling.overlapping_tiles(tiles, maps, 16.0)).collect()) == want


def test_affine_inverse(spark):
    m = F.array(*[F.lit(float(x)) for x in (2, 0, 10, 0, 4, 20)])
    assert spark.range(1).select(tiling.affine_inverse(m)).first()[0] == [0.5, 0, -5, 0, 0.25, -5]


def test_mutual(spark):
    a, b = [[1.0, 0.0], [0.8, 0.6], [0.0, 1.0]], [[0.9, 0.1], [0.0, 1.0], [0.6, 0.8]]
    d = spark.createDataFrame([(0, i, v) for i, v in enumerate(a)] + [(1, i, v) for i, v in enumerate(b)], "image_id long, kp long, v array<double>")
    p = spark.createDataFrame([(0, 1)], "src long, dst long")
    for block in (8192, 1):
        best = matching.nearest_both_ways(d, p, block=block)
        assert sorted((r.a, r.b) for r in best.where("forward").collect()) == [(0, 0), (1, 2), (2, 1)]
        assert sorted((r.a, r.b) for r in matching.mutual(best).collect()) == [(0, 0), (1, 2), (2, 1)]


def test_merge(spark):
    c = spark.createDataFrame([(0, 1, p, q, n) for n, (p, q) in enumerate(((5, 7), (2, 9), (5, 7)))], "src long, dst long, pix1 long, pix2 long, pos long")
    assert sorted((r.pix1, r.pix2, r.pos) for r in matching.merge_corres(c).collect()) == [(2, 9, 1), (5, 7, 0)]


def test_thresholds(spark):
    c = spark.createDataFrame([(0.5,), (1.0,)], "conf double")
    assert matching.confident(c, 0.5).count() == 2 and matching.confident(c, 0.5, strict=True).count() == 1
    assert matching.cached_confident(c, 0).count() == 2 and matching.cached_confident(c, 0.5).count() == 1


def distances(spark, xs):
    return spark.createDataFrame([(i, j, float(abs(x - y))) for i, x in enumerate(xs) for j, y in enumerate(xs)], "i long, j long, d double")


def test_farthest(spark):
    d = distances(spark, [0, 1, 4, 9])
    assert graphs.farthest_points(d, 3, seed=0) == [(0, 0.0), (3, 9.0), (2, 4.0)]
    assert [(r.i, r.key) for r in graphs.nearest_key(d, [0, 3, 2]).collect()] == [(1, 0)]
    assert edges(graphs.knn_edges(d, 2)) == [(0, 1), (1, 2), (2, 3)] and edges(graphs.knn_edges(d, 1)) == []
    assert len(graphs.farthest_points(d, 4, threshold=5.0, seed=0)) == 2


def test_spanning_tree(spark):
    s = spark.createDataFrame([(0, 1, 5.0), (1, 2, 4.0), (0, 2, 1.0), (2, 3, 3.0), (3, 4, 2.0), (0, 4, 0.0)], "i long, j long, s double")
    assert graphs.spanning_tree(s) == [(2, 1), (2, 3), (1, 0), (3, 4)]
    with pytest.raises(ValueError):
        graphs.spanning_tree(spark.createDataFrame([(0, 1, 1.0), (2, 3, 1.0)], "i long, j long, s double"))


def test_greedy(spark):
    rows = [[1, 1, 0, 0], [0, 1, 1, 0], [0, 0, 0, 0.5]]
    w = spark.createDataFrame([(r, c, float(x)) for r, row in enumerate(rows) for c, x in enumerate(row)], "row long, col long, w double")
    assert graphs.greedy_cover(w, 0.9) == [(0, 2.0), (1, 1.0), (2, 0.5)]


def test_ward():
    a = np.eye(3)
    a[0, 1] = a[1, 0] = 0.9
    a[1, 2] = a[2, 1] = 0.5
    assert graphs.ward_chain(a) == [(0, 1), (1, 2)]


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (7, 8), (9, 9), (3, 10)], "a long, b long")
    assert {r.node: r.component for r in connected_components(e).collect()} == {1: 1, 2: 1, 3: 1, 10: 1, 7: 7, 8: 7, 9: 9}


def test_guarded(spark):
    e = spark.createDataFrame([(0, 0, 1, 0), (0, 1, 1, 0)], "src long, a_kp long, dst long, b_kp long")
    by = {}
    for r in tracks.guarded_tracks(e).collect():
        by.setdefault(r.track_id, []).append((r.image_id, r.kp_id))
    assert sorted(map(sorted, by.values())) == [[(0, 0), (1, 0)], [(0, 1)]]
    assert len({r.track_id for r in tracks.component_tracks(e).collect()}) == 1


def test_fusion(spark):
    v = spark.createDataFrame([(0, 0, 10.0, 0.0, 0.0, 1.999), (0, 0, 20.0, 0.0, 0.0, 3.999)], "image_id long, pix long, x3 double, y3 double, z3 double, conf double")
    r = fusion.canonical_view(v).first()
    assert abs(r.x3 - 17.5) < 1e-9 and abs(r.conf - 2.5) < 1e-9
    c = spark.createDataFrame([(0, 1, 2.0, 4.0, 1.0, 2.0, 1.0)], "src long, dst long, c11 double, c21 double, c22 double, c12 double, conf double")
    assert abs(fusion.pair_scores(c).first().conf_score - 2.0) < 1e-9
    d = spark.createDataFrame([(0, float(x)) for x in (1, 2, 3, 4)], "image_id long, depth double")
    assert fusion.median_normalised(d).first()["median"] == 2.0
    nan = float("nan")
    for valid, kept in ((1, False), (2, True)):
        s = spark.createDataFrame([(0, 1.0 if k < valid else nan, 1.0, 1.0, 1.0) for k in range(4)], "key long, x double, y double, z double, conf double")
        assert (fusion.fused(s, 0.3).first().x is not None) == kept


def test_metrics(spark):
    s = spark.createDataFrame([(0, k, float(-k), l) for k, l in enumerate((0, 1, 0, 1))], "query_id long, item long, score double, label int")
    assert retrieval.average_precision(s).first().ap == 0.5
    m = spark.createDataFrame([(i, j, float(i == j)) for i in range(2) for j in range(2)], "i long, j long, s double")
    for mode, want in (("all", 1.006409), ("proper", 0.626523), ("dual", 0.626523)):
        assert abs(retrieval.info_nce(m, mode, 1.0).first().loss - want) < 1e-5


def test_whitening(spark):
    x = np.random.default_rng(0).normal(size=(400, 3)) @ np.array([[2, 0, 0], [1, 1, 0], [0, 0, 0.3]])
    d = spark.createDataFrame([(x.tolist(),) for x in x], "v array<double>")
    mean, projection = retrieval.learn_whitening(d)
    y = np.array([r.v for r in retrieval.whiten(d, mean, projection, normalise=False).collect()])
    assert np.allclose(y.T @ y / len(y), np.eye(3), atol=1e-6)


def test_geometry(spark):
    one = spark.range(1)
    at = [one.select(geo.ravel(F.lit(x), F.lit(y), F.lit(4), F.lit(3))).first()[0] for x, y in ((2.5, 1.5), (-1.0, 9.0), (3.6, 0.4))]
    assert at == [10, 8, 3]
    assert abs(one.select(geo.robust(F.lit(2.0), 1.5)).first()[0] - 3.525524) < 1e-5
    assert abs(one.select(geo.robust(F.lit(2.0), 0.5)).first()[0] - 1.0) < 1e-9
    assert geo.schedule("cosine", 0.5, 0.07, 0.0) == pytest.approx(0.035)
    m = F.array(*[F.lit(float(x)) for x in (0, -1, 0, 1, 0, 0, 0, 0, 1)])
    assert np.allclose(one.select(geo.quaternion(m)).first()[0], [0.70710678, 0, 0, 0.70710678])
    half = F.array(*[F.lit(float(x)) for x in (-1, 0, 0, 0, 1, 0, 0, 0, -1)])
    assert np.allclose(one.select(geo.quaternion(half)).first()[0], [0, 0, 1, 0])
    assert set(geo.clip_polygon([(0, 0), (2, 0), (2, 2), (0, 2)], [(1, 1), (3, 1), (3, 3), (1, 3)])) == {(1, 1), (2, 1), (2, 2), (1, 2)}
    assert np.allclose(geo.affine_from_points([(0, 0), (1, 0), (0, 1)], [(1, 1), (3, 1), (1, 4)]), [2, 0, 1, 0, 3, 1])


def test_triangulate(spark):
    eye, moved = [1.0, 0, 0, 0, 0, 1.0, 0, 0, 0, 0, 1.0, 0], [1.0, 0, 0, -1.0, 0, 1.0, 0, 0, 0, 0, 1.0, 0]
    d = spark.createDataFrame([([(list(map(float, eye)), 0.25, 0.125), (list(map(float, moved)), -0.25, 0.125)],)], "rays array<struct<p:array<double>,u:double,v:double>>")
    p = geo.triangulate(d).first().point
    assert np.allclose([p.x, p.y, p.z], [0.5, 0.25, 2.0])


def test_files(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# head\n\na/b.png\n  c.jpg \n")
    assert [r.path for r in files.read_list(spark, str(tmp_path / "list.txt")).collect()] == ["a/b.png", "c.jpg"]
    files.write_pairs(spark.createDataFrame([("b", "c"), ("a", "b"), ("b", "c")], "src string, dst string"), str(tmp_path / "pairs"))
    assert [(r.src, r.dst, r.score) for r in files.read_pairs(spark, str(tmp_path / "pairs")).collect()] == [("a", "b", 1.0), ("b", "c", 1.0)]
    (tmp_path / "t.json").write_text('{"A__B": [[1, 0, 5], [0, 1, 6]]}')
    r = files.read_transforms(spark, str(tmp_path / "t.json")).first()
    assert (r.src, r.dst, list(r.m)) == ("A", "B", [1, 0, 5, 0, 1, 6])
    png = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big") + b"\x08\x00\x00\x00\x00"
    (tmp_path / "im" / "sub").mkdir(parents=True)
    (tmp_path / "im" / "sub" / "x12.PNG").write_bytes(png)
    (tmp_path / "im" / "bad.jpg").write_bytes(b"no image")
    rows = files.read_images(spark, str(tmp_path / "im"))
    assert [(r.path, r.width, r.height) for r in rows.collect()] == [("sub/x12.PNG", 7, 5)]
    assert rows.select(files.numeric_stem()).first()[0] == 12
    with pytest.raises(ValueError):
        files.require_images(rows)


def test_radius_is_strict(spark):
    k = spark.createDataFrame([(0, 0, 2.0, 0.0), (0, 1, 0.0, 1.0)], "image_id long, kp_idx long, x double, y double")
    r = spark.createDataFrame([(0, 0, 0.0, 0.0), (0, 1, 4.0, 0.0)], "image_id long, pos long, x double, y double")
    assert {x.pos: x.kp_idx for x in tracks.radius_nearest(r, k, 2.0).collect()} == {0: 1, 1: None}


def test_tiles_meet_by_a_shuffle_and_not_through_the_driver(spark):
    """The size of tiles is guessed as that of their images; only the list of full cells may be broadcast."""
    images = spark.range(50).select(F.col("id").alias("image_id"), F.lit(1400).alias("width"), F.lit(900).alias("height"))
    one = [F.lit(float(x)) for x in (1, 0, 30, 0, 1, -20)]
    maps = images.select(F.col("image_id").alias("src"), (F.col("image_id") + 1).alias("dst"), F.array(*one).alias("m"))
    plan = tiling.overlapping_tiles(tiling.edge_aligned(images), maps)._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) >= 3 and all("SortMergeJoin" in line or "LeftOuter" in line for line in joins)


def test_best_tiles_meet_by_a_shuffle_and_not_through_the_driver(spark):
    from viewloom.plans import catalog

    plan = catalog.QUERIES["tile_best_one_to_one"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) >= 3 and all("SortMergeJoin" in line or "LeftOuter" in line for line in joins)

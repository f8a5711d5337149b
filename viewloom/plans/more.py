"""Further named queries and their SQL: column functions, flows, losses and the sparse model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..operators import flows, fusion, losses, matching, pairs, retrieval, tiling, tracks
from ..sources import files, model
from .base import base, read, rounded, sql
from .catalog import query

lit = lambda *xs: F.array(*[F.lit(float(x)) for x in xs])


# --- column functions

@query("pixel_unravel", sql("points", "SELECT pos, pix % 640 AS x, pix // 640 AS y FROM points"))
def _(spark, sf):
    return base(spark, sf, "points").select("pos", geo.unravel(F.col("pix"), F.lit(640)).alias("p")).select("pos", "p.x", "p.y")


@query("pixel_round_trip", sql("points", "SELECT pos, round(0.5 * (x + 0.5) + 3 - 0.5, 6) AS x, round(0.25 * (x + 0.5) + 2 * (y + 0.5) - 1 - 0.5, 6) AS y FROM points"))
def _(spark, sf):
    p = geo.centre_round_trip(F.col("x"), F.col("y"), lit(0.5, 0, 3, 0.25, 2, -1))
    return rounded(base(spark, sf, "points").select("pos", p.alias("p")).select("pos", "p.x", "p.y"))


@query("pixel_homography", sql("points", "SELECT pos, round((2 * x + y + 3) / (0.001 * x + 0.002 * y + 1), 6) AS x, round((x - y) / (0.001 * x + 0.002 * y + 1), 6)::DOUBLE + 0.0 AS y FROM points"))
def _(spark, sf):
    p = geo.homography(F.col("x"), F.col("y"), lit(2, 1, 3, 1, -1, 0, 0.001, 0.002, 1))
    return rounded(base(spark, sf, "points").select("pos", p.alias("p")).select("pos", "p.x", (F.col("p.y") + 0.0).alias("y")))


@query("points_in_rect", sql("points", "SELECT pos FROM points WHERE x >= 100 AND x < 300.5 AND y >= 50 AND y < 400"))
def _(spark, sf):
    return base(spark, sf, "points").where(geo.inside_rect(F.col("x"), F.col("y"), 100, 50, 300.5, 400)).select("pos")


@query("focal_of_view", sql("photos", "SELECT image_id, round(width / (2 * tan(height / 1000.0 / 2)), 6) AS focal, round(2 * atan(width / (2.0 * height)), 9) AS fov, round(1.2 * greatest(width, height), 6)::DOUBLE AS guess, round(512.0 / greatest(width, height), 9) AS scale FROM photos"))
def _(spark, sf):
    w, h = F.col("width"), F.col("height")
    p = base(spark, sf, "photos").select("image_id", F.round(geo.fov_to_focal(h / 1000.0, w), 6).alias("focal"), F.round(geo.focal_to_fov(h, w), 9).alias("fov"), F.round(geo.default_focal(w, h), 6).alias("guess"), F.round(geo.resize_scale(w, h, 512), 9).alias("scale"))
    return p


@query("residual_shapes", sql("observed", "SELECT pos, round(sqrt(x), 9) AS half, round(ln(1 + sqrt(x * x + y * y + z * z)) / sqrt(x * x + y * y + z * z), 9) AS log_factor, round(exp(-2 * (pow((x - 25) / 50, 2) + pow((z - 5) / 10, 2))), 9) AS weight FROM observed"))
def _(spark, sf):
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return rounded(base(spark, sf, "observed").select("pos", geo.l05(x).alias("half"), geo.log_norm(x, y, z).alias("log_factor"), geo.gaussian_centre_weight(x, z, F.lit(0.0), F.lit(0.0), F.lit(50.0), F.lit(10.0)).alias("weight")), 9)


@query("tile_tags", sql("photos", "SELECT image_id, format('[{}:{},{}:{}]', 10, height, 20, width) AS tag, CASE WHEN height > width THEN 7 ELSE 5 END::DOUBLE AS x, CASE WHEN height > width THEN width - 1 - 5 ELSE 7 END::DOUBLE AS y FROM photos"))
def _(spark, sf):
    w, h = F.col("width"), F.col("height")
    tag = geo.crop_tag(F.lit(20), F.lit(10), w, h)
    return base(spark, sf, "photos").select("image_id", tag.alias("tag"), geo.landscape(F.lit(5.0), F.lit(7.0), w, h).alias("p")).select("image_id", "tag", "p.x", "p.y")


@query("camera_and_back", sql("observed", "SELECT pos, round(0.6 * (x - 1) + 0.8 * (y - 2), 6)::DOUBLE + 0.0 AS x, round(0.6 * (y - 2) - 0.8 * (x - 1), 6)::DOUBLE + 0.0 AS y, round(z - 3, 6)::DOUBLE + 0.0 AS z, round(x, 6) AS wx, round(y, 6) AS wy FROM observed"))
def _(spark, sf):
    r, t = lit(0.6, -0.8, 0, 0.8, 0.6, 0, 0, 0, 1), lit(1, 2, 3)
    o = base(spark, sf, "observed").withColumn("c", geo.to_camera(F.struct("x", "y", "z"), r, t)).withColumn("w", geo.to_world(F.col("c"), r, t))
    return rounded(o.select("pos", *[(F.col(f"c.{c}") + 0.0).alias(c) for c in "xyz"], F.col("w.x").alias("wx"), F.col("w.y").alias("wy")))


@query("world_to_pixel", sql("points", "SELECT pos, round((-2 * (x - 100) - 0.5 * (y - 900)) / -4.0, 6)::DOUBLE + 0.0 AS x, round(2 * (y - 900) / -4.0, 6)::DOUBLE + 0.0 AS y FROM points"))
def _(spark, sf):
    p = files.world_to_pixel(F.col("x"), F.col("y"), lit(100, 2, 0.5, 900, 0, -2))
    return rounded(base(spark, sf, "points").select("pos", p.alias("p")).select("pos", (F.col("p.x") + 0.0).alias("x"), (F.col("p.y") + 0.0).alias("y")))


@query("path_digests", sql("photos", "SELECT image_id, md5('img/' || image_id || '.png') AS digest FROM photos"))
def _(spark, sf):
    return base(spark, sf, "photos").select("image_id", F.md5(F.concat(F.lit("img/"), F.col("image_id").cast("string"), F.lit(".png"))).alias("digest"))


@query("path_numbers", sql("photos", "SELECT image_id, image_id * 10 AS stem FROM photos"))
def _(spark, sf):
    p = base(spark, sf, "photos").withColumn("path", F.concat(F.lit("7/im_"), (F.col("image_id") * 10).cast("string"), F.lit("_b3.jpg")))
    return p.select("image_id", files.numeric_stem("path").alias("stem"))


_NORM = """t AS (SELECT image_id, width::DOUBLE w, height::DOUBLE h, (image_id % 90) * 4.5 x0, (image_id % 70) * 3.25 y0, 150.0 + image_id % 400 sx, 120.0 + (image_id * 7) % 450 sy FROM photos),
u AS (SELECT *, least(sx, w) w2, least(sy, h) h2 FROM t),
v AS (SELECT *, CASE WHEN sx < sy THEN least(h2 * 3.01 / 4, w) ELSE w2 END nw, CASE WHEN sx < sy THEN h2 ELSE least(w2 * 3.01 / 4, h) END nh FROM u),
a AS (SELECT *, floor(nw) lw, floor(nh) lh, greatest(floor(x0 + sx + (nw - sx) / 2) - floor(nw), 0) ax, greatest(floor(y0 + sy + (nh - sy) / 2) - floor(nh), 0) ay FROM v),
b AS (SELECT *, ax - greatest(ax + lw - w, 0) bx, ay - greatest(ay + lh - h, 0) by_ FROM a)
SELECT image_id, bx::BIGINT AS x0, by_::BIGINT AS y0, (bx + lw)::BIGINT AS x1, (by_ + lh)::BIGINT AS y1 FROM b"""


@query("windows_normal", sql("photos", _NORM))
def _(spark, sf):
    i = F.col("image_id")
    p = base(spark, sf, "photos").withColumn("x0", i % 90 * 4.5).withColumn("y0", i % 70 * 3.25)
    p = p.withColumn("x1", F.col("x0") + 150.0 + i % 400).withColumn("y1", F.col("y0") + 120.0 + i * 7 % 450)
    return p.select("image_id", geo.normal_window(*[F.col(c) for c in ("x0", "y0", "x1", "y1", "width", "height")]).alias("b")).select("image_id", "b.*")


# --- pairs, keypoints and matches

@query("match_ends", sql("raw", "SELECT src AS image_id, pix1::DOUBLE AS x, conf1 AS y FROM raw UNION ALL SELECT dst, pix2::DOUBLE, conf2 FROM raw"))
def _(spark, sf):
    r = base(spark, sf, "raw").select("src", "dst", F.col("pix1").cast("double").alias("x1"), F.col("conf1").alias("y1"), F.col("pix2").cast("double").alias("x2"), F.col("conf2").alias("y2"))
    return tracks.both_ends(r)


@query("matches_in_image", sql("raw", "SELECT pos, pix1 + src * 512 AS x1, pix2 + dst * 512 AS x2, pix2 + src * 256 AS y1, pix1 + dst * 256 AS y2 FROM raw"))
def _(spark, sf):
    r = base(spark, sf, "raw").select("pos", F.col("src").alias("tile1"), F.col("dst").alias("tile2"), F.col("pix1").alias("x1"), F.col("pix2").alias("x2"), F.col("pix2").alias("y1"), F.col("pix1").alias("y2"))
    tiles = spark.range(12).select(F.col("id").alias("tile_id"), (F.col("id") * 512).alias("x0"), (F.col("id") * 256).alias("y0"))
    return tiling.to_image(r, tiles).select("pos", "x1", "x2", "y1", "y2")


@query("matches_looked_up", sql("raw depths", "SELECT src, dst, pos, pix1, depth FROM raw JOIN depths d ON d.image_id = src AND d.x + 64 * d.y = pix1"))
def _(spark, sf):
    d = base(spark, sf, "depths").select("image_id", (F.col("x") + 64 * F.col("y")).alias("pix"), "depth")
    return matching.lookup(base(spark, sf, "raw").select("src", "dst", "pos", "pix1"), d)


@query("pairs_with_files", sql("edges", "SELECT DISTINCT 'a/' || src || '.jpg' AS src, 'b\\' || dst || '.jpg' AS dst FROM edges WHERE src % 3 <> 0 AND dst % 3 <> 0"))
def _(spark, sf):
    e = base(spark, sf, "edges").select(F.concat(F.lit("a/"), F.col("src").cast("string"), F.lit(".jpg")).alias("src"), F.concat(F.lit("b\\"), F.col("dst").cast("string"), F.lit(".jpg")).alias("dst")).distinct()
    there = spark.range(60).where("id % 3 <> 0").select(F.concat(F.lit("x/y/"), F.col("id").cast("string"), F.lit(".jpg")).alias("path"))
    return pairs.on_basenames(e, there)


@query("pairs_named", sql("edges", "SELECT src + 1 AS src, dst + 1 AS dst, pos FROM edges WHERE src < 30 AND dst < 30"))
def _(spark, sf):
    e = base(spark, sf, "edges").select(F.concat(F.lit("im"), F.col("src").cast("string")).alias("src"), F.concat(F.lit("im"), F.col("dst").cast("string")).alias("dst"), "pos")
    images = spark.range(30).select((F.col("id") + 1).alias("image_id"), F.concat(F.lit("im"), F.col("id").cast("string")).alias("name"))
    return model.named_ids(e, images)


@query("evenly_spaced", sql("raw", "r AS (SELECT src, dst, pos, row_number() OVER w - 1 n, count(*) OVER (PARTITION BY src, dst) - 1 l FROM raw WINDOW w AS (PARTITION BY src, dst ORDER BY pos)), k AS (SELECT unnest(range(20)) i) SELECT src, dst, pos FROM r JOIN k ON round_even(i * l / 19, 0) = n"))
def _(spark, sf):
    return flows.evenly_spaced(base(spark, sf, "raw").select("src", "dst", "pos"), 20, ("src", "dst"), "pos")


_CELLS = "c AS (SELECT i AS cell_id, (i % 5) * 128 x0, (i // 5) * 160 y0, (i % 5) * 128 + 128 x1, (i // 5) * 160 + 160 y1 FROM range(15) t(i))"


@query("crops_of_most_matches", sql("points", _CELLS + """, m AS (SELECT image_id AS pair_id, x AS ax, y AS ay, y AS bx, x / 2 AS by_ FROM points),
n AS (SELECT pair_id, a.cell_id crop1, b.cell_id crop2, count(*) n FROM m JOIN c a ON ax >= a.x0 AND ax < a.x1 AND ay >= a.y0 AND ay < a.y1 JOIN c b ON bx >= b.x0 AND bx < b.x1 AND by_ >= b.y0 AND by_ < b.y1 GROUP BY 1, 2, 3),
o AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY n DESC, crop1, crop2) r FROM n) SELECT pair_id, crop1, crop2, n FROM o WHERE r = 1"""))
def _(spark, sf):
    i = F.col("id")
    cells = spark.range(15).select(i.alias("cell_id"), (i % 5 * 128).alias("x0"), (F.floor(i / 5) * 160).alias("y0"), (i % 5 * 128 + 128).alias("x1"), (F.floor(i / 5) * 160 + 160).alias("y1"))
    m = base(spark, sf, "points").select(F.col("image_id").alias("pair_id"), "pos", F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("y").alias("x2"), (F.col("x") / 2).alias("y2"))
    return flows.best_crops(m, cells, cells, 128.0)


_ENDS = "m AS (SELECT src, dst, pos, pix1 + conf1 / 10 x1, pix2 + conf2 / 10 y1, pix2 + conf1 / 20 x2, pix1 + conf2 / 20 y2 FROM raw)"


def _ends(spark, sf):
    c = F.col
    return base(spark, sf, "raw").select("src", "dst", "pos", (c("pix1") + c("conf1") / 10).alias("x1"), (c("pix2") + c("conf2") / 10).alias("y1"), (c("pix2") + c("conf1") / 20).alias("x2"), (c("pix1") + c("conf2") / 20).alias("y2"))


_ROUNDED = sql("raw", _ENDS + """, e AS (SELECT src AS image_id, x1 x, y1 y FROM m UNION ALL SELECT dst, x2, y2 FROM m),
f AS (SELECT *, row_number() OVER (PARTITION BY image_id, round_even(x, 0), round_even(y, 0) ORDER BY x, y) n FROM e),
k AS (SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY round_even(x, 0), round_even(y, 0)) - 1 AS kp_idx, x, y FROM f WHERE n = 1)""")


@query("rounded_flow_keypoints", _ROUNDED + " SELECT image_id, kp_idx, x, y FROM k")
def _(spark, sf):
    return flows.format_rounded(_ends(spark, sf))[0]


@query("rounded_flow_matches", _ROUNDED + """, d AS (SELECT DISTINCT image_id, x, y FROM e),
j AS (SELECT d.image_id, d.x, d.y, kp_idx, row_number() OVER (PARTITION BY d.image_id, d.x, d.y ORDER BY sqrt((d.x - k.x) ** 2 + (d.y - k.y) ** 2), kp_idx) r FROM d JOIN k ON k.image_id = d.image_id AND abs(d.x - k.x) < 2 AND abs(d.y - k.y) < 2 AND sqrt((d.x - k.x) ** 2 + (d.y - k.y) ** 2) < 2)
SELECT DISTINCT src, dst, a.kp_idx AS kp_idx1, b.kp_idx AS kp_idx2 FROM m JOIN j a ON a.r = 1 AND a.image_id = src AND a.x = x1 AND a.y = y1 JOIN j b ON b.r = 1 AND b.image_id = dst AND b.x = x2 AND b.y = y2""")
def _(spark, sf):
    return flows.format_rounded(_ends(spark, sf))[1]


_VIEWS = "v AS (SELECT image_id AS pair_id, s AS side, u + 20 * w AS pix, z * (u - 9.5) / 25 + (s - 1) * 0.5 AS x, z * (w - 7) / 25 AS y, z FROM (SELECT image_id, s, u, w, 5.0 + (u * 7 + w * 3 + image_id) % 4 AS z FROM frames, range(1, 3) a(s), range(20) b(u), range(15) c(w)) q)"


def _views(spark, sf):
    grid = spark.range(600).select((F.col("id") % 2 + 1).alias("side"), F.floor(F.col("id") / 2).alias("pix"))
    u, w, z = F.col("pix") % 20, F.floor(F.col("pix") / 20), F.col("z")
    # dealt before they multiply, for all of them lie in one file
    dealt = base(spark, sf, "frames").select(F.col("image_id").alias("pair_id")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "pair_id")
    v = dealt.crossJoin(F.broadcast(grid)).withColumn("z", 5.0 + (u * 7 + w * 3 + F.col("pair_id")) % 4)
    shift = (F.col("side") - 1) * 0.5
    camera = [F.lit(25.0).alias("focal"), F.lit(9.5).alias("cx"), F.lit(7.0).alias("cy"), lit(1, 0, 0, 0, 1, 0, 0, 0, 1).alias("rotation"), F.array(shift.cast("double"), F.lit(0.0), F.lit(0.0)).alias("t")]
    return v.select("pair_id", "side", "pix", (z * (u - 9.5) / 25 + shift).alias("x"), (z * (w - 7) / 25).alias("y"), "z", *camera)


@query("reprojected_matches", sql("frames", _VIEWS + """, p AS MATERIALIZED (SELECT pair_id, side, pix, CAST(greatest(0, least(round_even(25 * (x - (2 - side) * 0.5) / z + 9.5, 0), 19)) + 20 * greatest(0, least(round_even(25 * y / z + 7, 0), 14)) AS BIGINT) AS t FROM v)
SELECT a.pair_id, a.pix AS pix1, b.pix AS pix2 FROM (SELECT * FROM p WHERE side = 1) a JOIN (SELECT * FROM p WHERE side = 2) b ON a.pair_id = b.pair_id AND a.t = b.pix WHERE b.t = a.pix"""))
def _(spark, sf):
    return flows.reprojected_matches(_views(spark, sf), (20, 15))


@query("matches_dense", """WITH e AS (SELECT vec_id, CAST(label AS BIGINT) label, embedding::DOUBLE[] v FROM embeddings WHERE (vec_id * 7919) % 10 >= 3),
s AS (SELECT a.label la, a.vec_id va, b.label lb, b.vec_id vb, list_inner_product(a.v, b.v) sim FROM e a JOIN e b ON a.label < b.label),
r AS (SELECT *, row_number() OVER (PARTITION BY va, lb ORDER BY sim DESC, vb) ra, row_number() OVER (PARTITION BY vb, la ORDER BY sim DESC, va) rb FROM s)
SELECT la AS src, lb AS dst, va AS a, vb AS b FROM r WHERE ra = 1 AND rb = 1""")
def _(spark, sf):
    return flows.match_pairs(*_described(spark, sf), 3.0, sparse=False)


def _described(spark, sf):
    d = read(spark, sf, "embeddings").select(F.col("label").cast("long").alias("image_id"), F.col("vec_id").alias("kp"), F.transform("embedding", lambda x: x.cast("double")).alias("v"), ((F.col("vec_id") * 7919) % 10).cast("double").alias("conf"))
    i = base(spark, sf, "images")
    return d, i.select(F.col("image_id").alias("src")).join(i.select(F.col("image_id").alias("dst")), F.col("src") < F.col("dst"))


@query("nearest_by_distance", """WITH e AS (SELECT vec_id, CAST(label AS BIGINT) label, embedding::DOUBLE[] v FROM embeddings),
s AS (SELECT a.label la, a.vec_id va, b.label lb, b.vec_id vb, list_distance(a.v, b.v) d FROM e a JOIN e b ON a.label < b.label),
r AS (SELECT *, row_number() OVER (PARTITION BY va, lb ORDER BY d, vb) ra FROM s) SELECT la AS src, lb AS dst, va AS a, vb AS b, round(-d, 6) AS score FROM r WHERE ra = 1""")
def _(spark, sf):
    d, p = _described(spark, sf)
    return rounded(matching.nearest_both_ways(d, p, "l2").where("forward").drop("forward"))


# --- fusion and losses

@query("gradient_confidence", sql("depths", """d AS (SELECT image_id, x, y, depth / 500 AS depth FROM depths),
g AS (SELECT a.image_id, a.x, a.y, sum((b.x - a.x) * (CASE WHEN b.y = a.y THEN 4.0 ELSE 2.0 END) * b.depth) gx, sum((b.y - a.y) * (CASE WHEN b.x = a.x THEN 4.0 ELSE 2.0 END) * b.depth) gy
 FROM d a JOIN d b ON b.image_id = a.image_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY 1, 2, 3)
SELECT image_id, x, y, round(2 * greatest(0, 1 - sqrt(gx * gx + gy * gy)), 9) AS conf FROM g"""))
def _(spark, sf):
    d = base(spark, sf, "depths").withColumn("depth", F.col("depth") / 500).withColumn("conf", F.lit(2.0))
    return rounded(fusion.gradient_confidence(d).select("image_id", "x", "y", "conf"), 9)


@query("relative_depth_by_angle", sql("views", """p AS (SELECT image_id, other_id, pix, pix % 25 px, pix // 25 py, min(z3) z3, min(conf) conf, min(x3) x3, min(y3) y3 FROM views GROUP BY 1, 2, 3),
c AS (SELECT image_id, other_id, px // 4 bx, py // 4 by_, z3 zc, x3 xc, y3 yc FROM p WHERE px % 4 = 2 AND py % 4 = 2),
a AS (SELECT p.image_id, pix, bx, by_, greatest(sqrt((x3 - xc) ** 2 + (y3 - yc) ** 2), 1e-8) rho, z3 - zc dz, conf FROM p JOIN c ON c.image_id = p.image_id AND c.other_id = p.other_id AND bx = px // 4 AND by_ = py // 4)
SELECT image_id, pix, round(1 + avg(rho) * tan(sum(atan(dz / rho) * (conf - 0.999)) / sum(conf - 0.999)) / (2 + bx + by_), 7) AS rel_depth FROM a GROUP BY image_id, pix, bx, by_"""))
def _(spark, sf):
    v = base(spark, sf, "views").groupBy("image_id", "other_id", "pix").agg(*[F.min(c).alias(c) for c in ("z3", "conf", "x3", "y3")])
    v = v.withColumn("px", F.pmod("pix", F.lit(25))).withColumn("py", F.floor(F.col("pix") / 25))
    canon = v.select("image_id", F.floor(F.col("px") / 4).alias("bx"), F.floor(F.col("py") / 4).alias("by")).distinct().withColumn("zc", 2.0 + F.col("bx") + F.col("by"))
    return rounded(fusion.relative_angle(v, canon, 4), 7)


_POINTMAP = "p AS (SELECT image_id AS batch_id, pos, x + 1 AS gx, z + 2 AS gy, y / 100 + 1 AS gz, x * 1.1 AS x, z + 1.5 AS y, y / 90 AS z, r % 5 <> 0 AS valid, r % 10 = 0 AS sky FROM observed)"


def _pointmap(spark, sf):
    o = base(spark, sf, "observed")
    return o.select(F.col("image_id").alias("batch_id"), "pos", (F.col("x") + 1).alias("gx"), (F.col("z") + 2).alias("gy"), (F.col("y") / 100 + 1).alias("gz"), (F.col("x") * 1.1).alias("x"), (F.col("z") + 1.5).alias("y"), (F.col("y") / 90).alias("z"), (F.col("r") % 5 != 0).alias("valid"), (F.col("r") % 10 == 0).alias("sky"))


@query("pointmap_residuals", sql("observed", _POINTMAP + """, q AS (SELECT batch_id, pos, gx, gy, gz, x, y, z, valid AND sqrt(gx * gx + gy * gy + gz * gz) <= 400 AS v, sky FROM p),
n AS (SELECT batch_id, avg(sqrt(gx * gx + gy * gy + gz * gz)) g, avg(sqrt(x * x + y * y + z * z)) m FROM q WHERE v GROUP BY 1)
SELECT batch_id, pos, round(CASE WHEN v THEN sqrt((x / m - gx / g) ** 2 + (y / m - gy / g) ** 2 + (z / m - gz / g) ** 2) ELSE 2 END, 9) AS residual FROM q JOIN n USING (batch_id) WHERE v OR sky"""))
def _(spark, sf):
    rows = losses.clip_valid(_pointmap(spark, sf), 400.0)
    return rounded(losses.pointmap_residuals(rows, sky_loss=2.0).select("batch_id", "pos", "residual"), 9)


@query("pointmap_residuals_invariant", sql("observed", _POINTMAP + """, s AS (SELECT batch_id, quantile_disc(gz, 0.5) mg, quantile_disc(z, 0.5) mz FROM p WHERE valid GROUP BY 1),
t AS (SELECT batch_id, pos, gx, gy, gz - mg AS gz, x, y, z - mz AS z FROM p JOIN s USING (batch_id) WHERE valid),
c AS (SELECT batch_id, quantile_disc(gx, 0.5) a, quantile_disc(gy, 0.5) b, quantile_disc(gz, 0.5) c, quantile_disc(x, 0.5) d, quantile_disc(y, 0.5) e, quantile_disc(z, 0.5) f FROM t GROUP BY 1),
k AS (SELECT batch_id, quantile_disc(sqrt((gx - a) ** 2 + (gy - b) ** 2 + (gz - c) ** 2), 0.5) g, greatest(1e-3, least(1e3, quantile_disc(sqrt((x - d) ** 2 + (y - e) ** 2 + (z - f) ** 2), 0.5))) m FROM t JOIN c USING (batch_id) GROUP BY 1)
SELECT batch_id, pos, round(sqrt((x / m - gx / g) ** 2 + (y / m - gy / g) ** 2 + (z / m - gz / g) ** 2), 7) AS residual FROM t JOIN k USING (batch_id)"""))
def _(spark, sf):
    rows = losses.pointmap_residuals(_pointmap(spark, sf), normalise=False, shift=True, scale=True)
    return rounded(rows.select("batch_id", "pos", "residual"), 7)


@query("matching_confidence_loss", sql("raw", "p AS (SELECT pix1::DOUBLE l, conf1 * conf2 c FROM raw WHERE pos % 2 = 0), q AS (SELECT (conf1 + conf2) / 2 c FROM raw WHERE pos % 2 = 1) SELECT round((SELECT avg(l * c - 0.2 * ln(c)) FROM p) + (SELECT avg((SELECT quantile_cont(l, 0.9) FROM p) * c - 0.2 * ln(c)) FROM q), 6) AS loss"))
def _(spark, sf):
    r, both = base(spark, sf, "raw"), (F.col("conf1"), F.col("conf2"))
    good = r.where("pos % 2 = 0").select(F.col("pix1").cast("double").alias("loss"), losses.fused_confidence(*both).alias("conf"))
    bad = r.where("pos % 2 = 1").select(losses.fused_confidence(*both, "mean").alias("conf"))
    return rounded(losses.matching_confidence_loss(good, bad, 0.2, 0.9))


@query("loss_3d", sql("observed", "SELECT image_id, round(sum(r * (pow(d + 4.0 / 9, 1.5) - pow(4.0 / 9, 1.5))) / sum(r), 6) AS loss FROM (SELECT image_id, r + 1 AS r, sqrt((x - z) ** 2 + (y / 100 - x) ** 2 + (z - 1) ** 2) d FROM observed) q GROUP BY 1"))
def _(spark, sf):
    c = F.col
    o = base(spark, sf, "observed").select("image_id", c("x").alias("x1"), (c("y") / 100).alias("y1"), c("z").alias("z1"), c("z").alias("x2"), c("x").alias("y2"), F.lit(1.0).alias("z2"), (c("r") + 1).alias("conf"))
    return rounded(losses.loss_3d(o, lambda d: geo.robust(d, 1.5), ("image_id",)))


@query("loss_2d", sql("observed", "SELECT image_id, round(sum(r * sqrt(sqrt((pix - (50 * x + 20 * (z + 1)) / (z + 1)) ** 2 + (g - (50 * y / 100 + 10 * (z + 1)) / (z + 1)) ** 2))) / sum(r), 6) AS loss FROM (SELECT image_id, pix, x, y, z, g, r + 1 AS r FROM observed) q GROUP BY 1"))
def _(spark, sf):
    o = base(spark, sf, "observed").select("image_id", F.col("pix").cast("double").alias("u"), F.col("g").cast("double").alias("v"), "x", (F.col("y") / 100).alias("y"), F.col("z"), (F.col("r") + 1).alias("conf"), lit(50, 0, 20, 20, 0, 50, 10, 10, 0, 0, 1, 1).alias("m"))
    return rounded(losses.loss_2d(o, geo.l05, ("image_id",)))


@query("loss_regression", sql("observed", "SELECT image_id, round(sum(r * sqrt((x - (z + 1)) ** 2 + (y / 100 - (x * 0.5 + 2)) ** 2 + (z - (y / 100 + 3)) ** 2)) / sum(r), 6) AS loss FROM (SELECT image_id, x, y, z, r + 1 AS r FROM observed) q GROUP BY 1"))
def _(spark, sf):
    c = F.col
    o = base(spark, sf, "observed").select("image_id", c("x").alias("x1"), (c("y") / 100).alias("y1"), c("z").alias("z1"), (c("x") / 2).alias("x"), (c("y") / 100).alias("y"), "z", (c("r") + 1).alias("conf"), lit(0, 0, 1, 1, 0, 0, 0, 1, 0).alias("rotation"), lit(1, 2, 3).alias("t"))
    return rounded(losses.loss_regression(o, lambda d: d, ("image_id",)))


@query("similarity_normalised", "WITH e AS (SELECT vec_id, embedding::DOUBLE[] v FROM embeddings), n AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) n FROM e) SELECT vec_id, round(v[1] / n, 9) AS first, round(v[2] / n, 9) AS second FROM n")
def _(spark, sf):
    n = read(spark, sf, "embeddings").select("vec_id", retrieval.normalised(F.col("embedding")).alias("v"))
    return rounded(n.select("vec_id", F.col("v")[0].alias("first"), F.col("v")[1].alias("second")), 9)


# --- the sparse model

def _model(spark, sf):
    o = base(spark, sf, "observed")
    seen = o.select(F.col("track_id").alias("point_id"), "image_id", "x", F.col("pix").cast("double").alias("y"))
    points = o.groupBy(F.col("track_id").alias("point_id")).agg(F.min("x").alias("x"), F.lit(2.0).alias("y"), F.lit(3.0).alias("z"), F.min("r").alias("r"), F.lit(0).alias("g"), F.lit(0).alias("b"))
    return model.sparse_model(points, seen)


_KEPT = "o AS (SELECT track_id AS point_id, image_id, x, pix::DOUBLE AS y FROM observed), k AS (SELECT point_id, row_number() OVER (ORDER BY point_id) AS new_id FROM (SELECT point_id FROM o GROUP BY 1 HAVING count(*) >= 2) q)"


@query("sparse_model_points", sql("observed", _KEPT + " SELECT new_id AS point_id, min(x) AS x, min(r) AS r FROM observed JOIN k ON k.point_id = track_id GROUP BY 1"))
def _(spark, sf):
    return _model(spark, sf)[0].select("point_id", "x", "r")


@query("sparse_model_observations", sql("observed", _KEPT + " SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY o.point_id, x, y) - 1 AS idx, x, y, new_id AS point_id FROM o LEFT JOIN k ON k.point_id = o.point_id"))
def _(spark, sf):
    return _model(spark, sf)[1]


@query("tile_manifest", sql("photos", "SELECT format('{{\"tile_id\":\"{}_tile_0000\",\"image_id\":{},\"x0\":0,\"y0\":0,\"x1\":{},\"y1\":{}}}', image_id, image_id, width, height) AS value FROM photos"))
def _(spark, sf):
    tiles = tiling.edge_aligned(base(spark, sf, "photos"), size=1 << 20, overlap=128)
    return model.tile_manifest(tiles.withColumn("tile_data", F.lit(None).cast("binary")))



@query("words_assigned", "WITH e AS (SELECT vec_id, embedding::DOUBLE[] v FROM embeddings), c AS (SELECT vec_id AS word, v FROM e WHERE vec_id % 16 = 3), r AS (SELECT e.vec_id AS id, word, list_distance(e.v, c.v) d, e.v[1] - c.v[1] AS x, row_number() OVER (PARTITION BY e.vec_id ORDER BY list_distance(e.v, c.v), word) AS rank FROM e, c) SELECT id, CAST(rank AS INT) AS rank, word, round(d, 6) AS d, round(x, 6) AS residual FROM r WHERE rank <= 5")
def _(spark, sf):
    e = read(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    found = retrieval.assign_words(e, e.where("id % 16 = 3").select(F.col("id").alias("word"), "v"), 5)
    return rounded(found.select("id", "rank", "word", "d", F.col("residual")[0].alias("residual")))


@query("blocks_of_evaluation", "WITH n AS (SELECT count(*) n FROM lineitem) SELECT CAST(i AS BIGINT) AS block, CAST(least(1000, n - 1000 * i) AS BIGINT) AS n FROM n, (SELECT unnest(range(1 + (SELECT (n - 1) // 1000 FROM n))) i) q WHERE n > 1000 * i")
def _(spark, sf):
    return retrieval.blocks_by_hash(base(spark, sf, "points").select("pos"), "pos", 1000).groupBy("block").agg(F.count("*").alias("n"))


@query("localisation_stats", sql("observed", "SELECT image_id, count(*) AS n, round(quantile_cont(x / 10, 0.5), 6) AS position, round(quantile_cont(z, 0.5), 6) AS angle, " + ", ".join(f"round(avg(CASE WHEN x / 10 <= {p} AND z <= {a} THEN 1 ELSE 0 END), 6) AS within_{i}" for i, (p, a) in enumerate(((0.25, 2.0), (0.5, 5.0), (5.0, 10.0)))) + " FROM observed GROUP BY 1"))
def _(spark, sf):
    e = base(spark, sf, "observed").select("image_id", (F.col("x") / 10).alias("position"), F.col("z").alias("angle"))
    return rounded(retrieval.localisation_stats(e, by=("image_id",)))


@query("pose_lines", sql("photos", "SELECT 'im' || image_id || '.png 1.0 0.0 0.0 0.0 0.5 ' || CAST(image_id AS DOUBLE) || ' 2.5' AS value FROM photos WHERE image_id % 5 <> 0"))
def _(spark, sf):
    p = base(spark, sf, "photos")
    q = F.when(F.col("image_id") % 5 != 0, lit(1, 0, 0, 0))
    return retrieval.pose_lines(p.select(F.concat(F.lit("im"), F.col("image_id").cast("string"), F.lit(".png")).alias("name"), q.alias("qvec"), F.array(F.lit(0.5), F.col("image_id").cast("double"), F.lit(2.5)).alias("tvec")))

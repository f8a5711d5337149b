"""Named queries of retrieval kernels, guarded tracks, footprints and reconstruction, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import canonical, flows, footprints, kernels, refine, spectral, tracks
from ..sources import files, model, readers
from ..sources.cache import PairCache
from ..sources.shared import new_folder, stash
from . import catalog
from .base import base, read, rounded, sql
from .catalog import ORACLES, query
from .more import _described

lit = lambda *xs: F.array(*[F.lit(float(x)) for x in xs])


# --- visual words

def _trained(rounds: int) -> str:
    """Rounds of k-means from every 16th vector."""
    parts = ["e AS (SELECT vec_id AS id, vec_id // 10 AS image_id, embedding::DOUBLE[] AS v FROM embeddings)", "b0 AS (SELECT id AS word, 0 AS n, v FROM e WHERE id % 16 = 3)"]
    for r in range(rounds):
        parts += [
            f"a{r} AS (SELECT id, word, e.v FROM e, b{r} QUALIFY row_number() OVER (PARTITION BY id ORDER BY list_distance(e.v, b{r}.v), word) = 1)",
            f"c{r} AS (SELECT word, max(n) AS n, list(x ORDER BY pos) AS v FROM (SELECT word, pos, count(*) AS n, avg(x) AS x FROM (SELECT word, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{r}) q GROUP BY 1, 2) q GROUP BY 1)",
            f"b{r + 1} AS (SELECT b{r}.word, coalesce(c{r}.n, 0) AS n, coalesce(c{r}.v, b{r}.v) AS v FROM b{r} LEFT JOIN c{r} USING (word))",
        ]
    return "WITH " + ",\n".join(parts)


def _signed(name: str, book: str, k: int) -> str:
    return f"""{name}_near AS (SELECT image_id, id, word, e.v, {book}.v AS w FROM e, {book} QUALIFY row_number() OVER (PARTITION BY id ORDER BY list_distance(e.v, {book}.v), word) <= {k}),
{name}_sum AS (SELECT image_id, word, pos, count(*) AS n, sum(x - y) AS r FROM (SELECT image_id, word, unnest(v) AS x, unnest(w) AS y, generate_subscripts(v, 1) AS pos FROM {name}_near) q GROUP BY 1, 2, 3),
{name} AS (SELECT image_id, word, max(n) AS n, string_agg(CASE WHEN r > 1e-9 THEN '1' ELSE '0' END, '' ORDER BY pos) AS bits FROM {name}_sum GROUP BY 1, 2)"""


def _features(spark, sf):
    return read(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 10).alias("image_id"), F.col("vec_id").cast("long").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))


def _codebook(spark, sf, rounds):
    f = _features(spark, sf)
    return kernels.train_codebook(f, f.where("id % 16 = 3").select(F.col("id").alias("word"), "v"), rounds)


@query("codebook_trained", _trained(3) + " SELECT word, n, CAST(pos - 1 AS INT) AS pos, round(value, 6) AS value FROM (SELECT word, n, unnest(v) AS value, generate_subscripts(v, 1) AS pos FROM b3) q")
def _(spark, sf):
    return rounded(_codebook(spark, sf, 3).select("word", "n", F.posexplode("v").alias("pos", "value")))


@query("image_signatures", _trained(1) + ",\n" + _signed("s", "b1", 5) + " SELECT * FROM s")
def _(spark, sf):
    found = kernels.image_words(_features(spark, sf), _codebook(spark, sf, 1), 5)
    return found.select("image_id", "word", "n", F.array_join(F.transform("bits", lambda b: F.lpad(F.bin(b), 64, "0")), "").alias("bits"))


@query("kernel_scores", _trained(2) + ",\n" + _signed("d", "b2", 1) + ",\n" + _signed("q", "b2", 5) + """,
p AS (SELECT q.image_id AS i, d.image_id AS j, 1 - 2 * hamming(q.bits, d.bits) / length(q.bits)::DOUBLE AS sim FROM q JOIN d USING (word)),
nq AS (SELECT image_id AS i, count(*) AS ni FROM q GROUP BY 1), nd AS (SELECT image_id AS j, count(*) AS nj FROM d GROUP BY 1)
SELECT i, j, round(sum(pow(sim, 3)) / sqrt(max(ni) * max(nj)), 9) AS s FROM p JOIN nq USING (i) JOIN nd USING (j) WHERE sim > 0 GROUP BY i, j""")
def _(spark, sf):
    return rounded(kernels.retrieval_scores(_features(spark, sf), _codebook(spark, sf, 2)), 9)


# --- guarded tracks

#: Rounds that merge the tracks whose least edge is the same, over edges k (src, a, dst, b).
_GUARDED = """ed AS (SELECT va, vb, row_number() OVER (ORDER BY va, vb) AS o FROM (SELECT DISTINCT least(s, d) AS va, greatest(s, d) AS vb FROM (SELECT src * 1000000000 + a AS s, dst * 1000000000 + b AS d FROM k) q) q),
grown(step, v, root) AS (
  SELECT 0, v, v FROM (SELECT va AS v FROM ed UNION SELECT vb FROM ed) q
  UNION ALL (
    WITH own AS (SELECT root, list(v // 1000000000) AS images FROM grown GROUP BY 1),
    live AS (SELECT o, least(a.root, b.root) AS x, greatest(a.root, b.root) AS y FROM ed JOIN grown a ON a.v = va JOIN grown b ON b.v = vb JOIN own p ON p.root = a.root JOIN own q ON q.root = b.root WHERE a.root <> b.root AND NOT list_has_any(p.images, q.images)),
    firsts AS (SELECT root, min(o) AS o FROM (SELECT x AS root, o FROM live UNION ALL SELECT y, o FROM live) q GROUP BY 1),
    won AS (SELECT x, y FROM live JOIN firsts f ON f.root = x AND f.o = live.o JOIN firsts g ON g.root = y AND g.o = live.o)
    SELECT step + 1, v, coalesce(x, root) FROM grown LEFT JOIN won ON y = root WHERE EXISTS (SELECT 1 FROM won)))
SELECT v // 1000000000 AS image_id, v % 1000000000 AS kp_id, format('{:012d}:{:012d}', root // 1000000000, root % 1000000000) AS track_id FROM grown WHERE step = (SELECT max(step) FROM grown)"""

ORACLES["guarded_tracks"] = "WITH RECURSIVE " + catalog._TRACKS.split(",\nu AS", 1)[0].removeprefix("WITH ") + ",\n" + _GUARDED


@query("guarded_tracks_in_rounds", sql("raw", "k AS (SELECT src, pix1 AS a, dst, pix2 AS b FROM raw WHERE conf1 * conf2 >= 16),\n" + _GUARDED))
def _(spark, sf):
    rows = base(spark, sf, "raw").where("conf1 * conf2 >= 16").select("src", F.col("pix1").alias("a_kp"), "dst", F.col("pix2").alias("b_kp"))
    return tracks.guarded_tracks(rows, group_edges=400)


# --- footprints

#: Convex quadrilaterals on a lattice, and geotransforms with pixels of several sizes.
_PRINTS = """f AS (SELECT image_id, (image_id % 100) * 41.0 + (image_id % 13) AS x, (image_id // 100) * 37.0 + (image_id % 11) AS y,
 CASE WHEN image_id % 50 = 7 THEN 400.0 ELSE 25.0 + image_id % 31 END AS w, 20.0 + image_id % 17 AS h, 0.5 + (image_id % 4) * 0.25 AS s FROM photos)"""


def _prints(spark, sf):
    i, lat = F.col("image_id"), lambda d: d.cast("double")
    f = base(spark, sf, "photos").select("image_id", (lat(i % 100) * 41 + i % 13).alias("x"), (lat(F.floor(i / 100)) * 37 + i % 11).alias("y"), F.when(i % 50 == 7, 400.0).otherwise(25.0 + i % 31).alias("w"), (20.0 + i % 17).alias("h"), (0.5 + (i % 4) * 0.25).alias("s"))
    x, y, w, h, s = (F.col(c) for c in "xywhs")
    ring = [x - w, y, x, y - h, x + w, y + h / 2, x, y + h]
    turned = F.when(i % 2 == 0, F.array(*ring)).otherwise(F.array(*[ring[k] for k in (6, 7, 4, 5, 2, 3, 0, 1, 6, 7)]))
    geo_transform = F.array(x - w, s, F.lit(0.0), y + h, F.lit(0.0), -s)
    return f.select("image_id", turned.alias("ring"), geo_transform.alias("geo"))


_OVERLAPS = sql("photos", _PRINTS + """,
v AS (SELECT image_id, unnest([1, 2, 3, 4]) AS n, unnest([x - w, x, x + w, x]) AS px, unnest([y, y - h, y + h / 2, y + h]) AS py, unnest([x, x + w, x, x - w]) AS qx, unnest([y - h, y + h / 2, y + h, y]) AS qy FROM f),
c AS (SELECT a.image_id AS a, b.image_id AS b FROM f a JOIN f b ON a.image_id < b.image_id AND a.x - a.w < b.x + b.w AND b.x - b.w < a.x + a.w AND a.y - a.h < b.y + b.h AND b.y - b.h < a.y + a.h),
o AS (SELECT a, b, b AS other, a AS own FROM c UNION ALL SELECT a, b, a, b FROM c),
inside AS (SELECT o.a, o.b, p.px AS x, p.py AS y FROM o JOIN v p ON p.image_id = own JOIN v e ON e.image_id = other GROUP BY o.a, o.b, o.own, p.n, p.px, p.py HAVING min((e.qx - e.px) * (p.py - e.py) - (e.qy - e.py) * (p.px - e.px)) >= 0),
crossed AS (SELECT c.a, c.b, p.px + t * (p.qx - p.px) AS x, p.py + t * (p.qy - p.py) AS y FROM c JOIN v p ON p.image_id = c.a JOIN v e ON e.image_id = c.b,
  LATERAL (SELECT (p.qx - p.px) * (e.qy - e.py) - (p.qy - p.py) * (e.qx - e.px) AS d) k, LATERAL (SELECT ((e.px - p.px) * (e.qy - e.py) - (e.py - p.py) * (e.qx - e.px)) / d AS t, ((e.px - p.px) * (p.qy - p.py) - (e.py - p.py) * (p.qx - p.px)) / d AS u) l
  WHERE d <> 0 AND t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1),
points AS (SELECT * FROM inside UNION ALL SELECT * FROM crossed),
middle AS (SELECT a, b, avg(x) AS mx, avg(y) AS my FROM points GROUP BY 1, 2),
around AS (SELECT a, b, x - mx AS x, y - my AS y, lead(x - mx, 1, first_x - mx) OVER w AS nx, lead(y - my, 1, first_y - my) OVER w AS ny FROM (
  SELECT *, first_value(x) OVER r AS first_x, first_value(y) OVER r AS first_y FROM points JOIN middle USING (a, b) WINDOW r AS (PARTITION BY a, b ORDER BY atan2(y - my, x - mx), x, y)) q
  WINDOW w AS (PARTITION BY a, b ORDER BY atan2(y - my, x - mx), x, y)),
areas AS (SELECT a, b, sum(x * ny - nx * y) / 2 AS area FROM around GROUP BY 1, 2),
ways AS (SELECT a AS src, b AS dst, area FROM areas WHERE area > 0.001 UNION ALL SELECT b, a, area FROM areas WHERE area > 0.001)
SELECT src, dst, round(area, 4) AS area, round(p.s / q.s, 6) AS mx, round((p.x - p.w - (q.x - q.w)) / q.s, 5)::DOUBLE + 0.0 AS tx, round((q.y + q.h - (p.y + p.h)) / q.s, 5)::DOUBLE + 0.0 AS ty
FROM ways JOIN f p ON p.image_id = src JOIN f q ON q.image_id = dst""")


@query("footprint_pairs", _OVERLAPS)
def _(spark, sf):
    found = footprints.footprint_pairs(_prints(spark, sf), 0.001)
    m = F.col("m")
    return found.select("src", "dst", F.round("area", 4).alias("area"), F.round(m[0], 6).alias("mx"), (F.round(m[2], 5) + 0.0).alias("tx"), (F.round(m[5], 5) + 0.0).alias("ty"))


# --- depth refinement

#: Depths of 16 x 12 pixels an image, some missing, and cameras beside each other.
_MAPS = """d AS (SELECT CAST(l_suppkey AS BIGINT) AS image_id, CAST(l_partkey % 16 AS INT) AS x, CAST(l_orderkey % 12 AS INT) AS y, 20 + avg(l_quantity) / 5 AS depth, avg(l_discount) * 10 AS conf FROM lineitem GROUP BY 1, 2, 3),
c AS (SELECT DISTINCT image_id, 18.0 AS focal, 7.5 AS cx, 5.5 AS cy, (image_id % 7) * 0.75 AS tx, (image_id % 3) * 0.5 AS tz FROM d),
n AS (SELECT a.image_id AS src, b.image_id AS dst FROM c a JOIN c b ON abs(a.image_id - b.image_id) <= 2)"""


def _maps(spark, sf):
    line = read(spark, sf, "lineitem")
    d = line.groupBy(F.col("l_suppkey").cast("long").alias("image_id"), (F.col("l_partkey") % 16).cast("int").alias("x"), (F.col("l_orderkey") % 12).cast("int").alias("y")).agg((20 + F.avg("l_quantity") / 5).alias("depth"), (F.avg("l_discount") * 10).alias("conf"))
    i = F.col("image_id")
    c = d.select("image_id").distinct().select("image_id", F.lit(18.0).alias("focal"), F.lit(7.5).alias("cx"), F.lit(5.5).alias("cy"), lit(1, 0, 0, 0, 1, 0, 0, 0, 1).alias("rotation"), F.array((i % 7) * 0.75, F.lit(0.0), (i % 3) * 0.5).alias("t"), F.lit(16).alias("width"), F.lit(12).alias("height"))
    near = c.select(F.col("image_id").alias("src"), F.explode(F.array(F.col("image_id") + 1, F.col("image_id") + 2)).alias("dst"))
    return stash(d, "maps"), c, near


@query("refined_depths", "WITH " + _MAPS + """,
k AS (SELECT d.*, s, ((((0 * 69069 + 5 + 1) % 2147483647 * 69069 + image_id + 1) % 2147483647 * 69069 + (y * 16 + x) + 1) % 2147483647 * 69069 + s + 1) % 2147483647 AS h FROM d, range(24) r(s)),
u AS (SELECT *, (((h * 16807 + 7) % 2147483647 * 48271) % 2147483647 + 1) / 2147483648.0::DOUBLE AS a, (((h * 48271 + 11) % 2147483647 * 16807) % 2147483647 + 1) / 2147483648.0::DOUBLE AS b FROM k),
t AS (SELECT u.image_id, x, y, s, depth, depth + (sqrt(-2 * ln(a)) * cos(2 * pi() * b) - 1) * 2 AS tried, focal, cx, cy, tx, tz FROM u JOIN c USING (image_id)),
p AS (SELECT t.image_id, t.x, t.y, s, t.depth, tried, dst, (tried * (t.x - t.cx) / t.focal + t.tx - v.tx) AS px, tried * (t.y - t.cy) / t.focal AS py, tried + t.tz - v.tz AS pz, v.focal, v.cx, v.cy FROM t JOIN n ON n.src = t.image_id JOIN c v ON v.image_id = n.dst),
q AS (SELECT p.*, d.depth - pz AS sdf, exp(d.conf) AS w FROM p LEFT JOIN d ON pz <> 0 AND d.image_id = dst AND d.x = round_even(p.focal * px / pz + p.cx, 0) AND d.y = round_even(p.focal * py / pz + p.cy, 0)),
f AS (SELECT image_id, x, y, s, any_value(depth) AS depth, any_value(tried) AS tried, abs(sum(greatest(sdf, -2) * w) FILTER (sdf >= -2) / sum(w) FILTER (sdf >= -2)) AS far FROM q GROUP BY 1, 2, 3, 4)
SELECT image_id, x, y, CAST(count(far) AS INT) AS seen, round(CASE WHEN count(far) = 0 OR count(*) FILTER (far = 2) = count(*) THEN any_value(depth) ELSE arg_min(tried, coalesce(far, 1e300) + s * 1e-13) END, 6) AS depth FROM f GROUP BY 1, 2, 3""")
def _(spark, sf):
    return rounded(refine.refined_depths(*_maps(spark, sf), threshold=2.0, samples=24, seed=5))


@query("world_points", "WITH " + _MAPS + " SELECT image_id, x, y, round(depth * (x - cx) / focal + tx, 6) AS wx, round(depth * (y - cy) / focal, 6)::DOUBLE + 0.0 AS wy, round(depth + tz, 6) AS wz FROM d JOIN c USING (image_id)")
def _(spark, sf):
    d, c, _ = _maps(spark, sf)
    return rounded(refine.world_points(d, c).select("image_id", "x", "y", "wx", (F.col("wy") + 0.0).alias("wy"), "wz"))


# --- canonical maps

#: Views of 12 x 8 pixels an image with up to four partners; blocks of 4 x 4.
_CANON = """v AS (SELECT CAST(l_suppkey AS BIGINT) AS image_id, CAST(l_partkey % 4 AS BIGINT) AS other_id, CAST(l_partkey % 12 AS BIGINT) AS px, CAST(l_orderkey % 8 AS BIGINT) AS py, 1 + avg(l_tax) * 9.1 AS conf, 5 + avg(l_quantity) / 9.7 AS z3, avg(l_discount) AS k FROM lineitem GROUP BY 1, 2, 3, 4),
w AS (SELECT image_id, other_id, px, py, conf, z3, z3 * (px - 6) * (1 + k) / 13.7 AS x3, z3 * (py - 4) * (1 - k) / 13.7 AS y3, px + 12 * py AS pix, conf - 0.999 AS e FROM v),
canon AS (SELECT image_id, pix, any_value(px) AS px, any_value(py) AS py, sum(e * x3) / sum(e) AS x3, sum(e * y3) / sum(e) AS y3, sum(e * z3) / sum(e) AS z3, sum(e * e) / sum(e) AS conf FROM w GROUP BY 1, 2),
rel AS (SELECT w.image_id, w.pix, sum(w.e * w.z3 / c.z3) / sum(w.e) AS rel FROM w JOIN w c ON c.image_id = w.image_id AND c.other_id = w.other_id AND c.px % 4 = 2 AND c.py % 4 = 2 AND c.px // 4 = w.px // 4 AND c.py // 4 = w.py // 4 GROUP BY 1, 2),
o AS (SELECT image_id, px - 6 AS p0, py - 4 AS p1, x3 / z3 AS q0, y3 / z3 AS q1 FROM canon),
f0 AS (SELECT image_id, sum(p0 * q0 + p1 * q1) / sum(q0 * q0 + q1 * q1) AS f FROM o GROUP BY 1),
f1 AS (SELECT image_id, sum((p0 * q0 + p1 * q1) / greatest(1e-8, sqrt((p0 - f * q0) ** 2 + (p1 - f * q1) ** 2))) / sum((q0 * q0 + q1 * q1) / greatest(1e-8, sqrt((p0 - f * q0) ** 2 + (p1 - f * q1) ** 2))) AS f FROM o JOIN f0 USING (image_id) GROUP BY 1),
f2 AS (SELECT image_id, sum((p0 * q0 + p1 * q1) / greatest(1e-8, sqrt((p0 - f * q0) ** 2 + (p1 - f * q1) ** 2))) / sum((q0 * q0 + q1 * q1) / greatest(1e-8, sqrt((p0 - f * q0) ** 2 + (p1 - f * q1) ** 2))) AS f FROM o JOIN f1 USING (image_id) GROUP BY 1),
usual AS (SELECT 12 / (2 * tan(radians(30))) AS u), focal AS (SELECT image_id, greatest(0.5 * u, least(3.5 * u, f)) AS base FROM f2, usual),
pixels AS (SELECT image_id, c.px, c.py, c.x3, c.y3, c.z3, c.conf, base, (c.py // 4) * 3 + c.px // 4 AS anchor, r.rel / m.rel AS ratio FROM canon c JOIN rel r USING (image_id, pix) JOIN focal USING (image_id)
  JOIN (SELECT image_id, pix % 12 // 4 AS bx, pix // 12 // 4 AS by_, rel FROM rel WHERE pix % 12 % 4 = 2 AND pix // 12 % 4 = 2) m USING (image_id) WHERE bx = c.px // 4 AND by_ = c.py // 4),
core AS (SELECT image_id, (py // 4) * 3 + px // 4 AS anchor, z3 AS depth FROM canon WHERE px % 4 = 2 AND py % 4 = 2)"""


def _canonical(spark, sf):
    line = read(spark, sf, "lineitem")
    v = line.groupBy(F.col("l_suppkey").cast("long").alias("image_id"), (F.col("l_partkey") % 4).cast("long").alias("other_id"), (F.col("l_partkey") % 12).cast("long").alias("px"), (F.col("l_orderkey") % 8).cast("long").alias("py"))
    v = v.agg((1 + F.avg("l_tax") * 9.1).alias("conf"), (5 + F.avg("l_quantity") / 9.7).alias("z3"), F.avg("l_discount").alias("k"))
    z, k = F.col("z3"), F.col("k")
    v = v.withColumns({"x3": z * (F.col("px") - 6) * (1 + k) / 13.7, "y3": z * (F.col("py") - 4) * (1 - k) / 13.7}).drop("k")
    c = line.select(F.col("l_suppkey").cast("long").alias("image_id")).distinct().select("image_id", F.lit(6.0).alias("cx"), F.lit(4.0).alias("cy"), F.lit(12).alias("width"), F.lit(8).alias("height"))
    return c, *canonical.canonical_maps(v, c, 4, rounds=2)


@query("canonical_pixels", "WITH " + _CANON + " SELECT image_id, px, py, round(x3, 6)::DOUBLE + 0.0 AS x3, round(y3, 6)::DOUBLE + 0.0 AS y3, round(z3, 6) AS z3, round(conf, 6) AS conf, round(base, 5) AS base_focal, anchor, round(ratio, 6) AS ratio FROM pixels")
def _(spark, sf):
    _, p, _ = _canonical(spark, sf)
    six = lambda *cs: [(F.round(c, 6) + 0.0).alias(c) for c in cs]
    return p.select("image_id", "px", "py", *six("x3", "y3", "z3", "conf", "ratio"), F.round("base_focal", 5).alias("base_focal"), "anchor")


@query("dense_points", "WITH " + _CANON + """, d AS (SELECT image_id, px, py, depth * (1 + (ratio - 1) * base / 15) AS depth FROM pixels JOIN core USING (image_id, anchor))
SELECT image_id, px, py, round(depth, 6) AS depth, round(depth + 1, 6) AS wx, round(depth * (px - 6) / 15 + 2, 6)::DOUBLE + 0.0 AS wy, round(depth * (py - 4) / 15 + 3, 6)::DOUBLE + 0.0 AS wz FROM d""")
def _(spark, sf):
    c, p, core = _canonical(spark, sf)
    found = c.select("image_id", F.lit(15.0).alias("focal"), "cx", "cy", lit(0, 0, 1, 1, 0, 0, 0, 1, 0).alias("rotation"), lit(1, 2, 3).alias("t"))
    d = canonical.dense_points(p, core, found)
    return d.select("image_id", "px", "py", *[(F.round(x, 6) + 0.0).alias(x) for x in ("depth", "wx", "wy", "wz")])


# --- coarse to fine

@query("coarse_to_fine", """WITH e AS (SELECT vec_id AS kp, CAST(label AS BIGINT) AS image, CAST(label AS BIGINT) * 4 + vec_id % 4 AS crop, embedding::DOUBLE[] AS v, vec_id % 64 AS u, (vec_id * 7) % 48 AS w FROM embeddings WHERE (vec_id * 31) % 10 >= 2),
s AS (SELECT a.crop ca, b.crop cb, a.image ia, b.image ib, a.kp ka, b.kp kb, a.u ua, a.w wa, b.u ub, b.w wb, list_inner_product(a.v, b.v) sim FROM e a JOIN e b ON b.image = a.image + 1),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY ka, cb ORDER BY sim DESC, kb) = 1 AND row_number() OVER (PARTITION BY kb, ca ORDER BY sim DESC, ka) = 1),
l AS (SELECT ia AS src, ib AS dst, (0.5 * ua + 10 * (ca % 4)) / (1 + 0.001 * ua) AS x1, (0.5 * wa + 7 * (ca % 4)) / (1 + 0.001 * ua) AS y1, (0.5 * ub + 10 * (cb % 4)) / (1 + 0.001 * ub) AS x2, (0.5 * wb + 7 * (cb % 4)) / (1 + 0.001 * ub) AS y2, sim FROM m)
SELECT src, dst, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2, round(sim, 6) AS score, n FROM (
  SELECT *, count(*) OVER g AS n, row_number() OVER (PARTITION BY src, dst, round_even(x1, 0), round_even(y1, 0), round_even(x2, 0), round_even(y2, 0) ORDER BY sim DESC, x1, y1, x2, y2) AS r
  FROM l WINDOW g AS (PARTITION BY src, dst, round_even(x1, 0), round_even(y1, 0), round_even(x2, 0), round_even(y2, 0))) q WHERE r = 1""")
def _(spark, sf):
    i = F.col("vec_id")
    e = read(spark, sf, "embeddings").select((F.col("label") * 4 + i % 4).cast("long").alias("crop_id"), i.alias("kp"), (i % 64).cast("double").alias("u"), (i * 7 % 48).cast("double").alias("v"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"), (i * 31 % 10).cast("double").alias("conf"))
    c, k = F.col("crop_id"), (F.col("crop_id") % 4).cast("double")
    zero = F.lit(0.0)
    crops = e.select("crop_id").distinct().select("crop_id", F.floor(c / 4).alias("image_id"), F.array(F.lit(0.5), zero, 10 * k, zero, F.lit(0.5), 7 * k, F.lit(0.001), zero, F.lit(1.0)).alias("m"))
    near = crops.select(F.col("crop_id").alias("crop1"), F.explode(F.array(*[(F.floor(c / 4) + 1) * 4 + j for j in range(4)])).alias("crop2"))
    return rounded(flows.coarse_to_fine(e, crops, near, 2.0))


# --- the sparse model, written and read back

@query("model_read_back", sql("observed", """o AS (SELECT track_id AS point_id, image_id, x, pix::DOUBLE AS y FROM observed), often AS (SELECT point_id, row_number() OVER (ORDER BY point_id) AS new_id FROM (SELECT point_id FROM o GROUP BY 1 HAVING count(*) >= 2) q)
SELECT image_id, 'im' || image_id || '.png' AS name, row_number() OVER (PARTITION BY image_id ORDER BY o.point_id, o.x, o.y) - 1 AS idx, o.x, o.y, coalesce(new_id, -1) AS point_id FROM o LEFT JOIN often USING (point_id)"""))
def _(spark, sf):
    o = base(spark, sf, "observed")
    seen = o.select(F.col("track_id").alias("point_id"), "image_id", "x", F.col("pix").cast("double").alias("y"))
    points = o.groupBy(F.col("track_id").alias("point_id")).agg(F.min("x").alias("x"), F.lit(2.0).alias("y"), F.lit(3.0).alias("z"), F.min("r").alias("r"), F.lit(0).alias("g"), F.lit(0).alias("b"))
    poses = o.select("image_id").distinct().select("image_id", lit(1, 0, 0, 0).alias("qvec"), lit(0, 0, 0.5).alias("tvec"), F.lit(1).alias("camera_id"), F.concat(F.lit("im"), F.col("image_id").cast("string"), F.lit(".png")).alias("name"))
    cameras = spark.createDataFrame([(1, "PINHOLE", 64, 48, [50.0, 50.0, 32.0, 24.0])], "camera_id long, model string, width int, height int, params array<double>")
    folder = new_folder(spark, "model")
    model.write_sparse_model(folder, cameras, poses, points, seen)
    images = readers.read_model(spark, folder)["images"]
    return images.select("image_id", "name", F.posexplode("points").alias("idx", "p")).select("image_id", "name", F.col("idx").cast("long").alias("idx"), "p.x", "p.y", "p.point_id")


# --- the pair cache

@query("cached_matches", f"WITH {catalog._MUTUAL} SELECT dst AS src, src AS dst, b AS a, a AS b FROM m")
def _(spark, sf):
    d, pairs = _described(spark, sf)
    cache = PairCache(spark, new_folder(spark, "pair-cache"), {"threshold": 0.0, "metric": "dot"})
    compute = lambda p: flows.match_pairs(d, p, 0.0, sparse=False)
    cache.fill(pairs.where("(src + dst) % 3 <> 0"), compute)
    return cache.through(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst")), compute).select("src", "dst", "a", "b")


# --- low-rank depths

@query("low_rank_fit", "WITH " + _MAPS + " SELECT image_id, CAST(count(*) AS INT) AS n, CAST(least(count(*), 400) AS INT) AS rank, round(sum(depth), 4) AS total, round(sum(depth * depth), 2) AS energy FROM d GROUP BY 1")
def _(spark, sf):
    """With as many vectors as anchors the depths come back whole."""
    d, c, _ = _maps(spark, sf)
    back = spectral.depths_of(spectral.low_rank_depths(d, c, 400), keep=("n", "rank"))
    return back.groupBy("image_id", "n", "rank").agg(F.round(F.sum("depth"), 4).alias("total"), F.round(F.sum(F.col("depth") * F.col("depth")), 2).alias("energy"))


@query("low_rank_depths")
def _(spark, sf):
    d, c, _ = _maps(spark, sf)
    return rounded(spectral.depths_of(spectral.low_rank_depths(d, c, 12)))


# --- SQL of iterative operators

ORACLES["greedy_cover"] = "WITH RECURSIVE " + sql("cover", """total AS (SELECT sum(w) AS t FROM (SELECT max(w) AS w FROM cover GROUP BY col) q),
g AS (
  SELECT 0 AS step, row, col, w::DOUBLE AS w, 0.0::DOUBLE AS got, CAST(-1 AS BIGINT) AS pick, 0.0::DOUBLE AS gain FROM cover
  UNION ALL (
    WITH best AS (SELECT row AS pick, sum(w) AS gain FROM g GROUP BY row ORDER BY gain DESC, row LIMIT 1),
    taken AS (SELECT g.col, g.w FROM g JOIN best ON row = best.pick)
    SELECT step + 1, g.row, g.col, greatest(g.w - coalesce(taken.w, 0), 0), got + best.gain, best.pick, best.gain
    FROM g CROSS JOIN best CROSS JOIN total LEFT JOIN taken ON taken.col = g.col WHERE got < 0.9 * t - 1e-12 AND best.gain > 0))
SELECT DISTINCT CAST(step - 1 AS INT) AS ord, pick AS row, round(gain, 6) AS gain FROM g WHERE step > 0""").removeprefix("WITH ")

#: Nodes of the tree with their paths from a root; breadth-first order is by length of the path and then the path.
_WALK = "{n}(node, path) AS (SELECT {root}, [{root}] UNION ALL SELECT t.b, list_append(path, t.b) FROM {n} JOIN both_ways t ON t.a = node WHERE NOT list_contains(path, t.b))"

ORACLES["max_spanning_tree"] = "WITH RECURSIVE " + sql("dist", """e AS (SELECT least(i, j) AS i, greatest(i, j) AS j, max(1 - d) AS s FROM dist WHERE 1 - d <> 0 AND i <> j GROUP BY 1, 2),
grown(nodes, i, j) AS (
  SELECT [(SELECT min(i) FROM e)], NULL::BIGINT, NULL::BIGINT
  UNION ALL SELECT * FROM (SELECT list_append(nodes, CASE WHEN list_contains(nodes, e.i) THEN e.j ELSE e.i END), e.i, e.j FROM grown, e WHERE list_contains(nodes, e.i) <> list_contains(nodes, e.j) ORDER BY s DESC, e.i, e.j LIMIT 1) q),
both_ways AS (SELECT i AS a, j AS b FROM grown WHERE i IS NOT NULL UNION ALL SELECT j, i FROM grown WHERE i IS NOT NULL),
""" + _WALK.format(n="first_walk", root="(SELECT min(a) FROM both_ways)") + """,
far AS (SELECT node FROM first_walk ORDER BY len(path) DESC, path DESC LIMIT 1),
""" + _WALK.format(n="second_walk", root="(SELECT node FROM far)") + """,
middle AS (SELECT path[len(path) - len(path) // 2] AS node FROM second_walk ORDER BY len(path) DESC, path DESC LIMIT 1),
""" + _WALK.format(n="third_walk", root="(SELECT node FROM middle)") + """
SELECT CAST(row_number() OVER (ORDER BY len(path), path) - 1 AS INT) AS ord, path[len(path) - 1] AS parent, node AS child FROM third_walk WHERE len(path) > 1""").removeprefix("WITH ")


@query("ply_of_every_third", sql("points", """k AS (SELECT pos, x, y, row_number() OVER (ORDER BY pos) - 1 AS n FROM points), t AS (SELECT pos, CASE WHEN x = floor(x) THEN x::BIGINT::VARCHAR ELSE x::VARCHAR END AS x, CASE WHEN y = floor(y) THEN y::BIGINT::VARCHAR ELSE y::VARCHAR END AS y FROM k WHERE n % 3 = 0)
SELECT CAST(-1 AS BIGINT) AS point_id, 'ply' || chr(10) || 'format ascii 1.0' || chr(10) || 'element vertex ' || count(*) || chr(10) || 'property float x' || chr(10) || 'property float y' || chr(10) || 'property float z' || chr(10) || 'property float nx' || chr(10) || 'property float ny' || chr(10) || 'property float nz' || chr(10) || 'property uchar red' || chr(10) || 'property uchar green' || chr(10) || 'property uchar blue' || chr(10) || 'end_header' AS value FROM t
UNION ALL SELECT pos, x || ' ' || y || ' 2 0 1 0 10 20 30' FROM t"""))
def _(spark, sf):
    p = base(spark, sf, "points")
    return files.ply_text(files.every_nth(p, 3, "pos").select(F.col("pos").alias("point_id"), "x", "y", F.lit(2.0).alias("z"), F.lit(10).alias("r"), F.lit(20).alias("g"), F.lit(30).alias("b")))

"""Canonical maps of images from the views of all their pairs, their focal lengths and anchors, and dense points."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..sources.shared import stash
from . import fusion


def focal_of_points(points: DataFrame, cameras: DataFrame, rounds: int = 10, least: float = 0.5, most: float = 3.5) -> DataFrame:
    """image_id, focal: the focal length under which points(image_id, px, py, x3, y3, z3) fall nearest to their pixels.

    The sum of distances is made small by rounds of weighted least squares, from even weights.  cameras(image_id, cx,
    cy, width, height); kept between least and most times the focal length of a view of 60 degrees.
    """
    size = (F.greatest("width", "height") / (2 * math.tan(math.radians(30)))).alias("usual")
    rows = points.join(cameras.select("image_id", "cx", "cy", size), "image_id").where(F.col("z3") > 0)
    p = [F.col("px") - F.col("cx"), F.col("py") - F.col("cy")]
    q = [F.col("x3") / F.col("z3"), F.col("y3") / F.col("z3")]
    rows = rows.select("image_id", "usual", p[0].alias("p0"), p[1].alias("p1"), q[0].alias("q0"), q[1].alias("q1"))
    along, length = F.col("p0") * F.col("q0") + F.col("p1") * F.col("q1"), F.col("q0") ** 2 + F.col("q1") ** 2
    solve = lambda w: (F.sum(w * along) / F.sum(w * length)).alias("focal")
    focal = rows.groupBy("image_id", "usual").agg(solve(F.lit(1.0)))
    for _ in range(rounds):
        far = F.hypot(F.col("p0") - F.col("focal") * F.col("q0"), F.col("p1") - F.col("focal") * F.col("q1"))
        focal = rows.join(focal.drop("usual"), "image_id").groupBy("image_id", "usual").agg(solve(1 / F.greatest(far, F.lit(1e-8))))
    return focal.select("image_id", F.greatest(F.col("usual") * least, F.least(F.col("usual") * most, F.col("focal"))).alias("focal"))


def canonical_maps(views: DataFrame, cameras: DataFrame, stride: int = 8, mode: str = "depth", rounds: int = 10) -> tuple[DataFrame, DataFrame]:
    """The canonical pixels and anchors of all images, in one pass over the views of their pairs.

    views(image_id, other_id, px, py, x3, y3, z3, conf): each image's own points as told with each partner; pairs are
    exploded to images before.  cameras(image_id, cx, cy, width, height).  Pixels: image_id, px, py, x3, y3, z3 and
    conf (means under conf), base_focal, anchor (number of the block of stride x stride pixels) and ``ratio``, the
    pixel's relative depth over that of the block's centre.  Anchors: image_id, anchor, depth of each block's centre.
    mode: relative depths by mean ratio ('depth') or mean angle ('angle').  Pixels of blocks without a centre, or that
    no view has with its centre, have no ratio and are left out.
    """
    sized = stash(views.join(cameras.select("image_id", "width"), "image_id").withColumn("pix", F.col("py") * F.col("width") + F.col("px")).drop("width"), "views")
    canon = fusion.canonical_view(sized).join(cameras.select("image_id", "width"), "image_id")
    canon = stash(canon.withColumns({"px": F.pmod("pix", "width"), "py": F.floor(F.col("pix") / F.col("width"))}), "canonical")
    focal = focal_of_points(canon, cameras, rounds).withColumnRenamed("focal", "base_focal")
    if mode == "depth":
        rel = fusion.relative_depth(sized, stride)
    else:
        half = stride // 2
        centre = canon.where((F.col("px") % stride == half) & (F.col("py") % stride == half))
        centre = centre.select("image_id", F.floor(F.col("px") / stride).alias("bx"), F.floor(F.col("py") / stride).alias("by"), F.col("z3").alias("zc"))
        rel = fusion.relative_angle(sized, centre, stride)
    maps = rel.join(canon.select("image_id", "pix", "px", "py", "width"), ["image_id", "pix"])
    maps = maps.select("image_id", "pix", F.col("px").alias("x"), F.col("py").alias("y"), "width", F.col("rel_depth").alias("depth"))
    placed = fusion.anchors(maps, maps, stride).select("image_id", "pix", "anchor", "ratio")
    pixels = canon.join(placed, ["image_id", "pix"]).join(focal, "image_id")
    core = canon.where((F.col("px") % stride == stride // 2) & (F.col("py") % stride == stride // 2))
    across = F.ceil(F.col("width") / stride)
    core = core.select("image_id", (F.floor(F.col("py") / stride) * across + F.floor(F.col("px") / stride)).alias("anchor"), F.col("z3").alias("depth"))
    return pixels.select("image_id", "px", "py", "x3", "y3", "z3", "conf", "base_focal", "anchor", "ratio"), core


def dense_points(pixels: DataFrame, anchors: DataFrame, cameras: DataFrame, compensate: bool = True) -> DataFrame:
    """image_id, px, py, depth, wx, wy, wz: world points of canonical pixels from the depths of their anchors.

    cameras(image_id, focal, cx, cy, rotation, t) are those found since.  A pixel's depth is its anchor's times its
    ratio; compensated, the ratio's part beyond 1 is scaled by the base focal length over the one found.
    """
    rows = pixels.join(anchors.select("image_id", "anchor", F.col("depth").alias("core")), ["image_id", "anchor"])
    rows = rows.join(cameras.select("image_id", "focal", "cx", "cy", "rotation", "t"), "image_id")
    ratio = 1 + (F.col("ratio") - 1) * F.col("base_focal") / F.col("focal") if compensate else F.col("ratio")
    rows = rows.withColumn("depth", F.col("core") * ratio)
    camera = geo.backproject(F.col("px"), F.col("py"), F.col("depth"), F.col("focal"), F.col("cx"), F.col("cy"))
    rows = rows.withColumn("p", geo.to_world(camera, F.col("rotation"), F.col("t")))
    return rows.select("image_id", "px", "py", "depth", *[F.col(f"p.{c}").alias(f"w{c}") for c in "xyz"])


def exploded_views(pairs: DataFrame) -> DataFrame:
    """image_id, other_id and the rest of pairs(src, dst, side, ...): side 1 holds src's points, side 2 dst's."""
    own = F.when(F.col("side") == 1, F.col("src")).otherwise(F.col("dst"))
    other = F.when(F.col("side") == 1, F.col("dst")).otherwise(F.col("src"))
    return pairs.select(own.alias("image_id"), other.alias("other_id"), *[c for c in pairs.columns if c not in ("src", "dst", "side")])


def partner_scores(corres: DataFrame) -> DataFrame:
    """image_id, other_id, score of corres(src, dst, score), both ways round; the last of repeated pairs by score."""
    one = corres.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.max("score").alias("score"))
    both = one.select(F.col("a").alias("image_id"), F.col("b").alias("other_id"), "score").union(one.select("b", "a", "score"))
    return both.withColumn("n_partners", F.count("*").over(Window.partitionBy("image_id")))

"""Confidence-weighted aggregation: pair scores, canonical views, votes and fusion."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import sums_before


def weighted_mean(value, weight):
    """sum(w x) / sum(w), null where there is no weight."""
    w = F.sum(weight)
    return F.when(w != 0, F.sum(F.col(value) * weight if isinstance(value, str) else value * weight) / w)


def pair_scores(confs: DataFrame) -> DataFrame:
    """src, dst, conf_score, conf_sum, n from pixel confidences c11, c21, c22, c12 and match confidence conf.

    conf_score is the geometric mean of the four mean confidences.
    """
    means = [F.avg(c) for c in ("c11", "c21", "c22", "c12")]
    score = F.pow(means[0] * means[1] * means[2] * means[3], F.lit(0.25))
    return confs.groupBy("src", "dst").agg(score.alias("conf_score"), F.sum("conf").alias("conf_sum"), F.count("*").alias("n"))


def score_matrix(matches: DataFrame) -> DataFrame:
    """i, j, n: matches of each image pair, both ways round."""
    one = matches.groupBy("src", "dst").agg(F.count("*").alias("n"))
    return one.select(F.col("src").alias("i"), F.col("dst").alias("j"), "n").union(one.select("dst", "src", "n")).groupBy("i", "j").agg(F.sum("n").alias("n"))


def canonical_view(views: DataFrame, base: float = 0.999) -> DataFrame:
    """image_id, pix and the mean of x3, y3, z3 under weights conf - base; conf: sum of squares over sum."""
    w = F.col("conf") - base
    return views.groupBy("image_id", "pix").agg(*[weighted_mean(c, w).alias(c) for c in ("x3", "y3", "z3")], (F.sum(w * w) / F.sum(w)).alias("conf"))


def block_centres(views: DataFrame, stride: int) -> DataFrame:
    """views(image_id, other_id, pix, px, py, ...) with the values zc, xc, yc of their block's centre pixel."""
    half = stride // 2
    centre = views.where((F.pmod(F.col("px"), F.lit(stride)) == half) & (F.pmod(F.col("py"), F.lit(stride)) == half))
    key = lambda d: d.withColumn("bx", F.floor(F.col("px") / stride)).withColumn("by", F.floor(F.col("py") / stride))
    centre = key(centre).select("image_id", "other_id", "bx", "by", F.col("x3").alias("xc"), F.col("y3").alias("yc"), F.col("z3").alias("zc"))
    return key(views).join(centre, ["image_id", "other_id", "bx", "by"])


def relative_depth(views: DataFrame, stride: int, eps: float = 1.1920929e-07, base: float = 0.999) -> DataFrame:
    """image_id, pix, rel_depth: the weighted mean of depth over the depth of the block's centre."""
    rows = block_centres(views, stride).withColumn("ratio", F.col("z3") / F.greatest(F.col("zc"), F.lit(eps)))
    return rows.groupBy("image_id", "pix").agg(weighted_mean("ratio", F.col("conf") - base).alias("rel_depth"))


def relative_angle(views: DataFrame, canon: DataFrame, stride: int, base: float = 0.999) -> DataFrame:
    """As relative_depth, by the weighted mean angle to the centre; canon(image_id, bx, by, zc) has canonical depths."""
    rho = F.greatest(F.hypot(F.col("x3") - F.col("xc"), F.col("y3") - F.col("yc")), F.lit(1e-8))
    rows = block_centres(views, stride).withColumn("rho", rho).withColumn("angle", F.atan((F.col("z3") - F.col("zc")) / F.col("rho")))
    means = rows.groupBy("image_id", "pix", "bx", "by").agg(weighted_mean("angle", F.col("conf") - base).alias("angle"), F.avg("rho").alias("rho"))
    means = means.join(canon.select("image_id", "bx", "by", F.col("zc").alias("depth")), ["image_id", "bx", "by"])
    return means.select("image_id", "pix", (1 + F.col("rho") * F.tan("angle") / F.col("depth")).alias("rel_depth"))


def anchors(pixels: DataFrame, depths: DataFrame, stride: int) -> DataFrame:
    """pixels(image_id, x, y, depth) with the number of their block and their depth over the block centre's depth.

    depths(image_id, x, y, depth, width): the centres are the pixels at stride / 2 in each block.
    """
    across = F.ceil(F.col("width") / stride)
    block = lambda d: d.withColumn("anchor", F.floor(F.col("y") / stride) * across + F.floor(F.col("x") / stride))
    half = stride // 2
    centres = block(depths.where((F.pmod("x", F.lit(stride)) == half) & (F.pmod("y", F.lit(stride)) == half))).select("image_id", "anchor", F.col("depth").alias("centre"))
    return block(pixels).join(centres, ["image_id", "anchor"]).withColumn("ratio", F.col("depth") / F.col("centre"))


def condense(corres: DataFrame) -> DataFrame:
    """image_id, n, conf_sum and the offset of an image's first correspondence end, with conf sqrt(c1 c2)."""
    conf = F.sqrt(F.col("conf1") * F.col("conf2")).alias("conf")
    ends = corres.select(F.col("src").alias("image_id"), conf).union(corres.select(F.col("dst"), conf))
    rows = ends.groupBy("image_id").agg(F.count("*").alias("n"), F.sum("conf").alias("conf_sum"))
    return sums_before(rows, "n", "image_id", name="offset")


def lower_median(col: str):
    """The lower of the two middle values."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {col})")


def median_normalised(depths: DataFrame) -> DataFrame:
    """Depths over their image's lower median."""
    middle = depths.groupBy("image_id").agg(lower_median("depth").alias("median"))
    return depths.join(middle, "image_id").withColumn("depth", F.col("depth") / F.col("median"))


def shared_intrinsics(cameras: DataFrame) -> DataFrame:
    """One focal length and principal point for all images, weighted by their total confidence."""
    return cameras.agg(*[weighted_mean(c, F.col("conf_sum")).alias(c) for c in ("focal", "cx", "cy")])


def tsdf_vote(samples: DataFrame, threshold: float, weighted: bool = True) -> DataFrame:
    """point_id, tsdf: samples(point_id, depth, projected, conf, inside) voted.

    sdf = depth - projected; below -threshold the point is unseen, as outside the image; other values count clipped
    from below, with weight exp(conf).  Without weight the vote is null.
    """
    sdf = F.col("depth") - F.col("projected")
    w = F.when((sdf >= -threshold) & F.col("inside"), F.exp("conf") if weighted else F.lit(1.0)).otherwise(0.0)
    return samples.groupBy("point_id").agg(weighted_mean(F.greatest(sdf, F.lit(-threshold)), w).alias("tsdf"), F.sum(F.when(w > 0, 1).otherwise(0)).alias("n_seen"))


def fused(samples: DataFrame, ratio: float) -> DataFrame:
    """key, x, y, z, conf: means under confidence of samples with all coordinates; null unless more than
    floor(views * ratio) views have them."""
    ok = ~(F.isnan("x") | F.isnan("y") | F.isnan("z") | F.col("x").isNull())
    w = F.when(ok, F.col("conf")).otherwise(0.0)
    clean = lambda c: F.when(ok, F.col(c)).otherwise(0.0)
    rows = samples.groupBy("key").agg(F.count("*").alias("views"), F.count_if(ok).alias("valid"), *[weighted_mean(clean(c), w).alias(c) for c in "xyz"])
    enough = F.col("valid") > F.floor(F.col("views") * ratio)
    return rows.select("key", "views", "valid", *[F.when(enough, F.col(c)).alias(c) for c in "xyz"])


def weighted_loss(residuals: DataFrame, rho, by: tuple[str, ...] = ()) -> DataFrame:
    """sum(conf rho(residual)) / sum(conf), over all rows or by group."""
    return residuals.groupBy(*by).agg((F.sum(F.col("conf") * rho(F.col("residual"))) / F.sum("conf")).alias("loss"))


def cell_scores(points: DataFrame, least: int = 10, floor: float = 20.0) -> DataFrame:
    """Target windows of cells: points(cell_id, x0.., px1, py1, px2, py2) contained in their cells.

    A cell with ``least`` points or more gets the mean of its points in image 2 and, per axis, the ratio of the 0.1
    to 0.9 spreads in images 2 and 1, each at least ``floor``.
    """
    q = lambda c: F.greatest(F.expr(f"percentile({c}, 0.9)") - F.expr(f"percentile({c}, 0.1)"), F.lit(floor))
    rows = points.groupBy("cell_id").agg(F.count("*").alias("n"), F.avg("px2").alias("mx"), F.avg("py2").alias("my"), (q("px2") / q("px1")).alias("sx"), (q("py2") / q("py1")).alias("sy"))
    return rows.where(F.col("n") >= least)


def database_report(images: DataFrame, keypoints: DataFrame, matches: DataFrame) -> DataFrame:
    """table_name, n_rows, n_keys of an export's tables."""
    row = lambda d, name, key: d.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.countDistinct(*key).alias("n_keys"))
    return row(images, "images", ["image_id"]).union(row(keypoints, "keypoints", ["image_id"])).union(row(matches, "matches", ["src", "dst"]))


def least_size(images: DataFrame) -> DataFrame:
    return images.agg(F.min("width").alias("width"), F.min("height").alias("height"))


def largest_reconstruction(images: DataFrame) -> DataFrame:
    """The model with most registered images, ties to the smaller id."""
    return images.groupBy("model_id").agg(F.count("*").alias("n")).agg(F.max_by("model_id", F.struct("n", -F.col("model_id"))).alias("model_id"), F.max("n").alias("n_images"))


def gradient_confidence(depths: DataFrame, block: int = 256) -> DataFrame:
    """depths(image_id, x, y, depth, conf) with conf times 1 less the depth's gradient, 0 at least.

    The gradient is the length of both 3 x 3 differences, weighed 2, 4, 2 along the edge; pixels that are not there
    count as 0.  Blocks of block x block pixels are done at once, each with a rim of its neighbours' pixels.
    """
    columns = ["image_id", "x", "y", "depth", "conf"]
    others = [c for c in depths.columns if c not in columns]
    cells = lambda c: F.array_distinct(F.array(*[F.floor((F.col(c) + d) / block) for d in (-1, 0, 1)]))
    spread = depths.withColumn("__bx", F.explode(cells("x"))).withColumn("__by", F.explode(cells("y")))

    def graded(key, table):
        bx, by = key[1].as_py(), key[2].as_py()
        x, y = (np.array(table.column(c)).astype(np.int64) - b * block + 1 for c, b in (("x", bx), ("y", by)))
        grid = np.zeros((block + 2, block + 2))
        grid[y, x] = np.array(table.column("depth"), float)
        gx, gy = np.zeros(grid.shape), np.zeros(grid.shape)
        for i in (-1, 0, 1):
            for j in (-1, 0, 1):
                near = np.zeros(grid.shape)
                near[1:-1, 1:-1] = grid[1 + j : block + 1 + j, 1 + i : block + 1 + i]
                gx += i * (4.0 if j == 0 else 2.0) * near
                gy += j * (4.0 if i == 0 else 2.0) * near
        keep = np.maximum(0.0, 1 - np.hypot(gx, gy))[y, x]
        own = (x >= 1) & (x <= block) & (y >= 1) & (y <= block)
        conf = pa.array(np.array(table.column("conf"), float) * keep)
        at = table.schema.get_field_index("conf")
        return table.set_column(at, "conf", conf).filter(pa.array(own)).drop_columns(["__bx", "__by"])

    fields = ", ".join(f"`{c}` {'double' if c == 'conf' else depths.schema[c].dataType.simpleString()}" for c in columns + others)
    return spread.select(*columns, *others, "__bx", "__by").groupBy("image_id", "__bx", "__by").applyInArrow(graded, fields).select(depths.columns)

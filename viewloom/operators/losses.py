"""Losses over tables: regression of point maps, matching under confidence, and reprojection residuals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fusion import lower_median, weighted_loss


def length(*cs):
    return F.sqrt(sum((c * c for c in cs[1:]), cs[0] * cs[0]))


def clip_valid(points: DataFrame, farthest: float | None = None) -> DataFrame:
    """points(gx, gy, gz, valid, sky) with far points not valid, and sky only where no point is valid."""
    valid = F.col("valid") if farthest is None else F.col("valid") & (length(*map(F.col, ("gx", "gy", "gz"))) <= farthest)
    return points.withColumn("valid", valid).withColumn("sky", F.col("sky") & ~F.col("valid"))


def pointmap_residuals(points: DataFrame, by: str = "batch_id", normalise: bool = True, shift: bool = False, scale: bool = False, keep_scale: bool = False, sky_loss: float | None = None) -> DataFrame:
    """points with residual, the distance of prediction (x, y, z) and truth (gx, gy, gz), for valid and sky pixels.

    Per group of ``by``, over its valid pixels: normalise divides both sides by their mean distance from the origin;
    shift takes each side's median depth off; scale divides each by its median distance from the median point, or
    with keep_scale takes the prediction to the truth's scale.  Medians are the lower ones.  Sky pixels have the
    residual sky_loss; without it they are left out.
    """
    rows, sides = points, (("gx", "gy", "gz"), ("x", "y", "z"))

    def told(**stats) -> DataFrame:
        return rows.join(rows.where("valid").groupBy(by).agg(*[e.alias(n) for n, e in stats.items()]), by)

    if normalise:
        rows = told(**{f"m{s[0]}": F.avg(length(*map(F.col, s))) for s in sides})
        rows = rows.withColumns({c: F.col(c) / F.col(f"m{s[0]}") for s in sides for c in s}).drop("mgx", "mx")
    if shift:
        rows = told(sgz=lower_median("gz"), sz=lower_median("z"))
        rows = rows.withColumns({c: F.col(c) - F.col(f"s{c}") for c in ("gz", "z")}).drop("sgz", "sz")
    if scale:
        rows = told(**{f"c{c}": lower_median(c) for s in sides for c in s})
        rows = rows.withColumns({f"d{s[0]}": length(*[F.col(c) - F.col(f"c{c}") for c in s]) for s in sides}).drop(*[f"c{c}" for s in sides for c in s])
        rows = told(tgx=lower_median("dgx"), tx=lower_median("dx")).withColumn("tx", F.greatest(F.lit(1e-3), F.least(F.lit(1e3), "tx")))
        factor = {c: F.col("tgx") / F.col("tx") for c in sides[1]} if keep_scale else {c: 1 / F.col(f"t{s[0]}") for s in sides for c in s}
        rows = rows.withColumns({c: F.col(c) * f for c, f in factor.items()}).drop("dgx", "dx", "tgx", "tx")
    residual = length(*[F.col(c) - F.col(f"g{c}") for c in "xyz"])
    if sky_loss is None:
        return rows.where("valid").withColumn("residual", residual)
    return rows.where("valid OR sky").withColumn("residual", F.when(F.col("valid"), residual).otherwise(F.lit(float(sky_loss))))


def fused_confidence(one, two, mode: str = "prod"):
    """One confidence of a match from those of its two views: their product or mean."""
    return one * two if mode == "prod" else (one + two) / 2


def matching_confidence_loss(positives: DataFrame, negatives: DataFrame | None, alpha: float, quantile: float | None = None) -> DataFrame:
    """loss: the mean of loss conf - alpha log conf over positives(loss, conf), and, with a quantile, that over
    negatives(conf) at this quantile of the positives' loss; 0 for a side without rows."""
    cost = lambda loss: F.coalesce(F.avg(loss * F.col("conf") - F.lit(alpha) * F.log("conf")), F.lit(0.0))
    out = positives.agg(cost(F.col("loss")).alias("loss"))
    if quantile is None or negatives is None:
        return out
    value = positives.agg(F.expr(f"percentile(loss, {float(quantile)})").alias("value"))
    other = negatives.crossJoin(F.broadcast(value)).agg(cost(F.coalesce("value", F.lit(0.0))).alias("other"))
    return out.crossJoin(F.broadcast(other)).select((F.col("loss") + F.col("other")).alias("loss"))


def loss_3d(pairs: DataFrame, rho, by: tuple[str, ...] = ()) -> DataFrame:
    """sum(conf rho(d)) / sum(conf) over pairs (x1, y1, z1, x2, y2, z2, conf) of world points, d their distance."""
    return weighted_loss(pairs.withColumn("residual", length(*[F.col(f"{c}1") - F.col(f"{c}2") for c in "xyz"])), rho, by)


def loss_2d(seen: DataFrame, rho, by: tuple[str, ...] = (), floor: float = 1e-3) -> DataFrame:
    """As loss_3d, over pixels (u, v, conf) and world points (x, y, z) projected by m, a row-major 3x4 array."""
    m = F.col("m")
    row = lambda i: m[4 * i] * F.col("x") + m[4 * i + 1] * F.col("y") + m[4 * i + 2] * F.col("z") + m[4 * i + 3]
    depth = F.greatest(row(2), F.lit(floor))
    return weighted_loss(seen.withColumn("residual", length(F.col("u") - row(0) / depth, F.col("v") - row(1) / depth)), rho, by)


def loss_regression(points: DataFrame, rho, by: tuple[str, ...] = ()) -> DataFrame:
    """As loss_3d, over an image's world points (x1, y1, z1) and another view's prediction (x, y, z) of them, taken to
    the world by rotation, a row-major 3x3 array, and t."""
    r, t = F.col("rotation"), F.col("t")
    world = {f"{c}2": r[3 * i] * F.col("x") + r[3 * i + 1] * F.col("y") + r[3 * i + 2] * F.col("z") + t[i] for i, c in enumerate("xyz")}
    return loss_3d(points.withColumns(world), rho, by)

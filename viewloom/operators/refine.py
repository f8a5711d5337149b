"""Refinement of depth maps by signed distances: samples along each ray, votes of the views, the depth nearest to 0."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo

REFINED = "image_id long, x int, y int, depth double, seen int"
CAMERA = ("focal", "cx", "cy", "rotation", "t", "width", "height")
_BIG = 2147483647
#: Samples that are held at a time.
CELLS = 2_000_000


def unit_noise(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers above 0 and below 1 for each place of whole-number keys, told by the keys alone."""
    h = np.zeros(np.broadcast(*keys).shape, np.int64)
    for k in keys:
        h = (h * 69069 + k + 1) % _BIG
    one, two = (((h * 16807 + 7) % _BIG * 48271) % _BIG, ((h * 48271 + 11) % _BIG * 16807) % _BIG)
    return (one + 1) / (_BIG + 1), (two + 1) / (_BIG + 1)


def normal_noise(*keys: np.ndarray) -> np.ndarray:
    """Normally distributed numbers, told by whole-number keys."""
    u, v = unit_noise(*keys)
    return np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)


def depth_maps(depths: DataFrame, cameras: DataFrame) -> DataFrame:
    """A row for each image: its camera, and pix, depth and conf of its pixels in raster order as arrays."""
    rows = depths.join(cameras.select("image_id", "width"), "image_id")
    pix = (F.col("y") * F.col("width") + F.col("x")).cast("long").alias("pix")
    packed = rows.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct(pix, F.col("depth").cast("double").alias("depth"), F.col("conf").cast("double").alias("conf")))).alias("p"))
    return packed.select("image_id", *[F.col(f"p.{c}").alias(c) for c in ("pix", "depth", "conf")]).join(cameras.select("image_id", *CAMERA), "image_id")


class View:
    """An image's camera and its depths as a grid, with a mark where there are any."""

    def __init__(self, row: dict):
        self.w, self.h, self.focal, self.cx, self.cy = row["width"], row["height"], row["focal"], row["cx"], row["cy"]
        self.rotation, self.t = np.array(row["rotation"], float).reshape(3, 3), np.array(row["t"], float)
        self.pix = np.array(row["pix"], np.int64)
        self.depth, self.weight = np.zeros(self.w * self.h), np.zeros(self.w * self.h)
        self.depth[self.pix], self.weight[self.pix] = row["depth"], 1.0
        self.exp_conf = np.zeros(self.w * self.h)
        self.exp_conf[self.pix] = np.exp(row["conf"])

    def rays(self, pix: np.ndarray) -> np.ndarray:
        """World directions of pixels at depth 1."""
        x, y = pix % self.w, pix // self.w
        return np.column_stack([(x - self.cx) / self.focal, (y - self.cy) / self.focal, np.ones(len(pix))]) @ self.rotation.T

    def votes(self, points: np.ndarray, threshold: float, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
        """Weighted signed distance, and weight, of this view for world points."""
        c = (points - self.t) @ self.rotation
        z = c[..., 2]
        with np.errstate(divide="ignore", invalid="ignore"):
            u, v = np.rint(self.focal * c[..., 0] / z + self.cx), np.rint(self.focal * c[..., 1] / z + self.cy)
        inside = (z != 0) & (u >= 0) & (u < self.w) & (v >= 0) & (v < self.h)
        at = np.where(inside, v * self.w + u, 0).astype(np.int64)
        sdf = self.depth[at] - z
        w = np.where(inside & (sdf >= -threshold), (self.exp_conf if weighted else self.weight)[at], 0.0)
        return w * np.maximum(sdf, -threshold), w


def refine(own: View, views: list[View], image: int, threshold: float, samples: int, rounds: int, weighted: bool, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Refined depths of own's pixels, and in how many of the last round's samples any view had a vote."""
    depth, seen = own.depth[own.pix].copy(), np.zeros(len(own.pix), np.int64)
    step = max(1, CELLS // (3 * samples))
    for r in range(rounds):
        limit = (rounds - r) * threshold
        for a in range(0, len(depth), step):
            pix = own.pix[a : a + step]
            noise = normal_noise(np.int64(seed + r), np.int64(image), pix[:, None], np.arange(samples)[None])
            tried = depth[a : a + step, None] + (noise - 1) * limit
            points = own.rays(pix)[:, None] * tried[..., None] + own.t
            total, weight = np.zeros(tried.shape), np.zeros(tried.shape)
            for view in views:
                s, w = view.votes(points, limit, weighted)
                total, weight = total + s, weight + w
            voted = weight > 0
            distance = np.where(voted, np.abs(total / np.where(voted, weight, 1)), np.inf)
            # where all samples are behind what is seen, or none is seen, the depth stays
            flat = (distance == limit).all(axis=1) | ~voted.any(axis=1)
            best = tried[np.arange(len(pix)), distance.argmin(axis=1)]
            depth[a : a + step] = np.where(flat, depth[a : a + step], best)
            seen[a : a + step] = voted.sum(axis=1)
    return depth, seen


def refined_depths(depths: DataFrame, cameras: DataFrame, pairs: DataFrame, threshold: float, samples: int = 1000, rounds: int = 1, weighted: bool = True, seed: int = 0) -> DataFrame:
    """image_id, x, y, depth, seen of depths(image_id, x, y, depth, conf) by truncated signed distances.

    Each round tries ``samples`` depths on each pixel's ray, threshold * (noise - 1) from its depth; the threshold
    starts at ``rounds`` times its value and falls to it.  A view votes with its depth at the nearest pixel less the
    sample's, cut at minus the threshold, weighted by exp(conf) or evenly; samples further behind than that, outside
    the view or where it has no depth have no vote.  The sample whose mean vote is nearest to 0 stays, the first of
    equal ones.  A pixel keeps its depth where all samples are at the threshold or no view sees any of them.

    cameras(image_id, focal, cx, cy, rotation, t, width, height), rotation and t to the world; pairs(src, dst), either
    way round: the views that vote on an image, besides itself.  Noise comes from the pixel and the seed, so reruns
    agree.  A task holds the maps of an image and its partners; samples are never rows.
    """
    maps = depth_maps(depths, cameras)
    edges = pairs.select("src", "dst").union(pairs.select("dst", "src")).distinct().where("src <> dst")
    own = maps.select(F.col("image_id").alias("src"), *[c for c in maps.columns])
    partner = edges.join(maps, F.col("dst") == F.col("image_id")).select("src", *maps.columns)

    def run(key, table):
        image = key[0].as_py()
        rows = sorted(table.to_pylist(), key=lambda r: (r["image_id"] != image, r["image_id"]))
        views = [View(r) for r in rows] if rows and rows[0]["image_id"] == image else []
        found, seen = refine(views[0], views, image, threshold, samples, rounds, weighted, seed) if views else (np.empty(0), np.empty(0, int))
        pix = views[0].pix if views else np.empty(0, np.int64)
        w = views[0].w if views else 1
        columns = (np.full(len(pix), image), (pix % w).astype(np.int32), (pix // w).astype(np.int32), found, seen.astype(np.int32))
        return pa.table([pa.array(c) for c in columns], names=["image_id", "x", "y", "depth", "seen"])

    return own.union(partner).groupBy("src").applyInArrow(run, REFINED)


def world_points(depths: DataFrame, cameras: DataFrame) -> DataFrame:
    """depths(image_id, x, y, depth, ...) with the world coordinates wx, wy, wz of its pixels."""
    rows = depths.join(cameras.select("image_id", "focal", "cx", "cy", "rotation", "t"), "image_id")
    p = geo.to_world(geo.backproject(F.col("x"), F.col("y"), F.col("depth"), F.col("focal"), F.col("cx"), F.col("cy")), F.col("rotation"), F.col("t"))
    return rows.withColumn("p", p).select(*depths.columns, *[F.col(f"p.{c}").alias(f"w{c}") for c in "xyz"])

"""Whole flows in one call: matching of pairs, tracks and keypoint tables of raw matches, crops of image pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..sources.shared import stash
from . import matching, tiling, tracks


def match_pairs(descriptors: DataFrame, pairs: DataFrame, threshold: float, sparse: bool = True, stride: int = 8, width: int | None = None, tolerance: float = 0.0, metric: str = "dot", rounds: int = 10) -> DataFrame:
    """src, dst, a, b: matches of image pairs by descriptors or 3D points (image_id, kp, v, conf).

    Dense: keypoints below the threshold go first, and the others match where each is the other's nearest.  Sparse:
    every stride-th pixel of both sides starts a reciprocal search (on a grid of ``width`` pixels, in both
    directions), or with a tolerance one round of it; matches whose lesser confidence is below the threshold go.
    metric l2 suits 3D points.
    """
    if not sparse:
        good = descriptors.where(F.col("conf") >= threshold)
        return matching.mutual(matching.nearest_both_ways(good, pairs, metric)).drop("score")
    best = stash(matching.nearest_both_ways(descriptors, pairs, metric), "best")
    ways = {w: best.where(F.col("forward") == w).select("src", "dst", "a", "b") for w in (True, False)}
    turned = {w: d.select("src", "dst", F.col("b").alias("a"), F.col("a").alias("b")) for w, d in ways.items()}
    on = ("src", "dst")

    def seeds(side: DataFrame) -> DataFrame:
        p = F.col("a")
        start = p % stride == stride // 2 if width is None else (p % width % stride == stride // 2) & (F.floor(p / width) % stride == stride // 2)
        return side.where(start).select(*on, p.alias("p1"))

    def search(forward: DataFrame, backward: DataFrame) -> DataFrame:
        if tolerance > 0:
            return matching.tolerant(seeds(forward), forward, backward, width or 1 << 31, tolerance, on)
        return matching.iterated_reciprocal(seeds(forward), forward, backward, rounds, on)

    there = search(ways[True], ways[False]).select(*on, F.col("p1").alias("a"), F.col("p2").alias("b"))
    back = search(turned[False], turned[True]).select(*on, F.col("p2").alias("a"), F.col("p1").alias("b"))
    rows = there.union(back).distinct()
    conf = lambda i, k, n: descriptors.select(F.col("image_id").alias(i), F.col("kp").alias(k), F.col("conf").alias(n))
    rows = rows.join(conf("src", "a", "c1"), ["src", "a"]).join(conf("dst", "b", "c2"), ["dst", "b"])
    return rows.where(F.least("c1", "c2") >= threshold).select("src", "dst", "a", "b")


def coarse_to_fine(descriptors: DataFrame, crops: DataFrame, crop_pairs: DataFrame, threshold: float = 0.0, metric: str = "dot") -> DataFrame:
    """src, dst, x1, y1, x2, y2, score, n: matches of image pairs from those of pairs of their crops.

    descriptors(crop_id, kp, u, v, vector, conf): keypoints at pixels of a crop; those of at least the threshold match
    where each is the other's nearest within a pair of crops.  crops(crop_id, image_id, m): m takes a crop's pixels to
    its image's, a row-major 3x3 homography.  The matches of all crop_pairs(crop1, crop2) of an image pair come
    together: of those that meet at the same pixels of both images, rounded, the best stays, ties by its places; n
    counts them.  A match whose end the homography sends to infinity is left out.
    """
    own = descriptors.where(F.col("conf") >= threshold).select(F.col("crop_id").alias("image_id"), "kp", F.col("vector").alias("v"))
    pairs = crop_pairs.select(F.col("crop1").alias("src"), F.col("crop2").alias("dst")).distinct()
    rows = matching.mutual(matching.nearest_both_ways(own, pairs, metric))
    for n, crop, kp in ((1, "src", "a"), (2, "dst", "b")):
        far = F.col("m")[6] * F.col("u") + F.col("m")[7] * F.col("v") + F.col("m")[8]
        ends = descriptors.join(crops, "crop_id").where(far != 0).withColumn("p", geo.homography(F.col("u"), F.col("v"), F.col("m")))
        ends = ends.select(F.col("crop_id").alias(crop), F.col("kp").alias(kp), F.col("image_id").alias(f"image{n}"), F.col("p.x").alias(f"x{n}"), F.col("p.y").alias(f"y{n}"))
        rows = rows.join(ends, [crop, kp])
    at = ["x1", "y1", "x2", "y2"]
    rows = rows.select(F.col("image1").alias("src"), F.col("image2").alias("dst"), *at, "score", *[F.rint(c).alias(f"r{c}") for c in at])
    best = rows.groupBy("src", "dst", *[f"r{c}" for c in at]).agg(F.max_by(F.struct(*at, "score"), F.struct("score", *[-F.col(c) for c in at])).alias("m"), F.count("*").alias("n"))
    return best.select("src", "dst", "m.*", "n")


def _attached(matches: DataFrame, keypoints: DataFrame, radius: float) -> DataFrame:
    """Matches (src, dst, pos, x1, y1, x2, y2) with the numbers kp1 and kp2 of their ends' nearest keypoints."""
    found = matches.select("src", "dst", "pos")
    for n, image in ((1, "src"), (2, "dst")):
        ends = matches.select(F.col(image).alias("image_id"), F.struct("src", "dst", "pos").alias("pos"), F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y"))
        own = tracks.radius_nearest(ends, keypoints, radius).where("kp_idx IS NOT NULL").select("pos.*", F.col("kp_idx").alias(f"kp{n}"))
        found = found.join(own, ["src", "dst", "pos"])
    return found


def format_tracks(matches: DataFrame, least: int = 3, radius: float = 2.0, guarded: bool = True) -> tuple[DataFrame, DataFrame]:
    """Keypoints (image_id, kp_idx, x, y) and index pairs (src, dst, kp_idx1, kp_idx2) of raw matches.

    Distinct ends are keypoints; each match ties the keypoints nearest to its ends; tracks of ``least`` keypoints or
    more stay, keypoints are numbered anew, and all pairs of a track's keypoints are matches.
    """
    points = stash(tracks.distinct_keypoints(tracks.both_ends(matches)), "keypoints")
    edges = _attached(matches, points, radius).select("src", F.col("kp1").alias("a_kp"), "dst", F.col("kp2").alias("b_kp")).distinct()
    edges = stash(edges, "edges")
    found = tracks.guarded_tracks(edges) if guarded else tracks.component_tracks(edges)
    kept = stash(tracks.long_tracks(found, least), "kept")
    place = kept.select("image_id", F.col("kp_id").alias("old"), "kp_idx")
    keypoints = place.join(points.select("image_id", F.col("kp_idx").alias("old"), "x", "y"), ["image_id", "old"]).select("image_id", "kp_idx", "x", "y")
    return keypoints, tracks.closure_pairs(kept)


def format_rounded(matches: DataFrame, radius: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """Keypoints and index pairs of raw matches without tracks: the first end of each rounded place is a keypoint,
    and a match ties the keypoints nearest to its ends."""
    ends = tracks.both_ends(matches)
    at = [F.rint("x"), F.rint("y")]
    first = ends.groupBy("image_id", *[c.alias(n) for n, c in zip(("rx", "ry"), at)]).agg(F.min(F.struct("x", "y")).alias("p"))
    order = Window.partitionBy("image_id").orderBy("rx", "ry")
    points = first.select("image_id", (F.row_number().over(order) - 1).cast("long").alias("kp_idx"), "rx", "ry", "p.x", "p.y")
    near, pairs = _around(points), matches.select("src", "dst", "x1", "y1", "x2", "y2")
    for n, image in ((1, "src"), (2, "dst")):
        pairs = _tied(pairs, near, n, image, radius)
    return points.drop("rx", "ry"), pairs.select("src", "dst", "kp_idx1", "kp_idx2").distinct()


def _around(points: DataFrame) -> DataFrame:
    """image_id, rx, ry, xs, ys, ids: the keypoints of each place and of those up to two from it, by their numbers.

    points(image_id, kp_idx, rx, ry, x, y) has one keypoint of a rounded place, so there are 25 at most.
    """
    moved = lambda c: F.explode(F.array(*[F.col(c) + d for d in (-2.0, -1.0, 0.0, 1.0, 2.0)])).alias(c)
    spread = points.select("image_id", moved("rx"), "ry", F.struct("kp_idx", "x", "y").alias("k")).select("image_id", "rx", moved("ry"), "k")
    near = spread.groupBy("image_id", "rx", "ry").agg(F.array_sort(F.collect_list("k")).alias("k"))
    return near.select("image_id", "rx", "ry", F.col("k.x").alias("xs"), F.col("k.y").alias("ys"), F.col("k.kp_idx").alias("ids"))


def _tied(matches: DataFrame, near: DataFrame, n: int, image: str, radius: float) -> DataFrame:
    """Matches with kp_idx1 or kp_idx2, the keypoint nearest to end n, for its coordinates; those with none within radius go.

    An end's place has a keypoint, so the nearest is a diagonal away at most, and its place no further than two.  All
    it may be lies in one row of near: an end is sent once, and its candidates are never rows.
    """
    x, y, on = f"x{n}", f"y{n}", [image, f"rx{n}", f"ry{n}"]
    rows = matches.withColumns({on[1]: F.rint(x), on[2]: F.rint(y)})
    rows = rows.join(near.select(*[F.col(c).alias(o) for c, o in zip(("image_id", "rx", "ry"), on)], "xs", "ys", "ids"), on)
    kept = [c for c in matches.columns if c not in (x, y)]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in matches.select(*kept).schema)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            own, at = ([np.asarray(batch.column(c)) for c in (x, y)], [np.asarray(batch.column(c).flatten()) for c in ("xs", "ys", "ids")])
            sizes = np.asarray(pc.list_value_length(batch.column("ids")))
            row, starts = np.repeat(np.arange(len(batch)), sizes), np.cumsum(sizes) - sizes
            d = np.sqrt(sum((k - e[row]) ** 2 for k, e in zip(at, own)))
            least = np.fmin.reduceat(d, starts)
            kp = np.minimum.reduceat(np.where(d == least[row], at[2], np.iinfo(np.int64).max), starts)
            part = pa.Table.from_batches([batch]).select(kept).append_column(f"kp_idx{n}", pa.array(kp, pa.int64()))
            yield from part.filter(pa.array(least < radius)).to_batches()

    return rows.select(*kept, x, y, "xs", "ys", "ids").mapInArrow(nearest, f"{fields}, kp_idx{n} long")


def reprojected_matches(views: DataFrame, size: tuple[int, int]) -> DataFrame:
    """pair_id, pix1, pix2 of views (pair_id, side, pix, x, y, z, focal, cx, cy, rotation, t): pixels whose world
    points fall on each other's pixel.  side: 1 or 2; rotation and t take a camera's points to the world."""
    width, height = size
    # numbers, for arrays are aggregated by a sort of all rows
    camera = {c: F.col(c) for c in ("focal", "cx", "cy")} | {f"r{i}": F.col("rotation")[i] for i in range(9)} | {f"t{i}": F.col("t")[i] for i in range(3)}
    cameras = views.select("pair_id", "side", *[c.alias(n) for n, c in camera.items()]).groupBy("pair_id", "side").agg(*[F.any_value(n).alias(n) for n in camera])
    other = cameras.select("pair_id", (3 - F.col("side")).alias("side"), *camera)
    # rows are many and cameras few, so rows are not sorted for the join
    rows = views.select("pair_id", "side", "pix", "x", "y", "z").join(other.hint("shuffle_hash"), ["pair_id", "side"])
    rows = rows.withColumn("p", geo.to_camera(F.struct("x", "y", "z"), [F.col(f"r{i}") for i in range(9)], [F.col(f"t{i}") for i in range(3)]))
    u, v = (F.col("focal") * F.col(f"p.{c}") / F.col("p.z") + F.col(o) for c, o in (("x", "cx"), ("y", "cy")))
    # a point in the other camera's plane falls on no pixel
    there = F.when(F.col("p.z") != 0, geo.ravel(u, v, F.lit(width), F.lit(height)))
    rows = rows.select("pair_id", "side", "pix", there.alias("to")).where("to IS NOT NULL")
    one = rows.where("side = 1").select("pair_id", F.col("pix").alias("a"), F.col("to").alias("b"))
    two = rows.where("side = 2").select("pair_id", F.col("to").alias("a"), F.col("pix").alias("b"))
    return matching.reciprocal(one, two, on=("pair_id",)).select("pair_id", F.col("a").alias("pix1"), F.col("b").alias("pix2"))


def sampled_matches(matches: DataFrame, pixels: int, n: int, negative: float = 0.0, seed: int = 0) -> DataFrame:
    """pair_id, pix1, pix2, valid: n rows of each pair of matches(pair_id, pix1, pix2), those of smallest hash.

    A part ``negative`` of them, and what matches there are too few for, are pixels that no match has, of ``pixels``
    in an image, paired in order of hash; a pair with too few of those gets more matches, as far as there are any.
    """
    order = lambda *cs: Window.partitionBy("pair_id").orderBy(F.xxhash64(*cs, F.lit(seed)), *cs)
    good = matches.select("pair_id", "pix1", "pix2", F.row_number().over(order("pix1", "pix2")).alias("r"), F.count("*").over(Window.partitionBy("pair_id")).alias("n_good"))
    sizes = good.groupBy("pair_id").agg(F.first("n_good").alias("n_good"))
    wanted = F.least(F.col("n_good"), F.lit(int(n * (1 - negative))))
    free = F.lit(pixels) - F.col("n_good")
    sizes = sizes.withColumn("n_bad", F.least(F.lit(n) - wanted, F.greatest(free, F.lit(0)))).withColumn("take", F.lit(n) - F.col("n_bad"))
    every = sizes.select("pair_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pixels - 1).cast("long"))).alias("pix"))

    def missing(col: str) -> DataFrame:
        left = every.join(matches.select("pair_id", F.col(col).alias("pix")), ["pair_id", "pix"], "left_anti")
        return left.select("pair_id", F.col("pix").alias(col), F.row_number().over(order("pix")).alias("r"))

    bad = missing("pix1").join(missing("pix2"), ["pair_id", "r"]).join(sizes, "pair_id").where(F.col("r") <= F.col("n_bad"))
    top = good.drop("n_good").join(sizes, "pair_id").where(F.col("r") <= F.col("take"))
    return top.select("pair_id", "pix1", "pix2", F.lit(True).alias("valid")).union(bad.select("pair_id", "pix1", "pix2", F.lit(False)))


def best_crops(matches: DataFrame, crops1: DataFrame, crops2: DataFrame, cell: float = 256.0) -> DataFrame:
    """pair_id, crop1, crop2, n: the two crops that hold both ends of most of a pair's matches.

    matches(pair_id, pos, x1, y1, x2, y2), crops(cell_id, x0, y0, x1, y1); ties go to the smaller crops.
    """
    def inside(n: int, crops: DataFrame) -> DataFrame:
        ends = matches.select("pair_id", "pos", F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y"))
        return tiling.contained(ends, crops, cell).select("pair_id", "pos", F.col("cell_id").alias(f"crop{n}"))

    both = inside(1, crops1).join(inside(2, crops2), ["pair_id", "pos"]).groupBy("pair_id", "crop1", "crop2").agg(F.count("*").alias("n"))
    top = both.groupBy("pair_id").agg(F.min(F.struct((-F.col("n")).alias("less"), "crop1", "crop2")).alias("m"))
    return top.select("pair_id", "m.crop1", "m.crop2", (-F.col("m.less")).alias("n"))


def evenly_spaced(rows: DataFrame, n: int, by: tuple[str, ...], order: str) -> DataFrame:
    """n rows of each group at even places from first to last, rounded half to even; a place that is hit twice gives
    its row twice."""
    window = Window.partitionBy(*by)
    placed = rows.withColumn("__place", F.row_number().over(window.orderBy(order)) - 1).withColumn("__last", F.count("*").over(window) - 1)
    hit = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.rint(i * F.col("__last") / F.lit(max(1, n - 1))) == F.col("__place"))
    return placed.withColumn("__hit", F.explode(hit)).drop("__place", "__last", "__hit")


BOX = ("x0", "y0", "x1", "y1")


def window_grid(images: DataFrame, longest: int = 512, overlap: float = 0.5) -> DataFrame:
    """image_id, cell_id, x0 .., width, height: even windows of the image's shape, sides multiples of 16, at a normal aspect."""
    w, h = F.col("width"), F.col("height")
    side = lambda c: F.greatest(F.lit(16), F.floor(c * longest / F.greatest(w, h) / 16) * 16).cast("int")
    rows = images.select("image_id", "width", "height", side(w).alias("w"), side(h).alias("h"))
    rows = rows.withColumns({"xs": tiling.window_starts(w, F.col("w"), overlap), "ys": tiling.window_starts(h, F.col("h"), overlap)})
    cells = F.flatten(F.transform("ys", lambda y: F.transform("xs", lambda x: geo.normal_window(x, y, x + F.col("w"), y + F.col("h"), w, h))))
    return rows.select("image_id", "width", "height", F.posexplode(cells).alias("cell_id", "c")).select("image_id", "cell_id", "width", "height", "c.*")


def _scored(matches: DataFrame, cells: DataFrame, sizes: DataFrame, least: int, cell: float) -> DataFrame:
    """pair columns, pos, a box of image 1 and the window of image 2 that its matches fill, and the weight of each match."""
    own = cells.select(F.col("image_id").alias("one"), "cell_id", *BOX)
    inside = tiling.contained(matches.withColumn("x", F.col("x1")).withColumn("y", F.col("y1")).drop("x1", "y1"), own.select("one", "cell_id", *BOX), cell, ("one",))
    inside = stash(inside.select("pair", "one", "two", "pos", "cell_id", *BOX, F.col("x").alias("px1"), F.col("y").alias("py1"), F.col("x2").alias("px2"), F.col("y2").alias("py2")), "inside")
    spread = lambda c: F.greatest(F.expr(f"percentile({c}, 0.9)") - F.expr(f"percentile({c}, 0.1)"), F.lit(20.0))
    key = ["pair", "one", "two", "cell_id", *BOX]
    found = inside.groupBy(*key).agg(F.count("*").alias("n"), *[F.avg(f"p{c}2").alias(f"m{c}") for c in "xy"], *[(spread(f"p{c}2") / spread(f"p{c}1")).alias(f"s{c}") for c in "xy"]).where(F.col("n") >= least)
    found = found.join(sizes.select(F.col("image_id").alias("two"), "width", "height"), "two")
    half = {c: (F.col(f"{c}1") - F.col(f"{c}0")) * F.col(f"s{c}") / 2 for c in "xy"}
    other = geo.normal_window(*[F.col(f"m{c}") + sign * half[c] for sign in (-1, 1) for c in "xy"], F.col("width"), F.col("height"))
    found = found.select(*key, other.alias("o"))
    rows = inside.join(found.select("pair", "one", "two", "cell_id", "o"), ["pair", "one", "two", "cell_id"])
    box = lambda c: F.col(f"o.{c}").cast("double")
    w = geo.gaussian_centre_weight(F.col("px1"), F.col("py1"), *[F.col(c).cast("double") for c in BOX]) * geo.gaussian_centre_weight(F.col("px2"), F.col("py2"), *map(box, BOX))
    return rows.select("pair", "pos", F.struct(*[F.col(c).cast("long").alias(c) for c in BOX]).alias("first"), F.col("o").alias("second"), w.alias("w"))


def _cover(target: float):
    boxes = [f"{c}_{n}" for n in (1, 2) for c in BOX]

    def cover(pdf: pd.DataFrame) -> pd.DataFrame:
        weights = pdf.pivot_table(index=boxes, columns="pos", values="w", aggfunc="max", fill_value=0.0).sort_index()
        left, total, got, picks = weights.to_numpy().copy(), weights.to_numpy().max(axis=0).sum(), 0.0, []
        while got < target * total - 1e-12:
            best = int(left.sum(axis=1).argmax())
            gain = left[best].copy()
            if gain.sum() <= 0:
                break
            picks.append((*weights.index[best], len(picks), float(gain.sum())))
            got += gain.sum()
            left = (left - gain).clip(min=0)
        out = pd.DataFrame(picks, columns=[*boxes, "ord", "gain"])
        return out.assign(src=pdf.src.iloc[0], dst=pdf.dst.iloc[0])[["src", "dst", "ord", "gain", *boxes]]

    return cover


def crop_pairs(images: DataFrame, matches: DataFrame, longest: int = 512, overlap: float = 0.5, least: int = 10, target: float = 0.9) -> DataFrame:
    """src, dst, ord, gain and boxes x0_1 .. y1_2: crops of both images that together show most of a pair's matches.

    Windows of each image with ``least`` matches or more get the window of the other image that their matches fill;
    of these crop pairs, from both sides, the one that adds most weight is taken in turn, until a share ``target`` of
    what all could show is reached.  A match weighs by how near it is to the middles of both windows.  A pair's crops
    and matches bound a task.
    """
    cells = stash(window_grid(images, longest, overlap), "windows")
    sizes = images.select("image_id", "width", "height")
    ends = lambda a, b: matches.select(F.struct("src", "dst").alias("pair"), "pos", F.col("src" if a == 1 else "dst").alias("one"), F.col("dst" if a == 1 else "src").alias("two"), *[F.col(f"{c}{n}").alias(f"{c}{m}") for m, n in ((1, a), (2, b)) for c in "xy"])
    there, back = (_scored(ends(a, 3 - a), cells, sizes, least, float(longest)) for a in (1, 2))
    rows = there.union(back.select("pair", "pos", F.col("second").alias("first"), F.col("first").alias("second"), "w"))
    flat = [F.col(f"{side}.{c}").alias(f"{c}_{n}") for n, side in ((1, "first"), (2, "second")) for c in BOX]
    rows = rows.select("pair.src", "pair.dst", "pos", *flat, "w")
    schema = "src long, dst long, ord int, gain double, " + ", ".join(f"{c}_{n} long" for n in (1, 2) for c in BOX)
    return rows.groupBy("src", "dst").applyInPandas(_cover(target), schema)

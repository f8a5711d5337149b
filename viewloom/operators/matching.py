"""Descriptor matching: nearest neighbours of image pairs in both directions, mutual best, and merges of matches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stash

BEST = "src long, dst long, a long, b long, forward boolean, score double"
BLOCK = 8192
#: Rows of a block that are multiplied at a time.
STRIP = 512


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _best(metric: str):
    def best(key, left, right):
        src, dst = (k.as_py() for k in key[:2])
        names = [x.split()[0] for x in BEST.split(", ")]
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, (pa.int64(),) * 4 + (pa.bool_(), pa.float64()))})
        a, b = np.array(left.column("kp")), np.array(right.column("kp"))
        by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[by_a], b[by_b]
        x, y = _matrix(left.column("v"))[by_a], _matrix(right.column("v"))[by_b]
        to, there = np.empty(len(a), np.int64), np.empty(len(a))
        fro, back = np.zeros(len(b), np.int64), np.full(len(b), -np.inf)
        for i in range(0, len(a), STRIP):
            part = x[i : i + STRIP]
            s = part @ y.T
            if metric == "l2":
                s = -np.sqrt(np.maximum(0.0, (part * part).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * s))
            to[i : i + STRIP], there[i : i + STRIP] = s.argmax(axis=1), s.max(axis=1)
            first, best = s.argmax(axis=0), s.max(axis=0)
            fro, back = np.where(best > back, first + i, fro), np.maximum(best, back)
        cols = (np.concatenate([a, a[fro]]), np.concatenate([b[to], b]), np.repeat([True, False], [len(a), len(b)]), np.concatenate([there, back]))
        n = len(cols[0])
        return pa.table(dict(zip(names, (np.full(n, src), np.full(n, dst), *cols))))

    return best


def nearest_both_ways(descriptors: DataFrame, pairs: DataFrame, metric: str = "dot", block: int = BLOCK) -> DataFrame:
    """src, dst, a, b, forward, score: each keypoint's nearest in the pair's other image, ties to the smaller id.

    descriptors(image_id, kp, v); metric 'dot' (score = inner product) or 'l2' (score = minus the distance).  Images
    are cut into blocks of keypoints; a task multiplies two blocks, and blocks meet by their best, so an image's
    size bounds no task's memory.  An image's descriptors go once to each block of its partners.
    """
    sizes = descriptors.groupBy("image_id").agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("blocks"))
    rows = descriptors.select("image_id", "kp", "v").join(sizes, "image_id").withColumn("block", F.pmod(F.xxhash64("kp"), F.col("blocks")))
    p = pairs.select("src", "dst").distinct()
    p = p.join(sizes.select(F.col("image_id").alias("src"), F.col("blocks").alias("nx")), "src").join(sizes.select(F.col("image_id").alias("dst"), F.col("blocks").alias("ny")), "dst")
    span = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    left = p.withColumn("by", span("ny")).join(rows, F.col("src") == F.col("image_id")).select(F.col("src").alias("src"), F.col("dst").alias("dst"), F.col("block").alias("bx"), "by", F.col("kp").alias("kp"), F.col("v").alias("v"))
    right = p.withColumn("bx", span("nx")).join(rows, F.col("dst") == F.col("image_id")).select(F.col("src").alias("src"), F.col("dst").alias("dst"), "bx", F.col("block").alias("by"), F.col("kp").alias("kp"), F.col("v").alias("v"))
    keys = ["src", "dst", "bx", "by"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best(metric), BEST)
    top = lambda side, other: (
        best.where(F.col("forward") if side == "a" else ~F.col("forward")).groupBy("src", "dst", side)
        .agg(F.max_by(F.struct(other, "score"), F.struct("score", -F.col(other))).alias("m"))
        .select("src", "dst", F.col(side), F.col(f"m.{other}").alias(other), F.lit(side == "a").alias("forward"), F.col("m.score").alias("score"))
    )
    return top("a", "b").unionByName(top("b", "a"))


def mutual(best: DataFrame) -> DataFrame:
    """src, dst, a, b, score of keypoints that are each other's nearest."""
    both = best.groupBy("src", "dst", "a", "b").agg(F.count_if(F.col("forward")).alias("f"), F.count_if(~F.col("forward")).alias("r"), F.max("score").alias("score"))
    return both.where("f > 0 AND r > 0").select("src", "dst", "a", "b", "score")


def reciprocal(forward: DataFrame, backward: DataFrame, on: tuple[str, ...] = ()) -> DataFrame:
    """(a, b) with forward(a -> b) and backward(b -> a); on: columns that name the image pair."""
    return forward.join(backward.select(*on, "a", "b"), [*on, "a", "b"], "left_semi")


def confident(matches: DataFrame, threshold: float, col: str = "conf", strict: bool = False) -> DataFrame:
    """Matches keep conf >= threshold; dense masks (strict) conf > threshold."""
    return matches.where(F.col(col) > threshold if strict else F.col(col) >= threshold)


def cached_confident(corres: DataFrame, threshold: float) -> DataFrame:
    """A cached table's rows: all at threshold 0, else strictly above it."""
    return corres if threshold == 0 else corres.where(F.col("conf") > threshold)


def cached_pair(corres: DataFrame, src, dst) -> DataFrame:
    """The cached matches of a pair in either orientation, turned to (src, dst)."""
    same = corres.where((F.col("src") == src) & (F.col("dst") == dst))
    turned = corres.where((F.col("src") == dst) & (F.col("dst") == src))
    flip = {"src": "dst", "dst": "src", "pix1": "pix2", "pix2": "pix1"}
    return same.unionByName(turned.select(*[F.col(flip.get(c, c)).alias(c) for c in corres.columns]))


def merge_corres(corres: DataFrame, position: str = "pos") -> DataFrame:
    """Distinct (pix1, pix2) per pair with the position of the first, and its other columns."""
    rest = [c for c in corres.columns if c not in ("src", "dst", "pix1", "pix2")]
    first = corres.groupBy("src", "dst", "pix1", "pix2").agg(F.min_by(F.struct(*rest), F.col(position)).alias("r"))
    return first.select("src", "dst", "pix1", "pix2", "r.*")


def union_directions(there: DataFrame, back: DataFrame, combine: str = "min") -> DataFrame:
    """Matches of both directions with one confidence: the lesser, or the root of the product; first one wins."""
    conf = F.least("conf1", "conf2") if combine == "min" else F.sqrt(F.col("conf1") * F.col("conf2"))
    pick = lambda d, tag: d.select("src", "dst", "pix1", "pix2", conf.alias("conf"), F.struct(F.lit(tag).alias("tag"), F.col("pos").cast("long").alias("pos")).alias("pos"))
    return merge_corres(pick(there, 0).unionByName(pick(back, 1))).drop("pos")


def iterated_reciprocal(seeds: DataFrame, forward: DataFrame, backward: DataFrame, rounds: int = 10, on: tuple[str, ...] = (), basin: bool = False) -> DataFrame:
    """(p1, p2) that seeds(p1) converge to by going forward(p1 -> p2) and backward(p2 -> p1) in turns.

    A seed is done when p2, or then p1, repeats; seeds still under way after the last round are left out.  on: columns
    of all three that name the image pair, each done by itself.  basin: one row per seed instead, as seed, p1, p2;
    p1 and p2 are null where it does not converge.  Every round is two equi-joins of the seeds under way, which are
    written in the shared folder; the maps must be materialised.
    """
    there = forward.select(*on, F.col("a").alias("p1"), F.col("b").alias("next"))
    back = backward.select(*on, F.col("b").alias("p2"), F.col("a").alias("next"))
    first = seeds.select(*on, "p1").distinct()
    own = ["seed"] if basin else []
    live, done = first.withColumn("seed", F.col("p1")).select(*on, *own, "p1", F.lit(-1).cast("long").alias("p2")), None
    for _ in range(rounds):
        to = live.join(there, [*on, "p1"]).select(*on, *own, "p1", F.col("next").alias("p2"), F.col("p2").alias("was"))
        fro = to.where("p2 <> was").join(back, [*on, "p2"]).select(*on, *own, F.col("next").alias("p1"), "p2", (F.col("next") == F.col("p1")).alias("settled"))
        step = stash(to.where("p2 = was").select(*on, *own, "p1", "p2", F.lit(True).alias("settled")).unionByName(fro).distinct(), "reciprocal")
        settled = step.where("settled").drop("settled")
        done = settled if done is None else done.unionByName(settled)
        live = step.where("NOT settled").drop("settled")
        if live.isEmpty():
            break
    if not basin:
        return done.distinct()
    return first.withColumnRenamed("p1", "seed").join(done.distinct(), [*on, "seed"], "left")


def tolerant(seeds: DataFrame, forward: DataFrame, backward: DataFrame, width: int, tolerance: float, on: tuple[str, ...] = ()) -> DataFrame:
    """One round from each seed p1; kept, with the seed itself, where the way back ends closer than tolerance pixels."""
    there = forward.select(*on, F.col("a").alias("p1"), F.col("b").alias("p2"))
    back = backward.select(*on, F.col("b").alias("p2"), F.col("a").alias("end"))
    dx = F.pmod("p1", F.lit(width)) - F.pmod("end", F.lit(width))
    dy = F.floor(F.col("p1") / width) - F.floor(F.col("end") / width)
    rows = seeds.select(*on, "p1").distinct().join(there, [*on, "p1"]).join(back, [*on, "p2"])
    return rows.where(F.sqrt((dx * dx + dy * dy).cast("double")) < tolerance).select(*on, "p1", "p2")


def match_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("src", "dst").agg(F.count("*").alias("n_matches"))


def enough_matches(matches: DataFrame, more_than: int = 15) -> DataFrame:
    """Pairs, canonical, with more than so many matches."""
    key = [F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")]
    return matches.groupBy(*key).agg(F.count("*").alias("n_matches")).where(F.col("n_matches") > more_than)


def pair_gate(matches: DataFrame, fallback: DataFrame, threshold: float) -> DataFrame:
    """A pair's matches if their largest confidence exceeds the threshold, else its fallback rows."""
    good = matches.groupBy("src", "dst").agg(F.max("conf").alias("top")).where(F.col("top") > threshold).select("src", "dst")
    return matches.join(good, ["src", "dst"], "left_semi").unionByName(fallback.join(good, ["src", "dst"], "left_anti"))


def first_negatives(pixels: DataFrame, matched: DataFrame, n: int) -> DataFrame:
    """Each image's first n pixels, in raster order, that no match has."""
    free = pixels.join(matched.select("image_id", "pix").distinct(), ["image_id", "pix"], "left_anti")
    place = F.row_number().over(Window.partitionBy("image_id").orderBy("pix"))
    return free.withColumn("place", place).where(F.col("place") <= n).drop("place")


def lookup(matches: DataFrame, values: DataFrame, col: str = "pix1", image: str = "src") -> DataFrame:
    """Matches with the columns of values(image_id, pix, ...) at one end."""
    return matches.join(values.withColumnsRenamed({"image_id": image, "pix": col}), [image, col])


def top_by_norm(features: DataFrame, n: int) -> DataFrame:
    """Each image's n features (image_id, pos, feat) of largest norm, ties to the smaller position, with norm and rank."""
    norm = F.sqrt(F.aggregate("feat", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    order = Window.partitionBy("image_id").orderBy(F.desc("norm"), "pos")
    return features.withColumn("norm", norm).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_local(features: DataFrame, k: int) -> DataFrame:
    """Each image's k features of most attention, ties to the smaller position; k < 0: that part in percent."""
    order = Window.partitionBy("image_id").orderBy(F.desc("attn"), "pos")
    rows = features.withColumn("rank", F.row_number().over(order))
    if k >= 0:
        return rows.where(F.col("rank") <= k)
    n = F.count("*").over(Window.partitionBy("image_id"))
    return rows.withColumn("n", n).where(F.col("rank") <= F.floor(F.lit(-k) * F.col("n") / 100)).drop("n")

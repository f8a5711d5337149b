"""Keypoints and multi-view tracks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import placed, stash, sums_before
from .components import connected_components


def both_ends(matches: DataFrame) -> DataFrame:
    """image_id, x, y of both ends of raw matches (src, dst, x1, y1, x2, y2); duplicates stay."""
    end = lambda i, n: matches.select(F.col(i).alias("image_id"), F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y"))
    return end("src", 1).union(end("dst", 2))


def distinct_keypoints(points: DataFrame) -> DataFrame:
    """image_id, kp_idx, x, y: distinct keypoints, numbered by (x, y) within their image from 0."""
    order = Window.partitionBy("image_id").orderBy("x", "y")
    return points.select("image_id", "x", "y").distinct().select("image_id", (F.row_number().over(order) - 1).cast("long").alias("kp_idx"), "x", "y")


def rounded_keypoints(points: DataFrame, position: str = "pos") -> DataFrame:
    """The first point of each group with equal coordinates rounded half to even."""
    first = points.groupBy("image_id", F.rint("x").alias("rx"), F.rint("y").alias("ry")).agg(F.min_by(F.struct("x", "y"), F.col(position)).alias("p"))
    return first.select("image_id", "p.x", "p.y")


def suppress_close(points: DataFrame, radius: float) -> DataFrame:
    """Points (image_id, kp_idx, x, y) that no point of smaller index lies within radius of; a join on grid cells.

    Cells are twice as wide as the radius, so a point reaches into four of them at most, or a margin further.
    """
    cell = lambda v: F.floor(v / (2 * radius))
    reach = lambda c: F.lit(radius * (1 + 1e-6)) + 1e-12 * F.abs(F.col(c))
    span = lambda c: F.explode(F.sequence(cell(F.col(c) - reach(c)), cell(F.col(c) + reach(c))))
    near = points.withColumn("cx", span("x")).withColumn("cy", span("y"))
    near = near.select("image_id", "cx", "cy", F.col("kp_idx").alias("o"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    rows = points.withColumn("cx", cell(F.col("x"))).withColumn("cy", cell(F.col("y"))).join(near, ["image_id", "cx", "cy"])
    close = rows.where((F.col("o") < F.col("kp_idx")) & (F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy")) <= radius)).select("image_id", "kp_idx").distinct()
    return points.join(close, ["image_id", "kp_idx"], "left_anti")


def radius_nearest(raw: DataFrame, keypoints: DataFrame, radius: float) -> DataFrame:
    """raw(image_id, pos, x, y) with kp_idx of the nearest keypoint closer than radius, null if none; ties: smaller index.

    Cells are as wide as the radius and a keypoint is looked for in 3 x 3 of them.
    """
    cell = lambda c: F.floor(F.col(c) / radius)
    spread = keypoints.select("image_id", "kp_idx", F.col("x").alias("kx"), F.col("y").alias("ky"), F.explode(F.sequence(cell("x") - 1, cell("x") + 1)).alias("cx"), cell("y").alias("by"))
    spread = spread.withColumn("cy", F.explode(F.sequence(F.col("by") - 1, F.col("by") + 1))).drop("by")
    rows = raw.withColumn("cx", cell("x")).withColumn("cy", cell("y")).join(spread, ["image_id", "cx", "cy"])
    rows = rows.withColumn("d", F.hypot(F.col("x") - F.col("kx"), F.col("y") - F.col("ky"))).where(F.col("d") < radius)
    best = rows.groupBy("image_id", "pos").agg(F.min_by("kp_idx", F.struct("d", "kp_idx")).alias("kp_idx"))
    return raw.join(best, ["image_id", "pos"], "left")


def occurrence_counts(points: DataFrame) -> DataFrame:
    """Occurrences of each (image_id, pix)."""
    return points.groupBy("image_id", "pix").agg(F.count("*").alias("n"))


def index_pairs(matches: DataFrame) -> DataFrame:
    """Distinct index pairs of image pairs in canonical order, ends swapped with the images."""
    turn = F.col("src") > F.col("dst")
    pick = lambda a, b: F.when(turn, F.col(b)).otherwise(F.col(a))
    return matches.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), pick("pix1", "pix2").alias("pix1"), pick("pix2", "pix1").alias("pix2")).distinct()


def _vertices(edges: DataFrame) -> DataFrame:
    key = lambda i, k: F.struct(F.col(i).cast("long").alias("image_id"), F.col(k).cast("long").alias("kp_id"))
    return edges.withColumn("a", key("src", "a_kp")).withColumn("b", key("dst", "b_kp"))


def track_name(vertex: str):
    """A track's id: its first vertex, image and keypoint."""
    return F.format_string("%012d:%012d", F.col(f"{vertex}.image_id"), F.col(f"{vertex}.kp_id"))


def component_tracks(edges: DataFrame) -> DataFrame:
    """image_id, kp_id, track_id over edges (src, a_kp, dst, b_kp): connected components, a track's id its first vertex."""
    parts = connected_components(_vertices(edges))
    return parts.select("node.image_id", "node.kp_id", track_name("component").alias("track_id"))


def _guarded(frames, most: int):
    """(x, y): the track x that each track y ends in, by each component's edges in order; an edge whose tracks share an
    image is refused.

    Edges come sorted by component and place and are not kept.  A refused edge keeps nothing either, so what is held is
    the merged tracks of one component, ``most`` at most: the edge that would bring in more ends its component's turn.
    """
    parent: dict[tuple, tuple] = {}
    images: dict[tuple, set] = {}
    part, full, done = None, False, []

    def find(x):
        while parent.get(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def merged():
        return [(*find(v), *v) for v in parent if parent[v] != v]

    for pdf in frames:
        for row in pdf[["ci", "ck", "xi", "xk", "yi", "yk", "ix", "iy"]].itertuples(index=False, name=None):
            if row[:2] != part:
                done += merged()
                part, full, parent, images = row[:2], False, {}, {}
            if full:
                continue
            ends = row[2:4], row[4:6]
            roots = [find(v) for v in ends]
            own = [images[r] if r in parent else set(seen) for r, seen in zip(roots, row[6:])]
            if roots[0] == roots[1] or not own[0].isdisjoint(own[1]):
                continue
            if len(parent) + sum(v not in parent for v in ends) > most:
                full = True
                continue
            parent.update((v, v) for v in ends if v not in parent)
            x, y = sorted(roots)
            parent[y] = x
            images.pop(y, None)
            less, images[x] = sorted(own, key=len)
            images[x] |= less
        yield pd.DataFrame(done, columns=["xi", "xk", "yi", "yk"], dtype="int64")
        done = []
    yield pd.DataFrame(merged(), columns=["xi", "xk", "yi", "yk"], dtype="int64")


def _apart(live: DataFrame, names: DataFrame) -> DataFrame:
    """The first edge between each two tracks that share no image, with both image sets.

    names(vertex, track); a track has one vertex of an image, so its vertices' images are its set.
    """
    for end in "xy":
        live = live.join(names.select(F.col("vertex").alias(end), F.col("track").alias(f"{end}_track")), end)
    x, y = F.least("x_track", "y_track").alias("x"), F.greatest("x_track", "y_track").alias("y")
    ends = live.where("x_track <> y_track").groupBy("component", x, y).agg(F.min("e").alias("e"))
    sets = names.groupBy("track").agg(F.collect_list("vertex.image_id").alias("images"))
    for end in "xy":
        ends = ends.join(sets.select(F.col("track").alias(end), F.col("images").alias(f"i{end}")), end)
    return ends.where(~F.arrays_overlap("ix", "iy"))


def _decided(live: DataFrame, most: int) -> DataFrame:
    """(x, y): the track x that each track y ends in by the edges of each component, as far as its turn goes."""
    ends = [F.col(f"{v}.{f}").alias(f"{v[0]}{c}") for v in ("component", "x", "y") for f, c in (("image_id", "i"), ("kp_id", "k"))]
    dealt = live.repartition("component").sortWithinPartitions("component", "e").select(*ends, "ix", "iy")
    done = dealt.mapInPandas(lambda frames: _guarded(frames, most), "xi long, xk long, yi long, yk long")
    vertex = lambda v: F.struct(F.col(f"{v}i").alias("image_id"), F.col(f"{v}k").alias("kp_id")).alias(v)
    return done.select(vertex("x"), vertex("y"))


def guarded_tracks(edges: DataFrame, group_edges: int = 200_000) -> DataFrame:
    """image_id, kp_id, track_id: tracks with at most one keypoint per image.  Edges are taken in the order (src, a_kp,
    dst, b_kp), and one that would put two keypoints of an image together is refused; its ends stay vertices.

    Unions never cross connected components.  A component's edges stream past one task in order, which merges tracks
    until it holds 2 * group_edges of them, the ends of as many merging edges.  Then a round over tables renames the
    ends of all edges and drops those within a track or between tracks that share an image, for tracks only grow, and
    those after the first of two tracks.  A round but the last makes group_edges merges or more of a component, so
    their number goes with its vertices, not with its edges.
    """
    canonical = edges.select(*[F.when(F.struct("src", "a_kp") <= F.struct(F.col("dst"), F.col("b_kp")), F.col(x)).otherwise(F.col(y)).cast("long").alias(z) for x, y, z in (("src", "dst", "src"), ("a_kp", "b_kp", "a_kp"), ("dst", "src", "dst"), ("b_kp", "a_kp", "b_kp"))]).distinct()
    keyed = _vertices(stash(canonical, "edges"))
    parts = stash(connected_components(keyed).select(F.col("node").alias("vertex"), "component"), "components")
    live = keyed.join(parts.withColumnRenamed("vertex", "a"), "a").select("component", F.struct("src", "a_kp", "dst", "b_kp").alias("e"), F.col("a").alias("x"), F.col("b").alias("y"))
    names = parts.select("vertex", F.col("vertex").alias("track"))
    while True:
        live = stash(_apart(live, names), "edges")
        if live.isEmpty():
            return names.select("vertex.image_id", "vertex.kp_id", track_name("track").alias("track_id"))
        won = stash(_decided(live, 2 * group_edges), "merged")
        names = stash(names.join(won.select(F.col("y").alias("track"), "x"), "track", "left").select("vertex", F.coalesce("x", "track").alias("track")), "tracks")


def one_per_image(tracks: DataFrame, position: str = "kp_id") -> DataFrame:
    """One representative keypoint per (track, image), with the track's number of distinct images."""
    rows = tracks.groupBy("track_id", "image_id").agg(F.min_by("kp_id", F.col(position)).alias("kp_id"))
    return rows.withColumn("n_images", F.count("*").over(Window.partitionBy("track_id")))


def track_lengths(tracks: DataFrame) -> DataFrame:
    """Keypoints and distinct images of each track."""
    return tracks.groupBy("track_id").agg(F.count("*").alias("n_keypoints"), F.countDistinct("image_id").alias("n_images"))


def long_tracks(tracks: DataFrame, least: int) -> DataFrame:
    """Keypoints of tracks with at least so many keypoints, numbered per image from 0 by (track, keypoint)."""
    n = F.count("*").over(Window.partitionBy("track_id"))
    order = Window.partitionBy("image_id").orderBy("track_id", "kp_id")
    return tracks.withColumn("n", n).where(F.col("n") >= least).withColumn("kp_idx", (F.row_number().over(order) - 1).cast("long"))


def _met_parts(kept: DataFrame, part: int) -> tuple[DataFrame, DataFrame]:
    """The keypoints of each track's parts as the first and as the second of two parts p1 <= p2 that meet."""
    sizes = kept.groupBy("track_id").agg(F.ceil(F.count("*") / F.lit(part)).cast("long").alias("parts"))
    rows = kept.select("track_id", "image_id", "kp_idx").join(sizes, "track_id").withColumn("own", F.pmod(F.xxhash64("image_id", "kp_idx"), F.col("parts")))
    later, earlier = F.sequence(F.col("own"), F.col("parts") - 1), F.sequence(F.lit(0).cast("long"), F.col("own"))
    one = rows.select("track_id", F.col("own").alias("p1"), F.explode(later).alias("p2"), F.col("image_id").alias("i1"), F.col("kp_idx").alias("k1"))
    two = rows.select("track_id", F.explode(earlier).alias("p1"), F.col("own").alias("p2"), F.col("image_id").alias("i2"), F.col("kp_idx").alias("k2"))
    return one, two


def closure_pairs(kept: DataFrame, part: int = 2048) -> DataFrame:
    """All pairs of a track's keypoints in images src < dst, by their new numbers.

    The result is quadratic in a track's keypoints.  They are dealt to parts of about ``part``, and each two parts meet
    once, so a long track is work of many tasks that hold a part each, and no pair is made in the other order as well.
    """
    n = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one, two = _met_parts(kept, part)
    # a given number of partitions, for the rows are few and the pairs many
    keys = ["track_id", "p1", "p2"]
    met = one.repartition(n, *keys).join(two.repartition(n, *keys), keys).where("i1 < i2 OR (i1 > i2 AND p1 < p2)")
    turned = lambda a, b: F.when(F.col("i1") < F.col("i2"), F.col(a)).otherwise(F.col(b))
    return met.select(F.least("i1", "i2").alias("src"), F.greatest("i1", "i2").alias("dst"), turned("k1", "k2").alias("kp_idx1"), turned("k2", "k1").alias("kp_idx2"))


def observed_pairs(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Observed edges with both ends kept, by their new numbers."""
    one = kept.select(F.col("image_id").alias("src"), F.col("kp_id").alias("a_kp"), F.col("kp_idx").alias("kp_idx1"))
    two = kept.select(F.col("image_id").alias("dst"), F.col("kp_id").alias("b_kp"), F.col("kp_idx").alias("kp_idx2"))
    return edges.join(one, ["src", "a_kp"]).join(two, ["dst", "b_kp"]).select("src", "dst", "kp_idx1", "kp_idx2")


def offsets(counts: DataFrame) -> DataFrame:
    """counts(image_id, n) with the number of items of all images before."""
    return sums_before(counts, "n", "image_id", name="offset")


def track_positions(observations: DataFrame, position: str = "pos") -> DataFrame:
    """Mean position of each track over its distinct (image, pixel) observations, the first of each, and their number."""
    rows = observations.groupBy("track_id", "image_id", "pix").agg(F.min_by(F.struct("x", "y", "z"), F.col(position)).alias("p")).select("track_id", "p.*")
    return rows.groupBy("track_id").agg(*[F.avg(c).alias(c) for c in ("x", "y", "z")], F.count("*").alias("n_obs"))


def first_colours(observations: DataFrame, position: str = "pos", default: int = 200) -> DataFrame:
    """Colour of each track's first observation inside its image; grey where it is outside or unknown."""
    first = observations.groupBy("track_id").agg(F.min_by(F.struct("x", "y", "width", "height", "r", "g", "b"), F.col(position)).alias("o"))
    inside = (F.col("o.x") >= 0) & (F.col("o.x") < F.col("o.width")) & (F.col("o.y") >= 0) & (F.col("o.y") < F.col("o.height"))
    return first.select("track_id", *[F.coalesce(F.when(inside, F.col(f"o.{c}")), F.lit(default)).alias(c) for c in "rgb"])


def rounded_groups(points: DataFrame, digits: int = 4) -> DataFrame:
    """points(x, y, z) with the number of their group of equal rounded coordinates."""
    keys = [F.bround(F.col(c), digits).alias(f"r{c}") for c in "xyz"]
    groups = placed(points.select(*keys).distinct(), "rx", "ry", "rz", name="group_id")
    return points.withColumns({f"r{c}": F.bround(F.col(c), digits) for c in "xyz"}).join(groups, ["rx", "ry", "rz"]).drop("rx", "ry", "rz")


def mean_length(tracks: DataFrame) -> DataFrame:
    return track_lengths(tracks).agg(F.avg("n_keypoints").alias("mean_length"))

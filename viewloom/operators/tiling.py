"""Tiles of large images, tile overlap joins, and one-to-one tile matching under an affine map."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _starts(extent: str, size: int, step: int):
    """0, step, 2 step .. below extent - size, and extent - size itself; 0 alone where size covers all."""
    last = F.col(extent) - F.lit(size)
    return F.when(last <= 0, F.array(F.lit(0))).otherwise(F.array_union(F.filter(F.sequence(F.lit(0), last, F.lit(step)), lambda x: x < last), F.array(last)))


def edge_aligned(images: DataFrame, size: int = 512, overlap: int = 128, compat_single: bool = False) -> DataFrame:
    """tile_id, image_id, x0, y0, x1, y1: tiles whose last row and column end at the image's edge.

    An image no larger than a tile on one side is cut along the other; compat_single instead gives one tile that
    claims the whole image.
    """
    w, h = F.col("width").cast("int"), F.col("height").cast("int")
    rows = images.select("image_id", w.alias("w"), h.alias("h"))
    rows = rows.withColumn("xs", _starts("w", size, size - overlap)).withColumn("ys", _starts("h", size, size - overlap))
    if compat_single:
        small = (F.col("w") <= size) | (F.col("h") <= size)
        one = F.array(F.struct(F.lit(0).alias("x0"), F.lit(0).alias("y0"), F.col("w").alias("x1"), F.col("h").alias("y1")))
    cells = F.flatten(F.transform("ys", lambda y: F.transform("xs", lambda x: F.struct(x.alias("x0"), y.alias("y0"), F.least(x + size, F.col("w")).alias("x1"), F.least(y + size, F.col("h")).alias("y1")))))
    rows = rows.select("image_id", F.posexplode(F.when(small, one).otherwise(cells) if compat_single else cells).alias("n", "t"))
    return rows.select(F.format_string("%s_tile_%04d", F.col("image_id").cast("string"), F.col("n")).alias("tile_id"), "image_id", "t.*")


def clipped(images: DataFrame, size: int = 1024, overlap: int = 256) -> DataFrame:
    """Tiles from every step on, cut at the edge; those with a side below the overlap are left out of the count."""
    step = size - overlap
    rows = images.select("image_id", F.col("width").cast("int").alias("w"), F.col("height").cast("int").alias("h"))
    span = lambda c: F.sequence(F.lit(0), F.col(c) - 1, F.lit(step))
    cells = F.flatten(F.transform(span("h"), lambda y: F.transform(span("w"), lambda x: F.struct(x.alias("x0"), y.alias("y0"), F.least(x + size, F.col("w")).alias("x1"), F.least(y + size, F.col("h")).alias("y1")))))
    kept = F.filter(cells, lambda t: (t["x1"] - t["x0"] >= overlap) & (t["y1"] - t["y0"] >= overlap))
    rows = rows.select("image_id", F.posexplode(kept).alias("n", "t"))
    return rows.select(F.format_string("%s_tile_%04d", F.col("image_id").cast("string"), F.col("n")).alias("tile_id"), "image_id", "t.*")


def window_starts(total, size, overlap):
    """Evenly spread starts of windows of a size that overlap by at least a fraction; rounded half to even."""
    total, size = (F.lit(x) if isinstance(x, (int, float)) else x for x in (total, size))
    n = F.when(total <= size, F.lit(1)).otherwise(F.ceil((total - size) / (size * (1 - F.lit(overlap)))).cast("int") + 1)
    step = F.when(n > 1, (total - size) / (n - 1)).otherwise(F.lit(0.0))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.rint(i * step).cast("int"))


def pixel_grid(images: DataFrame, stride: int = 1, centred: bool = False) -> DataFrame:
    """image_id, x, y, pix of every stride-th pixel, from stride / 2 on if centred."""
    first = stride // 2 if centred else 0
    rows = images.where((F.col("width") > first) & (F.col("height") > first)).select("image_id", "width", F.explode(F.sequence(F.lit(first), F.col("height") - 1, F.lit(stride))).alias("y"))
    rows = rows.where(F.col("width") > first).select("image_id", "width", F.explode(F.sequence(F.lit(first), F.col("width") - 1, F.lit(stride))).alias("x"), "y")
    return rows.select("image_id", "x", "y", (F.col("x") + F.col("width") * F.col("y")).alias("pix"))


def intersects(a: str, b: str):
    """Whether boxes a and b of columns prefix_x0 .. meet; touching counts."""
    return (F.col(f"{a}x0") <= F.col(f"{b}x1")) & (F.col(f"{b}x0") <= F.col(f"{a}x1")) & (F.col(f"{a}y0") <= F.col(f"{b}y1")) & (F.col(f"{b}y0") <= F.col(f"{a}y1"))


def overlap_area(a: str, b: str):
    """Common area of two boxes, 0 where they are apart."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(F.col(a + hi), F.col(b + hi)).cast("double") - F.greatest(F.col(a + lo), F.col(b + lo)).cast("double"))
    return side("x0", "x1") * side("y0", "y1")


def _celled(boxes: DataFrame, prefix: str, cell: float) -> DataFrame:
    """One row for each grid cell that a box touches."""
    span = lambda c: F.explode(F.sequence(F.floor(F.col(f"{prefix}{c}0") / cell), F.floor(F.col(f"{prefix}{c}1") / cell)))
    return boxes.withColumn("cx", span("x")).withColumn("cy", span("y"))


def box_join(left: DataFrame, right: DataFrame, cell: float = 512.0, on: tuple[str, ...] = (), most: int = 8192) -> DataFrame:
    """Pairs of boxes a_* and b_* that meet: an equi-join on grid cells, each pair in the first cell they share.

    Where a cell holds more than ``most`` boxes of the left, these are dealt to parts, and those of the right go to
    each part, so that a full cell is no single task's.  Boxes meet by a shuffle whatever their table's size is guessed
    to be, for a guess does not know how many cells they touch and would send them all through the driver.
    """
    keys = [*on, "cx", "cy"]
    one, two = _celled(left, "a_", cell), _celled(right, "b_", cell)
    full = one.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias("__parts")).where("__parts > 1")
    parts = lambda d: d.join(full, keys, "left").withColumn("__parts", F.coalesce("__parts", F.lit(1)))
    one = parts(one).withColumn("__part", F.pmod(F.xxhash64(*[f"a_{c}" for c in ("x0", "y0", "x1", "y1")], *[c for c in left.columns if c.startswith("a_") and c[2:] not in ("x0", "y0", "x1", "y1")]), F.col("__parts")).cast("int")).drop("__parts")
    two = parts(two).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
    rows = one.join(two.hint("merge"), [*keys, "__part"]).drop("__part")
    first = (F.col("cx") == F.greatest(F.floor(F.col("a_x0") / cell), F.floor(F.col("b_x0") / cell))) & (F.col("cy") == F.greatest(F.floor(F.col("a_y0") / cell), F.floor(F.col("b_y0") / cell)))
    return rows.where(first & intersects("a_", "b_")).drop("cx", "cy")


def affine_inverse(m):
    """Inverse of a row-major 2x3 affine array column."""
    a, b, c, d, e, f = (m[i] for i in range(6))
    det = a * e - b * d
    # adding 0 turns -0 to 0
    return F.array(e / det, 0 - b / det, (b * f - c * e) / det + 0.0, 0 - d / det, a / det, (c * d - a * f) / det + 0.0)


def apply_affine(m, x, y):
    """(x, y) under a row-major 2x3 affine array column, as a struct."""
    return F.struct((m[0] * x + m[1] * y + m[2]).alias("x"), (m[3] * x + m[4] * y + m[5]).alias("y"))


def pair_affines(pairs: DataFrame, affines: DataFrame) -> DataFrame:
    """src, dst, m: a pair's own map, else the inverse of the reverse one; pairs with neither drop out."""
    back = affines.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("m").alias("r"))
    rows = pairs.join(affines, ["src", "dst"], "left").join(back, ["src", "dst"], "left")
    return rows.select("src", "dst", F.coalesce("m", affine_inverse(F.col("r"))).alias("m")).where(F.col("m").isNotNull())


def project_tiles(tiles: DataFrame, maps: DataFrame) -> DataFrame:
    """src, dst, tile_id and the enclosing box a_x0 .. of each src tile's corners in dst.

    Maps and tiles meet by a shuffle: both grow with the images, and the size of tiles is guessed as their images'.
    """
    rows = maps.join(tiles.hint("merge"), F.col("src") == F.col("image_id"))
    m = F.col("m")
    corners = [apply_affine(m, F.col(x), F.col(y)) for x in ("x0", "x1") for y in ("y0", "y1")]
    rows = rows.withColumns({f"p{i}": c for i, c in enumerate(corners)})
    side = lambda f, c: f(*[F.col(f"p{i}.{c}") for i in range(4)])
    return rows.select("src", "dst", F.col("tile_id").alias("a_tile"), side(F.least, "x").alias("a_x0"), side(F.least, "y").alias("a_y0"), side(F.greatest, "x").alias("a_x1"), side(F.greatest, "y").alias("a_y1"))


def overlapping_tiles(tiles: DataFrame, maps: DataFrame, cell: float = 512.0) -> DataFrame:
    """Every tile of dst that a projected tile of src meets."""
    right = maps.select("src", "dst").join(tiles.hint("merge"), F.col("dst") == F.col("image_id")).select(F.col("src"), F.col("dst"), F.col("tile_id").alias("b_tile"), *[F.col(c).alias(f"b_{c}") for c in ("x0", "y0", "x1", "y1")])
    return box_join(project_tiles(tiles, maps), right, cell, ("src", "dst"))


def best_tiles(overlaps: DataFrame, least_area: float = 1.0) -> DataFrame:
    """One-to-one tiles: each a its b of largest common area, then each b its a; first tile wins ties.

    Areas must exceed least_area; an a that loses its b is not dealt another.
    """
    rows = overlaps.withColumn("area", overlap_area("a_", "b_")).where("area > 0")
    first = lambda d, own, other: d.groupBy("src", "dst", own).agg(F.min(F.struct((-F.col("area")).alias("less"), other)).alias("m")).select("src", "dst", own, f"m.{other}", (-F.col("m.less")).alias("area"))
    mine = first(rows, "a_tile", "b_tile").where(F.col("area") > least_area)
    return first(mine, "b_tile", "a_tile").select("src", "dst", "a_tile", "b_tile", "area")


def to_image(matches: DataFrame, tiles: DataFrame) -> DataFrame:
    """Tile-local matches (tile1, tile2, x1, y1, x2, y2) in image coordinates: the tiles' offsets added."""
    t = lambda n: tiles.select(F.col("tile_id").alias(f"tile{n}"), F.col("x0").alias(f"ox{n}"), F.col("y0").alias(f"oy{n}"))
    rows = matches.join(t(1), "tile1").join(t(2), "tile2")
    return rows.withColumns({f"{c}{n}": F.col(f"{c}{n}") + F.col(f"o{c}{n}") for c in "xy" for n in (1, 2)}).drop("ox1", "oy1", "ox2", "oy2")


def contained(points: DataFrame, cells: DataFrame, cell: float = 512.0, on: tuple[str, ...] = ()) -> DataFrame:
    """Points (x, y) within cells [x0, x1) x [y0, y1), of equal columns on: an equi-join on grid cells."""
    span = lambda c: F.explode(F.sequence(F.floor(F.col(f"{c}0") / cell), F.floor(F.col(f"{c}1") / cell)))
    left = points.withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell))
    rows = left.join(cells.withColumn("cx", span("x")).withColumn("cy", span("y")), [*on, "cx", "cy"]).drop("cx", "cy")
    return rows.where((F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1")))

"""Pairs of images whose footprints overlap, found by grid cells of the footprints' own size, and exact maps between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..sources.files import world_to_pixel


def _boxes(footprints: DataFrame) -> DataFrame:
    """Footprints with their bounding box and the level of the grid whose cells are as wide as it, or up to twice."""
    xs, ys = (F.transform(F.sequence(F.lit(0), (F.size("ring") / 2).cast("int") - 1), lambda i: F.col("ring")[2 * i + k]) for k in (0, 1))  # noqa: B023
    rows = footprints.where(F.size("ring") >= 6).withColumns({"x0": F.array_min(xs), "x1": F.array_max(xs), "y0": F.array_min(ys), "y1": F.array_max(ys)})
    wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return rows.where(wide > 0).withColumn("level", F.ceil(F.log2(wide)).cast("int"))


def _cell(value, level):
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("long")


def footprint_candidates(footprints: DataFrame) -> DataFrame:
    """a, b (structs of a footprint's columns): each two footprints whose bounding boxes share an area, once.

    A footprint lies in up to four cells of its level's grid.  It is looked for in the grids of all levels from its
    own up, of which there are as many as there are sizes, by powers of two; so neither a large footprint nor a small
    cell makes many rows.  Two boxes meet in the cell of the larger's grid that holds the lower corner of what they share.
    """
    rows = _boxes(footprints)
    own = [c for c in rows.columns]
    levels = F.broadcast(rows.agg(F.array_sort(F.collect_set("level")).alias("levels")))
    spread = lambda d, level: d.withColumn("cx", F.explode(F.sequence(_cell(F.col("x0"), level), _cell(F.col("x1"), level)))).withColumn("cy", F.explode(F.sequence(_cell(F.col("y0"), level), _cell(F.col("y1"), level))))
    small = rows.crossJoin(levels).withColumn("grid", F.explode(F.filter("levels", lambda x: x >= F.col("level"))))
    small = spread(small, F.col("grid")).select(F.col("grid").alias("grid"), "cx", "cy", F.struct(*own).alias("a"))
    large = spread(rows, F.col("level")).select(F.col("level").alias("grid"), "cx", "cy", F.struct(*own).alias("b"))
    # by size in the file both sides look small, and the driver would gather one of them to broadcast it
    both = small.join(large.hint("merge"), ["grid", "cx", "cy"])
    ordered = (F.col("a.level") < F.col("b.level")) | (F.col("a.image_id") < F.col("b.image_id"))
    low = {c: F.greatest(F.col(f"a.{c}0"), F.col(f"b.{c}0")) for c in "xy"}
    high = {c: F.least(F.col(f"a.{c}1"), F.col(f"b.{c}1")) for c in "xy"}
    here = (_cell(low["x"], F.col("grid")) == F.col("cx")) & (_cell(low["y"], F.col("grid")) == F.col("cy"))
    return both.where(ordered & here & (low["x"] < high["x"]) & (low["y"] < high["y"])).select("a", "b")


def _turned(ring: list[float]) -> list[tuple[float, float]]:
    """A ring's vertices counter-clockwise, without a closing one."""
    points = list(zip(ring[0::2], ring[1::2]))
    if points[0] == points[-1]:
        points.pop()
    area = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, [*points[1:], points[0]]))
    return points if area > 0 else points[::-1]


def _area(points: list[tuple[float, float]]) -> float:
    (x, y), *_ = points
    return sum((p[0] - x) * (q[1] - y) - (q[0] - x) * (p[1] - y) for p, q in zip(points, [*points[1:], points[0]])) / 2


def _clipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared, area = [], []
        for a, b in zip(batch.column("ring_a").to_pylist(), batch.column("ring_b").to_pylist()):
            points = geo.clip_polygon(_turned(a), _turned(b))
            shared.append([c for p in points for c in p])
            area.append(_area(points) if len(points) > 2 else 0.0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared, pa.list_(pa.float64())), pa.array(area, pa.float64())], [*batch.schema.names, "shared", "area"])


def footprint_pairs(footprints: DataFrame, least_area: float = 0.0) -> DataFrame:
    """src, dst, area, shared, m of each two of footprints(image_id, ring, geo) that share more than least_area, both
    ways round.

    ring: a convex polygon (x0, y0, x1, y1, ..) in world coordinates, in either sense, closed or not; geo: the image's
    geotransform; shared: the polygon that both cover, counter-clockwise; m: the 2x3 map, row-major, that takes pixels
    of src at the first three vertices of ``shared`` to those of dst, null where these lie on a line.  Footprints that
    only touch are no pair.
    """
    rows = footprint_candidates(footprints.select("image_id", "ring", "geo"))
    rows = rows.select(F.col("a.image_id").alias("src"), F.col("b.image_id").alias("dst"), F.col("a.geo").alias("geo_a"), F.col("b.geo").alias("geo_b"), F.col("a.ring").alias("ring_a"), F.col("b.ring").alias("ring_b"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    rows = rows.mapInArrow(_clipped, f"{fields}, shared array<double>, area double").where(F.col("area") > least_area)
    one = rows.select("src", "dst", "area", "shared", "geo_a", "geo_b")
    # each row makes both, so candidates are looked for and clipped once
    turned = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), "area", "shared", F.col("geo_b").alias("geo_a"), F.col("geo_a").alias("geo_b"))
    both = one.select(F.explode(F.array(F.struct(*one.columns), turned)).alias("e")).select("e.*")
    at = lambda i, g: world_to_pixel(F.col("shared")[2 * i], F.col("shared")[2 * i + 1], F.col(g))
    both = both.withColumn("p", F.array(*[at(i, "geo_a") for i in range(3)])).withColumn("q", F.array(*[at(i, "geo_b") for i in range(3)]))
    p, q = ([F.col(n)[i] for i in range(3)] for n in "pq")
    det = (p[1]["x"] - p[0]["x"]) * (p[2]["y"] - p[0]["y"]) - (p[2]["x"] - p[0]["x"]) * (p[1]["y"] - p[0]["y"])
    parts = []
    for c in "xy":
        u, v = q[1][c] - q[0][c], q[2][c] - q[0][c]
        m = (u * (p[2]["y"] - p[0]["y"]) - v * (p[1]["y"] - p[0]["y"])) / det
        n = ((p[1]["x"] - p[0]["x"]) * v - (p[2]["x"] - p[0]["x"]) * u) / det
        parts += [m, n, q[0][c] - m * p[0]["x"] - n * p[0]["y"]]
    return both.select("src", "dst", "area", "shared", F.when(F.abs(det) > 1e-9, F.array(*parts)).alias("m"))

"""Depth maps in few numbers: each image's depths as a combination of the smoothest vectors over its own points."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo

MODEL = "image_id long, n int, rank int, pix array<long>, coeffs array<double>, basis array<double>"


def smooth_basis(points: np.ndarray, rank: int, gamma: float, normalised: bool) -> np.ndarray:
    """The first eigenvectors of the Laplacian of a graph over points, as columns, by rising eigenvalue.

    An edge weighs exp(-gamma (distance / sum of both depths)^2).  Normalised: by the roots of both degrees.  Signs are
    such that a vector's largest component is above 0, the first of equal ones.
    """
    z = points[:, 2]
    square = (points * points).sum(1)
    d2 = np.maximum(0.0, square[:, None] + square[None] - 2 * points @ points.T)
    graph = np.exp(-gamma * d2 / (z[:, None] + z[None]) ** 2)
    np.fill_diagonal(graph, 0.0)
    degree = graph.sum(1)
    laplacian = np.diag(degree) - graph
    if normalised:
        root = 1 / np.sqrt(np.maximum(degree, 1e-300))
        laplacian = laplacian * root[:, None] * root[None]
    basis = np.linalg.eigh(laplacian)[1][:, :rank]
    largest = np.abs(basis).round(9).argmax(axis=0)
    return basis * np.where(basis[largest, np.arange(basis.shape[1])] < 0, -1.0, 1.0)


def encode(basis: np.ndarray, depth: np.ndarray, least_norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of depth, and the basis scaled by the first coefficients' sizes, least_norm at least.

    Scaled so, all coefficients are about 1 or below, and an optimiser may treat them alike.  The columns are
    orthogonal, so their normal equations are solved one by one.
    """
    first = basis.T @ depth
    scale = np.maximum(np.abs(first), least_norm) if least_norm else np.ones(len(first))
    return first / scale, basis * scale


def low_rank_depths(depths: DataFrame, cameras: DataFrame, rank: int = 64, gamma: float = 7.0, normalised: bool = True, least_norm: float = 5.0) -> DataFrame:
    """A row for each image of depths(image_id, x, y, depth): its n anchors' pix, their basis and its coefficients.

    cameras(image_id, width, focal, cx, cy).  depth is about basis @ coeffs; basis is row-major, a row for each pix and
    ``rank`` columns, as many as there are anchors where these are fewer.  Depths that are null or not above 0 are left
    out.  An image's anchors are one group, whose graph takes 8 n^2 bytes three times: subsample dense maps first.
    """
    point = geo.backproject(F.col("x"), F.col("y"), F.col("depth"), F.col("focal"), F.col("cx"), F.col("cy"))
    rows = depths.where(F.col("depth") > 0).join(cameras.select("image_id", "width", "focal", "cx", "cy"), "image_id")
    rows = rows.select(F.col("image_id").cast("long").alias("image_id"), (F.col("y") * F.col("width") + F.col("x")).cast("long").alias("pix"), point.alias("p")).select("image_id", "pix", "p.x", "p.y", "p.z")

    def solved(key, table):
        table = table.sort_by("pix")
        points = np.column_stack([np.array(table.column(c), float) for c in "xyz"])
        coeffs, basis = encode(smooth_basis(points, min(rank, len(points)), gamma, normalised), points[:, 2], least_norm)
        columns = ([key[0].as_py()], [len(points)], [len(coeffs)], [table.column("pix").to_pylist()], [coeffs.tolist()], [basis.ravel().tolist()])
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()))
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["image_id", "n", "rank", "pix", "coeffs", "basis"])

    return rows.groupBy("image_id").applyInArrow(solved, MODEL)


def _own_rows(of):
    """of(row of the basis) for each anchor.  It is taken in the row that holds the basis, for an explode would copy the
    whole basis to each anchor's row, n^2 numbers n times."""
    at = F.sequence(F.lit(0), F.size("pix") - 1)
    made = F.transform(at, lambda i: of(F.slice("basis", i * F.col("rank") + 1, F.col("rank"))))
    return F.when(F.size("pix") > 0, made)


def depths_of(models: DataFrame, coefficients: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """image_id, pix, depth of low_rank_depths, or under other coefficients(image_id, coeffs); keep: columns of models besides."""
    rows = models if coefficients is None else models.drop("coeffs").join(coefficients.select("image_id", "coeffs"), "image_id")
    depth = _own_rows(lambda b: F.aggregate(F.zip_with(b, "coeffs", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x))
    rows = rows.select("image_id", *keep, F.explode(F.arrays_zip("pix", depth.alias("depth"))).alias("p"))
    return rows.select("image_id", *keep, "p.pix", "p.depth")


def coefficient_step(models: DataFrame, targets: DataFrame) -> DataFrame:
    """image_id, coeffs: the least-squares coefficients for other depths targets(image_id, pix, depth, weight).

    The normal equations of each image are summed over its targets; null where these do not fix the coefficients.
    """
    own = models.select("image_id", F.explode(F.arrays_zip("pix", _own_rows(lambda b: b).alias("b"))).alias("p"))
    rows = own.select("image_id", "p.pix", "p.b").join(targets, ["image_id", "pix"])
    rows = rows.select("image_id", "b", F.col("depth").cast("double").alias("depth"), F.col("weight").cast("double").alias("weight"))

    def solved(key, table):
        a = np.array(table.column("b").to_pylist(), float)
        w, d = (np.array(table.column(c), float) for c in ("weight", "depth"))
        normal, right = (a * w[:, None]).T @ a, (a * w[:, None]).T @ d
        fixed = len(a) >= a.shape[1] and np.linalg.cond(normal) < 1e12
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([np.linalg.solve(normal, right).tolist() if fixed else None], pa.list_(pa.float64()))], names=["image_id", "coeffs"])

    return rows.groupBy("image_id").applyInArrow(solved, "image_id long, coeffs array<double>")

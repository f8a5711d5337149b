"""The sparse model and database of the exchange format, whole, and binary point clouds."""

from __future__ import annotations

import os
import sqlite3
import struct

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import files
from .shared import placed, stash

#: Tables of the exchange format's database.
TABLES = """
CREATE TABLE cameras (camera_id INTEGER PRIMARY KEY AUTOINCREMENT NOT NULL, model INTEGER NOT NULL, width INTEGER NOT NULL, height INTEGER NOT NULL, params BLOB, prior_focal_length INTEGER NOT NULL);
CREATE TABLE images (image_id INTEGER PRIMARY KEY AUTOINCREMENT NOT NULL, name TEXT NOT NULL UNIQUE, camera_id INTEGER NOT NULL, prior_qw REAL, prior_qx REAL, prior_qy REAL, prior_qz REAL, prior_tx REAL, prior_ty REAL, prior_tz REAL, FOREIGN KEY(camera_id) REFERENCES cameras(camera_id));
CREATE TABLE keypoints (image_id INTEGER PRIMARY KEY NOT NULL, rows INTEGER NOT NULL, cols INTEGER NOT NULL, data BLOB, FOREIGN KEY(image_id) REFERENCES images(image_id) ON DELETE CASCADE);
CREATE TABLE descriptors (image_id INTEGER PRIMARY KEY NOT NULL, rows INTEGER NOT NULL, cols INTEGER NOT NULL, data BLOB, FOREIGN KEY(image_id) REFERENCES images(image_id) ON DELETE CASCADE);
CREATE TABLE matches (pair_id INTEGER PRIMARY KEY NOT NULL, rows INTEGER NOT NULL, cols INTEGER NOT NULL, data BLOB);
CREATE TABLE two_view_geometries (pair_id INTEGER PRIMARY KEY NOT NULL, rows INTEGER NOT NULL, cols INTEGER NOT NULL, data BLOB, config INTEGER NOT NULL, F BLOB, E BLOB, H BLOB, qvec BLOB, tvec BLOB);
"""
CALIBRATED = 2
#: Header lines of the exchange format's text files.
HEADERS = {
    "cameras": "# Camera list with one line of data per camera:\n#   CAMERA_ID, MODEL, WIDTH, HEIGHT, PARAMS[]",
    "images": "# Image list with two lines of data per image:\n#   IMAGE_ID, QW, QX, QY, QZ, TX, TY, TZ, CAMERA_ID, NAME\n#   POINTS2D[] as (X, Y, POINT3D_ID)",
    "points3D": "# 3D point list with one line of data per point:\n#   POINT3D_ID, X, Y, Z, R, G, B, ERROR, TRACK[] as (IMAGE_ID, POINT2D_IDX)",
}


def sparse_model(points: DataFrame, observations: DataFrame, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Points with ``least`` observations or more under new ids 1, 2 .., and all observations under those ids.

    points(point_id, x, y, z, r, g, b), observations(point_id, image_id, x, y).  An observation's idx counts all of
    its image's, in order of point, x and y, as they are written; point_id is null where the point went.
    """
    often = observations.groupBy("point_id").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("point_id")
    kept = placed(points.join(often, "point_id", "left_semi"), "point_id", name="new_id")
    kept = stash(kept.withColumn("new_id", (F.col("new_id") + 1).cast("long")), "points")
    order = Window.partitionBy("image_id").orderBy("point_id", "x", "y")
    seen = observations.withColumn("idx", (F.row_number().over(order) - 1).cast("long"))
    seen = seen.join(kept.select("point_id", "new_id"), "point_id", "left").select("image_id", "idx", "x", "y", F.col("new_id").alias("point_id"))
    return kept.drop("point_id").withColumnRenamed("new_id", "point_id"), seen


def write_sparse_model(folder: str, cameras: DataFrame, poses: DataFrame, points: DataFrame, observations: DataFrame, least: int = 2) -> None:
    """cameras, images and points3D as folders of text lines with their headers, in order of id.

    cameras(camera_id, model, width, height, params), poses(image_id, qvec, tvec, camera_id, name); the rest as
    sparse_model takes it.  Files below a folder follow one another in name order; the first begins with the header.
    """
    kept, seen = sparse_model(points, observations, least)
    lines = {
        "cameras": (files.camera_lines(cameras), ["camera_id"]),
        "images": (files.image_lines(poses, seen), ["image_id", "line"]),
        "points3D": (files.point_lines(kept, seen.where("point_id IS NOT NULL")), ["point_id"]),
    }
    for name, (rows, order) in lines.items():
        head = rows.sparkSession.createDataFrame([(HEADERS[name],)], "value string")
        first = [F.lit(-1).cast("long").alias(c) for c in order]
        body = rows.select(*[F.col(c).cast("long").alias(c) for c in order], "value")
        head.select(*first, "value").union(body).orderBy(*order).select("value").write.mode("overwrite").text(f"{folder}/{name}")


def write_database(path: str, cameras: DataFrame, images: DataFrame, keypoints: DataFrame, matches: DataFrame, verified: bool = False) -> None:
    """One database file on the driver, rows streamed to it one image or pair at a time.

    cameras(camera_id, model_id, width, height, params, prior_focal), images(image_id, name, camera_id, qvec, tvec;
    both null without a prior), keypoints(image_id, kp_idx, x, y), matches(src, dst, kp_idx1, kp_idx2).  Pixels are
    written as they are.  verified: matches are taken as geometrically verified too.  The path must not exist.
    """
    if os.path.exists(path):
        raise FileExistsError(path)
    blob = lambda values, kind: np.ascontiguousarray(values, kind).tobytes()
    lists = lambda d, by, order, *cs: d.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*order, *cs))).alias("v")).orderBy(*by)
    turn = F.col("src") > F.col("dst")
    pick = lambda a, b: F.when(turn, F.col(b)).otherwise(F.col(a))
    canonical = matches.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), pick("kp_idx1", "kp_idx2").alias("i"), pick("kp_idx2", "kp_idx1").alias("j")).distinct()
    with sqlite3.connect(path) as con:
        con.executescript(TABLES)
        for r in cameras.orderBy("camera_id").toLocalIterator():
            con.execute("INSERT INTO cameras VALUES (?, ?, ?, ?, ?, ?)", (r.camera_id, r.model_id, r.width, r.height, blob(r.params, "<f8"), int(r.prior_focal)))
        for r in images.orderBy("image_id").toLocalIterator():
            con.execute("INSERT INTO images VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?, ?)", (r.image_id, r.name, r.camera_id, *(r.qvec or [None] * 4), *(r.tvec or [None] * 3)))
        for r in lists(keypoints, ["image_id"], ["kp_idx"], "x", "y").toLocalIterator():
            con.execute("INSERT INTO keypoints VALUES (?, ?, 2, ?)", (r.image_id, len(r.v), blob([(k.x, k.y) for k in r.v], "<f4")))
        for r in lists(canonical, ["src", "dst"], ["i", "j"]).toLocalIterator():
            row = (r.src * 2147483647 + r.dst, len(r.v), blob([(m.i, m.j) for m in r.v], "<u4"))
            con.execute("INSERT INTO matches VALUES (?, ?, 2, ?)", row)
            if verified:
                con.execute("INSERT INTO two_view_geometries (pair_id, rows, cols, data, config) VALUES (?, ?, 2, ?, ?)", (*row, CALIBRATED))


def named_ids(rows: DataFrame, images: DataFrame, columns: tuple[str, ...] = ("src", "dst")) -> DataFrame:
    """rows with names in columns replaced by the ids of images(image_id, name); unknown names drop out."""
    for c in columns:
        ids = images.select(F.col("name").alias(c), F.col("image_id").alias("__id"))
        rows = rows.join(ids, c).withColumn(c, F.col("__id")).drop("__id")
    return rows


def tile_manifest(tiles: DataFrame) -> DataFrame:
    """value: one JSON line per tile, without pixels."""
    return tiles.select(F.to_json(F.struct(*[c for c in tiles.columns if c != "tile_data"])).alias("value"))


def write_ply_binary(points: DataFrame, path: str) -> None:
    """points(x, y, z, nx, ny, nz, r, g, b) as one little-endian file, streamed to it by the driver in order of their values."""
    kinds = "".join(f"property float {c}\n" for c in ("x", "y", "z", "nx", "ny", "nz")) + "".join(f"property uchar {c}\n" for c in ("red", "green", "blue"))
    columns = ["x", "y", "z", "nx", "ny", "nz", "r", "g", "b"]
    rows = points.select(*columns)
    with open(path, "wb") as out:
        out.write(f"ply\nformat binary_little_endian 1.0\nelement vertex {rows.count()}\n{kinds}end_header\n".encode())
        for r in rows.orderBy(*columns).toLocalIterator():
            out.write(struct.pack("<6f3B", *r))

"""Readers and writers: image folders, list and pair files, transforms, and the text exchange model."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import placed

SUFFIXES = ("jpg", "jpeg", "png", "tif", "tiff", "bmp")


def image_size(head: bytes) -> tuple[int, int] | None:
    """Width and height from a PNG, BMP, GIF or JPEG file's bytes, None where they tell no image."""
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) >= 24:
        return struct.unpack(">II", head[16:24])
    if head[:2] == b"BM" and len(head) >= 26:
        w, h = struct.unpack("<ii", head[18:26])
        return w, abs(h)
    if head[:6] in (b"GIF87a", b"GIF89a") and len(head) >= 10:
        return struct.unpack("<HH", head[6:10])
    if head[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(head):
            if head[at] != 0xFF:
                return None
            kind, size = head[at + 1], struct.unpack(">H", head[at + 2 : at + 4])[0]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", head[at + 5 : at + 9])
                return w, h
            at += 2 + size
    return None


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def _size(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([image_size(bytes(c)) or (None, None) for c in content], columns=["width", "height"])


def read_images(spark: SparkSession, folder: str, recursive: bool = True, suffixes: tuple[str, ...] | None = SUFFIXES, gaps: bool = False) -> DataFrame:
    """path (below folder), width, height of each decodable image file; suffixes match in any case, None matches all.

    gaps: also image_id, the file's place from 0 in order of path among all that match, decodable or not.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    if suffixes is not None:
        files = files.where(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*suffixes))
    base = folder.split("://")[-1].removeprefix("file:").rstrip("/") + "/"
    below = F.element_at(F.split("path", F.lit("\\Q" + base + "\\E")), -1).alias("path")
    rows = files.select(below, _size("content").alias("s")).select("path", "s.width", "s.height")
    if gaps:
        rows = placed(rows, "path", name="image_id")
    return rows.where("width IS NOT NULL")


def require_images(images: DataFrame, least: int = 2) -> DataFrame:
    """images, or ValueError where there are fewer."""
    if len(images.limit(least).collect()) < least:
        raise ValueError(f"at least {least} images are needed")
    return images


def numbered(images: DataFrame, order=("path",)) -> DataFrame:
    """image_id from 0 in the given order; one row per image is ordered."""
    return images.withColumn("image_id", (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))


def numeric_stem(path="path"):
    """The first integer in a file's stem, for ordering."""
    return F.regexp_extract(F.regexp_extract(F.col(path), r"([^/]*?)(\.[^./]*)?$", 1), r"\d+", 0).cast("long")


def one_camera(images: DataFrame) -> DataFrame:
    """The single camera of all images; raises, when run, where their sizes differ."""
    rows = images.agg(F.min("width").alias("width"), F.max("width").alias("w"), F.min("height").alias("height"), F.max("height").alias("h"))
    same = (F.col("width") == F.col("w")) & (F.col("height") == F.col("h"))
    return rows.select(F.lit(0).alias("camera_id"), F.when(same, F.col("width")).otherwise(F.raise_error(F.lit("images differ in size"))).alias("width"), "height")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a list file that are neither blank nor begin with #."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("path")).where((F.length("path") > 0) & ~F.startswith("path", F.lit("#")))


def image_paths(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """path: given paths as they are, the lines of a .txt list, or the image files below a folder."""
    if not isinstance(source, str):
        return spark.createDataFrame([(p,) for p in source], "path string")
    return read_list(spark, source) if source.lower().endswith(".txt") else read_images(spark, source).select("path")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """src, dst, score of a pairs file with # comments."""
    rows = spark.read.option("comment", "#").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).schema("src string, dst string, score double").csv(path)
    return rows.where("src IS NOT NULL")


def pair_lines(pairs: DataFrame) -> DataFrame:
    """Sorted distinct pairs as lines 'src, dst, 1.0'."""
    rows = pairs.select("src", "dst").distinct().orderBy("src", "dst")
    return rows.select(F.format_string("%s, %s, 1.0", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value"))


def write_pairs(pairs: DataFrame, path: str) -> None:
    """A pairs file with its header, one part: a row per pair of images."""
    head = pairs.sparkSession.createDataFrame([("# query_image, map_image, score",)], "value string")
    head.union(pair_lines(pairs)).coalesce(1).write.mode("overwrite").text(path)


def read_transforms(spark: SparkSession, path: str) -> DataFrame:
    """src, dst, m (2x3, row-major) of a JSON map whose keys are names joined by two underscores."""
    whole = spark.read.text(path, wholetext=True)
    return parse_transforms(whole)


def parse_transforms(rows: DataFrame, col: str = "value") -> DataFrame:
    maps = rows.select(F.explode(F.from_json(F.col(col), "map<string, array<array<double>>>")).alias("key", "m"))
    return maps.select(F.split("key", "__")[0].alias("src"), F.split("key", "__")[1].alias("dst"), F.flatten("m").alias("m"))


def transforms_json(affines: DataFrame) -> DataFrame:
    """One row with the JSON of affines(src, dst, m)."""
    entry = F.struct(F.concat_ws("__", "src", "dst"), F.array(F.slice("m", 1, 3), F.slice("m", 4, 3)))
    return affines.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value"))


def world_to_pixel(x, y, geo):
    """Column and row of world coordinates under a geotransform array (origin x, width, skew, origin y, skew, height)."""
    det = geo[1] * geo[5] - geo[2] * geo[4]
    dx, dy = x - geo[0], y - geo[3]
    return F.struct(((geo[5] * dx - geo[2] * dy) / det).alias("x"), ((geo[1] * dy - geo[4] * dx) / det).alias("y"))


def footprints_with_files(footprints: DataFrame, files: DataFrame) -> DataFrame:
    """Footprints whose image_id has a .tif file."""
    names = files.select(F.regexp_extract("path", r"([^/]+)\.tif$", 1).alias("image_id")).where("image_id <> ''").distinct()
    return footprints.join(names, "image_id", "left_semi")


def mixture(sources: dict[str, DataFrame], counts: dict[str, int], key: str, seed: int = 0) -> DataFrame:
    """So many rows of each source, those of smallest hash."""
    out = None
    for name, n in counts.items():
        part = sources[name].orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n).withColumn("dataset", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def number_text(c):
    """A double as plain text, whole numbers without a point."""
    return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))


def camera_lines(cameras: DataFrame) -> DataFrame:
    """camera_id, value: 'CAMERA_ID MODEL WIDTH HEIGHT PARAMS..' with ids from 1."""
    params = F.array_join(F.transform("params", number_text), " ")
    return cameras.select("camera_id", F.concat_ws(" ", F.col("camera_id").cast("string"), "model", F.col("width").cast("string"), F.col("height").cast("string"), params).alias("value"))


def image_lines(poses: DataFrame, observations: DataFrame) -> DataFrame:
    """image_id, line, value: a pose line and a line of 'x y point' for each image.

    observations(image_id, idx, x, y, point_id): in order of idx; point -1 where it is null.
    """
    point = F.concat_ws(" ", number_text(F.col("x")), number_text(F.col("y")), F.coalesce(F.col("point_id"), F.lit(-1)).cast("string"))
    seen = observations.groupBy("image_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", point.alias("p")))), lambda s: s["p"]), " ").alias("points"))
    rows = poses.join(seen, "image_id", "left")
    pose = F.concat_ws(" ", F.col("image_id").cast("string"), F.array_join(F.transform("qvec", number_text), " "), F.array_join(F.transform("tvec", number_text), " "), F.col("camera_id").cast("string"), "name")
    lines = F.array(F.struct(F.lit(0).alias("line"), pose.alias("value")), F.struct(F.lit(1).alias("line"), F.coalesce("points", F.lit("")).alias("value")))
    return rows.select("image_id", F.explode(lines).alias("l")).select("image_id", "l.line", "l.value")


def point_lines(points: DataFrame, observations: DataFrame) -> DataFrame:
    """point_id, value: 'POINT3D_ID X Y Z R G B ERROR IMAGE IDX ..', the track ordered by image and index."""
    track = observations.groupBy("point_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("image_id", "idx"))), lambda s: F.concat_ws(" ", s["image_id"].cast("string"), s["idx"].cast("string"))), " ").alias("track"))
    xyz = [number_text(F.col(c)) for c in "xyz"]
    rgb = [F.col(c).cast("string") for c in "rgb"]
    return points.join(track, "point_id").select("point_id", F.concat_ws(" ", F.col("point_id").cast("string"), *xyz, *rgb, F.lit("0"), "track").alias("value"))


def every_nth(rows: DataFrame, n: int, order: str) -> DataFrame:
    """Rows 1, n + 1, 2 n + 1 .. in order of a column."""
    return placed(rows, order, name="__place").where(F.col("__place") % n == 0).drop("__place")


def ply_text(points: DataFrame) -> DataFrame:
    """A header row and a vertex row, as value, for points(point_id, x, y, z, r, g, b), normals (0, 1, 0)."""
    fields = "".join(f"property float {c}\n" for c in ("x", "y", "z", "nx", "ny", "nz")) + "".join(f"property uchar {c}\n" for c in ("red", "green", "blue"))
    head = points.agg(F.concat(F.lit("ply\nformat ascii 1.0\nelement vertex "), F.count("*").cast("string"), F.lit("\n" + fields + "end_header")).alias("value")).select(F.lit(-1).cast("long").alias("point_id"), "value")
    body = points.select(F.col("point_id").cast("long"), F.concat_ws(" ", *[number_text(F.col(c)) for c in "xyz"], F.lit("0 1 0"), *[F.col(c).cast("string") for c in "rgb"]).alias("value"))
    return head.union(body)

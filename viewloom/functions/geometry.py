"""Column expressions of pixels, cameras, affine maps and poses."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Model ids of the exchange format and their parameters.
CAMERA_MODELS = {"SIMPLE_PINHOLE": 0, "PINHOLE": 1, "SIMPLE_RADIAL": 2, "OPENCV": 4}
PAIR_BASE = 2147483647


def clip(c, low, high):
    return F.greatest(F.lit(low) if isinstance(low, (int, float)) else low, F.least(F.lit(high) if isinstance(high, (int, float)) else high, c))


def ravel(x, y, width, height):
    """Flat pixel x + width y of coordinates rounded half to even and clipped to the image."""
    px, py = clip(F.rint(x), 0.0, width.cast("double") - 1), clip(F.rint(y), 0.0, height.cast("double") - 1)
    return (px + width * py).cast("long")


def unravel(pix, width):
    return F.struct(F.pmod(pix, width).alias("x"), F.floor(pix / width).alias("y"))


def centre_to_original(x, y, m, width, height):
    """Pixel centre (+0.5) under a row-major 3x3 map, clipped to [0, side - 0.01]."""
    a, b = x + 0.5, y + 0.5
    u, v = m[0] * a + m[1] * b + m[2], m[3] * a + m[4] * b + m[5]
    return F.struct(clip(u, 0.0, width - 0.01).alias("x"), clip(v, 0.0, height - 0.01).alias("y"))


def centre_round_trip(x, y, m):
    """+0.5, the map, -0.5."""
    a, b = x + 0.5, y + 0.5
    return F.struct((m[0] * a + m[1] * b + m[2] - 0.5).alias("x"), (m[3] * a + m[4] * b + m[5] - 0.5).alias("y"))


def homography(x, y, m, divide: bool = True):
    """(x, y) under a row-major 3x3 array column, with or without perspective division."""
    w = m[6] * x + m[7] * y + m[8] if divide else F.lit(1.0)
    return F.struct(((m[0] * x + m[1] * y + m[2]) / w).alias("x"), ((m[3] * x + m[4] * y + m[5]) / w).alias("y"))


def inside_border(x, y, width, height, border: int = 3):
    return (x >= border) & (x < width - border) & (y >= border) & (y < height - border)


def inside_rect(x, y, left, top, right, bottom):
    return (x >= left) & (x < right) & (y >= top) & (y < bottom)


def finite(*cs):
    """All values present and finite."""
    ok = F.lit(True)
    for c in cs:
        ok = ok & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return ok


def fov_to_focal(fov, pixels):
    return pixels / (2 * F.tan(fov / 2))


def focal_to_fov(focal, pixels):
    return 2 * F.atan(pixels / (2 * focal))


def backproject(u, v, z, focal, cx, cy):
    """Camera coordinates of a pixel at depth z."""
    return F.struct((z * (u - cx) / focal).alias("x"), (z * (v - cy) / focal).alias("y"), z.alias("z"))


def reproject(x, y, z, focal, cx, cy, floor: float = 1e-3, low: float = -1000.0, high: float = 2000.0):
    """Pixel of camera coordinates; depth at least floor, pixels clipped."""
    d = F.greatest(z, F.lit(floor))
    return F.struct(clip(focal * x / d + cx, low, high).alias("u"), clip(focal * y / d + cy, low, high).alias("v"))


def to_world(p, rotation, t):
    """A row-major 3x3 rotation and a translation applied to a struct x, y, z."""
    row = lambda i: rotation[3 * i] * p["x"] + rotation[3 * i + 1] * p["y"] + rotation[3 * i + 2] * p["z"] + t[i]
    return F.struct(row(0).alias("x"), row(1).alias("y"), row(2).alias("z"))


def to_camera(p, rotation, t):
    """The inverse of to_world: the transpose applied to p - t."""
    d = [p["x"] - t[0], p["y"] - t[1], p["z"] - t[2]]
    col = lambda i: rotation[i] * d[0] + rotation[3 + i] * d[1] + rotation[6 + i] * d[2]
    return F.struct(col(0).alias("x"), col(1).alias("y"), col(2).alias("z"))


def robust(x, gamma: float = 1.0):
    """Gamma loss of a distance: (x + o)^g - o^g with o such that the slope at 0 is 1; g = 1 is x itself."""
    if gamma == 1:
        return x
    offset = (1 / gamma) ** (1 / (gamma - 1))
    return F.pow(x + offset, F.lit(gamma)) - offset**gamma


def l05(x):
    return F.sqrt(x)


def log_norm(x, y, z):
    """Factor that turns a vector's norm n into log1p(n)."""
    n = F.sqrt(x * x + y * y + z * z)
    return F.when(n > 0, F.log1p(n) / n).otherwise(F.lit(1.0))


def schedule(kind: str, alpha: float, base: float, end: float) -> float:
    """Learning rate at a part alpha of the way, linear or cosine."""
    import math

    if kind == "linear":
        return (1 - alpha) * base + alpha * end
    return end + (base - end) * (1 + math.cos(alpha * math.pi)) / 2


def gaussian_centre_weight(x, y, left, top, right, bottom):
    """exp(-2 d^2) of the distance to the box's centre in units of its sides."""
    dx, dy = (x - (left + right) / 2) / (right - left), (y - (top + bottom) / 2) / (bottom - top)
    return F.exp(-2 * (dx * dx + dy * dy))


def crop_tag(x0, y0, x1, y1):
    return F.format_string("[%d:%d,%d:%d]", y0, y1, x0, x1)


def pair_id(i, j):
    """The exchange format's id of an image pair."""
    return F.least(i, j) * PAIR_BASE + F.greatest(i, j)


def pair_id_images(p, base: int = PAIR_BASE):
    """Both images of a pair id; base 2^32 is another encoding in use."""
    return F.struct(F.floor(p / base).cast("long").alias("image_id1"), F.pmod(p, F.lit(base)).cast("long").alias("image_id2"))


def camera_params(model, focal, width, height):
    """params of a camera by its model's name: focal length(s), principal point at the middle, no distortion."""
    cx, cy, zero = width / 2, height / 2, F.lit(0.0)
    return (
        F.when(model == "SIMPLE_PINHOLE", F.array(focal, cx, cy)).when(model == "PINHOLE", F.array(focal, focal, cx, cy))
        .when(model == "SIMPLE_RADIAL", F.array(focal, cx, cy, zero)).when(model == "OPENCV", F.array(focal, focal, cx, cy, zero, zero, zero, zero))
    )


def default_focal(width, height):
    return 1.2 * F.greatest(width, height)


def quaternion(m):
    """w, x, y, z with w >= 0 of a row-major 3x3 rotation, from the largest of the four components."""
    t = [m[0] + m[4] + m[8], m[0] - m[4] - m[8], m[4] - m[0] - m[8], m[8] - m[0] - m[4]]
    w, x, y, z = (F.sqrt(F.greatest(F.lit(0.0), 1 + v)) / 2 for v in t)
    sign = lambda v, s: F.when(s < 0, -v).otherwise(v)
    plain = F.array(w, sign(x, m[7] - m[5]), sign(y, m[2] - m[6]), sign(z, m[3] - m[1]))
    # a half turn: w is 0 and signs follow the products of components
    lead = F.when((t[1] >= t[2]) & (t[1] >= t[3]), F.array(F.lit(0.0), x, sign(y, m[1] + m[3]), sign(z, m[2] + m[6])))
    lead = lead.when(t[2] >= t[3], F.array(F.lit(0.0), sign(x, m[1] + m[3]), y, sign(z, m[5] + m[7]))).otherwise(F.array(F.lit(0.0), sign(x, m[2] + m[6]), sign(y, m[5] + m[7]), z))
    return F.when(w < 1e-9, lead).otherwise(plain)


def resize_scale(width, height, longest: int):
    """Factor that takes the longer side to ``longest``."""
    return F.lit(float(longest)) / F.greatest(width, height)


def landscape(x, y, width, height):
    """Coordinates after a quarter turn of portrait images; others as they are."""
    return F.when(height > width, F.struct(y.alias("x"), (width - 1 - x).alias("y"))).otherwise(F.struct(x.alias("x"), y.alias("y")))


def triangulate(rows, rays: str = "rays", out: str = "point"):
    """rows with the least-squares point of an array of structs (p: row-major 3x4 array, u, v), by Cramer's rule.

    Each ray gives two equations; their normal equations are summed once, as a column of their own.  Null where the
    rays do not fix a point.
    """
    names = ("aa", "ab", "ac", "ad", "bb", "bc", "bd", "cc", "cd")

    def products(r):
        total = {}
        for i, c in enumerate(("u", "v")):
            e = dict(zip("abcd", (r[c] * r["p"][8 + k] - r["p"][4 * i + k] for k in range(4))))
            total = {n: e[n[0]] * e[n[1]] + total.get(n, F.lit(0.0)) for n in names}
        return F.struct(*[total[n].alias(n) for n in names])

    zero = F.struct(*[F.lit(0.0).alias(n) for n in names])
    summed = F.aggregate(F.transform(F.col(rays), products), zero, lambda s, e: F.struct(*[(s[n] + e[n]).alias(n) for n in names]))
    n = {k: F.col(f"__normal.{k}") for k in names}
    det = lambda m: m[0] * (m[4] * m[8] - m[5] * m[7]) - m[1] * (m[3] * m[8] - m[5] * m[6]) + m[2] * (m[3] * m[7] - m[4] * m[6])
    whole = [n[k] for k in ("aa", "ab", "ac", "ab", "bb", "bc", "ac", "bc", "cc")]
    right = [-n[k] for k in ("ad", "bd", "cd")]
    d = det(whole)
    part = lambda k: det([right[i // 3] if i % 3 == k else x for i, x in enumerate(whole)])
    point = F.when(F.abs(d) > 1e-12, F.struct(*[(part(k) / d).alias(c) for k, c in enumerate("xyz")]))
    return rows.withColumn("__normal", summed).withColumn(out, point).drop("__normal")


def clip_polygon(subject: list[tuple[float, float]], window: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The part of a polygon inside a convex one given counter-clockwise."""
    out = list(subject)
    for (ax, ay), (bx, by) in zip(window, [*window[1:], window[0]]):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: B023, E731
        kept = []
        for p, q in zip(out, [*out[1:], *out[:1]]):
            s, t = side(p), side(q)
            if s >= 0:
                kept.append(p)
            if (s > 0 > t) or (s < 0 < t):
                kept.append((p[0] + (q[0] - p[0]) * s / (s - t), p[1] + (q[1] - p[1]) * s / (s - t)))
        out = kept
    return out


def affine_from_points(a: list[tuple[float, float]], b: list[tuple[float, float]]) -> list[float] | None:
    """The 2x3 map, row-major, that takes three points to three others; None where they lie on a line."""
    (x0, y0), (x1, y1), (x2, y2) = a[:3]
    d = (x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0)
    if abs(d) < 1e-12:
        return None
    out = []
    for k in (0, 1):
        u0, u1, u2 = (p[k] for p in b[:3])
        m = ((u1 - u0) * (y2 - y0) - (u2 - u0) * (y1 - y0)) / d
        n = ((x1 - x0) * (u2 - u0) - (x2 - x0) * (u1 - u0)) / d
        out += [m, n, u0 - m * x0 - n * y0]
    return out


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def footprint_affine(ring_a: pd.Series, ring_b: pd.Series) -> pd.Series:
    """Affine of the first three vertices that two convex footprints (x0, y0, x1, y1, ..) have in common, else null."""
    def one(a, b):
        if a is None or b is None:
            return None
        a, b = list(zip(a[0::2], a[1::2])), list(zip(b[0::2], b[1::2]))
        common = clip_polygon(a, b)
        return affine_from_points([(x - a[0][0], y - a[0][1]) for x, y in common], [(x - b[0][0], y - b[0][1]) for x, y in common]) if len(common) >= 3 else None

    return pd.Series([one(x, y) for x, y in zip(ring_a, ring_b)])


def normal_window(x0, y0, x1, y1, width, height, forced: tuple[int, int] | None = None):
    """A window's whole-pixel box of aspect 3:4 (or of a forced width and height), about the same middle, inside the image.

    The longer side stays, cut to the image; the shorter becomes 3.01 / 4 of it.
    """
    w, h = (x1 - x0).cast("double"), (y1 - y0).cast("double")
    w2, h2 = F.least(w, width.cast("double")), F.least(h, height.cast("double"))
    tall = w < h
    if forced:
        new_w, new_h = F.lit(float(forced[0])), F.lit(float(forced[1]))
    else:
        new_w = F.when(tall, F.least(h2 * 3.01 / 4, width.cast("double"))).otherwise(w2)
        new_h = F.when(tall, h2).otherwise(F.least(w2 * 3.01 / 4, height.cast("double")))

    def side(low, high, old, new, whole):
        # the end is floored, the start follows from the whole length; then both move inside
        length, end = F.floor(new), F.floor(high + (new - old) / 2)
        start = F.greatest(end - length, F.lit(0))
        start = start - F.greatest(start + length - whole, F.lit(0))
        return start.cast("long"), (start + length).cast("long")

    (a0, a1), (b0, b1) = side(x0, x1, w, new_w, width), side(y0, y1, h, new_h, height)
    return F.struct(a0.alias("x0"), b0.alias("y0"), a1.alias("x1"), b1.alias("y1"))


def axis_to(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rotations that take the direction (0, 0, 1) to (x, y, 1) by the shortest way, one for each entry."""
    n = np.sqrt(x * x + y * y + 1)
    c, f = 1 / n, 1 / (n * (n + 1))
    return np.stack([1 - x * x * f, -x * y * f, x * c, -x * y * f, 1 - y * y * f, y * c, -x * c, -y * c, c], axis=-1).reshape(-1, 3, 3)


@F.pandas_udf(T.StructType([T.StructField(n, t) for n, t in (("width", T.IntegerType()), ("height", T.IntegerType()), ("rotation", T.ArrayType(T.DoubleType())), ("m", T.ArrayType(T.DoubleType())))]))
def rectified_crop(focal: pd.Series, cx: pd.Series, cy: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.DataFrame:
    """A crop as its own camera: its width and height, rotation, and the map from its pixels to the image's.

    The new principal point is the crop's middle.  The crop's farthest corner from the old principal point, side by
    side, stays where it is, so the map does not leave the image.
    """
    focal, cx, cy = (c.to_numpy(float) for c in (focal, cx, cy))
    x0, y0, x1, y1 = (np.rint(c.to_numpy(float)) for c in (x0, y0, x1, y1))
    w, h = x1 - x0, y1 - y0
    right, low = np.abs(x1 - cx) > np.abs(x0 - cx), np.abs(y1 - cy) > np.abs(y0 - cy)
    old = axis_to((np.where(right, x1, x0) - cx) / focal, (np.where(low, y1, y0) - cy) / focal)
    new = axis_to((np.where(right, w, 0) - w / 2) / focal, (np.where(low, h, 0) - h / 2) / focal)
    turn = old @ new.transpose(0, 2, 1)

    def camera(u, v):
        k = np.zeros((len(focal), 3, 3))
        k[:, 0, 0] = k[:, 1, 1] = focal
        k[:, 0, 2], k[:, 1, 2], k[:, 2, 2] = u, v, 1
        return k

    m = camera(cx, cy) @ turn @ np.linalg.inv(camera(w / 2, h / 2))
    return pd.DataFrame({"width": w.astype("int32"), "height": h.astype("int32"), "rotation": list(turn.reshape(-1, 9)), "m": list(m.reshape(-1, 9))})


def crop_to_size(crop, focal, width, height):
    """A rectified crop as a camera of a given size: width, height, focal, rotation and m, from its pixels to the image's.

    The crop is scaled by the smaller ratio of sides, so it lies whole and central in the new size.
    """
    w, h = crop["width"].cast("double"), crop["height"].cast("double")
    scale = F.least(width / w, height / h)
    m, right, down = crop["m"], w / 2 - width / (2 * scale), h / 2 - height / (2 * scale)
    rows = [F.array(m[3 * i] / scale, m[3 * i + 1] / scale, m[3 * i] * right + m[3 * i + 1] * down + m[3 * i + 2]) for i in range(3)]
    return F.struct(width.alias("width"), height.alias("height"), (focal * scale).alias("focal"), crop["rotation"].alias("rotation"), F.concat(*rows).alias("m"))


def random_crop(key, width, height, crop_width: int, crop_height: int, seed: int = 0, scale: tuple[float, float] = (0.5, 1.0)):
    """A box of the crop's aspect at a place and scale told by a hash of the key; as large as the image allows at 1."""
    part = lambda n: F.pmod(F.xxhash64(key, F.lit(seed), F.lit(n)), F.lit(1 << 20)) / float(1 << 20)
    most = F.least(width / crop_width, height / crop_height)
    factor = most * (F.lit(scale[0]) + part(0) * (scale[1] - scale[0]))
    w, h = F.floor(factor * crop_width), F.floor(factor * crop_height)
    x, y = F.floor(part(1) * (width - w + 1)), F.floor(part(2) * (height - h + 1))
    return F.struct(x.alias("x0"), y.alias("y0"), (x + w).alias("x1"), (y + h).alias("y1"))

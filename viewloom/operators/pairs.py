"""Image-pair graphs: complete, windowed, one against all, and set operations over pairs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("complete", "swin", "logwin", "oneref", "retrieval")


def parse_spec(spec: str) -> dict:
    """'swin-5-noncyclic', 'logwin-3', 'oneref-0', 'retrieval-20-10' or 'complete' as a dict; else ValueError.

    A window defaults to 3; a retrieval spec has exactly two numbers, keys and neighbours.
    """
    kind, *rest = spec.split("-")
    if kind not in KINDS:
        raise ValueError(f"unknown scene graph {spec!r}")
    cyclic = "noncyclic" not in rest
    numbers = [x for x in rest if x != "noncyclic"]
    if not all(x.isdigit() for x in numbers) or (not cyclic and kind not in ("swin", "logwin")):
        raise ValueError(f"malformed scene graph {spec!r}")
    values = list(map(int, numbers))
    most = {"complete": 0, "swin": 1, "logwin": 1, "oneref": 1, "retrieval": 2}[kind]
    if len(values) > most or (kind == "retrieval" and len(values) != 2):
        raise ValueError(f"malformed scene graph {spec!r}")
    if kind in ("swin", "logwin"):
        return {"kind": kind, "window": values[0] if values else 3, "cyclic": cyclic}
    if kind == "oneref":
        return {"kind": kind, "reference": values[0] if values else 0}
    if kind == "retrieval":
        return {"kind": kind, "keys": values[0], "neighbours": values[1]}
    return {"kind": kind}


def build_spec(kind: str, window: int = 3, reference: int = 0, keys: int = 20, neighbours: int = 10, cyclic: bool = True) -> str:
    """The inverse of parse_spec."""
    tail = "" if cyclic else "-noncyclic"
    made = {"complete": "complete", "swin": f"swin-{window}{tail}", "logwin": f"logwin-{window}{tail}", "oneref": f"oneref-{reference}", "retrieval": f"retrieval-{keys}-{neighbours}"}
    return made[kind]


def max_window(kind: str, n: int, cyclic: bool = True) -> int:
    """The largest useful window for n images."""
    reach = math.ceil((n - 1) / 2) if cyclic else n - 1
    if kind == "logwin":
        return max(1, math.ceil(math.log2(max(1, reach) + 1)))
    return max(1, reach)


def complete(images: DataFrame, col: str = "image_id", part: int = 1024) -> DataFrame:
    """All pairs (src, dst) with dst < src.

    The result is quadratic in the images.  They are dealt to parts of about ``part``, and each two parts meet once, so
    the pairs are work of many tasks that hold a part each, however few files the images lie in.
    """
    n = int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = images.select(F.col(col).alias("id")).where("id IS NOT NULL")
    sizes = ids.agg(F.ceil(F.count("*") / F.lit(part)).cast("long").alias("parts"))
    rows = ids.crossJoin(F.broadcast(sizes)).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")))
    one = rows.select(F.col("own").alias("p1"), F.explode(F.sequence("own", F.col("parts") - 1)).alias("p2"), F.col("id").alias("a"))
    two = rows.select(F.explode(F.sequence(F.lit(0).cast("long"), "own")).alias("p1"), F.col("own").alias("p2"), F.col("id").alias("b"))
    # a given number of partitions, for the rows are few and the pairs many; equal ids share a part
    keys = ["p1", "p2"]
    both = one.repartition(n, *keys).join(two.repartition(n, *keys), keys).where("p1 < p2 OR b < a")
    return both.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst"))


def _offsets(images: DataFrame, col: str, offsets: list[int], cyclic: bool, self_pairs: bool) -> DataFrame:
    """Pairs of positions i and i + offset, least first.  The number of images is one row, not a collected list."""
    n = images.agg(F.count("*").alias("n"))
    rows = images.select(F.col(col).alias("i")).crossJoin(F.broadcast(n))
    rows = rows.select("i", "n", F.explode(F.array(*map(F.lit, offsets))).alias("d"))
    j = F.pmod(F.col("i") + F.col("d"), F.col("n")) if cyclic else F.col("i") + F.col("d")
    rows = rows.withColumn("j", j).where((F.col("j") >= 0) & (F.col("j") < F.col("n")))
    rows = rows.select(F.least("i", "j").alias("src"), F.greatest("i", "j").alias("dst")).distinct()
    return rows if self_pairs else rows.where("src <> dst")


def sliding(images: DataFrame, window: int = 3, cyclic: bool = True, col: str = "image_id", compat_self_pairs: bool = False) -> DataFrame:
    """Neighbours up to ``window`` positions on; ids are 0..n-1.  A full circle's self pairs only on demand."""
    return _offsets(images, col, list(range(1, window + 1)), cyclic, compat_self_pairs)


def log_window(images: DataFrame, window: int = 3, cyclic: bool = True, col: str = "image_id") -> DataFrame:
    """Neighbours at distances 1, 2, 4 .. 2^(window-1) both ways, without self pairs."""
    steps = [1 << k for k in range(window)]
    return _offsets(images, col, [*steps, *[-s for s in steps]], cyclic, False)


def one_reference(images: DataFrame, reference: int = 0, col: str = "image_id") -> DataFrame:
    """(reference, other) for every other image."""
    return images.where(F.col(col) != reference).select(F.lit(reference).cast("long").alias("src"), F.col(col).alias("dst"))


def symmetrize(pairs: DataFrame) -> DataFrame:
    """The pairs and their reverses; duplicates stay."""
    return pairs.select("src", "dst").union(pairs.select("dst", "src"))


def unordered_first(pairs: DataFrame, position: str = "pos") -> DataFrame:
    """One orientation of each unordered pair, the one that comes first."""
    key = [F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")]
    first = pairs.groupBy(*key).agg(F.min_by(F.struct("src", "dst"), F.col(position)).alias("p"))
    return first.select("p.src", "p.dst")


def frame_gap(pairs: DataFrame, limit: int, cyclic: bool = False) -> DataFrame:
    """Pairs at most ``limit`` frames apart; cyclic: over the largest id's circle."""
    gap = F.abs(F.col("src") - F.col("dst"))
    if not cyclic:
        return pairs.where(gap <= limit)
    n = pairs.agg((F.max(F.greatest("src", "dst")) + 1).alias("n"))
    around = F.least(gap, F.abs(F.col("src") + F.col("n") - F.col("dst")), F.abs(F.col("src") - F.col("n") - F.col("dst")))
    return pairs.crossJoin(F.broadcast(n)).where(around <= limit).drop("n")


def keep_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose (src, dst) is among pairs."""
    return rows.join(pairs.select("src", "dst").distinct(), ["src", "dst"], "left_semi")


def images_of(pairs: DataFrame) -> DataFrame:
    """Distinct images over pairs."""
    return pairs.select(F.explode(F.array("src", "dst")).alias("image_id")).distinct()


def pairs_per_image(pairs: DataFrame) -> DataFrame:
    """image_id and the number of pairs it is in."""
    return pairs.select(F.explode(F.array("src", "dst")).alias("image_id")).groupBy("image_id").agg(F.count("*").alias("n_pairs"))


def without_written(pairs: DataFrame, written: DataFrame) -> DataFrame:
    """Pairs, in canonical order and once each, that are not written yet in either orientation."""
    canonical = lambda d: d.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    return canonical(pairs).join(canonical(written), ["src", "dst"], "left_anti")


def on_basenames(pairs: DataFrame, files: DataFrame) -> DataFrame:
    """Pairs of names whose base names both are among files(path)."""
    base = lambda c: F.element_at(F.split(F.replace(F.col(c), F.lit("\\"), F.lit("/")), "/"), -1)
    names = files.select(base("path").alias("name")).distinct()
    rows = pairs.withColumn("a", base("src")).withColumn("b", base("dst"))
    return rows.join(names.select(F.col("name").alias("a")), "a", "left_semi").join(names.select(F.col("name").alias("b")), "b", "left_semi").drop("a", "b")


def make_pairs(images: DataFrame, spec: str, symmetric: bool = False, sim: DataFrame | None = None) -> DataFrame:
    """Pairs by a scene-graph spec; a retrieval graph needs sim(i, j, s)."""
    p = parse_spec(spec)
    if p["kind"] == "complete":
        out = complete(images)
    elif p["kind"] == "swin":
        out = sliding(images, p["window"], p["cyclic"])
    elif p["kind"] == "logwin":
        out = log_window(images, p["window"], p["cyclic"])
    elif p["kind"] == "oneref":
        out = one_reference(images, p["reference"])
    else:
        from .graphs import retrieval_graph

        if sim is None:
            raise ValueError("a retrieval graph needs similarities")
        out = retrieval_graph(sim, p["keys"], p["neighbours"])
    return symmetrize(out) if symmetric else out

"""The pair cache computes each pair once, whatever its orientation, and reads committed runs alone."""

import shutil
from pathlib import Path

from pyspark.sql import functions as F

from viewloom.sources.cache import PairCache, digest


def test_cache(spark, tmp_path):
    asked = []

    def compute(pairs):
        asked.append(sorted((r.src, r.dst) for r in pairs.collect()))
        rows = pairs.where((F.col("src") + F.col("dst")) % 5 != 0)
        return rows.select("src", "dst", (10 * F.col("src")).alias("pix1"), (10 * F.col("dst")).alias("pix2"), F.lit(0.5).alias("conf"))

    frame = lambda *rows: spark.createDataFrame(rows, "src long, dst long")
    cache = PairCache(spark, str(tmp_path), {"threshold": 0.5, "metric": "dot"})
    got = lambda d: sorted(tuple(r) for r in d.select("src", "dst", "pix1", "pix2").collect())
    assert got(cache.through(frame((1, 2), (1, 2), (3, 2)), compute)) == [(1, 2, 10, 20)]
    assert got(cache.through(frame((2, 1), (2, 3), (4, 3)), compute)) == [(2, 1, 20, 10), (4, 3, 40, 30)]
    assert asked == [[(1, 2), (3, 2)], [(4, 3)]], "pairs without rows are known too"
    assert got(cache.through(frame((1, 2), (2, 1)), compute)) == [(1, 2, 10, 20), (2, 1, 20, 10)] and len(asked) == 2
    assert cache.fill(frame((1, 2), (4, 3)), compute) == 0 and len(cache.runs()) == 2

    # the same pair computed twice at once counts once; a run without committed keys does not count
    other = PairCache(spark, str(tmp_path / "other"), cache.params)
    other.fill(frame((1, 2), (6, 1)), compute)
    for r in other.runs():
        run = Path(r.removeprefix("file:"))
        to = tmp_path / digest(cache.params) / run.name
        shutil.copytree(run, to)
    assert got(cache.rows(frame((1, 2)))) == [(1, 2, 10, 20)]
    broken = tmp_path / digest(cache.params) / "broken"
    shutil.copytree(run, broken)
    (broken / "keys" / "_SUCCESS").unlink()
    assert "broken" not in "".join(cache.runs())

    # other parameters are another cache, and their order does not matter
    assert PairCache(spark, str(tmp_path), {"metric": "dot", "threshold": 0.5}).missing(frame((2, 1))).isEmpty()
    assert PairCache(spark, str(tmp_path), {"metric": "l2", "threshold": 0.5}).missing(frame((2, 1))).count() == 1
    assert cache.missing(frame((9, 8)).limit(0)).isEmpty()
    assert PairCache(spark, str(tmp_path / "none"), {}).through(frame((9, 8)).limit(0), compute).collect() == []


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    cache = PairCache(spark, str(tmp_path), {})
    pairs = spark.createDataFrame([(1, 2)], "src long, dst long")

    def fails(p):
        raise RuntimeError("lost")

    for _ in range(2):
        try:
            cache.through(pairs, fails)
        except RuntimeError:
            pass
    assert cache.runs() == [] and cache.rows(pairs) is None
    assert cache.through(pairs, lambda p: p.withColumn("pix1", F.lit(1))).count() == 1

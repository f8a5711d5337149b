"""A read-through cache of what is computed for image pairs: a committed table keyed by pair and parameters."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that change places with the ends of a pair.
ENDS = {"src": "dst", "pix1": "pix2", "a": "b", "kp_idx1": "kp_idx2", "x1": "x2", "y1": "y2", "conf1": "conf2"}


def digest(params: dict) -> str:
    """A digest of parameters, whatever their order."""
    return hashlib.md5(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()


def pair_key(src, dst, params: dict):
    """The key of a pair, either way round, under parameters."""
    low, high = F.least(src, dst).cast("string"), F.greatest(src, dst).cast("string")
    return F.md5(F.concat_ws("\x00", F.lit(digest(params)), F.length(low).cast("string"), low, high))


def turned(rows: DataFrame, ends: dict[str, str] = ENDS) -> DataFrame:
    """rows with the columns of both ends swapped."""
    swap = {k: v for k, v in (*ends.items(), *((v, k) for k, v in ends.items())) if k in rows.columns and v in rows.columns}
    return rows.select(*[F.col(swap.get(c, c)).alias(c) for c in rows.columns])


class PairCache:
    """Rows computed for pairs, in runs below ``folder``.

    A run is two tables: its rows, and then the keys of the pairs that it was asked for, those without a row too.  It
    counts once its keys are committed; rows of a run that failed before are never read.  Of runs that computed a pair
    at the same time the first by name counts, so nothing is doubled.
    """

    def __init__(self, spark: SparkSession, folder: str, params: dict):
        self.spark, self.folder, self.params = spark, folder.rstrip("/"), params

    def runs(self) -> list[str]:
        """Folders of committed runs with these parameters."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{digest(self.params)}/*/keys/_SUCCESS")
        found = pattern.getFileSystem(conf).globStatus(pattern)
        return sorted(f.getPath().getParent().getParent().toString() for f in found or [])

    def keys(self) -> DataFrame | None:
        """key and the run that counts for it."""
        runs = self.runs()
        if not runs:
            return None
        return self.spark.read.parquet(*[f"{r}/keys" for r in runs]).groupBy("key").agg(F.min("run").alias("run"))

    def missing(self, pairs: DataFrame) -> DataFrame:
        """The pairs, once and as they are first by order, that no run has."""
        asked = pairs.withColumn("key", pair_key(F.col("src"), F.col("dst"), self.params)).groupBy("key").agg(F.min(F.struct("src", "dst")).alias("p")).select("key", "p.*")
        done = self.keys()
        return asked if done is None else asked.join(done, "key", "left_anti")

    def fill(self, pairs: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> int:
        """Compute what is missing in one run; how many pairs that were.

        compute takes pairs(src, dst) and returns rows with src and dst, either way round.
        """
        run = f"{self.folder}/{digest(self.params)}/{uuid.uuid4().hex}"
        missing = self.missing(pairs)
        if missing.isEmpty():
            return 0
        asked = f"{run}/asked"
        missing.write.parquet(asked)
        asked = self.spark.read.schema(missing.schema).parquet(asked)
        rows = compute(asked.select("src", "dst"))
        key = pair_key(F.col("src"), F.col("dst"), self.params)
        rows.withColumn("key", key).withColumn("run", F.lit(run)).write.parquet(f"{run}/rows")
        # with this the run counts
        asked.select("key", F.lit(run).alias("run")).write.parquet(f"{run}/keys")
        return asked.count()

    def rows(self, pairs: DataFrame) -> DataFrame | None:
        """The cached rows of pairs(src, dst), turned as the pairs are; None where nothing is cached."""
        done = self.keys()
        if done is None:
            return None
        asked = pairs.select("src", "dst").distinct().withColumn("key", pair_key(F.col("src"), F.col("dst"), self.params))
        found = self.spark.read.parquet(*[f"{r}/rows" for r in self.runs()]).join(done, ["key", "run"]).drop("run")
        columns = [c for c in found.columns if c != "key"]
        wanted = asked.select("key", F.col("src").alias("__src"), F.col("dst").alias("__dst"))
        same = found.join(wanted, "key").where(F.col("src") == F.col("__src"))
        other = found.join(wanted, "key").where(F.col("src") != F.col("__src"))
        return same.select(*columns).unionByName(turned(other.select(*columns)))

    def through(self, pairs: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Rows of the pairs, computed where they are not cached yet."""
        self.fill(pairs, compute)
        found = self.rows(pairs)
        return found if found is not None else compute(pairs.select("src", "dst"))

"""Tables in the folder that all executors share, to cut lineage in iterative operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where it is unset and all runs on one machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="viewloom-")
    return _OWN[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(rows: DataFrame, *order: str, name: str = "place") -> DataFrame:
    """rows with their place from 0 in the given order, ties in any order.

    Rows are dealt to ranges; each range numbers its own, after as many rows as the ranges before it hold.  What is
    ordered in one task is a range, and the table of their sizes.
    """
    return sums_before(rows.withColumn("__one", F.lit(1).cast("long")), "__one", *order, name=name).drop("__one")


def sums_before(rows: DataFrame, value: str, *order: str, name: str = "before") -> DataFrame:
    """rows with the sum of a whole-number column over all rows before them in the given order, by ranges as well."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stash(rows.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("__range").agg(F.sum(value).alias("__n"))
    sizes = sizes.select("__range", F.coalesce(F.sum("__n").over(earlier(Window.orderBy("__range"))), F.lit(0)).alias("__before"))
    own = F.coalesce(F.sum(value).over(earlier(Window.partitionBy("__range").orderBy(*order))), F.lit(0))
    return dealt.join(F.broadcast(sizes), "__range").withColumn(name, F.col("__before") + own).drop("__range", "__before")

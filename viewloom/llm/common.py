"""What the operators of this subpackage share: folders all executors see, and sizes."""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset and all runs on one machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="viewloom-")
        spark.sparkContext.setCheckpointDir(_LOCAL[app])
    return _LOCAL[app]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str):
    """(filesystem, path) for a folder URI; runs on driver and executors alike."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of df; no job runs.  Where it has none, 16 MB for each shuffle partition."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 16_000_000


def parts(df: DataFrame, mb: float, least: int = 12, most: int = 65536) -> int:
    """Number of partitions so that each gets about mb megabytes of df."""
    return max(least, min(most, math.ceil(input_bytes(df) / (mb * 1e6))))


def utf8(col: str | F.Column):
    """The column's text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def binary_values(column) -> list[bytes]:
    """The values of an Arrow string or binary column as bytes, null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser for uint64 values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))

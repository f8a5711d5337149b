"""Pairs that arrive over time: each batch writes only pairs that are not written yet.

The matching side has no event time or windows; what a stream needs is that a pair is processed once, whatever
arrives twice or again after a restart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.pairs import without_written


def write_new_pairs(stream: DataFrame, table: str, checkpoint: str, trigger: dict | None = None, buckets: int = 1024) -> StreamingQuery:
    """Append the new pairs (src, dst) of a stream to a Parquet folder, canonical and once each.

    The folder is cut by buckets of pairs, and a batch reads only the buckets that its own pairs fall in.  A batch
    that is replayed after a failure finds its pairs written and adds nothing.
    """
    schema = "src long, dst long, bucket int"
    bucket = F.pmod(F.xxhash64(F.least("src", "dst"), F.greatest("src", "dst")), F.lit(buckets)).cast("int").alias("bucket")

    def add(batch: DataFrame, _: int) -> None:
        batch.persist()
        touched = [r.bucket for r in batch.select(bucket).distinct().collect()]
        written = batch.sparkSession.read.schema(schema).parquet(table).where(F.col("bucket").isin(touched))
        new = without_written(batch.select("src", "dst"), written)
        new.select("src", "dst", bucket).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(table)
        batch.unpersist()

    stream.sparkSession.createDataFrame([], schema).write.mode("append").partitionBy("bucket").parquet(table)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

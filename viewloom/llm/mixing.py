"""Mixing sources to target weights by Efraimidis-Spirakis keys, with DataFrame functions only.

Each document gets the exponential key ``-ln(u) / w`` with u from a hash of its id and w from its quality.
A source whose target is e whole sizes and a rest takes e complete epochs first; the rest goes to documents in
key order until their prefix sum meets the budget.  The prefix sum of a source is split over key buckets: sums
per bucket are aggregated before any shuffle of rows, and only rows of one bucket are ever ordered together,
so a source that holds a third of all rows is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
JUNK = r"[!#$%&*|<>{}=_^~\\]"
RESULTS = ("size", "source_size", "target", "taken")


def quality_weight(text, size):
    """1 for plain prose, falling with the share of symbols per word; never 0."""
    junk = F.regexp_count(text, F.lit(JUNK)).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * junk / F.greatest(size, F.lit(1)).cast("double"))


def source_targets(sums: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """skey, source_size -> also target: share of all sizes dealt by weight, at most cap times a source's size.

    Weights repeat over the sources in skey order.  The level that water-filling reaches is found from prefix
    sums over sources ordered by cap / weight; the table has one row per source.
    """
    every, level = Window.orderBy("skey"), Window.orderBy("ratio", "skey")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int"))
    t = sums.withColumn("w", w).withColumn("cap", F.lit(cap) * F.col("source_size"))
    t = t.withColumn("ratio", F.col("cap") / F.col("w"))
    before = F.coalesce(F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("w").over(level.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    t = t.withColumn("here", (total - before) / after)
    t = t.withColumn("lam", F.max(F.when(F.col("here") <= F.col("ratio"), F.col("here"))).over(Window.partitionBy()))
    return t.select("skey", "source_size", F.least("cap", F.coalesce(F.col("lam") * F.col("w"), F.col("cap"))).alias("target"))


def mix_sources(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", keep=None, quality=None, weights=(5, 2, 1), share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix-1", buckets: int = 4096) -> DataFrame:
    """docs' columns in ``keep`` (default: the id) and size, source_size, target, taken.

    quality: a column of document quality weights; those that are null, not positive or not finite count as 1.
    Default: 1 for plain prose, falling with the share of symbols.  size: words of the text (null or empty: 0).  taken: words that the mix takes of the row, repeats counted: 0,
    size, or more whole copies up to max_epochs.  A null source is a source of its own, last in order.  Rows with
    equal keys (equal ids) are ordered by size; identical rows are interchangeable.  An empty table gives an empty
    result.  Kept columns that bear a result's name are replaced by the result.
    """
    keep = [c for c in (keep or [id_col]) if c not in RESULTS]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        *[F.col(c).alias(f"k_{c}") for c in keep],
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("1"), F.col(source_col)), F.lit("2")).alias("skey"),
        ((F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("|" + seed))), 1, 13), 16, 10).cast("double") + 1.0) / F.lit(float(2**52 + 1))).alias("u"),
        text.alias("t"), *([] if quality is None else [F.col(quality).cast("double").alias("q")]),
    )
    good = F.when((F.col("q") > 0) & (F.col("q") < float("inf")), F.col("q")).otherwise(F.lit(1.0)) if quality else quality_weight(F.col("t"), F.col("size"))
    rows = rows.withColumn("w", good).drop("t", "q")
    rows = rows.withColumn("key", -F.log("u") / F.col("w"))
    rows = rows.withColumn("bucket", F.least(F.lit(buckets - 1), F.floor(F.lit(float(buckets)) * (F.lit(1.0) - F.exp(-F.col("key"))))).cast("int"))

    sums = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(sums.groupBy("skey").agg(F.sum("bucket_size").alias("source_size")), weights, share, max_epochs)
    ordered = Window.partitionBy("skey").orderBy("bucket")
    plan = (
        sums.withColumn("before", F.sum("bucket_size").over(ordered) - F.col("bucket_size"))
        .join(targets, "skey")
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
        .drop("bucket_size")
    )
    within = Window.partitionBy("skey", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.drop("u", "w").join(plan, ["skey", "bucket"]).withColumn("upto", F.col("before") + F.sum("size").over(within))
    chosen = F.col("upto") - F.col("size") / 2.0 <= F.col("budget")
    taken = F.col("size") * (F.col("epochs") + F.when(chosen, 1).otherwise(0))
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep], "size", "source_size", "target", taken.cast("long").alias("taken"))


def op6_mix(spark, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') t, coalesce('1' || source, '2') skey,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT size,
         len(regexp_extract_all(coalesce(text, ''), '[!#$%&*|<>{}=_^~\\]'))::DOUBLE junk,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|mix-1'), 1, 13))::BIGINT::DOUBLE + 1.0) / 4503599627370497.0 u
  FROM documents),
k AS (SELECT *, -ln(u) / (1.0 / (1.0 + 4.0 * junk / greatest(size, 1)::DOUBLE)) AS key FROM d),
s AS (SELECT skey, sum(size)::BIGINT source_size FROM d GROUP BY 1),
r AS (SELECT *, list_extract([5.0, 2.0, 1.0]::DOUBLE[], 1 + ((row_number() OVER (ORDER BY skey)) - 1) % 3) w, 2.0::DOUBLE * source_size cap FROM s),
l AS (SELECT *, cap / w ratio,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / sum(w) OVER (ORDER BY cap / w, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) here FROM r),
m AS (SELECT *, max(CASE WHEN here <= ratio THEN here END) OVER () lam FROM l),
g AS (SELECT skey, source_size, least(cap, coalesce(lam * w, cap))::DOUBLE target FROM m),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END epochs FROM g),
p AS (SELECT doc_id, k.size, source_size, target, epochs, target - epochs * source_size budget,
         sum(k.size) OVER (PARTITION BY k.skey ORDER BY key, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) upto
      FROM k JOIN e USING (skey))
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN upto - size / 2.0 <= budget THEN 1 ELSE 0 END))::BIGINT taken FROM p
"""

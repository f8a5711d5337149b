"""A corpus pipeline: quality classifier, near-duplicate join, suffix-array dedup, source mixing and BPE.

STAGES lists (name, function of (spark, docs, sf_dir)).  Every stage works on all rows that its predecessor kept; all
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm import bpe, common, jaccard, mixing, quality, suffix


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.  Null or empty texts, hosts and languages are values of their own;
    repeated rows stay repeated; an empty table gives an empty result."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels, keep=docs.columns).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each group linked by five-word shingles at a similarity of 0.8 or more.

    Null ids count as largest; of rows that repeat an id and a text one stays, and of equal ids with similar texts as
    well.  Rows without words are linked with nothing and all stay.  An empty table gives an empty result.
    """
    words = F.coalesce(F.col("text").rlike(mixing.WORD), F.lit(False))
    found = jaccard.jaccard_components(docs, k=5, percent=80, keys=True).where("n_shingles > 0")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("f"))
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63)))
    first = first.select(number("f.doc_id").alias("__id"), F.col("f.text_key").alias("__key"))
    rows = docs.where(words).withColumn("__id", number("doc_id")).withColumn("__key", F.xxhash64("text"))
    kept = rows.join(first, ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"])
    return kept.select(docs.columns).unionByName(docs.where(~words))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that earlier documents have; characters that a removal cuts go as a whole.

    A null text becomes empty; n_chars, where there is such a column, is counted anew.  Other columns and repeated
    rows stay as they are; an empty table gives an empty result.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = suffix.suffix_dedup(docs, texts=True, keep=others).withColumnRenamed("kept_text", "text")
    counted = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")} if "n_chars" in others else {}
    given = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text": F.col("text")}
    return found.select([(given | counted).get(c, F.col(f"row.`{c}`")) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents of later epochs once more for each; those without words add nothing and go, null
    and empty texts so too.  A null source is one of its own.  An empty table gives an empty result."""
    taken = mixing.mix_sources(docs, keep=docs.columns).where("taken > 0")
    times = F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))
    return taken.withColumn("epoch", F.explode(times)).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of the text that they decode to; a null text is empty, repeated rows stay
    repeated, an empty table gives an empty result."""
    return bpe.bpe_tokens(docs)


STAGES = [("quality", classify), ("near_duplicates", near_duplicates), ("suffix_dedup", repeats), ("mixing", mix), ("bpe", tokens)]

#: The classifier's fit and the automaton have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after another, over the documents of sf_dir; each result is a table of the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

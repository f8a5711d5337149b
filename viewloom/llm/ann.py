"""Approximate nearest neighbours by inner product: a forest of sorted hash-prefix arrays.

Every tree gives each vector a string of sign bits and keeps the strings sorted.  A query descends to its longest
prefix match in every tree; then all trees ascend together, one bit at a time and within a level one tree after
another, until their ranges hold enough entries.  Only those entries' vectors are scored.  Vectors of unequal norms
get one more coordinate that makes them equal, so the angle ranks as the inner product does.

Distinct vectors are dealt to shards by length and hash.  A shard's forest is built once; every query of its length
is sent to it and streams past it.  A query asks for the same share of each shard, less of large tables than of
small ones, as neighbours are nearer there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .blocks import record

HITS = "query_rep long, rep long, score double"
DEPTH = 32


class Forest:
    """Sorted hash strings of a shard's rows, a tree each."""

    def __init__(self, x: np.ndarray, trees: int, largest: float, seed: int):
        self.planes = np.random.default_rng(seed).normal(size=(x.shape[1] + 1, trees * DEPTH))
        self.trees, self.n = trees, len(x)
        strings = self.strings(np.column_stack([x, np.sqrt(np.maximum(0.0, largest - (x * x).sum(axis=1)))]))
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def strings(self, wide: np.ndarray) -> np.ndarray:
        """A row per tree, a string per vector."""
        bits = np.packbits(wide @ self.planes > 0, axis=1)
        return np.ascontiguousarray(bits.view(">u4").astype(np.uint32).reshape(len(wide), self.trees).T)

    def entries(self, own: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree the range of entries that share the first ``level`` bits with it."""
        rest = ((np.int64(1) << (DEPTH - level)) - 1).astype(np.uint32)
        lo = [np.searchsorted(k, s & ~rest) for k, s in zip(self.sorted, own)]
        hi = [np.searchsorted(k, s | rest, "right") for k, s in zip(self.sorted, own)]
        return np.column_stack(lo), np.column_stack(hi)

    def ranges(self, queries: np.ndarray, want: float) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree a range of entries, want entries or more over all trees where there are so many.

        Ranges only grow on the way up, so the level at which they hold enough is found by bisection.
        """
        own = self.strings(np.column_stack([queries, np.zeros(len(queries))]))
        up, down = np.zeros(len(queries), np.int64), np.full(len(queries), DEPTH, np.int64)
        while (up < down).any():
            level = (up + down + 1) // 2
            lo, hi = self.entries(own, level)
            enough = (hi - lo).sum(axis=1) >= want
            up, down = np.where(enough, level, up), np.where(enough, down, level - 1)
        lo, hi = self.entries(own, up)
        was_lo, was_hi = self.entries(own, np.minimum(up + 1, DEPTH))
        were = was_hi - was_lo
        held = were.sum(axis=1, keepdims=True) + np.cumsum(hi - lo - were, axis=1)
        # trees up to the one that brings enough have ascended to this level, the others not
        risen = np.column_stack([np.ones(len(held), bool), held[:, :-1] < want])
        return np.where(risen, lo, was_lo), np.where(risen, hi, was_hi)

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        found = np.zeros(self.n, bool)
        for order, a, b in zip(self.order, low.tolist(), high.tolist()):
            found[order[a:b]] = True
        return np.flatnonzero(found)


def _matrix(column, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def best_of(forest: Forest, reps: np.ndarray, x: np.ndarray, asked: np.ndarray, q: np.ndarray, want: float, keep: int) -> Iterator[tuple]:
    """For each query its best candidates: (query, rep, score, candidates scored)."""
    low, high = forest.ranges(q, want)
    # single precision on vectors of length 1 at most, and all within its error in double precision again
    top = np.sqrt((x * x).sum(axis=1).max(initial=0.0))
    small, error = (x / top).astype(np.float32), x.shape[1] * 2.0**-22
    for i, query in enumerate(q):
        c = forest.candidates(low[i], high[i])
        n = len(c)
        if n > keep:
            s = small[c] @ (query / np.sqrt(query @ query)).astype(np.float32)
            c = c[s >= np.partition(s, n - keep)[n - keep] - error]
        exact = (x[c] * query).sum(axis=1)
        best = np.lexsort((reps[c], -exact))[:keep]
        yield np.full(len(best), asked[i]), reps[c[best]], exact[best], np.full(len(best), n)


def _search(trees: int, keep: int, seed: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, forest = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            edges = np.flatnonzero(_edges(table))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), table.num_rows]):
                part = table.slice(a, b - a)
                dims, number, asks = (part.column(c)[0].as_py() for c in ("dims", "shard", "asks"))
                if (dims, number) != shard:
                    shard, held, forest = (dims, number), [], None
                ids, v = np.array(part.column("rep")), _matrix(part.column("v"), dims)
                if not asks:
                    held.append((ids, v))
                    continue
                if not held:
                    continue
                if forest is None:
                    reps, x = (np.concatenate(z) for z in zip(*held))
                    held = [(reps, x)]
                    forest = Forest(x, trees, part.column("largest")[0].as_py(), seed)
                want = max(part.column("share")[0].as_py() * len(x) + trees, 4.0 * keep)
                for at in range(0, len(v), 512):
                    found = best_of(forest, reps, x, ids[at : at + 512], v[at : at + 512], want, keep)
                    yield from record(HITS, *map(np.concatenate, list(zip(*found))[:3])).to_batches()

    return search


def _edges(table: pa.Table) -> np.ndarray:
    """Whether a row is the first of its shard's rows or queries."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in ("dims", "shard", "asks"):
        new[1:] |= np.diff(np.array(table.column(c))) != 0
    return new


def nearest(vectors: DataFrame, *, id_col="vec_id", vector_col="embedding", every: int = 20, k: int = 20, trees: int = 128, effort: float = 4.5, power: float = 0.78, shard_rows: int = 16384, seed: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by every.

    Candidates are all rows of the query's length but its own, nearest first, ties to the smaller id; all of them
    where there are fewer than k.  score is the inner product in double precision; of vectors of unequal lengths
    there is none, so each length is searched by itself.  Vectors that are null, zero or empty, or hold null or
    non-finite components, and rows with a null id, take no part.  Equal vectors are searched once; of those the
    k + 1 smallest ids can be in a result.  Rows that repeat an id count each.  An empty table gives an empty result;
    other columns are not read.
    effort, power: a query's ranges hold effort * n^power entries over all trees, of n distinct vectors, and its own;
    a table that is not clustered needs about that for a recall of 0.9.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(good, F.lit(False)))
    rows = rows.withColumn("hash", F.xxhash64("v"))
    # the smallest ids of each distinct vector; the limit holds before the shuffle as well
    firsts = rows.withColumn("place", F.row_number().over(Window.partitionBy("hash", "v").orderBy("id"))).where(F.col("place") <= k + 1)
    firsts = common.stash(firsts, "vectors")
    distinct = firsts.where("place = 1").select(F.size("v").alias("dims"), F.col("id").alias("rep"), "v", "hash")
    asked = rows.where(F.col("id") % every == 0).select("id", "hash", "v").join(distinct.select("rep", "v", "hash"), ["hash", "v"]).select(F.col("id").alias("query_id"), "rep")
    asked = common.stash(asked, "asked")
    shape = distinct.groupBy("dims").agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("largest"), F.ceil(F.count("*") / F.lit(shard_rows)).cast("long").alias("shards"), F.least(F.lit(float(trees)), F.lit(effort) * F.pow(F.count("*").cast("double"), F.lit(power - 1.0))).alias("share"))
    placed = distinct.join(shape, "dims").select("dims", F.pmod(F.xxhash64("hash"), "shards").alias("shard"), F.lit(False).alias("asks"), "rep", "v", "largest", "share")
    queries = distinct.join(asked.select("rep").distinct(), "rep").join(shape, "dims")
    queries = queries.select("dims", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), F.lit(True).alias("asks"), "rep", "v", "largest", "share")
    n = common.parts(distinct, shard_rows * 512 / 1e6, least=int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.unionByName(queries).repartition(n, "dims", "shard").sortWithinPartitions("dims", "shard", "asks")
    hits = dealt.mapInArrow(_search(trees, k + 1, seed), HITS)
    best = Window.partitionBy("query_rep").orderBy(F.desc("score"), "rep")
    hits = hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place")
    ids = firsts.join(distinct.select("rep", "hash", "v"), ["hash", "v"]).select("rep", F.col("id").alias("vec_id"))
    ids = ids.groupBy("rep").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    # k + 1 ids at most for each vector, so k + 1 vectors give (k + 1)^2 rows at most, cut at once to k + 1
    named = hits.join(ids, "rep").groupBy("query_rep").agg(F.sort_array(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("i")))))).alias("found"))
    named = named.select(F.col("query_rep").alias("rep"), F.slice("found", 1, k + 1).alias("found"))
    out = asked.join(named, "rep").select("query_id", F.slice(F.filter("found", lambda x: x["i"] != F.col("query_id")), 1, k).alias("found"))
    out = out.select("query_id", F.posexplode("found").alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.i").alias("vec_id"), (-F.col("hit.s")).alias("score"))


def op9_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

"""Hard-negative mining by vantage-point trees: rows of another label whose score is a share of a positive's.

Scores are integer inner products.  One more coordinate makes all rows equally long, so that a row's distance from an
anchor tells its score: d^2 = |anchor|^2 + longest^2 - 2 score.  A window of scores is an annulus of distances.  A tree
halves its rows by their distance from a vantage point, again and again; the triangle inequality then bounds the
scores of each leaf.  A search visits the leaves that can meet the annulus, the nearest first, and ends where the next
leaf can't hold anything better than the k rows found.

A small tree over a bounded sample deals the rows to cells, and each cell's rows get trees of their own, a table of
which is written once.  An anchor goes to its most promising cell first; what it finds there bounds which other cells
it is sent to.  Trees only say where to look: every row is in one, scores are exact, and so are results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .blocks import dump, load, record

SHARD_ROWS, LEAF_ROWS, SAMPLE_ROWS, CELLS, BLOCK_ASKS = 16_384, 128, 4_096, 1_024, 65_536
LEAST, MOST = -(1 << 62), 1 << 62
INDEX = "dims int, cell int, salt int, blob binary"
FOUND = "gid long, w int, score long, id long"


class Tree:
    """Vantage points, and for each node the range of distances from its parent's vantage point.

    Node i is the first or second half of node parent[i]; vantage[i] is a row, or -1 for a leaf, which holds the rows
    order[start[i] : end[i]].
    """

    def __init__(self, x: np.ndarray, longest: float, arrays: list[np.ndarray]):
        self.x, self.longest = x, longest
        self.parent, self.vantage, self.low, self.high, self.start, self.end, self.order = arrays

    @classmethod
    def build(cls, x: np.ndarray, longest: float, leaf_rows: int, open_ends: bool = False) -> Tree:
        """x: rows; longest: a squared length that none exceeds.  open_ends: ranges that hold for rows yet to come."""
        wide = np.column_stack([x, np.sqrt(np.maximum(0.0, longest - (x * x).sum(axis=1)))])
        order = np.arange(len(x))
        parent, vantage, low, high, start, end = [-1], [-1], [0.0], [np.inf], [0], [len(x)]
        at = 0
        while at < len(parent):
            a, b = start[at], end[at]
            if b - a > leaf_rows:
                rows = order[a:b]
                middle = wide[rows].mean(axis=0)
                v = rows[np.argmax(((wide[rows] - middle) ** 2).sum(axis=1))]
                d = np.sqrt(np.maximum(0.0, ((wide[rows] - wide[v]) ** 2).sum(axis=1)))
                limit = np.partition(d, (b - a) // 2)[(b - a) // 2]
                if limit == d.max():
                    limit = d[d < limit].max(initial=-1.0)
                inside = d <= limit
                if inside.any() and not inside.all():
                    vantage[at] = int(v)
                    order[a:b] = np.concatenate([rows[inside], rows[~inside]])
                    cut = a + int(inside.sum())
                    for half, (i, j) in ((inside, (a, cut)), (~inside, (cut, b))):
                        ends = (0.0 if half is inside else limit, limit if half is inside else np.inf) if open_ends else (d[half].min(), d[half].max())
                        for column, value in zip((parent, vantage, low, high, start, end), (at, -1, *ends, i, j)):
                            column.append(value)
            at += 1
        kinds = (np.int64, np.int64, float, float, np.int64, np.int64)
        return cls(x, longest, [*(np.array(c, k) for c, k in zip((parent, vantage, low, high, start, end), kinds)), order])

    @property
    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.vantage < 0)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """For each row the number of its leaf among the leaves; for trees with open ends."""
        rest = np.sqrt(np.maximum(0.0, self.longest - (x * x).sum(axis=1)))
        at, number = np.zeros(len(x), np.int64), np.cumsum(self.vantage < 0) - 1
        for node in np.flatnonzero(self.vantage >= 0).tolist():
            here = np.flatnonzero(at == node)
            v = self.x[self.vantage[node]]
            side = np.sqrt(max(0.0, self.longest - v @ v))
            d = np.sqrt(((x[here] - v) ** 2).sum(axis=1) + (rest[here] - side) ** 2)
            first, second = np.flatnonzero(self.parent == node).tolist()
            at[here] = np.where(d <= self.high[first], first, second)
        return number[at]

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each query can have with a row of each leaf."""
        norm = (queries * queries).sum(axis=1)
        slack = 1e-6 * (np.sqrt(self.longest) + 1)
        inner = np.flatnonzero(self.vantage >= 0)
        d = dict(zip(inner.tolist(), np.sqrt(np.maximum(0.0, (norm + self.longest)[:, None] - 2 * (queries @ self.x[self.vantage[inner]].T))).T))
        near, far = {0: np.zeros(len(queries))}, {0: np.full(len(queries), np.inf)}
        for i in range(1, len(self.parent)):
            p = int(self.parent[i])
            near[i] = np.maximum(near[p], np.maximum(d[p] - self.high[i], self.low[i] - d[p]))
            far[i] = np.minimum(far[p], d[p] + self.high[i])
        near, far = (np.column_stack([b[i] for i in self.leaves.tolist()]) for b in (near, far))
        top = (norm + self.longest)[:, None]
        return (top - (far + slack) ** 2) / 2 - 1, (top - np.maximum(0.0, near - slack) ** 2) / 2 + 1


def scores_of(a: np.ndarray, b: np.ndarray, exact_floats: bool) -> np.ndarray:
    """Integer inner products of all rows of a with all rows of b; as products of doubles where those are exact."""
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64) if exact_floats else a @ b.T


def first_k(ask: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first of each ask, by falling score and rising key, ask after ask."""
    order = np.lexsort((key, -score, ask))
    first = np.searchsorted(ask[order], ask[order])
    return order[np.arange(len(order)) - first < k]


class Shard:
    """The rows of a cell or a part of it: distinct (vector, label) with their smallest ids, and their tree."""

    def __init__(self, tree: Tree, labels: np.ndarray, ids: np.ndarray, ends: np.ndarray, longest: int):
        self.tree, self.labels, self.ids, self.ends, self.longest = tree, labels, ids, ends, longest
        self.whole = tree.x.astype(np.int64)
        self.starts = np.append(0, ends[:-1])
        self.first = ids[self.starts] if len(ends) else ids

    @classmethod
    def build(cls, x: np.ndarray, labels: np.ndarray, ids: list[list[int]], leaf_rows: int = LEAF_ROWS) -> Shard:
        longest = int((x * x).sum(axis=1).max(initial=0))
        return cls(Tree.build(x.astype(float), float(longest), leaf_rows), labels, np.array([i for some in ids for i in some], np.int64), np.cumsum([len(i) for i in ids]), longest)

    def dump(self) -> bytes:
        t = self.tree
        shape = np.array([*self.whole.shape, self.longest], np.int64)
        return dump(shape, self.whole.reshape(-1), self.labels, self.ids, self.ends, t.parent, t.vantage, t.low, t.high, t.start, t.end, t.order)

    @classmethod
    def load(cls, blob: bytes) -> Shard:
        (n, dims, longest), flat, labels, ids, ends, *arrays = load(blob)
        return cls(Tree(flat.reshape(int(n), int(dims)).astype(float), float(longest), arrays), labels, ids, ends, int(longest))

    def search(self, queries: np.ndarray, labels: np.ndarray, query: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, ...]:
        """Ask i is for the k best rows of query[i] with scores low[i] to high[i], of the same label or another one.
        The asks, scores and ids found."""
        exact = max(self.longest, int((queries * queries).sum(axis=1).max(initial=0))) < 1 << 52
        least, most = (b[query] for b in self.tree.bounds(queries.astype(float)))
        order = np.argsort(-np.minimum(most, high[:, None]), axis=1, kind="stable")
        leaves, bar = self.tree.leaves, low.copy()
        held = tuple(np.empty(0, np.int64) for _ in range(3))
        at, step = 0, 1
        while at < len(leaves):
            some = order[:, at : at + step]
            ask = np.repeat(np.arange(len(query)), some.shape[1])
            leaf = some.reshape(-1)
            alive = (most[ask, leaf] >= bar[ask]) & (least[ask, leaf] <= high[ask])
            ask, leaf = ask[alive], leaf[alive]
            found = [held]
            for one in np.unique(leaf).tolist():
                asks = ask[leaf == one]
                rows = self.tree.order[self.tree.start[leaves[one]] : self.tree.end[leaves[one]]]
                of, back = np.unique(query[asks], return_inverse=True)
                s = scores_of(queries[of], self.whole[rows], exact)[back]
                fits = (s >= bar[asks][:, None]) & (s <= high[asks][:, None]) & ((labels[query[asks]][:, None] == self.labels[rows]) == same)
                i, j = np.nonzero(fits)
                found.append((asks[i], s[i, j], rows[j]))
            held = tuple(map(np.concatenate, zip(*found)))
            best = first_k(held[0], held[1], self.first[held[2]], k)
            held = tuple(x[best] for x in held)
            full = np.bincount(held[0], minlength=len(query)) >= k
            last = np.searchsorted(held[0], np.arange(len(query)), "right") - 1
            bar[full] = np.maximum(bar[full], held[1][last[full]])
            at, step = at + step, step * 2
        # each row stands for its smallest ids
        n = (self.ends - self.starts)[held[2]]
        place = np.repeat(self.starts[held[2]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ask, score, key = np.repeat(held[0], n), np.repeat(held[1], n), self.ids[place]
        best = first_k(ask, score, key, k)
        return ask[best], score[best], key[best]


def _matrix(column, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def _by_dims(batch) -> Iterator[tuple[int, pa.Table]]:
    table = pa.Table.from_batches([batch])
    dims = np.array(table.column("dims"))
    for n in np.unique(dims).tolist():
        yield n, table.take(pa.array(np.flatnonzero(dims == n)))


def _placed(trees):
    """Adds each row's cell."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, part in _by_dims(batch):
                tree = trees.value.get(dims)
                cell = tree.assign(_matrix(part.column("v"), dims).astype(float)) if tree else np.zeros(part.num_rows)
                yield from part.append_column("cell", pa.array(cell.astype(np.int32), pa.int32())).to_batches()

    return placed


def _built(shard_rows: int):
    """Trees of the rows of each (dims, cell, salt), which follow one another."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, n = None, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                x, labels, ids = zip(*held)
                shard = Shard.build(np.concatenate(x), np.concatenate(labels), [i for some in ids for i in some])
                yield from record(INDEX, *([k] for k in key), [shard.dump()]).to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = np.column_stack([np.array(table.column(c)) for c in ("dims", "cell", "salt")])
            edges = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
            for a, b in zip(edges, [*edges[1:], len(keys)]):
                if tuple(keys[a].tolist()) != key or n >= 2 * shard_rows:
                    yield from out()
                    key, held, n = tuple(keys[a].tolist()), [], 0
                part = table.slice(a, b - a)
                held.append((_matrix(part.column("v"), key[0]), np.array(part.column("label")), part.column("ids").to_pylist()))
                n += b - a
        yield from out()

    return built


ROUTED = "dims int, cell int, gid long, label long, v array<long>, low array<long>, high array<long>"


def _routed(trees, home: bool):
    """A row for each query and cell: its most promising cell, or the others that can hold something."""

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, part in _by_dims(batch):
                tree = trees.value.get(dims)
                n = part.num_rows
                if tree is None:
                    ask, cell = (np.arange(n), np.zeros(n)) if home else (np.empty(0, int), np.empty(0))
                else:
                    least, most = tree.bounds(_matrix(part.column("v"), dims).astype(float))
                    low, high = (part.column(c).to_pylist() for c in ("low", "high"))
                    top = np.array([max(h, default=LEAST) for h in high], float)
                    # cells that reach the window equally are told apart by their least score
                    first = np.lexsort((-least, -np.minimum(most, top[:, None])), axis=1)[:, 0]
                    if home:
                        ask, cell = np.arange(n), first
                    else:
                        meets = np.zeros(most.shape, bool)
                        for w in range(max(map(len, low), default=0)):
                            lo, hi = (np.array([x[w] if w < len(x) else y for x in xs], float)[:, None] for xs, y in ((low, MOST), (high, LEAST)))
                            meets |= (most >= lo) & (least <= hi) & (lo <= hi)
                        meets[np.arange(n), first] = False
                        ask, cell = np.nonzero(meets)
                rows = part.select(["gid", "label", "v", "low", "high"]).take(pa.array(ask))
                rows = rows.add_column(0, "cell", pa.array(cell.astype(np.int32), pa.int32()))
                yield from rows.add_column(0, "dims", pa.array(np.full(len(ask), dims), pa.int32())).to_batches()

    return routed


def _searched(k: int, same: bool):
    """The index's rows of a (dims, cell, salt, block) come before its asks."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shards = None, []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = np.column_stack([np.array(table.column(c)).astype(np.int64) for c in ("dims", "cell", "salt", "block", "asks")])
            edges = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
            for a, b in zip(edges, [*edges[1:], len(keys)]):
                part, now = table.slice(a, b - a), tuple(keys[a, :4].tolist())
                if now != key:
                    key, shards = now, []
                if not keys[a, 4]:
                    shards += [Shard.load(x) for x in part.column("blob").to_pylist()]
                    continue
                for at in range(0, b - a, 256):
                    some = part.slice(at, 256)
                    gids, low, high = np.array(some.column("gid")), some.column("low").to_pylist(), some.column("high").to_pylist()
                    query = np.repeat(np.arange(len(gids)), [len(x) for x in low])
                    if not len(query):
                        continue
                    window = np.concatenate([np.arange(len(x)) for x in low])
                    lo, hi = (np.array([y for x in xs for y in x], np.int64) for xs in (low, high))
                    for shard in shards:
                        ask, score, ids = shard.search(_matrix(some.column("v"), key[0]), np.array(some.column("label")), query, lo, hi, k, same)
                        yield from record(FOUND, gids[query[ask]], window[ask], score, ids).to_batches()

    return searched


def _best(found: DataFrame, k: int) -> DataFrame:
    """gid, w, found: the k best (score, id) of each ask, best first."""
    order = Window.partitionBy("gid", "w").orderBy(F.desc("score"), "id")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    found = found.groupBy("gid", "w").agg(F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("f"))
    return found.select("gid", "w", F.transform("f", lambda x: F.struct(x["score"].alias("score"), x["id"].alias("id"))).alias("found"))


class Index:
    """All rows in trees, as a table in the shared folder, and the small tree over cells that every task has."""

    def __init__(self, groups: DataFrame, shard_rows: int = SHARD_ROWS):
        spark: SparkSession = groups.sparkSession
        self.shard_rows = shard_rows
        sample = groups.orderBy("hash", "gid").limit(SAMPLE_ROWS).select("dims", "v").collect()
        sizes = {r.dims: r for r in groups.groupBy("dims").agg(F.count("*").alias("n"), F.max("norm").alias("longest")).orderBy(F.desc("n")).limit(SAMPLE_ROWS).collect()}
        trees = {}
        for dims in sorted({r.dims for r in sample}):
            some = [r.v for r in sample if r.dims == dims]
            x = np.array(some, float).reshape(len(some), dims)
            cells = min(CELLS, -(-sizes[dims].n // shard_rows)) if dims in sizes else 1
            if cells > 1:
                trees[dims] = Tree.build(x, float(sizes[dims].longest), max(1, len(x) // cells), open_ends=True)
        self.trees, self.several = spark.sparkContext.broadcast(trees), bool(trees)
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema.fields)
        placed = common.stash(groups.mapInArrow(_placed(self.trees), f"{fields}, cell int"), "placed")
        # a cell that is too large for one tree has several
        salts = placed.groupBy("dims", "cell").agg(F.ceil(F.count("*") / F.lit(shard_rows)).cast("int").alias("salts"))
        self.salts = common.stash(salts, "cells")
        self.parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), common.parts(placed, 32.0))
        salted = placed.join(self.salts, ["dims", "cell"]).withColumn("salt", F.pmod("hash", F.col("salts")).cast("int"))
        salted = salted.select("dims", "cell", "salt", "v", "label", "ids").repartition(self.parts, "dims", "cell", "salt").sortWithinPartitions("dims", "cell", "salt")
        self.table = common.stash(salted.mapInArrow(_built(shard_rows), INDEX), "trees")

    def search(self, asks: DataFrame, k: int, same: bool) -> DataFrame:
        """gid, w, found for asks (dims, gid, label, v, low, high); window w is low[w] to high[w]."""
        asks = common.stash(asks, "asks")
        blocks = max(1, -(-asks.count() // BLOCK_ASKS))

        def visit(asks: DataFrame, home: bool) -> DataFrame:
            routed = asks.select("dims", "gid", "label", "v", "low", "high").mapInArrow(_routed(self.trees, home), ROUTED)
            routed = routed.join(self.salts, ["dims", "cell"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            block = F.pmod(F.xxhash64("gid"), F.lit(blocks)).cast("int")
            routed = routed.select("dims", "cell", "salt", block.alias("block"), F.lit(True).alias("asks"), "gid", "label", "v", "low", "high")
            index = self.table.select("dims", "cell", "salt", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(False).alias("asks"), "blob")
            dealt = index.unionByName(routed, allowMissingColumns=True).repartition(self.parts * blocks, "dims", "cell", "salt", "block")
            dealt = dealt.sortWithinPartitions("dims", "cell", "salt", "block", "asks")
            return dealt.mapInArrow(_searched(k, same), FOUND)

        first = common.stash(_best(visit(asks, True), k), "found-first")
        if not self.several:
            return first
        # the k-th best at home is the least that another cell has to offer
        bar = first.where(F.size("found") >= k).groupBy("gid").agg(F.map_from_entries(F.collect_list(F.struct("w", F.element_at("found", -1)["score"].alias("s")))).alias("bar"))
        rest = asks.join(bar, "gid", "left")
        rest = rest.withColumn("low", F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("bar", i.cast("int")), x))))
        named = first.select("gid", "w", F.inline("found"))
        return common.stash(_best(named.unionByName(visit(rest, False)), k), "found")


def hard_negatives(vectors: DataFrame, *, id_col="vec_id", vector_col="embedding", label_col="label", every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the integer inner product, best are higher scores, ties by smaller
    id.  Anchors are the rows whose id is divisible by ``every``, their positives the best ``positives`` other rows of
    the same label.  For each positive come the best ``negatives`` rows of other labels whose score is low to high
    per cent of the positive's, ranked from 1; a negative positive's window is empty.

    Rows with a null id, label or vector, or a null or non-finite component, take no part.  Vectors of unequal lengths
    have no score, so each length is searched by itself; empty vectors score 0.  Rows that repeat an id are rows of
    their own, as anchors, positives and negatives.  An empty table gives an empty result; other columns are not read.
    Vectors of a scaled length of 2^28 or more are an error, as their scores' shares don't fit whole numbers.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("x"))
    good = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.coalesce(good, F.lit(False)))
    rows = rows.select("id", "label", F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x)).alias("v")).withColumn("hash", F.xxhash64("v"))
    # of equal rows the smallest ids can be in a result; the limit holds before the shuffle as well
    keep, alike = max(positives + 1, negatives), ["hash", "v", "label"]
    firsts = rows.withColumn("place", F.row_number().over(Window.partitionBy(*alike).orderBy("id"))).where(F.col("place") <= keep)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    groups = firsts.groupBy(*alike).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    groups = groups.select(F.monotonically_increasing_id().alias("gid"), F.size("v").alias("dims"), norm.alias("norm"), *alike, "ids")
    groups = common.stash(groups, "vectors")
    if groups.where(F.col("norm") >= float(1 << 56)).limit(1).count():
        raise ArithmeticError(f"vectors of a length of 2^28 or more after scaling by {scale}")
    anchors = rows.where(F.col("id") % every == 0).join(groups.select("gid", "norm", *alike), alike).select("gid", F.col("id").alias("anchor_id"), F.col("norm").cast("long").alias("own"))
    anchors = common.stash(anchors, "anchors")
    index = Index(groups, shard_rows)
    asking = common.stash(groups.join(anchors.select("gid").distinct(), "gid").select("dims", "gid", "label", "v"), "asking")
    window = lambda x: F.array(F.lit(x).cast("long"))
    best = index.search(asking.withColumns({"low": window(LEAST), "high": window(MOST)}), positives + 1, True)
    # a whole part of the score, rounded inwards at either end
    scores = F.filter(F.array_distinct(F.transform("found", lambda p: p["score"])), lambda s: s >= 0)
    windows = best.select("gid", scores.alias("scores")).where(F.size("scores") > 0)
    share = "transform(scores, s -> (s * {} + {}) div 100)".format
    windows = windows.withColumns({"low": F.expr(share(low, 99)), "high": F.expr(share(high, 0))})
    windows = common.stash(windows, "windows")
    worse = index.search(asking.join(windows.drop("scores"), "gid"), negatives, False)
    worse = worse.join(windows.select("gid", F.posexplode("scores").alias("w", "positive_score")), ["gid", "w"]).select("gid", "positive_score", F.col("found").alias("worse"))
    own = F.array_position("found", F.struct(F.col("own").alias("score"), F.col("anchor_id").alias("id"))).cast("int")
    others = F.slice(F.filter("found", lambda p, i: (own == 0) | (i != own - 1)), 1, positives)
    pairs = anchors.join(best.select("gid", "found"), "gid").select("gid", "anchor_id", F.explode(others).alias("p"))
    pairs = pairs.select("gid", "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    out = pairs.join(worse, ["gid", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.posexplode("worse").alias("at", "n"))
    return out.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score"))


def op11_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)),
p AS (SELECT anchor, anchor_id, r, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same
  AND 100 * s.score >= 50 * p.positive_score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3"""

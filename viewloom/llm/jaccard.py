"""N-gram Jaccard join with prefix filters under several global token orders.

Tokens are word shingles.  Every order puts rare shingles first (by the power of two of their document frequency)
and breaks ties by a hash of its own.  Two sets that are similar enough share a token of their prefixes under each
order.  The first order's prefixes are posted by token; a pair that meets there must share prefix tokens under the
other orders too, before its sets are read and compared.  Only shingles that some other set has can make a pair, so
prefixes keep those alone.

A token that many sets post does not make all their pairs:
  1. each token links its sets to one of them, the head, the one with the fewest tokens of its own;
  2. a token whose sets then are in one component is done; of the others, those of few sets are paired;
  3. large ones are centred anew.  With x' = x ^ h and y' = y ^ h, symmetric differences with a head h, x ^ y is
     x' ^ y'.  So for two sets that are similar, of which one is not similar to h, x' and y' must overlap, by a
     number that lengths tell; this again is a prefix filter, over differences, and edits of one text seldom agree.
     Its tokens make new groups, per head, which go back to 2, and are paired in any case after the last round.
Components after all that are those of all links.

Words, shingles and sets are told apart by 64-bit hashes: among n distinct ones some two agree with odds of about
n^2 / 2^65, one in 37,000 for a billion.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, common
from .blocks import mix64, record
from .components import connected_components

SALTS = (0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
ROWS = "kind int, id long, n long, node long, own long, text_key long, first array<long>, second array<long>, third array<long>, blob binary"
CENTRED = "head long, node long, n long, own long, d long, linked boolean, tokens array<long>"
MEMBER, SET = 0, 1
#: Groups of at most so many sets are paired; larger ones are centred on a head of theirs first, so many times.
PAIRED, ROUNDS = 32, 2
#: Frequencies are asked for by 52 bits of a hash; hashes that meet there only count as more frequent.
MASK = np.uint64((1 << 64) - (1 << 12))


def least_overlap(n: int, percent: int) -> int:
    """The least intersection of a set of n tokens with any set of at least this similarity."""
    return -(-percent * n // 100)


def prefix(tokens: np.ndarray, levels: np.ndarray, salt: int, percent: int) -> np.ndarray:
    """The prefix tokens that other sets have, under the order of levels first, then of the salted hash."""
    size = len(tokens) - least_overlap(len(tokens), percent) + 1
    first = np.lexsort((mix64(tokens ^ np.uint64(salt)), levels))[:size]
    return tokens[first[levels[first] > 0]]


def _ask(k: int, buckets: int):
    def ask(key, table):
        _, texts = blocks.unpack(table)
        sets = blocks.shingle_sets(*blocks.word_hashes(texts), k)
        found, count = np.unique(np.concatenate(sets or [np.empty(0, np.uint64)]) & MASK, return_counts=True)
        rows = blocks.requests(key[0].as_py(), found, buckets, count.astype(np.uint32))
        return record(blocks.REQUEST, *(zip(*rows) if rows else [[]] * 3))

    return ask


def _answer(key, table):
    """The power of two of each hash's document frequency: 0 for hashes of one document."""
    found, place, others, sizes = blocks.by_hash(table.column("blob").to_pylist())
    total = np.bincount(place, weights=np.concatenate([x[0] for x in others]), minlength=len(found))
    level = np.floor(np.log2(total)).astype(np.uint8)
    ends, bucket = np.cumsum(sizes), key[0].as_py()
    rows = [(c, bucket, blocks.dump(level[place[e - n : e]])) for c, e, n in zip(table.column("chunk").to_pylist(), ends.tolist(), sizes.tolist())]
    return record(blocks.REPLY, *zip(*rows))


def text_key(text: bytes) -> int:
    """What xxhash64 of a text is in SQL."""
    value = xxhash.xxh64_intdigest(text, 42)
    return value - (1 << 64) if value >> 63 else value


def _prepare(k: int, percent: int):
    def prepare(_, docs, replies):
        if docs.num_rows == 0:
            return record(ROWS, *[[]] * 10)
        ids, texts = blocks.unpack(docs)
        sets = blocks.shingle_sets(*blocks.word_hashes(texts), k)
        found, level = np.unique(np.concatenate(sets) & MASK), blocks.gather(replies)
        rows, seen = [], set()
        for i, text, tokens in zip(ids, texts, sets):
            key = text_key(text)
            if not len(tokens):
                rows.append((MEMBER, i, 0, None, None, key, *[None] * 4))
                continue
            node = xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)
            rows.append((MEMBER, i, len(tokens), node, None, key, *[None] * 4))
            if node in seen:
                continue
            seen.add(node)
            at = level[np.searchsorted(found, tokens & MASK)]
            firsts = [prefix(tokens, at, salt, percent) for salt in SALTS]
            if all(map(len, firsts)):
                rows.append((SET, None, len(tokens), node, int((at == 0).sum()), None, *[x.view(np.int64).tolist() for x in firsts], blocks.dump_sorted(tokens, at)))
        return record(ROWS, *zip(*rows))

    return prepare


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _verify(percent: int):
    def verify(batches):
        last, known = None, None
        for batch in batches:
            keep = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                if a != last:
                    last, known = a, blocks.load_sorted(x)[0]
                if similar(known, blocks.load_sorted(y)[0], percent):
                    keep.append((a, b))
            yield from record("a long, b long", *(zip(*keep) if keep else [[]] * 2)).to_batches()

    return verify


def difference_prefix(head: tuple, other: tuple, percent: int) -> tuple[int, bool, np.ndarray]:
    """Size of the symmetric difference with a head, whether the two are similar, and the difference's prefix.

    Sets are (sorted tokens, levels).  q |x'| - r (|h| + |x|) > 0 says that x is not similar to h, for q and r of
    100 plus and less percent.  Then x' overlaps y' of any similar y by at least that over 2 * 100; if x is similar
    and y is not, by more than (q |x'| + r (|h| - |x|)) / 2 q.  Order: what x has more, rare first, then what it
    lacks, what only the head has last; tokens that no other set has are passed over.
    """
    (h, h_level), (x, x_level) = head, other
    more, lacks = ~np.isin(x, h, assume_unique=True), ~np.isin(h, x, assume_unique=True)
    plus, plus_level, minus, minus_level = x[more], x_level[more], h[lacks], h_level[lacks]
    d, q, r = len(plus) + len(minus), 100 + percent, 100 - percent
    excess = q * d - r * (len(h) + len(x))
    overlap = -(-excess // 200) if excess > 0 else (q * d + r * (len(h) - len(x))) // (2 * q) + 1
    size = max(0, d - max(1, overlap) + 1)
    plus = plus[np.lexsort((mix64(plus), plus_level))][:size]
    minus = minus[np.lexsort((mix64(minus), minus_level == 0))][: size - len(plus)]
    shared = plus[x_level[np.searchsorted(x, plus)] > 0]
    return d, excess <= 0, np.concatenate([shared, minus])


def _centre(percent: int):
    def centre(batches):
        last, known = None, None
        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                if a != last:
                    last, known = a, blocks.load_sorted(x)
                other = blocks.load_sorted(y)
                d, linked, tokens = difference_prefix(known, other, percent)
                rows.append((a, b, len(other[0]), int((other[1] == 0).sum()), d, linked, tokens.view(np.int64).tolist()))
            yield from record(CENTRED, *(zip(*rows) if rows else [[]] * 7)).to_batches()

    return centre


def with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with both sets."""
    one = sets.select(F.col("node").alias("a"), F.col("blob").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("blob").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share prefix tokens under the other orders too, and whose sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("second").alias("a2"), F.col("third").alias("a3"))
    two = sets.select(F.col("node").alias("of_b"), F.col("second").alias("b2"), F.col("third").alias("b3"))
    share = F.arrays_overlap("a2", "b2") & F.arrays_overlap("a3", "b3")
    pairs = pairs.join(one, "a").join(two, (F.col("b") == F.col("of_b")) & share).select("a", "b")
    return with_sets(pairs, sets).mapInArrow(_verify(percent), "a long, b long")


def _ordered(left: str, right: str):
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def jaccard_components(docs: DataFrame, *, id_col="doc_id", text_col="text", k: int = 4, percent: int = 85, paired: int = PAIRED, rounds: int = ROUNDS, keys: bool = False, rows_per_chunk: int = blocks.ROWS_PER_CHUNK) -> DataFrame:
    """One row per row of docs: id, n_shingles and component_id, the smallest id reachable over links.

    Two rows link when their sets' Jaccard similarity is at least percent / 100; rows with equal sets link.  A null
    text or one without words has an empty set and links with nothing: component_id is its own id (null for a null
    id, which counts as larger than all others where it links).  Repeated rows stay repeated.  An empty table gives
    an empty result.  Other columns are not read.
    paired, rounds: groups of at most so many sets are paired, and how often larger ones are centred before; they
    change the work, not the result.  keys: return also text_key, xxhash64 of the row's text, and component, a number
    of the group that is its alone even where ids repeat (null for empty sets).
    """
    buckets = blocks.buckets_for(docs)
    chunks = blocks.pack(docs, id_col, text_col, rows_per_chunk).groupBy("chunk")
    replies = chunks.applyInArrow(_ask(k, buckets), blocks.REQUEST).groupBy("bucket").applyInArrow(_answer, blocks.REPLY)
    rows = common.stash(chunks.cogroup(replies.groupBy("chunk")).applyInArrow(_prepare(k, percent), ROWS), "shingles")
    members = rows.where(F.col("kind") == MEMBER).select("id", "n", "node", "text_key")
    sets = rows.where(F.col("kind") == SET).select("node", "n", "own", "first", "second", "third", "blob").dropDuplicates(["node"])
    postings = sets.select(F.lit(0).cast("long").alias("head"), F.explode("first").alias("token"), "node", "n", "own", F.col("n").alias("d"))
    postings = common.stash(postings, "postings")

    # what two sets, or their differences with one head, have in common at most, by the tokens that no other set has
    most = F.least(F.col("d") - F.col("own"), F.col("its_d") - F.col("its_own"))
    fits = F.lit(100 + percent) * (F.col("d") + F.col("its_d") - F.lit(2) * most) <= F.lit(100 - percent) * (F.col("n") + F.col("m"))
    group = ["head", "token"]

    def heads_of(postings: DataFrame) -> DataFrame:
        found = postings.groupBy(group).agg(F.min_by(F.struct("node", "n", "own", "d"), F.struct("own", "node")).alias("h"), F.count("*").alias("size")).where("size > 1")
        return found.select(*group, F.col("h.node").alias("its_node"), F.col("h.n").alias("m"), F.col("h.own").alias("its_own"), F.col("h.d").alias("its_d"))

    stars = postings.join(heads_of(postings), group).where((F.col("node") != F.col("its_node")) & fits).select(*_ordered("node", "its_node")).distinct()
    links = common.stash(verified(common.stash(stars, "stars"), sets, percent), "links")
    parts = connected_components(links)

    for left in range(rounds, -1, -1):
        # what the sets of a group still leave apart
        placed = postings.join(parts, "node", "left").select(*group, "node", "n", "own", "d", F.coalesce("component", "node").alias("component"))
        size = placed.groupBy(group).agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low < high")
        placed = common.stash(placed.join(size.select(*group, "size"), group), "open")
        small = placed.where(F.col("size") <= paired) if left else placed
        other = small.select(*group, F.col("node").alias("other"), F.col("n").alias("m"), F.col("own").alias("its_own"), F.col("d").alias("its_d"), F.col("component").alias("there"))
        apart = small.join(other, group).where((F.col("component") < F.col("there")) & fits)
        pairs = common.stash(apart.select(*_ordered("node", "other")).distinct(), "apart")
        links = links.union(common.stash(verified(pairs, sets, percent), "links"))
        large = placed.where(F.col("size") > paired)
        if not left or large.isEmpty():
            break
        centred = large.join(heads_of(large), group).where("node <> its_node").select(F.col("its_node").alias("a"), F.col("node").alias("b")).distinct()
        centred = common.stash(with_sets(centred, sets).mapInArrow(_centre(percent), CENTRED), "centred")
        links = links.union(centred.where("linked").select(F.col("head").alias("a"), F.col("node").alias("b")))
        postings = centred.select("head", F.explode("tokens").alias("token"), "node", "n", "own", "d")
    parts = connected_components(common.stash(links, "links"))

    # a set's component as its smallest id, over all rows that have the set
    least = members.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"))
    least = least.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = common.stash(least, "sets-least")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = named.join(smallest, "component").select("node", "component", "component_id")
    out = members.join(placed, "node", "left")
    more = ["text_key", "component"] if keys else []
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"), *more)


def op7_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                     ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) t FROM d),
n AS (SELECT r, count(*) n FROM s GROUP BY r),
b AS (SELECT x.r a, y.r b, count(*) c FROM s x JOIN s y ON x.t = y.t AND x.r < y.r GROUP BY 1, 2),
l AS (SELECT a, b FROM b JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
u AS (SELECT a x, b y FROM l UNION ALL SELECT b, a FROM l),
reach(x, y) AS (SELECT x, x FROM u UNION SELECT reach.x, u.y FROM reach JOIN u ON reach.y = u.x),
m AS (SELECT x r, min(doc_id) least FROM reach JOIN d ON d.r = reach.y GROUP BY x)
SELECT doc_id, coalesce(n, 0) n_shingles, coalesce(least, doc_id) component_id FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""

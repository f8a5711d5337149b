"""Image retrieval by visual words: codebook training, binary signatures of an image's words, and match kernels.

Vectors meet the codebook in blocks, or in place where the codebook is small enough to go to every task.  Sums of
vectors are taken in the tasks that read them and again per key, so a word that most vectors fall into is no hot group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stash
from .matching import _matrix
from .retrieval import in_blocks

#: Numbers of a codebook that may go to every task, 64 MB of doubles.
BROADCAST = 8_000_000
#: Partial sums that a task holds, in numbers.
HELD = 4_000_000
#: Keys whose sums are sent at once.
SENT = 1_024


def _nearest(x: np.ndarray, words: np.ndarray, book: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word and squared distance of the k words nearest to each row, nearest first, ties to the smaller word."""
    rows, found, dist = [], [], []
    square = (book * book).sum(1)
    step = max(1, 1_000_000 // max(1, len(book)))
    for at in range(0, len(x), step):
        part = x[at : at + step]
        d = (part * part).sum(1)[:, None] + square[None] - 2 * (part @ book.T)
        last = np.partition(d, min(k, len(book)) - 1, axis=1)[:, min(k, len(book)) - 1]
        # expanding the square loses digits, so what is near is measured again
        i, j = np.nonzero(d <= (last + 1e-9 * (1 + np.abs(last)))[:, None])
        exact = ((part[i] - book[j]) ** 2).sum(1)
        order = np.lexsort((words[j], exact, i))
        keep = order[np.arange(len(order)) - np.searchsorted(i[order], i[order]) < k]
        rows.append(i[keep] + at)
        found.append(j[keep])
        dist.append(exact[keep])
    return tuple(np.concatenate(c) if c else np.empty(0, t) for c, t in ((rows, int), (found, int), (dist, float)))


def _shared(codebook: DataFrame):
    """Words and their vectors for every task, in order of words; None where they are more than BROADCAST numbers."""
    size = codebook.agg(F.sum(F.size("v")).alias("n")).first().n or 0
    if size > BROADCAST:
        return None
    rows = codebook.select("word", F.transform("v", lambda x: x.cast("double")).alias("v")).orderBy("word").collect()
    return codebook.sparkSession.sparkContext.broadcast((np.array([r.word for r in rows], np.int64), np.array([r.v for r in rows], float)))


def nearest_words(vectors: DataFrame, codebook: DataFrame, k: int = 1, block: int = 4096) -> DataFrame:
    """The columns of vectors, rank and word: the k words of codebook(word, v) nearest to each v, as one row each.

    vectors has ``id``, distinct, and ``v``; its rows become double arrays.  A codebook of up to BROADCAST numbers
    goes to every task, by a count and not by an estimate; a larger one meets the vectors in blocks.
    """
    vectors = vectors.withColumn("v", F.transform("v", lambda x: x.cast("double")))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    shared = _shared(codebook)
    if shared:
        at = vectors.columns.index("v")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, book = shared.value
            for batch in batches:
                if not len(words) or not len(batch):
                    continue
                i, j, _ = _nearest(_matrix(batch.column(at)), words, book, k)
                part = pa.Table.from_batches([batch]).take(pa.array(i))
                rank = np.arange(len(i)) - np.searchsorted(i, i) + 1
                part = part.append_column("rank", pa.array(rank, pa.int32())).append_column("word", pa.array(words[j], pa.int64()))
                yield from part.to_batches()

        return vectors.mapInArrow(run, f"{fields}, rank int, word long")

    def near(a, x, b, y):
        i, j, d = _nearest(x, b, y, k)
        yield a[i], b[j], d

    words = codebook.select(F.col("word").alias("id"), "v")
    pairs = in_blocks(vectors.select("id", "v"), near, "id long, word long, d double", block, words)
    rank = F.row_number().over(Window.partitionBy("id").orderBy("d", "word"))
    top = pairs.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("id").alias("id"), "rank", "word")
    return vectors.join(top, "id").select(*vectors.columns, F.col("rank").cast("int").alias("rank"), "word")


def vector_sums(rows: DataFrame, keys: list[str], col: str = "v") -> DataFrame:
    """keys, n and total: the number of rows and the sum of their array column, for whole-number keys.

    Tasks add up what they read and send one row a key, or more where they hold HELD numbers; those are added where
    their key is.
    """
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            if len(batch):
                yield np.column_stack([np.array(batch.column(i)) for i in range(len(keys))]), _matrix(batch.column(len(keys)))

    return _sums(rows.select(*[F.col(k).cast("long").alias(k) for k in keys], F.col(col).alias("total")), keys, parts)


def nearest_sums(vectors: DataFrame, codebook: DataFrame, keys: list[str], k: int = 1) -> DataFrame:
    """vector_sums by keys, whole-number columns of vectors and ``word``, of nearest_words(vectors, codebook, k).

    Where the codebook goes to every task, words are found and vectors added up in one pass, so a task has one Python
    worker and the vectors do not leave it.
    """
    shared = _shared(codebook)
    if not shared:
        return vector_sums(nearest_words(vectors, codebook, k), keys)
    own = [c for c in keys if c != "word"]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        words, book = shared.value
        for batch in batches:
            if not len(words) or not len(batch):
                continue
            x = _matrix(batch.column(len(own)))
            i, j, _ = _nearest(x, words, book, k)
            found = {c: np.array(batch.column(n))[i] for n, c in enumerate(own)} | {"word": words[j]}
            yield np.column_stack([found[c] for c in keys]), x[i]

    return _sums(vectors.select(*[F.col(c).cast("long").alias(c) for c in own], F.transform("v", lambda x: x.cast("double")).alias("v")), keys, parts)


def _sums(rows: DataFrame, keys: list[str], parts) -> DataFrame:
    """keys, n and total of what parts makes of the rows: whole-number keys and vectors, in batches."""
    schema = ", ".join([*[f"{k} long" for k in keys], "n long", "total array<double>"])
    kinds = [*[pa.int64()] * (len(keys) + 1), pa.list_(pa.float64())]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def out() -> Iterator[pa.RecordBatch]:
            # a part at a time and without Python numbers, so sending takes little beside what is held
            while held:
                some = list(islice(held, SENT))
                sums = [held.pop(key) for key in some]
                flat = np.concatenate([t for _, t in sums])
                ends = np.cumsum([0, *[len(t) for _, t in sums]])
                columns = [*map(list, zip(*some)), [n for n, _ in sums]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns, kinds), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], [*keys, "n", "total"])

        for key_of, x in parts(batches):
            found, place, n = np.unique(key_of, axis=0, return_inverse=True, return_counts=True)
            total = np.zeros((len(found), x.shape[1]))
            np.add.at(total, place.reshape(-1), x)
            for key, m, t in zip(map(tuple, found.tolist()), n.tolist(), total):
                if key in held:
                    held[key][0] += m
                    held[key][1] += t
                else:
                    # a copy, for a view would keep the whole batch's sums
                    held[key] = [m, t.copy()]
            if len(held) * x.shape[1] > HELD:
                yield from out()
        yield from out()

    return rows.mapInArrow(summed, schema).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_merged(len(keys), kinds, keys), schema)


def _merged(depth: int, kinds: list, keys: list[str]):
    """Adds up rows of equal keys, which follow one another."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None

        def made(rows: list) -> pa.RecordBatch:
            columns = [*zip(*[r[0] for r in rows]), [r[1] for r in rows], [r[2].tolist() for r in rows]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*keys, "n", "total"])

        for batch in batches:
            rows = []
            x = _matrix(batch.column(depth + 1)) if len(batch) else []
            for key, n, t in zip(zip(*[batch.column(i).to_pylist() for i in range(depth)]), batch.column(depth).to_pylist(), x):
                if last and last[0] == key:
                    last = (key, last[1] + n, last[2] + t)
                    continue
                if last:
                    rows.append(last)
                last = (key, n, t)
            if rows:
                yield made(rows)
        if last:
            yield made([last])

    return merged


def first_words(vectors: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """word (from 0), v: k distinct vectors, those of the smallest hash; all where there are fewer."""
    v = F.transform("v", lambda x: x.cast("double"))
    top = vectors.select(v.alias("v")).distinct().withColumn("h", F.xxhash64("v", F.lit(seed))).orderBy("h", "v").limit(k)
    return top.select((F.row_number().over(Window.orderBy("h", "v")) - 1).cast("long").alias("word"), "v")


def train_codebook(vectors: DataFrame, start: DataFrame, rounds: int = 10, least_move: float = 1e-9) -> DataFrame:
    """word, n, v after rounds of k-means over vectors(id, v) from the words start(word, v).

    Ties go to the smaller word, and a word that no vector is nearest to stays where it is (n 0).  Ends early where no
    word moves further than least_move; each round's codebook is a table of the shared folder, one row reaches the driver.
    """
    vectors = vectors.select("id", "v")
    book = stash(start.select(F.col("word").cast("long").alias("word"), F.lit(0).cast("long").alias("n"), F.transform("v", lambda x: x.cast("double")).alias("v")), "codebook")
    for _ in range(rounds):
        sums = nearest_sums(vectors, book.select("word", "v"), ["word"]).select("word", F.col("n").alias("m"), F.transform("total", lambda x, i: x / F.col("n")).alias("mean"))
        both = book.join(sums, "word", "left").select("word", F.coalesce("m", F.lit(0)).alias("n"), F.coalesce("mean", "v").alias("v"), F.col("v").alias("was"))
        both = stash(both, "codebook")
        moved = F.aggregate(F.zip_with("v", "was", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: F.greatest(s, x))
        far = both.agg(F.max(moved).alias("d")).first().d
        book = both.drop("was")
        if far is None or far <= least_move:
            break
    return book


def signature(total, least: float = 1e-9):
    """Signs of an array as whole numbers of 64 bits, the first component in the highest bit; 1: above least."""
    bit = lambda x: F.when(x > least, F.lit(1)).otherwise(F.lit(0)).cast("long")
    starts = F.sequence(F.lit(0), F.floor((F.size(total) - 1) / 64).cast("int"))
    part = lambda i: F.aggregate(F.slice(total, i * 64 + 1, F.lit(64)), F.lit(0).cast("long"), lambda s, x: F.shiftleft(s, 1).bitwiseOR(bit(x)))
    return F.transform(starts, part)


def hamming(a, b):
    """Bits in which two signatures differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def image_words(features: DataFrame, codebook: DataFrame, k: int = 1, least: float = 1e-9) -> DataFrame:
    """image_id, word, n, bits: for each image and word the signs of the sum of its features' residuals.

    features(image_id, id, v), each with its k nearest words; n: the features that fell to the word.
    """
    near = nearest_sums(features.select("image_id", "id", "v"), codebook.select("word", "v"), ["image_id", "word"], k)
    sums = near.join(codebook.select("word", F.col("v").alias("w")), "word")
    residual = F.zip_with("total", "w", lambda t, w: t - F.col("n") * w)
    return sums.select("image_id", "word", "n", residual.alias("r"), F.size("w").alias("dims")).select("image_id", "word", "n", signature(F.col("r"), least).alias("bits"), "dims")


def kernel_scores(queries: DataFrame, database: DataFrame, alpha: float = 3.0, threshold: float = 0.0, posting: int = 4096) -> DataFrame:
    """i, j, s of image_words i and j that share a word: the sum over shared words of sim^alpha where sim = 1 - 2 x
    differing bits / dims is above the threshold, over the root of both images' numbers of words.

    The database is an inverted file by word; a word with more than ``posting`` images is cut into parts, which all
    queries of the word meet.
    """
    parts = database.groupBy("word").agg(F.ceil(F.count("*") / F.lit(posting)).cast("int").alias("parts"))
    left = queries.select(F.col("image_id").alias("i"), "word", F.col("bits").alias("x")).join(parts, "word").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    right = database.select(F.col("image_id").alias("j"), "word", F.col("bits").alias("y"), "dims").join(parts, "word").withColumn("part", F.pmod(F.xxhash64("j"), F.col("parts")).cast("int")).drop("parts")
    sim = 1 - 2 * hamming(F.col("x"), F.col("y")) / F.col("dims")
    pairs = left.join(right, ["word", "part"]).select("i", "j", sim.alias("sim")).where(F.col("sim") > threshold)
    raw = pairs.groupBy("i", "j").agg(F.sum(F.pow("sim", F.lit(alpha))).alias("s"))
    sizes = lambda d, n: d.groupBy(F.col("image_id").alias(n)).agg(F.count("*").alias(f"n{n}"))
    return raw.join(sizes(queries, "i"), "i").join(sizes(database, "j"), "j").select("i", "j", (F.col("s") / F.sqrt(F.col("ni") * F.col("nj"))).alias("s"))


def retrieval_scores(features: DataFrame, codebook: DataFrame, assigned: int = 5, alpha: float = 3.0, threshold: float = 0.0) -> DataFrame:
    """i, j, s of all images of features(image_id, id, v) against all: the database with one word a feature, queries
    with ``assigned`` words."""
    database = stash(image_words(features, codebook, 1), "inverted-file")
    queries = stash(image_words(features, codebook, assigned), "query-words")
    return kernel_scores(queries, database, alpha, threshold)

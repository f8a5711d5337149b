"""Language-model scores with a log-frequency Bloom filter.

Word-pair counts of the training documents are quantised to levels on a logarithmic scale; a pair of level q is in
the filter as (pair, 1) .. (pair, q).  A count is read by probing level after level until one is missing.  The
filter is in parts, one for each bucket of the pairs' hashes; each chunk of documents asks the buckets for the levels
of its distinct pairs, so no task or driver holds more than a part, and every level is kept at every size.  Unigram
counts are exact and asked for in the same way.

Probabilities of what follows a word sum to 1 over the training words and one unknown word: the counts that the
filter tells of a word's pairs are themselves summed.  Each pair is counted by one chunk, the first that asks for it.

Words and pairs are told apart by 64-bit hashes: among n distinct ones some two agree with odds of about n^2 / 2^65.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, common
from .blocks import mix64, record

END = np.uint64(0x7F4A7C15D1342543)
PROBES = 5
TOP = 64  # no level of a 64-bit count is higher at the base in use
OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(i: int | None) -> bool:
    """The fifth of the documents that the model does not learn from; a null id counts as empty text."""
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, the numbers of tokens, and the token before each (END at starts)."""
    words, n = blocks.word_hashes(texts)
    all_words = np.insert(words, np.cumsum(n), END) if len(n) else words
    before = np.empty_like(all_words)
    if len(before):
        before[0], before[1:] = END, all_words[:-1]
    return all_words, n + 1, before


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(before * np.uint64(0x9FB21C651E98DF25) + word)


def level_of(counts: np.ndarray, base: float) -> np.ndarray:
    """1 + floor(log_base count)."""
    return 1 + np.floor(np.log(counts) / math.log(base) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray, base: float) -> np.ndarray:
    """The middle of the counts that share a level; 0 for level 0."""
    low = np.ceil(base ** (level - 1.0) - 1e-9)
    high = np.maximum(low, np.ceil(base**level - 1e-9) - 1)
    return np.where(level > 0, (low + high) / 2, 0.0)


def _places(pairs: np.ndarray, level: int, bits: np.ndarray) -> list[np.ndarray]:
    """Bit numbers of (pair, level) in sub-filters of so many bits."""
    one = mix64(pairs + np.uint64(level * 0xA0761D6478BD642F & (1 << 64) - 1))
    two = mix64(one ^ np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)
    return [(one + np.uint64(i) * two) % bits for i in range(PROBES)]


def build_filter(pairs: np.ndarray, levels: np.ndarray, bits_per_item: int) -> np.ndarray:
    """The sub-filter of one bucket; levels counts from 1."""
    size = max(64, int(levels.sum()) * bits_per_item)
    size += -size % 8
    table = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for place in _places(pairs[levels >= level], level, np.uint64(size)):
            table[place] = True
    return np.packbits(table)


class Filter:
    """All sub-filters, one after another."""

    def __init__(self, parts: dict[int, bytes], buckets: int, base: float, floor: int):
        self.shift = np.uint64(64 - (buckets.bit_length() - 1))
        size = np.array([len(parts.get(b, b"")) for b in range(buckets)], np.uint64)
        self.bits, self.start = size * np.uint64(8), (np.cumsum(size) - size) * np.uint64(8)
        self.data = np.frombuffer(b"".join(parts.get(b, b"") for b in range(buckets)), np.uint8)
        self.base, self.floor = base, floor

    def levels(self, pairs: np.ndarray) -> np.ndarray:
        """The level of each pair: probes until one is missing; 0 for what is not stored."""
        out = np.zeros(len(pairs), np.int64)
        bucket = (pairs >> self.shift).astype(np.int64)
        left = np.flatnonzero(self.bits[bucket] > 0)
        level = 1
        while len(left) and level <= TOP:
            some, at = pairs[left], bucket[left]
            there = np.ones(len(left), bool)
            for place in _places(some, level, self.bits[at]):
                bit = self.start[at] + place
                there &= (self.data[(bit >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (bit & np.uint64(7)).astype(np.uint8))) & 1 == 1
            left = left[there]
            out[left] = level
            level += 1
        return np.where(out > 0, out + self.floor - 1, 0)


def _ask(buckets: int, of_pairs: bool):
    """A chunk's distinct words or word pairs, with their counts in its training documents."""

    def ask(key, table):
        ids, texts = blocks.unpack(table)
        words, n, before = tokens(texts)
        learn = np.repeat(np.array([not held_out(i) for i in ids], bool), n)
        found, place = np.unique(pair_hash(before, words) if of_pairs else words, return_inverse=True)
        rows = blocks.requests(key[0].as_py(), found, buckets, np.bincount(place[learn], minlength=len(found)).astype(np.uint32))
        return record(blocks.REQUEST, *zip(*rows))

    return ask


def _answer(key, table):
    """Counts for each chunk that asked; one row of chunk null has the bucket's numbers of tokens and words."""
    chunks = table.column("chunk").to_pylist()
    found, place, others, sizes = blocks.by_hash(table.column("blob").to_pylist())
    total = np.bincount(place, weights=np.concatenate([x[0] for x in others]), minlength=len(found)).astype(np.uint64)
    ends = np.cumsum(sizes)
    bucket = key[0].as_py()
    rows = [(c, bucket, blocks.dump(total[place[e - n : e]]), None, None) for c, e, n in zip(chunks, ends.tolist(), sizes.tolist())]
    rows.append((None, bucket, None, int(total.sum()), int((total > 0).sum())))
    return record(blocks.REPLY + ", n long, v long", *zip(*rows))


FIRST = 128


def _levels(buckets: int, base: float, bits_per_item: int, least_count: int):
    """The filter of one bucket's pairs, and what it tells each chunk that asked; the replies count as buckets of their own.

    A reply is a pair's level, and FIRST more for the first chunk that asks for it.
    """
    floor = int(level_of(np.array([float(least_count)]), base)[0])

    def answer(key, table):
        chunks = np.array(table.column("chunk").to_pylist(), np.int64)
        found, place, others, sizes = blocks.by_hash(table.column("blob").to_pylist())
        total = np.bincount(place, weights=np.concatenate([x[0] for x in others]), minlength=len(found))
        learnt = total >= least_count
        bits = build_filter(found[learnt], level_of(total[learnt], base) - floor + 1, bits_per_item).tobytes() if learnt.any() else b""
        said = Filter({0: bits}, 1, base, floor).levels(found).astype(np.uint8)
        of, least = np.repeat(chunks, sizes), np.full(len(found), blocks.NO_ID)
        np.minimum.at(least, place, of)
        reply = said[place] + np.uint8(FIRST) * (of == least[place])
        ends = np.cumsum(sizes)
        blobs = [blocks.dump(reply[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist())]
        return record(blocks.REPLY, chunks.tolist(), [buckets + key[0].as_py()] * len(blobs), blobs)

    return answer


class Told:
    """What a chunk's documents hold and what the replies tell of it."""

    def __init__(self, docs, replies, buckets: int, base: float):
        def gather(kind: int) -> np.ndarray:
            bucket = replies.column("bucket")
            return blocks.gather(replies.filter(pc.and_(pc.greater_equal(bucket, kind * buckets), pc.less(bucket, (kind + 1) * buckets))))

        self.ids, texts = blocks.unpack(docs)
        words, self.n, before = tokens(texts)
        del texts
        pairs, of = np.unique(pair_hash(before, words), return_inverse=True)
        of = of.astype(np.int32)
        del before
        self.found, place = np.unique(words, return_inverse=True)
        place = place.astype(np.int32)
        del words
        known = gather(0).astype(np.float64)
        self.count = known[place]
        # the end of a text is a token of every chunk, and what stands before a text's first word
        self.context = np.concatenate([[np.searchsorted(self.found, END)], place[:-1]]).astype(np.int32)
        reply = gather(1)
        first, second = np.empty(len(pairs), np.int32), np.empty(len(pairs), np.int32)
        first[of], second[of] = self.context, place
        told = np.minimum(count_of((reply % FIRST).astype(np.int64), base), np.minimum(known[first], known[second]))
        self.together = told[of]
        mine = reply >= FIRST
        self.owned = np.bincount(first[mine], weights=told[mine], minlength=len(self.found))
        self.after = gather(2)


def _ask_sums(buckets: int, base: float):
    """For a chunk's words, the sum of the counts of pairs that begin with them and that this chunk counts."""

    def ask(key, docs, replies):
        if docs.num_rows == 0:
            return record(blocks.REQUEST, *[[]] * 3)
        told = Told(docs, replies, buckets, base)
        return record(blocks.REQUEST, *zip(*blocks.requests(key[0].as_py(), told.found, buckets, told.owned)))

    return ask


def _sums(buckets: int):
    def answer(key, table):
        found, place, others, sizes = blocks.by_hash(table.column("blob").to_pylist())
        total = np.bincount(place, weights=np.concatenate([x[0] for x in others]), minlength=len(found))
        ends = np.cumsum(sizes)
        blobs = [blocks.dump(total[place[e - n : e]]) for e, n in zip(ends.tolist(), sizes.tolist())]
        return record(blocks.REPLY, table.column("chunk").to_pylist(), [2 * buckets + key[0].as_py()] * len(blobs), blobs)

    return answer


def _score(buckets: int, base: float, n_train: int, v_train: int, mu: float):
    def score(_, docs, replies):
        if docs.num_rows == 0:
            return record(OUT, *[[]] * 7)
        told = Told(docs, replies, buckets, base)
        unigram = (told.count + 0.5) / (n_train + 0.5 * (v_train + 1))
        p = (told.together + mu * unigram) / (told.after[told.context] + mu)
        n, starts = told.n, np.cumsum(told.n) - told.n
        base_score, scores = np.add.reduceat(np.log10(unigram), starts), np.add.reduceat(np.log10(p), starts)
        known = np.add.reduceat((told.count > 0).astype(np.int64), starts)
        return record(OUT, told.ids, [held_out(i) for i in told.ids], n, known, [n_train] * len(n), base_score, scores)

    return score


def lm_scores(docs: DataFrame, *, id_col="doc_id", text_col="text", base: float = 1.5, bits_per_item: int = 8, mu: float = 20.0, least_count: int = 1, rows_per_chunk: int = blocks.ROWS_PER_CHUNK) -> DataFrame:
    """One row per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    score is the log10 probability under p(w|h) = (c(h,w) + mu p(w)) / (sum over v of c(h,v) + mu), p(w) being the
    add-half unigram estimate and c(h,w) what the filter tells, never more than the words' own counts; h is the word
    before, or the end before a text's first word.  Pairs seen less than least_count times are not stored.  Null texts are empty (one end token); a null id is a training document; repeated rows
    count and are scored each; an empty table gives an empty result; other columns are not read.
    """
    buckets = blocks.buckets_for(docs)
    packed = blocks.pack(docs, id_col, text_col, rows_per_chunk)
    chunks = packed.groupBy("chunk")
    asked = chunks.applyInArrow(_ask(buckets, False), blocks.REQUEST)
    replies = common.stash(asked.groupBy("bucket").applyInArrow(_answer, blocks.REPLY + ", n long, v long"), "lm-counts")
    n_train, v_train = (int(x or 0) for x in replies.agg(F.sum("n"), F.sum("v")).first())
    asked = chunks.applyInArrow(_ask(buckets, True), blocks.REQUEST)
    levels = common.stash(asked.groupBy("bucket").applyInArrow(_levels(buckets, base, bits_per_item, least_count), blocks.REPLY), "lm-levels")
    replies = replies.where("chunk IS NOT NULL").select("chunk", "bucket", "blob").unionByName(levels)
    asked = chunks.cogroup(replies.groupBy("chunk")).applyInArrow(_ask_sums(buckets, base), blocks.REQUEST)
    sums = common.stash(asked.groupBy("bucket").applyInArrow(_sums(buckets), blocks.REPLY), "lm-sums")
    out = chunks.cogroup(replies.unionByName(sums).groupBy("chunk"))
    return out.applyInArrow(_score(buckets, base, n_train, v_train, mu), OUT).withColumnRenamed("doc_id", id_col)


def op10_lm(spark, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Suffix-array dedup: remove bytes that an earlier document has already, in repeats of a given length or more.

In suffix order, the longest previous factor of a suffix is the longer of its common prefixes with the previous and
with the next smaller one: the nearest suffixes before and after it that begin in an earlier document.  Bytes under a
factor of ``length`` or more go.  Shorter factors change nothing, so suffixes are ordered by their first ``length``
bytes and common prefixes count up to that.

The suffix array is split by content: the smallest hash among the short strings inside the first ``length`` bytes of
a suffix, its anchor, names the bucket, and equal strings have equal anchors.  Three passes over chunks of documents:
  1. each chunk asks which of its anchors other chunks have;
  2. suffixes with an anchor that repeats inside the chunk are ordered there; of the others, those whose anchor
     another chunk has go to the anchor's bucket, once per distinct string and chunk, and are ordered there;
  3. the marks of both are joined to spans.
A passage that a third of all documents share so reaches its bucket once per chunk.

Strings are compared by their bytes; hashes only choose buckets.  Whole texts of 50 bytes or more that two chunks have
are told by 126 bits of a digest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import blocks, common
from .blocks import mix64, record

GRAM = 24
MARK = "place long, chunk long, kind int, blob binary"
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
TEXT_OUT = OUT + ", kept binary, kept_text string, span_starts array<long>, span_ends array<long>"
LOCAL, SEGMENT, FOUND = 0, 1, 2
_PIECE = 1 << 19


def _piece_runs(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of length bytes in data: the place of its anchor, and the hashes of all short strings."""
    total, back = blocks.prefix_hash(data)
    n = len(data) - GRAM + 1
    h = mix64((total[GRAM:] - total[:n]) * back[:n])
    value, place, size, window = h, np.arange(n, dtype=np.int32), 1, length - GRAM + 1
    while size < window:
        step = min(size, window - size)
        m = len(value) - step
        left = value[:m] <= value[step:]
        place = np.where(left, place[:m], place[step:])
        value = np.where(left, value[:m], value[step:])
        size += step
    return place, h


def runs(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring strings with one anchor: text number, first start in the text, count, anchor hash.

    Long texts are cut into pieces that overlap by length - 1 bytes, so that memory stays bounded.
    """
    out: list[tuple] = []
    held: list[tuple[int, int, bytes]] = []

    def flush():
        if not held:
            return
        data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
        sizes = np.array([len(p) for _, _, p in held])
        at = np.cumsum(sizes) - sizes
        place, h = _piece_runs(data, length)
        owner = np.repeat(np.arange(len(held)), sizes)[: len(place)]
        start = np.arange(len(place))
        inside = start + length <= (at + sizes)[owner]
        start, owner, place = start[inside], owner[inside], place[inside]
        first = np.ones(len(start), bool)
        first[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(first)
        number, offset = np.array([x[0] for x in held]), np.array([x[1] for x in held])
        o = owner[first]
        out.append((number[o], offset[o] + start[first] - at[o], np.diff(np.append(first, len(start))), h[place[first]]))
        held.clear()

    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), _PIECE):
            piece = text[at : at + _PIECE + length - 1]
            if size + len(piece) > 2 * _PIECE:
                flush()
                size = 0
            held.append((i, at, piece))
            size += len(piece)
    flush()
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))


def expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All members of runs of consecutive numbers."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(start, count)


def collapse(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers as runs."""
    first = np.flatnonzero(np.diff(numbers, prepend=-2) != 1)
    return numbers[first], np.diff(np.append(first, len(numbers)))


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """starts' places in suffix order (ties: as given), and each one's common prefix with the one before, up to length."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int32)
    keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[starts])
    order = np.argsort(keys.view(f"S{length}").ravel(), kind="stable")
    keys, whole = keys[order], length // 8 * 8
    common = np.zeros(len(order), np.int32)
    common[1:] = length
    # bytes past the last whole word first, then words from the last to the first: the first difference stays
    for at in range(length - 1, whole - 1, -1):
        common[1:][keys[1:, at] != keys[:-1, at]] = at
    words = keys[:, :whole].view("<u8")
    for at in range(whole // 8 - 1, -1, -1):
        apart = words[1:, at] ^ words[:-1, at]
        some = np.flatnonzero(apart)
        lowest = apart[some] & -apart[some]
        common[1 + some] = 8 * at + (np.frexp(lowest.astype(np.float64))[1] - 1) // 8
    return order, common


def previous_factors(owner: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """Longest previous factors of suffixes in suffix order, 0 where shorter than least; owner ranks the documents.

    Each suffix points to its neighbour and, while that has no smaller owner, on to where the neighbour points, with
    the least common prefix on the way; all at once, until all point to their previous (next) smaller one.
    """
    out = np.zeros(len(owner), common.dtype)
    for step, shared in ((-1, common.copy()), (1, np.append(common[1:], 0).astype(common.dtype))):
        to = np.arange(len(owner)) + step
        left = np.flatnonzero(shared >= least)
        while len(left):
            left = left[owner[to[left]] >= owner[left]]
            via = to[left]
            further, reach = to[via], np.minimum(shared[left], shared[via])
            to[left], shared[left] = further, reach
            left = left[reach >= least]
        out = np.maximum(out, np.where(shared >= least, shared, 0))
    return out


def class_heads(owner: np.ndarray, common: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct string, in suffix order, and the place of its first suffix of least owner."""
    new = common < length
    klass, first = np.cumsum(new) - 1, np.flatnonzero(new)
    least = np.minimum.reduceat(owner, first) if len(first) else np.empty(0, owner.dtype)
    at_least = np.flatnonzero(owner == least[klass]) if len(first) else np.empty(0, np.int64)
    return klass, at_least[np.unique(klass[at_least], return_index=True)[1]]


def _ranks(ids: list) -> np.ndarray:
    """Rank of each id in an ordered list, equal ids alike."""
    return np.cumsum([0, *[a != b for a, b in zip(ids[1:], ids[:-1])]]) if ids else np.empty(0, np.int64)


def _whole(texts: list[bytes], length: int) -> dict[bytes, int]:
    first: dict[bytes, int] = {}
    for i, t in enumerate(texts):
        if len(t) >= length:
            first.setdefault(t, i)
    return first


class Chunk:
    """A chunk's documents, its distinct texts, and their runs."""

    def __init__(self, table: pa.Table, length: int):
        self.ids, self.texts = blocks.unpack(table)
        self.rank = _ranks(self.ids)
        first = _whole(self.texts, length)
        # a text that stands earlier in the chunk, in a document of smaller id, goes as a whole
        self.copy = np.array([len(t) >= length and self.rank[first[t]] < self.rank[i] for i, t in enumerate(self.texts)], bool)
        self.own = [b"" if c else t for c, t in zip(self.copy, self.texts)]
        self.text, self.start, self.count, self.anchor = runs(self.own, length)
        sizes = np.array([len(t) for t in self.own], np.int64)
        self.at = np.cumsum(sizes) - sizes
        # two halves of a text's digest, both odd; anchors are even, so neither is taken for the other
        self.anchor = self.anchor & ~np.uint64(1)
        digests = [hashlib.blake2b(t, digest_size=16).digest() for t in self.texts]
        self.keys = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2) | np.uint64(1)
        self.long = np.array([len(t) >= length for t in self.own], bool)
        self.asked = np.unique(np.concatenate([self.anchor, self.keys[self.long].ravel()]))


def _ask(length: int, buckets: int):
    def ask(key, table):
        rows = blocks.requests(key[0].as_py(), Chunk(table, length).asked, buckets)
        return record(blocks.REQUEST, *(zip(*rows) if rows else [[]] * 3))

    return ask


def _answer(key, table):
    """For each hash of a chunk: 1 if other chunks have it, 2 more if an earlier one does."""
    chunks = np.array(table.column("chunk").to_pylist(), np.int64)
    found, place, _, sizes = blocks.by_hash(table.column("blob").to_pylist())
    number = np.bincount(place, minlength=len(found))
    of = np.repeat(chunks, sizes)
    least = np.full(len(found), blocks.NO_ID)
    np.minimum.at(least, place, of)
    reply = (number[place] > 1).astype(np.uint8) + 2 * (least[place] < of).astype(np.uint8)
    ends, bucket = np.cumsum(sizes), key[0].as_py()
    rows = [(int(c), bucket, blocks.dump(reply[e - n : e])) for c, e, n in zip(chunks, ends.tolist(), sizes.tolist())]
    return record(blocks.REPLY, *zip(*rows))


def _mark(length: int, buckets: int):
    bits = np.uint64(64 - (buckets.bit_length() - 1))

    def mark(key, docs, replies):
        if docs.num_rows == 0:
            return record(MARK, *[[]] * 4)
        chunk, c = key[0].as_py(), Chunk(docs, length)
        reply = blocks.gather(replies)
        said = reply[np.searchsorted(c.asked, c.anchor)] if len(c.anchor) else np.empty(0, np.uint8)
        # whole texts that an earlier chunk has need no look at their parts
        gone = np.zeros(len(c.texts), bool)
        if c.long.any():
            gone[c.long] = (reply[np.searchsorted(c.asked, c.keys[c.long])] & 2 > 0).all(axis=1)
        _, inverse, number = np.unique(c.anchor, return_inverse=True, return_counts=True)
        data = np.frombuffer(b"".join(c.own), np.uint8)
        base = c.at[c.text] + c.start if len(c.text) else np.empty(0, np.int64)

        again = number[inverse] > 1 if len(inverse) else np.empty(0, bool)
        starts = expand(base[again], c.count[again])
        owner = np.repeat(c.rank[c.text[again]], c.count[again]) if len(starts) else np.empty(0, np.int64)
        order, common = suffix_order(data, starts, length)
        earlier = previous_factors(owner[order], common, length) >= length
        klass, head = class_heads(owner[order], common, length)
        local = np.sort(starts[order][earlier])
        # strings that their first document repeats follow their first place
        rest = ~earlier
        rest[head] = False
        follows, leads = starts[order][rest], starts[order][head][klass[rest]]
        by = np.argsort(follows)
        # whole texts are compared as such by the answers; marks for all of their strings
        copies = np.flatnonzero(gone)
        rows = [(chunk, chunk, LOCAL, blocks.dump(*collapse(local), follows[by], leads[by], copies))]

        sent = (said & 1 > 0) & ~gone[c.text] if len(c.text) else np.empty(0, bool)
        places = expand(base[sent], c.count[sent])
        anchor = np.repeat(c.anchor[sent], c.count[sent])
        skip = np.concatenate([local, follows])
        keep = ~np.isin(places, skip) if len(skip) else np.ones(len(places), bool)
        places, bucket = places[keep], (anchor[keep] >> bits).astype(np.int64)
        if len(places):
            cut = np.ones(len(places), bool)
            cut[1:] = (np.diff(places) != 1) | (anchor[keep][1:] != anchor[keep][:-1])
            first = np.flatnonzero(cut)
            n = np.diff(np.append(first, len(places)))
            by = np.argsort(bucket[first], kind="stable")
            begin, n, bucket = places[first][by], n[by], bucket[first][by]
            edge = np.flatnonzero(np.diff(bucket, prepend=-1))
            for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(begin)]):
                body = data[expand(begin[i:j], n[i:j] + length - 1)]
                rows.append((int(bucket[i]), chunk, SEGMENT, blocks.dump(begin[i:j], n[i:j].astype(np.uint32), body)))
        return record(MARK, *zip(*rows))

    return mark


def _find(length: int):
    """Order a bucket's strings; for each chunk the places whose string an earlier chunk has.  Local rows pass."""

    def find(key, table):
        if key[0].as_py() == LOCAL:
            return table.select(["place", "chunk", "kind", "blob"])
        loaded = sorted((c, blocks.load(b)) for c, b in zip(table.column("chunk").to_pylist(), table.column("blob").to_pylist()))
        chunk = np.repeat([c for c, _ in loaded], [len(x[0]) for _, x in loaded])
        begin = np.concatenate([x[0] for _, x in loaded])
        n = np.concatenate([x[1] for _, x in loaded]).astype(np.int64)
        data = np.concatenate([x[2] for _, x in loaded])
        size = n + length - 1
        at = np.cumsum(size) - size
        # equal runs of strings meet as one, that of their first chunk
        body, whole = data.tobytes(), {}
        twin = np.empty(len(n), np.int64)
        for i, (a, s) in enumerate(zip(at.tolist(), size.tolist())):
            twin[i] = whole.setdefault(body[a : a + s], i)
        one = np.flatnonzero(twin == np.arange(len(n)))
        starts = expand(at[one], n[one])
        owner = np.repeat(chunk[one], n[one])
        order, shared = suffix_order(data, starts, length)
        earlier = previous_factors(owner[order], shared, length) >= length
        marked = np.zeros(len(data), bool)
        marked[starts[order][earlier]] = True
        out: dict[int, list] = {}
        for i, (c, t) in enumerate(zip(chunk.tolist(), twin.tolist())):
            if t != i and chunk[t] < c:
                out.setdefault(c, []).append(begin[i] + np.arange(n[i]))
            else:
                some = np.flatnonzero(marked[at[t] : at[t] + n[t]])
                if len(some):
                    out.setdefault(c, []).append(begin[i] + some)
        rows = [(key[1].as_py(), c, FOUND, blocks.dump(*collapse(np.unique(np.concatenate(x))))) for c, x in out.items()]
        return record(MARK, *(zip(*rows) if rows else [[]] * 4))

    return find


def _finish(length: int, texts_too: bool, empty: pa.Schema):
    names = TEXT_OUT if texts_too else OUT

    def finish(_, docs, marks):
        if docs.num_rows == 0:
            return empty.empty_table()
        ids, texts, extras = blocks.unpack(docs, extra=True)
        rank = _ranks(ids)
        first = _whole(texts, length)
        copy = np.array([len(t) >= length and rank[first[t]] < rank[i] for i, t in enumerate(texts)], bool)
        sizes = np.array([0 if x else len(t) for x, t in zip(copy, texts)], np.int64)
        at = np.cumsum(sizes) - sizes
        marked, follows, leads = [], np.empty(0, np.int64), np.empty(0, np.int64)
        for kind, blob in zip(marks.column("kind").to_pylist(), marks.column("blob").to_pylist()):
            start, count, *more = blocks.load(blob)
            marked.append(expand(start, count))
            if kind == LOCAL:
                follows, leads = more[0], more[1]
                copy[more[2]] = True
        places = np.concatenate(marked) if marked else np.empty(0, np.int64)
        led = np.isin(leads, places) | (copy[np.searchsorted(at, leads, "right") - 1] if len(leads) else False)
        places = np.unique(np.concatenate([places, follows[led]]))
        start, count = collapse(places)
        # runs of neighbouring documents touch in these places, so they are cut at the documents' ends
        cover: list[list[tuple[int, int]]] = [[] for _ in texts]
        for s, n, i in zip(start.tolist(), count.tolist(), (np.searchsorted(at, start, "right") - 1).tolist()):
            end = s + n
            while s < end:
                while i + 1 < len(at) and at[i + 1] <= s:
                    i += 1
                stop = min(end, int(at[i + 1])) if i + 1 < len(at) else end
                spans, a, b = cover[i], s - int(at[i]), stop - int(at[i]) + length - 1
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
                else:
                    spans.append((a, b))
                s = stop
        rows = []
        for i, text, whole, spans in zip(ids, texts, copy.tolist(), cover):
            spans = [(0, len(text))] if whole else spans
            edges = [0, *[x for s in spans for x in s], len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2]))
            row = (i, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
            rows.append((*row, kept, kept.decode("utf-8", "ignore"), [a for a, _ in spans], [b for _, b in spans]) if texts_too else row)
        out = record(names, *zip(*rows))
        for name in extras.column_names if extras is not None else ():
            out = out.append_column(name, extras.column(name))
        return out

    return finish


def suffix_dedup(docs: DataFrame, *, id_col="doc_id", text_col="text", length: int = 50, texts: bool = False, keep=(), rows_per_chunk: int = blocks.ROWS_PER_CHUNK) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept_sha256; with texts also kept, kept_text (without
    characters that a removal cuts) and spans; with keep also a struct ``row`` of these columns of docs.

    A byte goes where a string of length bytes covers it that also starts in a row of smaller id (null ids are
    largest, rows of equal ids are no copies of each other).  Ids are whole numbers.  Null texts are empty; texts
    shorter than length stay whole.  Repeated rows stay repeated.  An empty table gives an empty result.  Other
    columns are not read.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    buckets, keep = blocks.buckets_for(docs), tuple(keep)
    chunks = blocks.pack(docs, id_col, text_col, rows_per_chunk, keep).groupBy("chunk")
    replies = chunks.applyInArrow(_ask(length, buckets), blocks.REQUEST).groupBy("bucket").applyInArrow(_answer, blocks.REPLY)
    marks = chunks.cogroup(replies.groupBy("chunk")).applyInArrow(_mark(length, min(1 << 16, 4 * buckets)), MARK)
    found = marks.groupBy("kind", "place").applyInArrow(_find(length), MARK).select("chunk", "kind", "blob")
    schema = StructType.fromDDL(TEXT_OUT if texts else OUT)
    for n, c in enumerate(keep):
        schema.add(f"extra{n}", docs.schema[c].dataType)
    out = chunks.cogroup(found.groupBy("chunk")).applyInArrow(_finish(length, texts, to_arrow_schema(schema)), schema).withColumnRenamed("doc_id", id_col)
    if keep:
        out = out.withColumn("row", F.struct(*[F.col(f"extra{n}").alias(c) for n, c in enumerate(keep)])).drop(*[f"extra{n}" for n in range(len(keep))])
    return out


def op1_suffix(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Strings are cut from pieces of 312 bytes and their next 49, as DuckDB finds places in long texts slowly.
OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () r, doc_id, hex(encode(coalesce(text, ''))) h FROM documents),
q AS (SELECT r, doc_id, length(h) // 2 n, a, substr(h, 2 * a + 1, 722) piece FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2, 312)) a FROM d) x),
s AS (SELECT r, doc_id, n, a, piece, unnest(range(least(312, n - a))) i FROM q),
f AS (SELECT r, a + i p, substr(piece, 2 * i + 1, 2) byte,
             a + i + 50 <= n AND doc_id > min(doc_id) OVER (PARTITION BY md5_number(substr(piece, 2 * i + 1, 100))) gone FROM s),
c AS (SELECT r, p, byte, coalesce(bool_or(gone) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) cut FROM f),
e AS (SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY r ORDER BY p), false) first FROM c),
k AS (SELECT r, count(*) FILTER (cut) n_removed, count(*) FILTER (first) n_spans, string_agg(byte, '' ORDER BY p) FILTER (NOT cut) kept FROM e GROUP BY r)
SELECT doc_id, length(h) // 2 n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans, sha256(from_hex(coalesce(kept, ''))) kept_sha256
FROM d LEFT JOIN k USING (r)
"""

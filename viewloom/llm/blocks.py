"""Chunks of documents as compressed blobs, words and shingles as 64-bit hashes, and counted requests.

A chunk holds the documents of a range of ids.  Operators that need corpus counts of what a chunk contains send
one sorted list of distinct hashes per (chunk, bucket of hashes), and get an answer in the same order back; so the
shuffle carries each hash once per chunk, whatever its frequency, and no task sees more than one bucket or chunk.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import mix64

ROWS_PER_CHUNK = 1024
NO_ID = (1 << 63) - 1
PACKED = "chunk long, blob binary, extra binary"
REQUEST = "bucket int, chunk long, blob binary"
REPLY = "chunk long, bucket int, blob binary"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(range(256)).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
_BASE = 0x9E3779B97F4A7C15
_PIECE = 2 << 20


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, byte planes apart."""
    out = []
    for a in map(np.ascontiguousarray, arrays):
        out.append(a.dtype.str.encode().ljust(4) + struct.pack("<q", len(a)) + a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def load(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        kind, n = np.dtype(data[at : at + 4].decode().strip()), struct.unpack_from("<q", data, at + 4)[0]
        end = at + 12 + n * kind.itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data[at + 12 : end], np.uint8).reshape(kind.itemsize, n).T).reshape(-1).view(kind))
        at = end
    return out


def dump_sorted(first: np.ndarray, *others: np.ndarray) -> bytes:
    """dump, with differences instead of the sorted first array."""
    return dump(np.diff(first, prepend=np.uint64(0)), *others)


def load_sorted(blob: bytes) -> list[np.ndarray]:
    first, *others = load(blob)
    return [np.cumsum(first, dtype=np.uint64), *others]


def record(names: str, *columns) -> pa.Table:
    """An Arrow table with columns of a DDL schema of long, int, double, boolean, string and binary."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    pairs = [x.split() for x in names.split(", ")]
    return pa.table([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, pairs)], names=[n for n, _ in pairs])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}
    more: dict[int, list[pa.RecordBatch]] = {}
    size = 0

    def out():
        rows = []
        for chunk, some in held.items():
            ids, texts = zip(*some)
            none = np.array([i is None for i in ids])
            blob = dump(np.array([i or 0 for i in ids], np.int64), none.view(np.uint8), np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8))
            rows.append((chunk, blob, ipc(more[chunk]) if more else None))
        held.clear()
        more.clear()
        return record(PACKED, *zip(*rows)).to_batches()

    for batch in batches:
        chunks = batch.column(0).to_pylist()
        for chunk, i, text in zip(chunks, batch.column(1).to_pylist(), common.binary_values(batch.column(2))):
            held.setdefault(chunk, []).append((i, text))
            size += len(text) + 64
        if batch.num_columns > 3:
            others, of = batch.select(range(3, batch.num_columns)), np.array(chunks)
            for chunk in np.unique(of).tolist():
                more.setdefault(chunk, []).append(others.take(pa.array(np.flatnonzero(of == chunk))))
            size += others.nbytes
        if size > 16 << 20:
            yield from out()
            size = 0
    if held:
        yield from out()


def ipc(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        for batch in batches:
            stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def pack(docs: DataFrame, id_col: str, text_col: str, rows: int = ROWS_PER_CHUNK, extra: tuple[str, ...] = ()) -> DataFrame:
    """(chunk, blob, extra) rows; a chunk is a range of ``rows`` ids (null ids: the last chunk), in one blob or more.

    extra: columns that go along with each row, whatever their types.
    """
    i = F.col(id_col).cast("long")
    chunk = F.coalesce(F.floor(i / F.lit(rows)).cast("long"), F.lit(NO_ID).cast("long"))
    more = [F.col(c).alias(f"extra{n}") for n, c in enumerate(extra)]
    return docs.select(chunk.alias("chunk"), i.alias("id"), F.col(text_col).alias("text"), *more).mapInArrow(_pack, PACKED)


def unpack(table: pa.Table, extra: bool = False) -> tuple[list, ...]:
    """Ids and texts of a chunk, ordered by id (null last) and text; with extra also the columns that go along."""
    rows, n = [], 0
    for blob in table.column("blob").to_pylist():
        ids, none, sizes, body = load(blob)
        ends, body = np.cumsum(sizes), body.tobytes()
        texts = [body[e - m : e] for e, m in zip(ends.tolist(), sizes.tolist())]
        rows += zip(none.tolist(), ids.tolist(), texts, range(n, n + len(ids)))
        n += len(ids)
    rows.sort()
    out = [None if r[0] else r[1] for r in rows], [r[2] for r in rows]
    if not extra:
        return out
    parts = [pa.ipc.open_stream(x).read_all() for x in table.column("extra").to_pylist() if x is not None]
    return *out, pa.concat_tables(parts).take(pa.array([r[3] for r in rows])) if parts else None


@lru_cache(4)
def _tables(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per byte, powers of the base, and their inverses modulo 2^64."""
    n, inverse = 1 << bits, pow(_BASE, -1, 1 << 64)
    letters = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    power, back = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for out, base in ((power, _BASE), (back, inverse)):
        out[0], size = 1, 1
        while size < n:
            out[size : 2 * size] = out[:size] * np.uint64(pow(base, size, 1 << 64))
            size *= 2
    return letters, power, back


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums S with a string's hash (S[end] - S[start]) * B[start], and B."""
    letters, power, back = _tables(max(21, int(len(data) + 1).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters[data] * power[: len(data)], out=total[1:])
    return total, back


def _piece_words(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    gap = np.ones(len(a) + 2, bool)
    gap[1:-1] = _SPACE[a]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    total, back = prefix_hash(a)
    return mix64((total[edge[1::2]] - total[edge[0::2]]) * back[edge[0::2]])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z lower-cased, in order, and the number of words of each text.

    Texts are joined to pieces of a few MB; longer ones are cut at white space, never inside a word.
    """
    out, counts, held, size = [], [], [], 0

    def flush():
        if not held:
            return
        data = b" ".join(held).translate(LOWER)
        a = np.frombuffer(data, np.uint8)
        gap = np.ones(len(a) + 2, bool)
        gap[1:-1] = _SPACE[a]
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        starts = edge[0::2]
        total, back = prefix_hash(a)
        out.append(mix64((total[edge[1::2]] - total[starts]) * back[starts]))
        ends = np.cumsum([len(t) + 1 for t in held])
        at = np.searchsorted(starts, ends)
        counts.append(np.diff(at, prepend=0))
        held.clear()

    for text in texts:
        if size + len(text) > _PIECE:
            flush()
            size = 0
        if len(text) <= _PIECE:
            held.append(text)
            size += len(text) + 1
            continue
        n, at = 0, 0
        while at < len(text):
            end = min(len(text), at + _PIECE)
            while end < len(text) and not _SPACE[text[end]]:
                end += 1
            out.append(_piece_words(text[at:end].translate(LOWER)))
            n += len(out[-1])
            at = end
        counts.append(np.array([n]))
    flush()
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), (np.concatenate(counts) if counts else np.empty(0, np.int64))


def shingle_sets(words: np.ndarray, counts: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingle hashes of each text; a text of 1 to k - 1 words is one shingle."""
    scale = [np.uint64(mix64(np.array([i + 11], np.uint64))[0] | np.uint64(1)) for i in range(k)]
    out, at = [], 0
    whole = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i, s in enumerate(scale):
        whole += words[i : i + len(whole)] * s
    whole = mix64(whole)
    for n in counts.tolist():
        if n >= k:
            out.append(np.unique(whole[at : at + n - k + 1]))
        elif n:
            out.append(mix64(np.array([np.sum(words[at : at + n] * np.array(scale[:n])) + np.uint64(n)], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Start of each bucket (and the end of the last) in sorted hashes; buckets is a power of two."""
    bits = buckets.bit_length() - 1
    edges = np.arange(buckets, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def requests(chunk: int, hashes: np.ndarray, buckets: int, *others: np.ndarray) -> list[tuple[int, int, bytes]]:
    """A row for each bucket that has some of the sorted hashes; others go along."""
    at = bucket_of(hashes, buckets)
    return [(b, chunk, dump_sorted(hashes[i:j], *[x[i:j] for x in others])) for b, (i, j) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())) if j > i]


def gather(table: pa.Table) -> np.ndarray:
    """The answers to a chunk's requests, in the order of its hashes."""
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("blob").to_pylist()))
    return np.concatenate([load(x)[0] for _, x in rows]) if rows else np.empty(0, np.uint8)


def by_hash(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[list[np.ndarray]], np.ndarray]:
    """Distinct hashes of several requests, each request's places among them joined, the other arrays, and sizes."""
    loaded = [load_sorted(x) for x in blobs]
    sizes = np.array([len(x[0]) for x in loaded])
    found, place = np.unique(np.concatenate([x[0] for x in loaded]), return_inverse=True)
    return found, place, [x[1:] for x in loaded], sizes


def buckets_for(docs: DataFrame, mb: float = 2.0) -> int:
    """A power of two so that each bucket has about mb megabytes of the input's hashes."""
    return 1 << max(4, min(16, int(common.input_bytes(docs) / (mb * 1e6)).bit_length()))

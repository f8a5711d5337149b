"""Media columns: payloads as 8-bit grey PNG images, content-addressed in tar shards of the shared folder.

Rows carry (digest, shard, offset, length).  Metadata columns come from range reads of the PNG header alone;
features read the whole member.  No payload is shuffled: a task stores a payload once in the shards that it writes,
and the index names one place for each digest.  A shard's name is unique to the task attempt that wrote it and the
index is a committed table, so lost executors leave at most unreferenced files.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = len(SIGNATURE) + 8 + 13 + 4
INDEX = "digest binary, shard string, offset long, length long"
META = "digest binary, width int, height int, bit_depth int, colour_type int"
FEATURES = "digest binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def pad(data: bytes) -> bytes:
    """data followed by bytes 0 up to a positive multiple of the width."""
    return data + bytes(-len(data) % WIDTH or (0 if data else WIDTH))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes, level: int = 6) -> bytes:
    """A grey image of WIDTH columns whose samples are payload's bytes."""
    height = len(payload) // WIDTH
    lines = np.zeros((height, WIDTH + 1), np.uint8)
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, height, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int, int]:
    """Width, height, bit depth and colour type from a file's first HEADER_BYTES bytes."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG file")
    return struct.unpack(">IIBB", data[16:26])


def decode_png(data: bytes) -> bytes:
    """The samples of a file written by encode_png; chunk checksums are verified."""
    width, height, depth, colour = png_header(data)
    if (width, depth, colour) != (WIDTH, 8, 0):
        raise ValueError("not a grey 8-bit image of the expected width")
    at, packed = len(SIGNATURE), []
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged chunk")
        if kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, WIDTH + 1)
    if lines[:, 0].any():
        raise ValueError("unexpected line filter")
    return lines[:, 1:].tobytes()


def image_feature(payload: bytes) -> str:
    """Mean, deviation and entropy of the samples and a 64-bit hash of column means against their mean."""
    a = np.frombuffer(payload, np.uint8)
    p = np.bincount(a, minlength=256) / len(a)
    columns = a.reshape(-1, WIDTH).mean(axis=0)
    bits = "".join("1" if x else "0" for x in columns > columns.mean())
    return f"{a.mean():.4f}|{a.std():.4f}|{-(p[p > 0] * np.log2(p[p > 0])).sum():.4f}|{int(bits, 2):016x}"


def _writer(folder: str, shard_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = common.open_fs(folder)
        seen: set[bytes] = set()
        stream, name, at = None, "", 0
        for batch in batches:
            rows = []
            for text in batch.column(0):
                payload = pad((text.as_py() or "").encode())
                digest = hashlib.sha256(payload)
                if digest.digest() in seen:
                    continue
                seen.add(digest.digest())
                if stream is None:
                    name, at = f"{uuid.uuid4().hex}.tar", 0
                    stream = fs.open_output_stream(f"{base}/{name}")
                media = encode_png(payload)
                info = tarfile.TarInfo(f"{digest.hexdigest()}.png")
                info.size = len(media)
                head = info.tobuf(tarfile.USTAR_FORMAT)
                stream.write(head + media + bytes(-len(media) % 512))
                rows.append((digest.digest(), name, at + len(head), len(media)))
                at += len(head) + len(media) + -len(media) % 512
                if at >= shard_bytes:
                    stream.write(bytes(1024))
                    stream.close()
                    stream = None
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_schema(INDEX))], schema=_schema(INDEX))
        if stream is not None:
            stream.write(bytes(1024))
            stream.close()

    return write


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _reader(folder: str, ddl: str, of):
    """An Arrow function that opens each row's shard and gives one row of(file, digest, offset, length)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = common.open_fs(folder)
        open_name, file = "", None
        for batch in batches:
            rows = []
            for digest, shard, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != open_name:
                    if file is not None:
                        file.close()
                    open_name, file = shard, fs.open_input_file(f"{base}/{shard}")
                rows.append((digest, *of(file, offset, length)))
            schema = _schema(ddl)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
        if file is not None:
            file.close()

    return read


def _header(file, offset: int, length: int) -> tuple:
    return png_header(file.read_at(min(HEADER_BYTES, length), offset))


def _features(file, offset: int, length: int) -> tuple:
    media = file.read_at(length, offset)
    payload = decode_png(media)
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), image_feature(payload)


def store(docs: DataFrame, *, text_col="text", folder: str | None = None, shard_bytes: int = 64 << 20) -> tuple[DataFrame, str]:
    """Write the distinct payloads of each part of docs; the index (digest, shard, offset, length) and the shards' folder.

    A null text counts as empty.  Other columns are not read.  An empty table gives an empty index and no shard.
    """
    spark = docs.sparkSession
    folder = folder or common.new_folder(spark, "media")
    fs, base = common.open_fs(folder)
    fs.create_dir(base, recursive=True)
    written = common.stash(docs.select(common.utf8(text_col).alias("text")).mapInArrow(_writer(folder, shard_bytes), INDEX), "media-written")
    index = written.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("digest", "at.*")
    index = index.repartition(common.parts(docs, 16), "shard").sortWithinPartitions("shard", "offset")
    return common.stash(index, "media-index"), folder


def read_metadata(index: DataFrame, folder: str) -> DataFrame:
    """Metadata columns of each member, from range reads of its header alone."""
    return index.select("digest", "shard", "offset", "length").mapInArrow(_reader(folder, META, _header), META)


def read_features(index: DataFrame, folder: str) -> DataFrame:
    """Payload digests and features of each member, read back from the shards."""
    return index.select("digest", "shard", "offset", "length").mapInArrow(_reader(folder, FEATURES, _features), FEATURES)


def media_columns(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """id, n_bytes, digest, shard, offset, length, header metadata and features of each row of docs.

    Repeated rows stay repeated; equal texts share one member.  Null texts count as empty (64 zero bytes).
    """
    index, folder = store(docs, text_col=text_col)
    data = F.encode(common.utf8(text_col), "UTF-8")
    n = F.octet_length(common.utf8(text_col))
    zeros = F.when(n == 0, F.lit(WIDTH)).otherwise(F.pmod(-n, F.lit(WIDTH)))
    rows = docs.select(F.col(id_col), n.cast("long").alias("n_bytes"), F.unhex(F.sha2(F.concat(data, F.unhex(F.repeat(F.lit("00"), zeros.cast("int")))), 256)).alias("digest"))
    index = index.repartition(common.parts(docs, 16), "shard").sortWithinPartitions("shard", "offset")
    known = index.join(read_metadata(index, folder), "digest").join(read_features(index, folder), "digest")
    return rows.join(known, "digest")


def op5_media(spark, sf_dir: str) -> DataFrame:
    out = media_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height")

"""WARC archives with dictionary-compressed records.

Each archive file starts with a skippable frame that holds a Zstandard dictionary built from the file's own first
records; after it every record is a frame of its own, so single records can be read at their offset.  Records of
equal payloads are one response and revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Fixed values of the formats.
MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def make_record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit carries the response's HTTP header, without the payload."""
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of at most size bytes; raw content where there is too little to train on."""
    whole = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(1024, whole // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b"WARC/1.1\r\n"


def write_archives(rows, create, *, dict_bytes: int = 64 << 10, sample_bytes: int = 2 << 20, file_bytes: int = 64 << 20):
    """Write (page_id, record) rows to files made by create() -> (name, stream); yields (page_id, name, offset, length).

    The dictionary of a file is built from its first records, whole ones, until they make sample_bytes.
    """
    rows = iter(rows)
    while True:
        held, size = [], 0
        for x in rows:
            held.append(x)
            size += len(x[1])
            if size >= sample_bytes:
                break
        if not held:
            return
        raw = train([r for _, r in held], dict_bytes)
        packer = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
        name, stream = create()
        body = zstandard.ZstdCompressor(level=6).compress(raw)
        stream.write(struct.pack("<II", MAGIC, len(body)) + body)
        at = 8 + len(body)

        def put(record: bytes, packer=packer, stream=stream) -> int:
            frame = packer.compress(record)
            stream.write(frame)
            return len(frame)

        for key, record in held:
            n = put(record)
            yield key, name, at, n
            at += n
        held = None
        while at < file_bytes:
            x = next(rows, None)
            if x is None:
                break
            n = put(x[1])
            yield x[0], name, at, n
            at += n
        stream.close()


def read_archive(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of each record of an archive, read in order through a window of a few records."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != MAGIC:
        raise ValueError("no leading dictionary frame")
    known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(stream.read(size)))
    unpacker = zstandard.ZstdDecompressor(dict_data=known)
    at, held = 8 + size, b""
    while True:
        one = unpacker.decompressobj()
        got = [one.decompress(held)] if held else []
        read = len(held)
        while not one.eof:
            more = stream.read(1 << 18)
            if not more:
                if read:
                    raise ValueError("archive ends inside a record")
                return
            got.append(one.decompress(more))
            read += len(more)
        held = one.unused_data
        yield at, *parse_record(b"".join(got))
        at += read - len(held)


def _writer(folder: str, options: dict):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = common.open_fs(folder)

        def create():
            name = f"{uuid.uuid4().hex}.warc.zst"
            return name, fs.open_output_stream(f"{base}/{name}")

        def records():
            for batch in batches:
                for i, u, h, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                    yield i, make_record(i, u or "", (h.as_py() or "").encode(), r)

        out = []
        for row in write_archives(records(), create, **options):
            out.append(row)
            if len(out) == 4096:
                yield _index(out)
                out = []
        yield _index(out)

    return write


def _index(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["page_id", "archive", "offset", "length"])


def _id(text: str | None) -> int | None:
    value = (text or "<urn:page:null>")[len("<urn:page:") : -1]
    return None if value == "null" else int(value)


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = common.open_fs(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{name}") as stream:
                    for at, fields, block in read_archive(stream):
                        kind, digest, n = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                        if kind == "response":
                            payload = block[len(HTTP) :]
                            n, digest = len(payload), payload_digest(payload)
                        rows.append((_id(fields["WARC-Record-ID"]), n, digest, kind, _id(fields.get("WARC-Refers-To")), name, at))
                        if len(rows) == 4096:
                            yield _table(rows)
                            rows = []
                yield _table(rows)

    return read


def _table(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], [x.split()[0] for x in ROWS.split(", ")])


def write_warc(pages: DataFrame, *, id_col="page_id", url_col="url", body_col="html", folder: str | None = None, **options) -> tuple[DataFrame, str]:
    """Archive every row of pages; the index (page_id, archive, offset, length) and the folder of the archives.

    A null payload counts as empty.  Of rows with equal payloads the one with the largest id is the response;
    rows that repeat this id, and rows with a null id, are responses as well.  Other columns are not read.
    Payloads are joined on the id, which is spread evenly; groups of equal payloads meet as digests only, and
    after partial aggregation.  An empty table gives an empty index and no file.
    """
    spark = pages.sparkSession
    folder = folder or common.new_folder(spark, "warc")
    fs, base = common.open_fs(folder)
    fs.create_dir(base, recursive=True)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), common.utf8(body_col).alias("body"))
    keys = rows.select("page_id", F.unhex(F.sha1(F.encode("body", "UTF-8"))).alias("digest"))
    largest = keys.groupBy("digest").agg(F.max("page_id").alias("response"))
    refers = keys.join(largest, "digest").where("page_id < response").select(F.col("page_id").alias("revisit_id"), F.col("digest").alias("revisit_digest"), F.col("response").alias("refers_to")).distinct()
    same = (F.col("page_id") == F.col("revisit_id")) & (F.unhex(F.sha1(F.encode("body", "UTF-8"))) == F.col("revisit_digest"))
    joined = rows.join(refers, same, "left").select("page_id", "url", "body", "refers_to")
    index = joined.mapInArrow(_writer(folder, options), "page_id long, archive string, offset long, length long")
    return common.stash(index, "warc-index"), folder


def read_warc(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives that the index names, one row each; an archive to a task, in one pass over it.

    Null page ids come back as null, empty payloads as 0 bytes; an empty index gives an empty result.
    """
    names = common.stash(index.select("archive").distinct(), "warc-names")
    return names.repartition(max(1, names.count())).mapInArrow(_reader(folder), ROWS)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    return read_warc(*write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"))).drop("archive", "offset")


OP2_SQL = r"""
WITH d AS (SELECT page_id, coalesce(html, '') h FROM pages),
s AS (SELECT *, sha1(h) x, max(page_id) OVER (PARTITION BY h) top FROM d),
g AS (SELECT *, list_transform(range(8), lambda i: ('0x' || x[5 * i + 1 : 5 * i + 5])::INT) v FROM s)
SELECT page_id, strlen(h)::BIGINT payload_bytes,
       list_aggregate(flatten(list_transform(v, lambda n: list_transform([15, 10, 5, 0], lambda b: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((n >> b) & 31) + 1]))), 'string_agg', '') payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END record_type, CASE WHEN page_id < top THEN top END refers_to
FROM g
"""

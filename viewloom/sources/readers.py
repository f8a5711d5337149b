"""Readers of sparse models and databases of the exchange format: executors read the files, in ranges of records.

The driver lists names and, for binary files, walks over the heads of records to cut a file; it never holds rows.
"""

from __future__ import annotations

import shutil
import sqlite3
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Camera models of the exchange format by number, and how many parameters each has.
MODELS = {0: ("SIMPLE_PINHOLE", 3), 1: ("PINHOLE", 4), 2: ("SIMPLE_RADIAL", 4), 3: ("RADIAL", 5), 4: ("OPENCV", 8), 5: ("OPENCV_FISHEYE", 8), 6: ("FULL_OPENCV", 12), 7: ("FOV", 5), 8: ("SIMPLE_RADIAL_FISHEYE", 4), 9: ("RADIAL_FISHEYE", 5), 10: ("THIN_PRISM_FISHEYE", 12)}
#: Fixed value: a pair's number in the database is its first image times this, and its second image.
PAIR_BASE = 2147483647
SCHEMAS = {
    "cameras": "camera_id long, model string, width long, height long, params array<double>",
    "images": "image_id long, qvec array<double>, tvec array<double>, camera_id long, name string, points array<struct<x: double, y: double, point_id: long>>",
    "points3D": "point_id long, x double, y double, z double, r int, g int, b int, error double, track array<struct<image_id: long, idx: long>>",
}
DATABASE = {
    "images": "image_id long, name string, camera_id long",
    "cameras": "camera_id long, model string, width long, height long, params array<double>, prior_focal boolean",
    "keypoints": "image_id long, kp_idx long, x double, y double",
    "matches": "src long, dst long, kp_idx1 long, kp_idx2 long",
    "two_view_geometries": "src long, dst long, kp_idx1 long, kp_idx2 long",
}


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Parts:
    """A file, or the files of a folder in order of name, read as one."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.fs, path = filesystem(uri)
        info = self.fs.get_file_info(path)
        if info.type == fs.FileType.Directory:
            found = self.fs.get_file_info(fs.FileSelector(path))
            found = sorted((f for f in found if f.is_file and not f.base_name.startswith(("_", "."))), key=lambda f: f.base_name)
        elif info.type == fs.FileType.File:
            found = [info]
        else:
            raise FileNotFoundError(uri)
        self.files = [(f.path, f.size) for f in found if f.size]
        self.size, self.at, self.file = sum(s for _, s in self.files), 0, (None, None)
        self.held, self.held_at, self.chunk = b"", 0, 1 << 18

    def fill(self) -> None:
        """Hold the next ``chunk`` bytes."""
        out, n, at, before = [], self.chunk, self.at, 0
        for path, size in self.files:
            if n and before <= at < before + size:
                if self.file[0] != path:
                    self.file = path, self.fs.open_input_file(path)
                self.file[1].seek(at - before)
                out.append(self.file[1].read(min(n, before + size - at)))
                n, at = n - len(out[-1]), at + len(out[-1])
            before += size
        self.held, self.held_at = b"".join(out), self.at

    def next(self, n: int) -> bytes:
        """Up to n of the next bytes, none at the end; the place stays."""
        if not self.held_at <= self.at < self.held_at + len(self.held):
            self.fill()
        return self.held[self.at - self.held_at :][:n]

    def read(self, n: int) -> bytes:
        out = []
        while n and (piece := self.next(n)):
            out.append(piece)
            n, self.at = n - len(piece), self.at + len(piece)
        return b"".join(out)

    def unpack(self, kind: str) -> tuple:
        return struct.unpack(kind, self.read(struct.calcsize(kind)))

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of all."""
        out = []
        while piece := self.next(1 << 12):
            cut = piece.find(b"\n")
            out.append(piece if cut < 0 else piece[:cut])
            self.at += len(out[-1]) + (cut >= 0)
            if cut >= 0:
                return b"".join(out)
        return b"".join(out) if out else None

    def name(self) -> str:
        """A text that ends with a zero byte."""
        out = []
        while piece := self.next(64):
            cut = piece.find(b"\0")
            out.append(piece if cut < 0 else piece[:cut])
            self.at += len(out[-1]) + (cut >= 0)
            if cut >= 0:
                return b"".join(out).decode()
        raise EOFError("a name does not end")


def binary_record(table: str, f: Parts, skip: bool = False):
    """The next record of a binary table; with skip only the place moves."""
    if table == "cameras":
        number, model, width, height = f.unpack("<iiQQ")
        name, n = MODELS[model]
        return number, name, width, height, list(f.unpack(f"<{n}d"))
    if table == "images":
        number, *pose, camera = f.unpack("<I7dI")
        name, (n,) = f.name(), f.unpack("<Q")
        if skip:
            f.at += 24 * n
            return None
        points = np.frombuffer(f.read(24 * n), [("x", "<f8"), ("y", "<f8"), ("point_id", "<i8")])
        return number, pose[:4], pose[4:], camera, name, [dict(zip(("x", "y", "point_id"), p)) for p in points.tolist()]
    number, x, y, z, r, g, b, error, n = f.unpack("<Q3d3BdQ")
    if skip:
        f.at += 8 * n
        return None
    track = np.frombuffer(f.read(8 * n), "<u4").reshape(-1, 2).tolist()
    return number, x, y, z, r, g, b, error, [{"image_id": i, "idx": k} for i, k in track]


def is_pose(words: list[bytes]) -> bool:
    """Whether a line of an images file is a pose: a points line has triples of numbers, the third of each whole."""
    if len(words) < 10:
        return False
    if len(words) % 3:
        return True
    try:
        _ = [float(w) for w in words], [int(w) for w in words[2::3]]
        return False
    except ValueError:
        return True


def text_records(table: str, f: Parts, end: int) -> Iterator[tuple]:
    """Records whose first line begins before ``end``, from f's place on, which may be inside a line."""
    if f.at:
        f.at -= 1
        f.line()
    while f.at < end and (line := f.line()) is not None:
        words = line.split()
        if not words or words[0].startswith(b"#"):
            continue
        if table == "cameras":
            yield int(words[0]), words[1].decode(), int(words[2]), int(words[3]), [float(w) for w in words[4:]]
        elif table == "points3D":
            track = [int(w) for w in words[8:]]
            yield int(words[0]), *map(float, words[1:4]), *map(int, words[4:7]), float(words[7]), [{"image_id": i, "idx": k} for i, k in zip(track[::2], track[1::2])]
        elif is_pose(words):
            points = (f.line() or b"").split()
            points = [{"x": float(x), "y": float(y), "point_id": int(p)} for x, y, p in zip(points[::3], points[1::3], points[2::3])]
            name = line.split(None, 9)[9].strip().decode()
            yield int(words[0]), [float(w) for w in words[1:5]], [float(w) for w in words[5:8]], int(words[8]), name, points


#: Types of a vertex's properties.
_PLY = {"char": "i1", "uchar": "u1", "short": "i2", "ushort": "u2", "int": "i4", "uint": "u4", "float": "f4", "double": "f8", "int8": "i1", "uint8": "u1", "int16": "i2", "uint16": "u2", "int32": "i4", "uint32": "u4", "float32": "f4", "float64": "f8"}


def ply_head(f: Parts) -> tuple[int, np.dtype | None, list[str]]:
    """Vertices, their binary type (None for text) and the names of their properties; f is then at the first vertex."""
    order, n, fields, vertex = None, 0, [], False
    while (line := f.line()) is not None and line.strip() != b"end_header":
        words = line.decode().split()
        if words[:1] == ["format"]:
            order = {"ascii": None, "binary_little_endian": "<", "binary_big_endian": ">"}[words[1]]
        elif words[:1] == ["element"]:
            vertex = words[1] == "vertex"
            n = int(words[2]) if vertex else n
        elif words[:1] == ["property"] and vertex:
            fields.append((words[2], _PLY[words[1]]))
    return n, order and np.dtype([(c, order + k) for c, k in fields]), [c for c, _ in fields]


def ply_records(f: Parts, first: int, last: int) -> Iterator[tuple]:
    """Vertices as points numbered from 1, without error and track."""
    n, kind, names = ply_head(f)
    if kind is not None:
        f.at += first * kind.itemsize
        values = (dict(zip(names, v)) for v in np.frombuffer(f.read((last - first) * kind.itemsize), kind).tolist())
    else:
        rows = ((f.line() or b"").split() for _ in range(last))
        values = (dict(zip(names, map(float, w))) for i, w in enumerate(rows) if i >= first)
    for i, v in enumerate(values, first + 1):
        yield i, float(v["x"]), float(v["y"]), float(v["z"]), *(int(v.get(c, v.get(c[0], 200))) for c in ("red", "green", "blue")), None, None


class Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def batches(rows: Iterator[tuple], schema, size: int = 2000, values: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of up to size rows, that end with the row that brings the items of their lists to ``values``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held, items = to_arrow_schema(schema), [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    for row in rows:
        held.append(row)
        items += sum(len(v) for v in row if isinstance(v, list))
        if len(held) == size or items >= values:
            yield out()
            held.clear()
            items = 0
    if held:
        yield out()


class ModelSource(DataSource):
    """A table of a sparse model.  Options: path, table (cameras, images, points3D), kind (bin, txt, ply), and size,
    about how many bytes a task reads."""

    @classmethod
    def name(cls) -> str:
        return "viewloom_model"

    def schema(self) -> str:
        return SCHEMAS[self.options["table"]]

    def reader(self, schema) -> DataSourceReader:
        return ModelReader(schema, dict(self.options))


class ModelReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.schema, self.path, self.table, self.kind = schema, options["path"], options["table"], options["kind"]
        self.size = int(options.get("size", 32 << 20))

    def partitions(self) -> list[Range]:
        f = Parts(self.path)
        if self.kind == "txt":
            edges = [*range(0, f.size, self.size), f.size]
        elif self.kind == "ply":
            n, kind, _ = ply_head(f)
            edges = [*range(0, n, max(1, self.size // (kind.itemsize if kind is not None else 64))), n]
        else:
            # heads are read, bodies are skipped
            f.chunk = 1 << 12
            (n,) = f.unpack("<Q")
            edges = [f.at]
            for _ in range(n):
                binary_record(self.table, f, skip=True)
                if f.at - edges[-1] >= self.size:
                    edges.append(f.at)
            edges += [f.at] if edges[-1] < f.at else []
        return [Range(a, b) for a, b in zip(edges, edges[1:])] or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        f = Parts(self.path)
        if self.kind == "ply":
            rows = ply_records(f, partition.first, partition.last)
        else:
            f.at = partition.first
            rows = text_records(self.table, f, partition.last) if self.kind == "txt" else self.records(f, partition.last)
        yield from batches(rows, self.schema)

    def records(self, f: Parts, last: int) -> Iterator[tuple]:
        while f.at < last:
            yield binary_record(self.table, f)


def read_model(spark: SparkSession, folder: str, size: int = 32 << 20) -> dict[str, DataFrame]:
    """cameras, images and points3D of a model's folder, each by the first form there is: binary, text, or (points) ply.

    A text table may be a file or a folder of parts that follow one another in order of name, as write_sparse_model
    leaves them.  Executors read ranges of about ``size`` bytes; a record belongs to the range in which it begins.
    Points of a ply file are numbered from 1 and have neither error nor track.
    """
    from pyarrow import fs

    spark.dataSource.register(ModelSource)
    system, base = filesystem(folder)
    out = {}
    for table in SCHEMAS:
        for kind, names in (("bin", [f"{table}.bin"]), ("txt", [f"{table}.txt", table]), ("ply", [f"{table}.ply"] if table == "points3D" else [])):
            there = [n for n in names if system.get_file_info(f"{base}/{n}").type != fs.FileType.NotFound]
            if there:
                out[table] = spark.read.format("viewloom_model").options(path=f"{folder.rstrip('/')}/{there[0]}", table=table, kind=kind, size=str(size)).load()
                break
        else:
            raise FileNotFoundError(f"{folder}: no {table}")
    return out


class DatabaseSource(DataSource):
    """A table of a database file.  Options: path, table, and rows, how many keys a task reads."""

    @classmethod
    def name(cls) -> str:
        return "viewloom_database"

    def schema(self) -> str:
        return DATABASE[self.options["table"]]

    def reader(self, schema) -> DataSourceReader:
        return DatabaseReader(schema, dict(self.options))


class DatabaseReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.schema, self.path, self.table, self.rows = schema, options["path"], options["table"], int(options.get("rows", 1000))

    def query(self, text: str, *values) -> Iterator[tuple]:
        """Rows of the file; one in a store that cannot be opened in place is copied to this task's own folder first."""
        system, path = filesystem(self.path)
        with tempfile.TemporaryDirectory() as folder:
            if system.type_name != "local":
                with system.open_input_stream(path) as source, open(f"{folder}/copy", "wb") as copy:
                    shutil.copyfileobj(source, copy, 1 << 20)
                path = f"{folder}/copy"
            con = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
            try:
                yield from con.execute(text, values)
            finally:
                con.close()

    def partitions(self) -> list[Range]:
        edges = [r[0] for r in self.query(f"SELECT min(k) FROM (SELECT rowid AS k, row_number() OVER (ORDER BY rowid) - 1 AS n FROM {self.table}) GROUP BY n / ? ORDER BY 1", self.rows)]
        return [Range(a, b) for a, b in zip(edges, [*edges[1:], 1 << 62])] or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        columns = {"images": "image_id, name, camera_id", "cameras": "camera_id, model, width, height, params, prior_focal_length", "keypoints": "image_id, cols, data"}.get(self.table, "pair_id, cols, data")
        found = self.query(f"SELECT {columns} FROM {self.table} WHERE rowid >= ? AND rowid < ?", partition.first, partition.last)
        if self.table == "images":
            yield from batches(found, self.schema)
        elif self.table == "cameras":
            yield from batches(((i, MODELS[m][0], w, h, np.frombuffer(p, "<f8").tolist(), bool(prior)) for i, m, w, h, p, prior in found), self.schema)
        else:
            names = [f.name for f in self.schema.fields]
            for key, width, data in found:
                if not data:
                    continue
                points = self.table == "keypoints"
                v = np.frombuffer(data, "<f4" if points else "<u4").reshape(-1, width)[:, :2]
                n = len(v)
                heads = [np.full(n, key), np.arange(n)] if points else [np.full(n, key // PAIR_BASE), np.full(n, key % PAIR_BASE)]
                ends = v.T.astype(float if points else np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*heads, *ends)], names)


def read_database(spark: SparkSession, path: str, rows: int = 1000) -> dict[str, DataFrame]:
    """The tables images, cameras, keypoints, matches and two_view_geometries of a database file, as write_database
    takes them; executors read ranges of ``rows`` keys.  Keypoints and matches are a row each."""
    spark.dataSource.register(DatabaseSource)
    return {t: spark.read.format("viewloom_database").options(path=path, table=t, rows=str(rows)).load() for t in DATABASE}

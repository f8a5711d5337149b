"""Models of all forms, read in ranges of any size, against what was written."""

import random
import struct

import pytest

from viewloom.sources import model, readers

rng = random.Random(8)
CAMERAS = [(1, 1, 64, 48, [50.0, 51.0, 32.0, 24.0]), (7, 2, 640, 480, [500.0, 320.0, 240.0, 0.01])]
IMAGES = [(i, [1.0, 0.0, 0.5, 0.0], [0.25, -1.0, float(i)], 1 + 6 * (i % 2), name, [(rng.random(), rng.random(), rng.choice([-1, 3, 2**40])) for _ in range(n)]) for i, (name, n) in enumerate([("a.png", 3), ("dir/b c.png", 0), ("1234", 40), ("x" * 90, 5), ("5 6 7", 1)], 1)]
POINTS = [(10 + i, rng.random(), -rng.random(), 2.5, i, 2 * i, 255, 0.5 * i, [(rng.randrange(1, 6), k) for k in range(rng.randrange(6))]) for i in range(30)]


def binary(folder):
    put = lambda name, n, body: (folder / name).write_bytes(struct.pack("<Q", n) + b"".join(body))
    put("cameras.bin", len(CAMERAS), [struct.pack("<iiQQ", *c[:4]) + struct.pack(f"<{len(c[4])}d", *c[4]) for c in CAMERAS])
    put("images.bin", len(IMAGES), [struct.pack("<I7dI", i, *q, *t, c) + n.encode() + b"\0" + struct.pack("<Q", len(p)) + b"".join(struct.pack("<ddq", *x) for x in p) for i, q, t, c, n, p in IMAGES])
    put("points3D.bin", len(POINTS), [struct.pack("<Q3d3BdQ", *p[:8], len(p[8])) + b"".join(struct.pack("<II", *x) for x in p[8]) for p in POINTS])


def text(folder):
    line = lambda *xs: " ".join(map(str, xs))
    flat = lambda rows: [x for r in rows for x in r]
    (folder / "cameras.txt").write_text("# a comment\n" + "".join(line(c[0], readers.MODELS[c[1]][0], *c[2:4], *c[4]) + "\n" for c in CAMERAS))
    body = "".join(f"{line(i, *q, *t, c, n)}\n{line(*flat(p))}\n" for i, q, t, c, n, p in IMAGES)
    parts = folder / "images"
    parts.mkdir()
    (parts / "part-0").write_text("# 1\n# 2\n" + body[:150])
    (parts / "part-1").write_text(body[150:])
    (parts / "_SUCCESS").write_text("")
    (folder / "points3D.txt").write_text("\n".join(line(*p[:8], *flat(p[8])) for p in POINTS))


def check(found, points=True):
    cameras = sorted((r.camera_id, r.model, r.width, r.height, r.params) for r in found["cameras"].collect())
    assert cameras == [(c[0], readers.MODELS[c[1]][0], *c[2:]) for c in CAMERAS]
    images = sorted((r.image_id, r.qvec, r.tvec, r.camera_id, r.name, [tuple(p) for p in r.points]) for r in found["images"].collect())
    assert images == IMAGES
    if points:
        assert sorted((*r[:8], [tuple(t) for t in r.track]) for r in found["points3D"].collect()) == POINTS


@pytest.mark.parametrize("size", [90, 1 << 20])
@pytest.mark.parametrize("write", [binary, text])
def test_read_model(spark, tmp_path, write, size):
    write(tmp_path)
    check(readers.read_model(spark, str(tmp_path), size))


def test_binary_comes_first_and_ply_last(spark, tmp_path):
    binary(tmp_path)
    text(tmp_path)
    (tmp_path / "cameras.txt").write_text("nonsense")
    check(readers.read_model(spark, f"file://{tmp_path}", 200))
    (tmp_path / "points3D.bin").unlink()
    (tmp_path / "points3D.txt").unlink()
    with pytest.raises(FileNotFoundError):
        readers.read_model(spark, str(tmp_path))
    head = "ply\nformat {}\nelement vertex 5\n" + "".join(f"property float {c}\n" for c in "xyz") + "".join(f"property uchar {c}\n" for c in ("red", "green", "blue")) + "element face 0\nproperty list uchar int vertex_indices\nend_header\n"
    rows = [(i / 2, -i, 4.0, i, 2, 3) for i in range(5)]
    for body in (head.format("ascii 1.0").encode() + "".join(" ".join(map(str, r)) + "\n" for r in rows).encode(), head.format("binary_little_endian 1.0").encode() + b"".join(struct.pack("<3f3B", *r) for r in rows)):
        (tmp_path / "points3D.ply").write_bytes(body)
        found = readers.read_model(spark, str(tmp_path), 40)
        check(found, points=False)
        assert sorted(tuple(r)[:7] for r in found["points3D"].collect()) == [(i, *r) for i, r in enumerate(rows, 1)]


def test_written_models_read_back(spark, tmp_path):
    cameras = spark.createDataFrame([(1, "PINHOLE", 64, 48, [50.0, 50.0, 32.0, 24.0])], "camera_id long, model string, width int, height int, params array<double>")
    poses = spark.createDataFrame([(i, [1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.5], 1, f"{i}.png") for i in range(1, 9)], "image_id long, qvec array<double>, tvec array<double>, camera_id long, name string")
    points = spark.createDataFrame([(i, i / 2, 2.0, 3.0, 9, 8, 7) for i in range(20)], "point_id long, x double, y double, z double, r int, g int, b int")
    seen = spark.createDataFrame([(i, 1 + (i * k) % 8, i / 4, k / 8) for i in range(20) for k in (1, 2, 3)], "point_id long, image_id long, x double, y double")
    model.write_sparse_model(str(tmp_path), cameras, poses, points, seen)
    kept, observed = model.sparse_model(points, seen)
    found = readers.read_model(spark, str(tmp_path), 64)
    assert sorted((r.image_id, r.name) for r in found["images"].collect()) == [(i, f"{i}.png") for i in range(1, 9)]
    back = sorted((r.image_id, i, p.x, p.y, p.point_id) for r in found["images"].collect() for i, p in enumerate(r.points))
    assert back == sorted((r.image_id, r.idx, r.x, r.y, -1 if r.point_id is None else r.point_id) for r in observed.collect())
    assert sorted((r.point_id, r.x) for r in found["points3D"].collect()) == sorted((r.point_id, r.x) for r in kept.collect())


def test_batches_end_by_their_values():
    """Images with many points make small batches, so what a task holds does not go with points per image."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(readers.SCHEMAS["images"])
    point = {"x": 1.0, "y": 2.0, "point_id": 3}
    made = list(readers.batches(((i, [1.0] * 4, [0.0] * 3, 1, "a", [point] * 600) for i in range(100)), schema))
    assert sum(b.num_rows for b in made) == 100 and max(b.num_rows for b in made) * 600 <= 21_000
    assert [r["image_id"] for b in made for r in b.to_pylist()] == list(range(100))

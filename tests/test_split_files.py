"""Readers that split large files give the rows of one-task readers; models written back are the same models."""

import math
import os
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenequarry.sources import files as S
from scenequarry.sources import model_writer as W
from scenequarry.sources import models as M
from scenequarry.sources import ranges as R


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "2000")
    yield
    for n, v in zip(names, old, strict=True):
        spark.conf.set(n, v)


def model(rng, n=120):
    cameras = [(1, "PINHOLE", 64, 48, [50.5, 51.25, 32.0, 24.0]), (2, "SIMPLE_RADIAL", 10, 20, [5.0, 6.0, 7.0, 0.1])]
    images, points = [], []
    for i in range(n):
        q = rng.normal(size=4)
        seen = [(float(x), float(y), int(p)) for x, y, p in zip(rng.random(i % 7) * 100, rng.random(i % 7), rng.integers(-1, 50, i % 7), strict=True)]
        images.append((i + 1, *(q / np.linalg.norm(q)).tolist(), *rng.normal(size=3).tolist(), 1 + i % 2, f"dir {i % 3}/främe_{i}.png", seen))
    for k in range(3 * n):
        points.append((10 * k + 7, *rng.normal(size=3).tolist(), *rng.integers(0, 256, 3).tolist(), float(rng.random()), [(int(a), int(b)) for a, b in rng.integers(0, 99, (k % 5, 2))]))
    return cameras, images, points


def text_files(d, images):
    d.mkdir(parents=True)
    lines = ["# Image list", "#   IMAGE_ID, QW, ..."]
    for image_id, *pose, camera, name, seen in images:
        lines += [f"{image_id} {' '.join(map(repr, pose))} {camera} {name}", " ".join(f"{x!r} {y!r} {p}" for x, y, p in seen)]
        if image_id % 10 == 0:
            lines.append("# a comment between images")
    (d / "images.txt").write_text("\n".join(lines) + "\n")


def as_rows(df, *columns):
    return sorted((tuple(tuple(map(tuple, v)) if isinstance(v, list) else v for v in r) for r in df.select(*columns).collect()), key=repr)


def test_image_lists_split_and_keep_their_pairs(spark, tmp_path, small_splits):
    _, images, _ = model(np.random.default_rng(1))
    for scene in ("hall", "yard"):
        text_files(tmp_path / scene, images if scene == "hall" else images[:3])
    path = f"{tmp_path}/*/images.txt"
    assert spark.read.text(path).rdd.getNumPartitions() > 5
    got = M.read_images(spark, path, observations=True)
    want = [(s, *i[:-1], tuple(i[-1])) for s, n in (("hall", 120), ("yard", 3)) for i in images[:n]]
    assert as_rows(got, "scene", *M.IMAGE_NAMES, "points2d") == sorted(want, key=repr)
    assert M.read_images(spark, path).columns == ["scene", *M.IMAGE_NAMES] and M.read_images(spark, path).count() == 123


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, small_splits):
    r = random.Random(2)
    lines = {f"f {k}.txt": ["x" * r.randrange(0, 300) + f" {k} {i}" for i in range(200 * k + 1)] for k in range(4)}
    for name, rows in lines.items():
        (tmp_path / name).write_text("\n".join(rows))
    got = {(x.file.rsplit("/", 1)[1], x.line): x.value for x in R.numbered_lines(spark, str(tmp_path)).collect()}
    assert got == {(name, i): v for name, rows in lines.items() for i, v in enumerate(rows)}


@pytest.mark.parametrize("binary", [False, True])
@pytest.mark.parametrize("range_bytes", [1, 700, 1 << 30])
def test_round_trip_of_models(spark, tmp_path, binary, range_bytes):
    cameras, images, points = model(np.random.default_rng(3))
    scenes = F.explode(F.array(F.lit("hall"), F.lit("yard"))).alias("scene")
    c = spark.createDataFrame(cameras, "camera_id int, model string, width long, height long, params array<double>").select(scenes, "*")
    i = spark.createDataFrame(images, "image_id int, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id int, name string, points2d array<struct<x:double,y:double,point_id:bigint>>").select(scenes, "*").repartition(5)
    p = spark.createDataFrame(points, "point_id long, x double, y double, z double, r short, g short, b short, error double, track array<struct<image_id:int,point2d_idx:int>>").select(scenes, "*").repartition(5)
    out = str(tmp_path / "out")
    W.write_model(c, i, p, out, binary)
    end = "bin" if binary else "txt"
    assert sorted(os.listdir(f"{out}/hall")) == [f"cameras.{end}", f"images.{end}", f"points3D.{end}"]
    if binary:
        read = (M.read_cameras_binary(spark, f"{out}/*/cameras.bin"), M.read_images_binary(spark, f"{out}/*/images.bin", True, range_bytes), M.read_points_binary(spark, f"{out}/*/points3D.bin", range_bytes))
        tasks = M.read_points_binary(spark, f"{out}/*/points3D.bin", range_bytes).rdd.getNumPartitions()
        assert tasks == 2 if range_bytes > 1 << 20 else tasks > 20
    else:
        read = (M.read_cameras(spark, f"{out}/*/cameras.txt"), M.read_images(spark, f"{out}/*/images.txt", True), M.read_points(spark, f"{out}/*/points3D.txt"))
    assert sorted(map(str, read[0].collect())) == sorted(map(str, c.select(*read[0].columns).collect()))
    assert as_rows(read[1], "scene", *M.IMAGE_NAMES, "points2d") == as_rows(i, "scene", *M.IMAGE_NAMES, "points2d")
    assert as_rows(read[2], "scene", *M.POINT_NAMES, "track") == as_rows(p, "scene", *M.POINT_NAMES, "track")
    if not binary:
        ids = [int(line.split()[0]) for line in open(f"{out}/yard/points3D.txt")]
        assert ids == sorted(ids)


def test_scene_transforms_move_poses_and_points(spark, tmp_path):
    images = spark.createDataFrame([("a", 1, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1, "frame_0001.png"), ("b", 1, 0.5, 0.5, -0.5, 0.5, 1.0, 2.0, 3.0, 1, "x.png"), ("c", 1, 1.0, 0.0, 0.0, 0.0, 5.0, 0.0, 0.0, 1, "y.png")], "scene string, image_id int, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id int, name string")
    points = spark.createDataFrame([("a", 7, 10.0, 20.0, 30.0), ("b", 8, 1.0, -2.0, 0.5), ("c", 9, 1.0, 1.0, 1.0)], "scene string, point_id long, x double, y double, z double")
    turn, s = math.radians(30), 2.5
    b = [s * math.cos(turn), -s * math.sin(turn), 0.0, 1.0, s * math.sin(turn), s * math.cos(turn), 0.0, -4.0, 0.0, 0.0, s, 2.0, 0.0, 0.0, 0.0, 1.0]
    transforms = spark.createDataFrame([("a", [1.0, 0.0, 0.0, 1.0, 0.0, 1.0, 0.0, 2.0, 0.0, 0.0, 1.0, 3.0, 0.0, 0.0, 0.0, 1.0]), ("b", b)], "scene string, m array<double>")
    moved, placed = W.transform_model(images, points, transforms)
    got, at = {r.scene: r for r in moved.collect()}, {r.scene: (r.x, r.y, r.z) for r in placed.collect()}
    assert at["a"] == (11.0, 22.0, 33.0) and at["c"] == (1.0, 1.0, 1.0)
    assert (got["a"].qw, got["a"].tx, got["a"].ty, got["a"].tz) == (1.0, -1.0, -2.0, -3.0)
    assert (got["c"].tx, got["c"].qw) == (5.0, 1.0)

    def seen(q, t, p):  # a point in front of the camera
        w, x, y, z = q
        r = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]])
        return r @ np.array(p) + np.array(t)

    pose = lambda r: ((r.qw, r.qx, r.qy, r.qz), (r.tx, r.ty, r.tz))
    before = seen((0.5, 0.5, -0.5, 0.5), (1.0, 2.0, 3.0), (1.0, -2.0, 0.5))
    assert np.allclose(seen(*pose(got["b"]), at["b"]), s * before)


def test_failed_tasks_leave_no_files(tmp_path):
    w = W.ModelWriter(str(tmp_path), "cameras", False)
    from pyspark.sql import Row

    row = Row(scene="a", camera_id=1, model="PINHOLE", width=1, height=2, params=[1.0])
    w.abort([w.write(iter([row])), None])
    assert os.listdir(tmp_path / "a") == []
    w.commit([w.write(iter([row])), None])
    assert (tmp_path / "a" / "cameras.txt").read_text() == "1 PINHOLE 1 2 1.0\n"


@pytest.mark.parametrize("fmt", ["binary_little_endian", "binary_big_endian", "ascii"])
@pytest.mark.parametrize("range_bytes", [1, 3000, 1 << 30])
def test_splat_files_in_ranges(spark, tmp_path, small_splits, fmt, range_bytes):
    rng = np.random.default_rng(4)
    names = ["extra", *S.PLY_NAMES, *[f"f_rest_{i}" for i in range(9)]]
    data = rng.normal(size=(150, len(names))).astype("<f4")
    head = f"ply\nformat {fmt} 1.0\ncomment made here\nelement camera 2\nproperty uchar k\nelement vertex 150\n" + "".join(f"property float {n}\n" for n in names) + "property uchar red\nelement face 1\nproperty list uchar int vertex_indices\nend_header\n"
    rows = np.zeros(150, [(n, "<f4") for n in names] + [("red", "u1")])
    for k, n in enumerate(names):
        rows[n] = data[:, k]
    rows["red"] = np.arange(150)
    big = rows.astype(rows.dtype.newbyteorder(">"))
    body = {"ascii": ("1\n2\n" + "".join(" ".join(map(repr, map(float, d))) + f" {k}\n" for k, d in enumerate(data)) + "3 0 1 2\n").encode()}.get(fmt) or b"\1\2" + (big if "big" in fmt else rows).tobytes() + b"\3\0\0\0\0"
    for scene in ("hall", "yard"):
        (tmp_path / scene).mkdir()
        (tmp_path / scene / "a b.ply").write_bytes(head.encode() + body)
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.ply").write_text("ply\nformat ascii 1.0\nelement vertex 0\nproperty float x\nend_header\n")
    df = S.read_splats(spark, str(tmp_path), range_bytes)
    got = sorted(df.collect(), key=lambda r: (r.scene, r.splat_id))
    assert [(r.scene, r.splat_id) for r in got] == [(s, k) for s in ("hall", "yard") for k in range(150)]
    own = [[r[c] for c in S.SPLAT_COLUMNS] for r in got[:150]]
    assert np.array_equal(np.array(own), data[:, 1:15].astype(float)) and [r.r for r in got[:150]] == list(range(150)) and got[0].g == 255
    assert np.array_equal([r.shn for r in got[150:]], data[:, [15 + c * 3 + i for i in range(3) for c in range(3)]].astype(float))
    if fmt != "ascii":
        parts = df.select(F.spark_partition_id().alias("p"), "scene").groupBy("scene").agg(F.countDistinct("p").alias("n")).collect()
        assert all(r.n == 1 if range_bytes > 1 << 20 else r.n > 4 for r in parts)


def test_broken_files_say_so(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.ply").write_text("no header here")
    with pytest.raises(Exception, match="no PLY header"):
        S.read_splats(spark, str(tmp_path)).collect()
    (tmp_path / "a" / "images.bin").write_bytes(struct.pack("<Q", 2) + b"\0" * 40)
    with pytest.raises(Exception, match="without an end"):
        M.read_images_binary(spark, f"{tmp_path}/*/images.bin").collect()

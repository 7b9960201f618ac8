import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenequarry.sources import files as S
from scenequarry.sources import models as M


def test_text_model_keeps_images_without_observations(spark, tmp_path):
    d = tmp_path / "room"
    d.mkdir()
    (d / "cameras.txt").write_text("# head\n\n1 PINHOLE 64 48 50 51 32 24\n2 SIMPLE_PINHOLE 10 20 5 6 7\n")
    (d / "images.txt").write_text("# head\n1 1 0 0 0 0 0 12 1 a.jpg\n1.0 2.0 5\n2 1 0 0 0 1 2 3 2 b c.jpg\n\n3 1 0 0 0 1 2 3 2 d.jpg\n\n")
    (d / "points3D.txt").write_text("# head\n7 1 2 3 10 20 30 0.5 1 4 2 9\n8 0 0 0 1 2 3 0.1\n")
    cams = {r["camera_id"]: r for r in M.read_cameras(spark, f"{tmp_path}/*/cameras.txt").collect()}
    assert cams[1]["params"] == [50, 51, 32, 24] and cams[2]["model"] == "SIMPLE_PINHOLE" and cams[1]["scene"] == "room"
    imgs = sorted((r["image_id"], r["name"]) for r in M.read_images(spark, f"{tmp_path}/*/images.txt").collect())
    assert imgs == [(1, "a.jpg"), (2, "b c.jpg"), (3, "d.jpg")]
    pts = M.read_points(spark, f"{tmp_path}/*/points3D.txt")
    assert sorted((r["point_id"], r["image_id"], r["point2d_idx"]) for r in M.observations(pts).collect()) == [(7, 1, 4), (7, 2, 9)]
    out = str(tmp_path / "out")
    M.write_model_text(M.read_images(spark, f"{tmp_path}/*/images.txt"), pts, out)
    again = M.read_images(spark, f"{out}/images/scene=room/*.txt")
    assert sorted(r["image_id"] for r in again.collect()) == [1, 2, 3]
    assert M.observations(M.read_points(spark, f"{out}/points3D/*/*.txt")).count() == 2


def test_binary_model(spark, tmp_path):
    d = tmp_path / "room"
    d.mkdir()
    (d / "cameras.bin").write_bytes(struct.pack("<Q", 1) + struct.pack("<iiQQ4d", 3, 1, 64, 48, 50, 50, 32, 24))
    img = struct.pack("<i7di", 9, 1, 0, 0, 0, 1, 2, 3, 3) + b"x.jpg\0" + struct.pack("<Q", 2) + b"\0" * 48
    (d / "images.bin").write_bytes(struct.pack("<Q", 2) + img + img)
    c = M.read_cameras_binary(spark, f"{tmp_path}/*/cameras.bin").first()
    assert (c["camera_id"], c["model"], c["width"], c["params"]) == (3, "PINHOLE", 64, [50, 50, 32, 24])
    assert [(r["image_id"], r["name"], r["tz"]) for r in M.read_images_binary(spark, f"{tmp_path}/*/images.bin").collect()] == [(9, "x.jpg", 3.0)] * 2


@pytest.mark.parametrize("fmt", ["binary_little_endian", "ascii"])
def test_splat_file(spark, tmp_path, fmt):
    names = list(S.PLY_NAMES) + [f"f_rest_{i}" for i in range(9)]
    rng = np.random.default_rng(0)
    data = rng.normal(size=(5, len(names))).astype("<f4")
    head = f"ply\nformat {fmt} 1.0\nelement vertex 5\n" + "".join(f"property float {n}\n" for n in names) + "end_header\n"
    body = data.tobytes() if fmt.startswith("b") else "\n".join(" ".join(map(str, r)) for r in data).encode()
    d = tmp_path / "hall"
    d.mkdir()
    (d / "a.ply").write_bytes(head.encode() + body)
    rows = S.read_splats(spark, str(tmp_path)).orderBy("splat_id").collect()
    assert len(rows) == 5 and rows[0]["scene"] == "hall" and rows[0]["r"] == 255
    assert np.allclose([r["opacity_raw"] for r in rows], data[:, 3], atol=1e-6)
    # coefficient-major triples: coefficient 0 of the three channels first
    assert np.allclose(rows[2]["shn"][:3], [data[2, 14], data[2, 17], data[2, 20]], atol=1e-6)


def test_transforms_and_errors(spark, tmp_path):
    eye = np.eye(4).tolist()
    docs = {
        "a": {"w": 100, "h": 100, "camera_angle_x": 1.0, "frames": [{"file_path": "x.png", "transform_matrix": eye}, {"file_path": "y.png", "transform_matrix": [[1.0]]}]},
        "b": {"w": 100, "h": 50, "camera_angle_x": 1.0, "frames": []},
        "c": {"w": 10, "h": 5, "frames": [{"file_path": "z.png", "transform_matrix": eye}]},
    }
    for n, doc in docs.items():
        (tmp_path / n).mkdir()
        (tmp_path / n / "transforms.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "transforms.json").write_text("{ broken")
    cams, errors = S.read_transforms(spark, f"{tmp_path}/*/transforms.json")
    got = {r["scene"]: r for r in cams.collect()}
    assert set(got) == {"a", "c"} and got["c"]["model"] == "EQUIRECTANGULAR"
    assert got["a"]["fx"] == pytest.approx(50 / np.tan(0.5)) and got["a"]["fy"] == got["a"]["fx"] and got["a"]["cx"] == 50
    assert sorted(r["scene"] for r in errors.collect()) == ["a", "b", "e"]


def test_clips_locale_trace_metrics(spark, tmp_path):
    (tmp_path / "clip.json").write_text(json.dumps({"name": "c", "tracks": [
        {"id": 1, "type": "vec3", "target": "cam", "keyframes": [{"time": 0.5, "easing": "ease_in", "value": [1, 2, 3]}]},
        {"id": 2, "target": "cam", "keyframes": [{"time": 9, "value": [1]}]}, {"id": 3, "target": "", "keyframes": []}]}))
    k = S.read_clips(spark, f"{tmp_path}/clip.json").collect()
    assert [(r["target"], r["t"], r["easing"], r["value"]) for r in k] == [("cam", 0.5, "ease_in", [1.0, 2.0, 3.0])]
    (tmp_path / "en.json").write_text(json.dumps({"_meta": {"x": "y"}, "menu": {"file": {"open": "Open"}, "n": 3}, "ok": "OK"}))
    loc = S.flatten_locale(spark, f"{tmp_path}/en.json").collect()
    assert sorted((r["lang"], r["key"], r["text"]) for r in loc) == [("en", "menu.file.open", "Open"), ("en", "ok", "OK")]
    (tmp_path / "t.json").write_text('{"timestamp":"2024-01-01T00:00:00","stage":"a","gpus":[{"index":0,"vram_used_mb":5},{"index":1,"vram_used_mb":7}],"system":{"ram_used_mb":9}}\n{"timestamp":"2024-01-01T00:00:01","stage":"b","gpus":[],"system":{"ram_used_mb":1}}\n')
    t = S.read_trace(spark, f"{tmp_path}/t.json").collect()
    assert sorted((r["stage"], r["gpu"], r["vram_mb"]) for r in t if r["gpu"] is not None) == [("a", 0, 5.0), ("a", 1, 7.0)] and len(t) == 3
    m = spark.createDataFrame([(10, 20.0, 0.8, 0.1, 5)], S.METRICS_SCHEMA)
    S.append_metrics(m, f"{tmp_path}/run1")
    S.append_metrics(m, f"{tmp_path}/run1")
    assert S.read_metrics(spark, f"{tmp_path}/run1").count() == 2


def test_images_and_listings(spark, tmp_path):
    rng = np.random.default_rng(4)
    for s, n in (("s1", 2), ("s2", 1)):
        (tmp_path / s).mkdir()
        for i in range(n):
            img = rng.integers(0, 256, (130, 70), dtype=np.uint8)
            (tmp_path / s / f"f{i}.pgm").write_bytes(b"P5 70 130 255\n" + img.tobytes())
        (tmp_path / s / "v.mp4").write_bytes(b"x")
    (tmp_path / "s2" / "bad.pgm").write_bytes(b"nope")
    got = {r["path"].rsplit("/", 1)[1] + r["path"].rsplit("/", 2)[1]: r for r in S.frame_metrics(spark, str(tmp_path), "*.pgm").collect()}
    assert got["bad.pgms2"]["blur_score"] is None and got["f0.pgms1"]["coverage_score"] == 1.0
    assert 0.4 < got["f0.pgms1"]["exposure_mean"] < 0.6 and got["f0.pgms1"]["phash"] != got["f1.pgms1"]["phash"]
    flat = S.image_metrics(np.full((128, 128), 9, np.uint8))
    assert flat[0] == 0 and flat[4] == 0 and flat[1] == pytest.approx(9 / 255)
    assert {r["session_id"]: r["n_sets"] for r in S.list_sessions(spark, str(tmp_path)).collect()} == {"s1": 1, "s2": 1}
    f = S.frame_listing(spark, str(tmp_path), "*.pgm").filter("session_id = 's1'").orderBy("path").collect()
    assert [r["frame_index"] for r in f] == [0, 1]


def test_object_sink_and_factories(spark, tmp_path):
    s = spark.range(40).select(F.lit(0).alias("scene_id"), F.col("id").alias("splat_id"), *[F.col("id").cast("double").alias(a) for a in "xyz"])
    labels = s.select("scene_id", "splat_id", F.when(F.col("splat_id") < 5, 1).when(F.col("splat_id") < 30, 2).otherwise(0).alias("label"))
    S.write_objects(s, labels, str(tmp_path / "o"))
    back = spark.read.parquet(str(tmp_path / "o"))
    assert {r["object"]: r["count"] for r in back.groupBy("object").count().collect()} == {"object_002": 25, "background": 10}
    S.write_summary(s.join(labels, ["scene_id", "splat_id"]), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["num_objects"] == 1
    assert [r["v"] for r in S.linspace(spark, 0, 1, 5).orderBy("id").collect()] == [0, 0.25, 0.5, 0.75, 1.0]
    assert [r["v"] for r in S.arange(spark, 1, 3, 0.5).orderBy("id").collect()] == [1, 1.5, 2, 2.5]
    a = S.random_cloud(spark, 50, 3)
    assert a.repartition(7).exceptAll(S.random_cloud(spark, 50, 3)).isEmpty() and a.filter("abs(x) > 1 or r > 255").isEmpty()
    assert S.eye(spark, 3).count() == 3 and S.full(spark, 3, 2.0).agg(F.sum("v")).first()[0] == 6

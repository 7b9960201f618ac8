"""Sparse reconstruction models: text and binary readers over many scenes' files at once, and the text writer.

The scene of a file is the name of the folder that holds it, hashed by the caller or mapped with ``scene_of``.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scenequarry.sources.ranges import RANGE_BYTES, numbered_lines, ranged_records

# executors get the record readers by value and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Camera model names by number and their parameter counts.
MODEL_IDS = {
    0: ("SIMPLE_PINHOLE", 3), 1: ("PINHOLE", 4), 2: ("SIMPLE_RADIAL", 4), 3: ("RADIAL", 5), 4: ("OPENCV", 8),
    5: ("OPENCV_FISHEYE", 8), 6: ("FULL_OPENCV", 12), 7: ("FOV", 5), 8: ("SIMPLE_RADIAL_FISHEYE", 4),
    9: ("RADIAL_FISHEYE", 5), 10: ("THIN_PRISM_FISHEYE", 12),
}


def scene_of(path: Column) -> Column:
    """Name of the folder above the file."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.text(path).select(scene_of(F.col("_metadata.file_path")).alias("scene"), F.trim("value").alias("line"))
    return df.filter((F.col("line") != "") & ~F.col("line").startswith("#")).withColumn("p", F.split("line", r"\s+"))


def read_cameras(spark: SparkSession, path: str) -> DataFrame:
    """cameras.txt: scene, camera_id, model, width, height, params."""
    p = lambda i: F.get("p", F.lit(i))
    return _lines(spark, path).select(
        "scene", p(0).cast("int").alias("camera_id"), p(1).alias("model"), p(2).cast("int").alias("width"), p(3).cast("int").alias("height"),
        F.slice("p", 5, F.greatest(F.size("p") - 4, F.lit(0))).cast("array<double>").alias("params"),
    )


def read_images(spark: SparkSession, path: str, observations: bool = False) -> DataFrame:
    """images.txt: two lines per image, the second (observations) may be empty; comment lines count for nothing.

    Large files are read by several tasks: lines are numbered across splits, and an image's line has an even number. With
    ``observations`` the second line comes along as ``points2d``: array<struct<x, y, point_id>>.
    """
    lines = numbered_lines(spark, path, lambda v: ~F.trim(v).startswith("#"))
    if observations:
        even = F.col("line") % 2 == 0
        pairs = lines.groupBy("file", F.floor(F.col("line") / 2).alias("image"))
        lines = pairs.agg(F.max(F.when(even, F.col("value"))).alias("value"), F.max(F.when(~even, F.col("value"))).alias("_second"))
    else:
        lines = lines.filter("line % 2 = 0").withColumn("_second", F.lit(None).cast("string"))
    rows = lines.filter("trim(value) <> ''").select(scene_of(F.col("file")).alias("scene"), F.split(F.trim("value"), r"\s+", 10).alias("p"), F.filter(F.split(F.trim("_second"), r"\s+"), lambda x: x != "").alias("o"))
    names = ("image_id", "qw", "qx", "qy", "qz", "tx", "ty", "tz", "camera_id", "name")
    types = ("int", *["double"] * 7, "int", "string")
    head = ["scene", *[F.get("p", F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))]]
    if not observations:
        return rows.select(*head)
    o = lambda i, k, t: F.get("o", 3 * i + k).cast(t)
    count = F.floor(F.size("o") / 3).cast("int")
    points = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(o(i, 0, "double").alias("x"), o(i, 1, "double").alias("y"), o(i, 2, "long").alias("point_id"))))
    return rows.select(*head, F.coalesce(points, F.array().cast("array<struct<x:double,y:double,point_id:bigint>>")).alias("points2d"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """points3D.txt with the track as array<struct<image_id, point2d_idx>>."""
    p = lambda i, t: F.get("p", F.lit(i)).cast(t)
    pairs = F.floor((F.size("p") - 8) / 2).cast("int")
    at = lambda i, k: F.get("p", F.lit(8) + i * 2 + k).cast("int")
    track = F.transform(
        F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(at(i, 0).alias("image_id"), at(i, 1).alias("point2d_idx")),
    )
    return _lines(spark, path).select(
        "scene", p(0, "long").alias("point_id"), *[p(i + 1, "double").alias(a) for i, a in enumerate("xyz")],
        *[p(i + 4, "short").alias(c) for i, c in enumerate("rgb")], p(7, "double").alias("error"), track.alias("track"),
    )


def observations(points: DataFrame) -> DataFrame:
    return points.select("scene", "point_id", F.explode("track").alias("o")).select("scene", "point_id", "o.*")


def _camera_records(content: bytes) -> list[tuple]:
    n, off, out = struct.unpack_from("<Q", content)[0], 8, []
    for _ in range(n):
        cid, mid, w, h = struct.unpack_from("<iiQQ", content, off)
        name, k = MODEL_IDS.get(mid, ("PINHOLE", 4))
        out.append((cid, name, w, h, list(struct.unpack_from(f"<{k}d", content, off + 24))))
        off += 24 + 8 * k
    return out


def _binary(spark: SparkSession, path: str, records, names: list[str], schema: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select(scene_of(F.col("path")).alias("scene"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for scene, content in zip(pdf["scene"], pdf["content"]):
                out = pd.DataFrame(records(content), columns=names)
                out.insert(0, "scene", scene)
                yield out

    return files.mapInPandas(run, f"scene string, {schema}")


def read_cameras_binary(spark: SparkSession, path: str) -> DataFrame:
    """cameras.bin with 64-bit sizes, as the public format defines."""
    return _binary(spark, path, _camera_records, ["camera_id", "model", "width", "height", "params"],
                   "camera_id int, model string, width long, height long, params array<double>")


def _image_index(f: BinaryIO) -> Iterator[tuple[int, int]]:
    """Places of image records: a head of 64 bytes, a name that ends with a zero byte, a count, 24 bytes an observation."""
    n, off = struct.unpack("<Q", f.read(8))[0], 8
    for _ in range(n):
        f.seek(off + 64)
        name = f.read(256)
        while (end := name.find(b"\0")) < 0 or len(name) < end + 9:
            more = f.read(256)
            if not more:
                raise ValueError("image record without an end")
            name += more
        last = off + 64 + end + 9 + 24 * struct.unpack_from("<Q", name, end + 1)[0]
        yield off, last
        off = last


def _image_batches(f: BinaryIO, n: int) -> Iterator[pa.RecordBatch]:
    for a in range(0, n, 200):
        heads, names, points = [], [], []
        for _ in range(min(200, n - a)):
            heads.append(struct.unpack("<i7di", f.read(64)))
            name = bytearray()
            while (c := f.read(1)) != b"\0":
                name += c
            names.append(name.decode("utf-8", "replace"))
            points.append(np.frombuffer(f.read(24 * struct.unpack("<Q", f.read(8))[0]), np.dtype([("x", "<f8"), ("y", "<f8"), ("point_id", "<i8")])))
        flat = np.concatenate(points)
        entries = pa.StructArray.from_arrays([pa.array(flat[c]) for c in ("x", "y", "point_id")], ["x", "y", "point_id"])
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, points)]), pa.int32()), entries)
        types = [pa.int32(), *[pa.float64()] * 7, pa.int32()]
        yield pa.RecordBatch.from_arrays([*[pa.array([h[k] for h in heads], t) for k, t in enumerate(types)], pa.array(names), lists], [*IMAGE_NAMES, "points2d"])


IMAGE_NAMES = ["image_id", "qw", "qx", "qy", "qz", "tx", "ty", "tz", "camera_id", "name"]


def read_images_binary(spark: SparkSession, path: str, observations: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """images.bin, large files in ranges of records; ``observations`` as in ``read_images``."""
    schema = "image_id int, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id int, name string, points2d array<struct<x:double,y:double,point_id:bigint>>"
    rows = ranged_records(spark, path, _image_index, _image_batches, schema, range_bytes)
    return rows.select(scene_of(F.col("path")).alias("scene"), *IMAGE_NAMES, *(["points2d"] if observations else []))


def _point_index(f: BinaryIO) -> Iterator[tuple[int, int]]:
    """Places of point records: 51 bytes that end with a count, then 8 bytes per observation of the track."""
    n, off = struct.unpack("<Q", f.read(8))[0], 8
    data, at = b"", 8  # what was read, from place ``at`` on
    for _ in range(n):
        if off + 51 > at + len(data):
            f.seek(off)
            data, at = f.read(4 << 20), off
            if len(data) < 51:
                raise ValueError("point record without an end")
        last = off + 51 + 8 * struct.unpack_from("<Q", data, off - at + 43)[0]
        yield off, last
        off = last


def _point_batches(f: BinaryIO, n: int) -> Iterator[pa.RecordBatch]:
    for a in range(0, n, 5000):
        heads, tracks = [], []
        for _ in range(min(5000, n - a)):
            *head, k = struct.unpack("<Q3d3BdQ", f.read(51))
            heads.append(head)
            tracks.append(np.frombuffer(f.read(8 * k), np.int32).reshape(-1, 2))
        flat = np.concatenate(tracks)
        entries = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["image_id", "point2d_idx"])
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, tracks)]), pa.int32()), entries)
        types = [pa.int64(), *[pa.float64()] * 3, *[pa.int16()] * 3, pa.float64()]
        yield pa.RecordBatch.from_arrays([*[pa.array([h[k] for h in heads], t) for k, t in enumerate(types)], lists], [*POINT_NAMES, "track"])


POINT_NAMES = ["point_id", "x", "y", "z", "r", "g", "b", "error"]


def read_points_binary(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """points3D.bin with the columns of ``read_points``, large files in ranges of records."""
    schema = "point_id long, x double, y double, z double, r short, g short, b short, error double, track array<struct<image_id:int,point2d_idx:int>>"
    rows = ranged_records(spark, path, _point_index, _point_batches, schema, range_bytes)
    return rows.select(scene_of(F.col("path")).alias("scene"), *POINT_NAMES, "track")


def write_model_text(images: DataFrame, points: DataFrame, path: str) -> None:
    """images and points3D as text, one folder per scene; each image is followed by its empty observation line."""
    nums = lambda cols: [F.col(c).cast("string") for c in cols]
    img = F.concat(F.concat_ws(" ", *nums(("image_id", "qw", "qx", "qy", "qz", "tx", "ty", "tz", "camera_id")), F.col("name")), F.lit("\n"))
    images.select("scene", img.alias("value")).write.mode("overwrite").partitionBy("scene").text(f"{path}/images")
    pairs = F.array_join(F.transform("track", lambda t: F.concat_ws(" ", t["image_id"].cast("string"), t["point2d_idx"].cast("string"))), " ")
    pt = F.concat_ws(" ", *nums(("point_id", "x", "y", "z", "r", "g", "b", "error")), pairs)
    points.select("scene", pt.alias("value")).write.mode("overwrite").partitionBy("scene").text(f"{path}/points3D")

"""Reconstruction models back to files: one text or binary model per scene, laid down by a data source writer with a commit step."""

from __future__ import annotations

import os
import struct
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from scenequarry.functions import vectors as V
from scenequarry.functions.cameras import camera_centre
from scenequarry.operators.scale import attach
from scenequarry.sources.models import MODEL_IDS
from scenequarry.sources.ranges import local_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tables of a model, with the column that orders their records.
TABLES = {"cameras": "camera_id", "images": "image_id", "points3D": "point_id"}
_NUMBERS = {name: k for k, (name, _) in MODEL_IDS.items()}
_POSE = ("qw", "qx", "qy", "qz", "tx", "ty", "tz")


def transform_model(images: DataFrame, points: DataFrame, transforms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Poses and points after the scene's transform: ``transforms`` has scene and m, a row-major 4 x 4 matrix.

    The matrix turns, shifts and scales evenly. Camera centres and points move with it, cameras turn with it; scenes without
    a matrix stay as they are. All other columns stay.
    """
    one = F.array(*[F.lit(float(i % 5 == 0)) for i in range(16)])
    dim = transforms.select("scene", F.col("m").cast("array<double>").alias("_m"))

    def with_matrix(df: DataFrame) -> DataFrame:
        return attach(df, dim, ["scene"], "left").withColumn("_m", F.coalesce("_m", one))

    m = lambda i, j: F.get("_m", F.lit(4 * i + j))
    scale = F.sqrt(m(0, 0) * m(0, 0) + m(1, 0) * m(1, 0) + m(2, 0) * m(2, 0))
    q, t = V.cols(*_POSE[:4]), V.cols(*_POSE[4:])
    own = V.quat_matrix(q)
    turned = [[sum((own[i][k] * m(j, k) for k in range(3)), F.lit(0.0)) / scale for j in range(3)] for i in range(3)]
    moved = with_matrix(images).withColumn("_c", F.array(*V.mat4_point(F.col("_m"), camera_centre(q, t)))).withColumn("_r", F.array(*[F.array(*row) for row in turned]))
    r = [[F.get(F.get("_r", F.lit(i)), F.lit(j)) for j in range(3)] for i in range(3)]
    c = [F.get("_c", F.lit(i)) for i in range(3)]
    pose = dict(zip(_POSE, [*V.matrix_quat(r), *[-(r[i][0] * c[0] + r[i][1] * c[1] + r[i][2] * c[2]) for i in range(3)]], strict=True))
    placed = with_matrix(points)
    place = dict(zip("xyz", V.mat4_point(F.col("_m"), V.cols("x", "y", "z")), strict=True))
    return moved.withColumns(pose).select(*images.columns), placed.withColumns(place).select(*points.columns)


def write_model(cameras: DataFrame, images: DataFrame, points: DataFrame, path: str, binary: bool = False) -> None:
    """One model per scene under ``path``/scene: cameras, images with their 2-D observations, points with their tracks.

    Files are ``.txt`` or ``.bin`` and hold their records in order of id. The format wants one file per table and scene, so
    a scene's table is one sorted stream through one task, record by record; different scenes are written side by side.
    Tasks write under names of their own; only the commit step gives the files of the tasks that succeeded their final
    names, so a repeated or failed task leaves nothing behind. Images may lack ``points2d``, which counts as empty.
    """
    spark = cameras.sparkSession
    spark.dataSource.register(ModelSource)
    for (table, key), df in zip(TABLES.items(), (cameras, images, points), strict=True):
        if table == "images" and "points2d" not in df.columns:
            df = df.withColumn("points2d", F.array().cast("array<struct<x:double,y:double,point_id:bigint>>"))
        if binary:
            df = attach(df, df.groupBy("scene").agg(F.count("*").alias("_count")), ["scene"])
        rows = df.repartition("scene").sortWithinPartitions("scene", key)
        rows.write.format("scene_model").mode("append").options(path=path, table=table, binary=str(binary)).save()


class ModelSource(DataSource):
    """Sink ``scene_model``; options path, table and binary."""

    @classmethod
    def name(cls) -> str:
        return "scene_model"

    def writer(self, schema, overwrite: bool) -> ModelWriter:
        return ModelWriter(self.options["path"], self.options["table"], self.options["binary"] == "True")


@dataclass
class Written(WriterCommitMessage):
    """(name while writing, final name) of each file of a task."""

    files: list[tuple[str, str]]


class ModelWriter(DataSourceWriter):
    def __init__(self, path: str, table: str, binary: bool) -> None:
        self.path, self.table, self.binary = path, table, binary

    def write(self, iterator: Iterator[Row]) -> Written:
        files: list[tuple[str, str]] = []
        out, scene = None, None
        record = RECORDS[self.table][self.binary]
        for r in iterator:
            if out is None or r.scene != scene:
                if out:
                    out.close()
                scene = r.scene
                final = f"{self.path}/{scene}/{self.table}.{'bin' if self.binary else 'txt'}"
                files.append((f"{self.path}/{scene}/.{self.table}-{uuid.uuid4().hex}", final))
                out = _create(files[-1][0])
                if self.binary:
                    out.write(struct.pack("<Q", r["_count"]))
            out.write(record(r))
        if out:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        for m in messages:
            for name, final in m.files if m else []:
                _move(name, final)

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            for name, _ in m.files if m else []:
                _remove(name)


def _store(name: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(name.replace("s3a://", "s3://", 1))


def _create(name: str):
    if (local := local_path(name)) is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    system, path = _store(name)
    return system.open_output_stream(path)


def _move(name: str, final: str) -> None:
    if (local := local_path(name)) is not None:
        os.replace(local, local_path(final))
    else:
        (system, a), (_, b) = _store(name), _store(final)
        system.move(a, b)


def _remove(name: str) -> None:
    if (local := local_path(name)) is not None:
        os.path.exists(local) and os.unlink(local)
    else:
        system, path = _store(name)
        system.delete_file(path)


def _cameras_line(r: Row) -> bytes:
    return f"{r.camera_id} {r.model} {r.width} {r.height} {' '.join(map(repr, r.params))}\n".encode()


def _cameras_bytes(r: Row) -> bytes:
    return struct.pack(f"<iiQQ{len(r.params)}d", r.camera_id, _NUMBERS[r.model], r.width, r.height, *r.params)


def _images_line(r: Row) -> bytes:
    head = " ".join(map(repr, (r[c] for c in _POSE)))
    return f"{r.image_id} {head} {r.camera_id} {r.name}\n{' '.join(f'{p.x!r} {p.y!r} {p.point_id}' for p in r.points2d)}\n".encode()


def _images_bytes(r: Row) -> bytes:
    points = b"".join(struct.pack("<ddq", p.x, p.y, p.point_id) for p in r.points2d)
    return struct.pack("<i7di", r.image_id, *(r[c] for c in _POSE), r.camera_id) + r.name.encode() + b"\0" + struct.pack("<Q", len(r.points2d)) + points


def _points_line(r: Row) -> bytes:
    track = "".join(f" {t.image_id} {t.point2d_idx}" for t in r.track)
    return f"{r.point_id} {r.x!r} {r.y!r} {r.z!r} {r.r} {r.g} {r.b} {r.error!r}{track}\n".encode()


def _points_bytes(r: Row) -> bytes:
    track = b"".join(struct.pack("<ii", t.image_id, t.point2d_idx) for t in r.track)
    return struct.pack("<Q3d3BdQ", r.point_id, r.x, r.y, r.z, r.r, r.g, r.b, r.error, len(r.track)) + track


#: Text and binary form of each table's records.
RECORDS = {"cameras": (_cameras_line, _cameras_bytes), "images": (_images_line, _images_bytes), "points3D": (_points_line, _points_bytes)}

"""Truncated signed distance fusion of depth frames into sparse voxels."""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenequarry.functions.cameras import VIEW_MATRIX, with_view_matrix
from scenequarry.functions.vectors import dot
from scenequarry.operators.scale import BROADCAST_ROWS, attach
from scenequarry.session import cut

# executors get the batch functions by value and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = ("depth", "weight", "r", "g", "b")
VIEW = (*VIEW_MATRIX, "tx", "ty", "tz", "fx", "fy", "cx", "cy", "width", "height")
#: Views whose pixels one task packs.
VIEWS_PER_TASK = 200


def candidate_voxels(depth: DataFrame, views: DataFrame, voxel: float, trunc: float) -> DataFrame:
    """Voxels within the truncation band of any depth point (axis-wise), from back-projected pixels.

    Pixels collapse to distinct surface voxels before the band is exploded, so the fan-out is per surface voxel.
    """
    v = attach(depth.filter("depth > 0"), with_view_matrix(views), ["scene_id", "image_id"], rows=views.count())
    d = F.col("depth")
    cam = [(F.col("px_col") + 0.5 - F.col("cx")) / F.col("fx") * d - F.col("tx"), (F.col("px_row") + 0.5 - F.col("cy")) / F.col("fy") * d - F.col("ty"),
           d - F.col("tz")]
    v = v.withColumns({f"_c{i}": c for i, c in enumerate(cam)})
    c = [F.col(f"_c{i}") for i in range(3)]
    world = [dot([F.col(f"_r{i}{j}") for i in range(3)], c) for j in range(3)]
    base = v.select("scene_id", *[F.floor(w / voxel).alias(n) for w, n in zip(world, ("ix", "iy", "iz"))]).distinct()
    m = math.ceil(trunc / voxel)
    for n in ("ix", "iy", "iz"):
        base = base.withColumn(n, F.explode(F.sequence(F.col(n) - m, F.col(n) + m)))
        base = base.distinct()
    return base


def _ends(b: pa.RecordBatch, columns: tuple[str, ...]) -> list[int]:
    """Where the values of these columns change."""
    codes = np.stack([b.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in columns])
    return [*(np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(0)) + 1).tolist(), b.num_rows]


def _picture(px: pa.Table) -> tuple[bytes, bytes, int, int]:
    """Samples in the order of their pixels, a bit for each missing one, and the place where the list of each pixel begins."""
    row, col = (px.column(c).to_numpy().astype(np.int64) for c in ("px_row", "px_col"))
    rows, cols = int(row.max()) + 1, int(col.max()) + 1
    cell = row * cols + col
    by = np.argsort(cell, kind="stable")
    begin = np.r_[0, np.cumsum(np.bincount(cell, minlength=rows * cols))].astype(np.int32)
    values = np.stack([px.column(c).to_numpy()[by] for c in SAMPLE])
    values[0][np.isnan(values[0])] = np.inf  # no number is beyond all others
    there = np.stack([px.column(c).is_valid().to_numpy()[by] for c in SAMPLE[2:]])
    held = values.tobytes() + (b"" if there.all() else there.tobytes())
    return zlib.compress(held, 1), zlib.compress(begin.tobytes(), 1), rows, cols


def packed_depth(depth: DataFrame, parts: int) -> DataFrame:
    """(scene_id, image_id, samples, begin, rows, cols): the samples of each image, packed; a task holds one image unpacked."""
    kept = depth.filter("depth > 0 AND px_row >= 0 AND px_col >= 0 AND weight IS NOT NULL AND scene_id IS NOT NULL AND image_id IS NOT NULL")
    px = kept.select("scene_id", "image_id", *[F.col(c).cast("int").alias(c) for c in ("px_row", "px_col")], *[F.col(c).cast("double").alias(c) for c in SAMPLE])
    px = px.repartition(parts, "scene_id", "image_id").sortWithinPartitions("scene_id", "image_id")
    kinds = {c: px.schema[c].dataType.simpleString() for c in ("scene_id", "image_id")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def told() -> pa.RecordBatch:
            made = _picture(pa.Table.from_batches(held).combine_chunks())
            packed = [pa.array([x], k) for x, k in zip(made, (pa.binary(), pa.binary(), pa.int32(), pa.int32()), strict=True)]
            return pa.RecordBatch.from_arrays([*(held[0].column(i).slice(0, 1) for i in range(2)), *packed], ["scene_id", "image_id", "samples", "begin", "rows", "cols"])

        for b in batches:
            if not b.num_rows:
                continue
            ends = _ends(b, ("scene_id", "image_id"))
            for lo, hi in zip([0, *ends], ends, strict=False):
                part = b.slice(lo, hi - lo)
                if held and any(held[0].column(i)[0] != part.column(i)[0] for i in range(2)):
                    yield told()
                    held.clear()
                held.append(part)
        if held:
            yield told()

    return px.mapInArrow(run, f"scene_id {kinds['scene_id']}, image_id {kinds['image_id']}, samples binary, begin binary, rows int, cols int")


class _Sums:
    """Voxels of one block and what views have added to them."""

    def __init__(self, voxel: float, trunc: float) -> None:
        self.voxel, self.trunc = voxel, trunc
        self.held: list[pa.RecordBatch] = []
        self.ids: pa.Table | None = None

    def add(self, part: pa.RecordBatch) -> None:
        """The samples of these views, one after the other."""
        if self.ids is None:
            self.ids = pa.Table.from_batches(self.held).combine_chunks()
            self.center = [(self.ids.column(c).to_numpy() + 0.5) * self.voxel for c in ("ix", "iy", "iz")]
            self.sums = np.zeros((5, self.ids.num_rows))
            self.there = np.zeros((4, self.ids.num_rows), bool)  # any sample, then those with a colour
        for view, samples, begin, rows, cols in zip(*(part.column(c).to_pylist() for c in ("view", "samples", "begin", "rows", "cols")), strict=True):
            self.one(np.array(view, np.float64), zlib.decompress(samples), np.frombuffer(zlib.decompress(begin), np.int32), rows, cols)

    def one(self, v: np.ndarray, samples: bytes, begin: np.ndarray, rows: int, cols: int) -> None:
        x, y, z = self.center
        cam = lambda i: x * v[3 * i] + y * v[3 * i + 1] + z * v[3 * i + 2] + v[9 + i]
        with np.errstate(all="ignore"):
            depth = cam(2)
            front = np.flatnonzero(depth > 0)
            x, y, z, depth = x[front], y[front], z[front], depth[front]
            a, b = v[12] * cam(0) / depth + v[14], v[13] * cam(1) / depth + v[15]
            # beyond the marked rows and columns there are no samples
            seen = np.flatnonzero((a >= 0) & (a < v[16] - 1) & (a < cols) & (b >= 0) & (b < v[17] - 1) & (b < rows))
            cell = np.floor(b[seen]).astype(np.int64) * cols + np.floor(a[seen]).astype(np.int64)
            first = begin[cell].astype(np.int64)
            many = begin[cell + 1] - first
            run = np.repeat(np.arange(len(cell)), many)
            place = np.repeat(first, many) + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
            n = int(begin[-1])
            values = np.frombuffer(samples, np.float64, 5 * n).reshape(5, n)[:, place]
            sdf = values[0] - depth[seen[run]]
            hit = np.flatnonzero(sdf >= -self.trunc)
            at, values = front[seen[run[hit]]], values[:, hit]
            w = values[1]
            adds = [w * np.maximum(-1.0, np.minimum(1.0, sdf[hit] / self.trunc)), w, *(w * c for c in values[2:])]
        self.there[0, at] = True
        if len(samples) > 40 * n:
            known = np.frombuffer(samples, bool, offset=40 * n).reshape(3, n)[:, place[hit]]
        else:
            known = np.ones((3, len(at)), bool)
        once = not len(many) or many.max() <= 1
        for i, add in enumerate(adds):
            some, amount = (at, add) if i < 2 else (at[known[i - 2]], add[known[i - 2]])
            if i > 1:
                self.there[i - 1, some] = True
            if once:
                self.sums[i, some] += amount
            else:
                np.add.at(self.sums[i], some, amount)

    def told(self) -> Iterator[pa.RecordBatch]:
        if self.ids is None:
            return
        some = np.flatnonzero(self.there[0])
        sums = [pa.array(s[some]) if i < 2 else pa.array(s[some], mask=~self.there[i - 1, some]) for i, s in enumerate(self.sums)]
        ids = self.ids.take(pa.array(some)).combine_chunks()
        arrays = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in ids.columns]
        yield pa.RecordBatch.from_arrays([*arrays, *sums], ["scene_id", "ix", "iy", "iz", "_t", "_w", "_r", "_g", "_b"])


def integrate(voxels: DataFrame, depth: DataFrame, views: DataFrame, voxel: float, trunc: float, batch: int = BROADCAST_ROWS) -> DataFrame:
    """Fuse all views into the voxels: tsdf, weight and colour as weighted means.

    ``depth``: scene_id, image_id, px_row, px_col, depth, r, g, b in [0, 1], weight. A running weighted mean equals the ratio of sums, so
    views combine in any order. Free space counts with the clipped value 1; only points more than ``trunc`` behind are left out.

    Pictures are packed, one row per view. Blocks of ``batch`` voxels meet groups of views, as many as give all tasks work: a task
    holds one block with its sums and one unpacked picture, and reads the pixels by index where views and voxels meet.
    """
    spark = voxels.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = packed_depth(depth, max(tasks, -(-views.count() // VIEWS_PER_TASK)))
    view = with_view_matrix(views).select("scene_id", "image_id", F.array(*[F.col(c).cast("double") for c in VIEW]).alias("view"))
    seen = cut(view.join(packed.hint("merge"), ["scene_id", "image_id"]))
    voxels = cut(voxels.select("scene_id", "ix", "iy", "iz").filter("scene_id IS NOT NULL"))
    sizes = cut(voxels.groupBy("scene_id").agg(F.ceil(F.count(F.lit(1)) / batch).cast("int").alias("_blocks")))
    blocks = sizes.agg(F.sum("_blocks")).first()[0] or 1
    groups = -(-tasks // blocks)
    deal = lambda n, *by: F.pmod(F.xxhash64(*by), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = attach(voxels, sizes, ["scene_id"]).withColumn("block", deal(F.col("_blocks"), "scene_id", "ix", "iy", "iz")).withColumn("part", each(F.lit(groups)))
    copies = attach(seen, sizes, ["scene_id"]).withColumn("part", deal(F.lit(groups), "scene_id", "image_id")).withColumn("block", each(F.col("_blocks")))
    rows = dealt.drop("_blocks").withColumn("is_view", F.lit(False)).unionByName(copies.drop("_blocks", "image_id").withColumn("is_view", F.lit(True)), allowMissingColumns=True)
    rows = rows.repartition(max(tasks, blocks * groups), "scene_id", "block", "part").sortWithinPartitions("scene_id", "block", "part", "is_view")
    kinds = ", ".join(f"{c} {voxels.schema[c].dataType.simpleString()}" for c in voxels.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, at = None, None
        for b in batches:
            if not b.num_rows:
                continue
            ends = _ends(b, ("scene_id", "block", "part", "is_view"))
            for lo, hi in zip([0, *ends], ends, strict=False):
                part = b.slice(lo, hi - lo)
                key = tuple(part.column(c)[0].as_py() for c in ("scene_id", "block", "part"))
                if key != at:
                    if sums:
                        yield from sums.told()
                    sums, at = _Sums(voxel, trunc), key
                if not part.column("is_view")[0].as_py():
                    sums.held.append(part.select(["scene_id", "ix", "iy", "iz"]))
                elif sums.held:  # a block of few voxels may have none
                    sums.add(part)
        if sums:
            yield from sums.told()

    hit = cut(rows.mapInArrow(run, f"{kinds}, _t double, _w double, _r double, _g double, _b double"))
    g = hit.groupBy("scene_id", "ix", "iy", "iz").agg(F.sum("_t").alias("_t"), F.sum("_w").alias("weight"), *[F.sum(f"_{c}").alias(f"_{c}") for c in "rgb"])
    safe = F.greatest(F.col("weight"), F.lit(1e-8))
    return g.filter("weight > 0").select(
        "scene_id", "ix", "iy", "iz", (F.col("_t") / safe).alias("tsdf"), "weight", *[(F.col(f"_{c}") / safe).alias(c) for c in "rgb"]
    )


def observed(voxels: DataFrame, min_weight: float = 2.0) -> DataFrame:
    """Voxels of weight above the consensus limit; a scene without any keeps all its voxels of positive weight."""
    top = voxels.groupBy("scene_id").agg(F.max("weight").alias("_w"))
    j = attach(voxels, top, ["scene_id"])
    keep = F.when(F.col("_w") > min_weight, F.col("weight") > min_weight).otherwise(F.col("weight") > 0)
    return j.filter(keep).drop("_w")

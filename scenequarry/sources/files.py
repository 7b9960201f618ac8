"""Readers and writers for splat, camera-transform, clip, metric, trace, locale and image files, and file listings."""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenequarry.session import cut

from scenequarry.operators.scale import attach, rank_rows
from scenequarry.sources.models import scene_of
from scenequarry.sources.ranges import RANGE_BYTES, in_tasks, listed_files, numbered_lines, open_path, same_path

# executors get the batch readers by value and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ------------------------------------------------------------------ splat tables

PLY_TYPES = {
    "char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "i2", "int16": "i2", "ushort": "u2", "uint16": "u2",
    "int": "i4", "int32": "i4", "uint": "u4", "uint32": "u4", "float": "f4", "float32": "f4", "double": "f8", "float64": "f8",
}
CHUNK = 200_000
SPLAT_COLUMNS = ("x", "y", "z", "opacity_raw", "s0", "s1", "s2", "qw", "qx", "qy", "qz", "c0", "c1", "c2")
PLY_NAMES = ("x", "y", "z", "opacity", "scale_0", "scale_1", "scale_2", "rot_0", "rot_1", "rot_2", "rot_3", "f_dc_0", "f_dc_1", "f_dc_2")


def ply_head(f: BinaryIO) -> dict:
    """What the header of a PLY file declares: format, vertex rows and fields, and where they begin (bytes and lines)."""
    data = b""
    while (end := data.find(b"end_header")) < 0 or b"\n" not in data[end:]:
        more = f.read(1 << 16)
        if not more:
            raise ValueError("no PLY header")
        data += more
    start = data.index(b"\n", end) + 1
    lines = [w for w in (line.split() for line in data[:start].decode("ascii", "replace").splitlines()) if w]
    head = {"fmt": "", "count": 0, "fields": [], "start": start, "lines": len(lines)}
    order, element, before = "<", None, []
    for w in lines:
        if w[0] == "format":
            head["fmt"], order = w[1], ">" if w[1] == "binary_big_endian" else "<"
        elif w[0] == "element":
            element = w[1]
            if element == "vertex":
                head["count"] = int(w[2])
                head["start"] += sum(n * size for n, size in before)
                head["lines"] += sum(n for n, _ in before)
            else:
                before.append([int(w[2]), 0])
        elif w[0] == "property":
            if element == "vertex":
                if w[1] == "list":
                    raise ValueError("list properties are not expected on vertices")
                head["fields"].append([w[2], order + PLY_TYPES[w[1]]])
            elif w[1] != "list":
                before[-1][1] += np.dtype(PLY_TYPES[w[1]]).itemsize
            elif not head["fields"] and head["fmt"] != "ascii":
                raise ValueError("list properties are not expected before vertices")
    at = {n: i for i, (n, _) in enumerate(head["fields"])}
    rest = sorted((n for n in at if n.startswith("f_rest_")), key=lambda n: int(n.rsplit("_", 1)[1]))
    k = len(rest) // 3
    # places of fields in a row; coefficients come channel by channel and go out as triples
    head["own"], head["rgb"] = [at.get(n, -1) for n in PLY_NAMES], [at.get(n, -1) for n in ("red", "green", "blue")]
    head["rest"] = [at[rest[c * k + i]] for i in range(k) for c in range(3)]
    return head


_SPLAT_SCHEMA = f"scene string, splat_id long, {', '.join(f'{c} double' for c in SPLAT_COLUMNS)}, shn array<double>, r short, g short, b short"


def read_splats(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All PLY files under ``path``: scene (folder), splat_id (row in file), the splat columns, shn, and r g b for plain clouds.

    Headers are read once per file. Binary files are read in ranges of rows of about ``range_bytes``, each by its own task;
    ascii files are split by Spark at line ends. The rows are the same for any size of ranges. Colours default to white.
    Write the result partitioned by scene before use.
    """

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                with open_path(p) as f:
                    h = ply_head(f)
                width = np.dtype([tuple(x) for x in h["fields"]]).itemsize
                row = {"path": p, "width": width, **h, "fields": [{"name": n, "type": t} for n, t in h["fields"]]}
                yield pa.RecordBatch.from_pylist([row], schema)

    ints = pa.list_(pa.int32())
    schema = pa.schema([("path", pa.string()), ("width", pa.int64()), ("fmt", pa.string()), ("count", pa.int64()), ("start", pa.int64()), ("lines", pa.int64()), ("fields", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))), ("own", ints), ("rgb", ints), ("rest", ints)])
    told = cut(listed_files(spark, path, "*.ply").select("path").mapInArrow(heads, "path string, width long, fmt string, count long, start long, lines long, fields array<struct<name:string,type:string>>, own array<int>, rgb array<int>, rest array<int>"))
    return _binary_splats(told.filter("fmt <> 'ascii'"), range_bytes).unionByName(_ascii_splats(spark, told.filter("fmt = 'ascii'")))


def _binary_splats(heads: DataFrame, range_bytes: int) -> DataFrame:
    rows = F.greatest(F.lit(1), F.floor(F.lit(range_bytes) / F.greatest("width", F.lit(1))))
    ranges = heads.filter("count > 0").withColumn("rows", rows).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.col("rows"))))
    ranges = ranges.select("path", scene_of(F.col("path")).alias("scene"), "fields", "own", "rgb", "rest", (F.col("start") + F.col("first") * F.col("width")).alias("at"), "first", F.least("rows", F.col("count") - F.col("first")).alias("n"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (r for b in batches for r in b.to_pylist()):
            dtype = np.dtype([(x["name"], x["type"]) for x in r["fields"]])
            with open_path(r["path"]) as f:
                f.seek(r["at"])
                for a in range(0, r["n"], CHUNK):
                    c = np.frombuffer(f.read(min(CHUNK, r["n"] - a) * dtype.itemsize), dtype)
                    n = len(c)
                    field = lambda k: c[dtype.names[k]].astype(np.float64)  # noqa: B023, E731
                    columns = [pa.array([r["scene"]] * n, pa.string()), pa.array(np.arange(n) + r["first"] + a)]
                    columns += [pa.array(field(k)) if k >= 0 else pa.nulls(n, pa.float64()) for k in r["own"]]
                    many = np.stack([field(k) for k in r["rest"]], 1).ravel() if r["rest"] else None
                    columns.append(pa.nulls(n, pa.list_(pa.float64())) if many is None else pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(r["rest"]), pa.int32()), pa.array(many)))
                    columns += [pa.array(field(k).astype(np.int16) if k >= 0 else np.full(n, 255, np.int16)) for k in r["rgb"]]
                    yield pa.RecordBatch.from_arrays(columns, ["scene", "splat_id", *SPLAT_COLUMNS, "shn", "r", "g", "b"])

    return in_tasks(ranges).mapInArrow(read, _SPLAT_SCHEMA)


def _ascii_splats(spark: SparkSession, heads: DataFrame) -> DataFrame:
    paths = [r.path for r in heads.select("path").toLocalIterator()]  # as many names as Spark lists to read them
    if not paths:
        return spark.createDataFrame([], _SPLAT_SCHEMA)
    lines = numbered_lines(spark, paths, lambda v: F.trim(v) != "")
    rows = attach(lines, heads.select(same_path(F.col("path")).alias("file"), "count", "lines", "own", "rgb", "rest"), ["file"]).filter((F.col("line") >= F.col("lines")) & (F.col("line") < F.col("lines") + F.col("count")))
    rows = rows.withColumn("p", F.split(F.trim("value"), r"\s+"))
    at = lambda places, i: F.get(F.col("p"), F.get(F.col(places), F.lit(i))).cast("double")
    return rows.select(
        scene_of(F.col("file")).alias("scene"), (F.col("line") - F.col("lines")).alias("splat_id"), *[F.when(F.get("own", F.lit(i)) >= 0, at("own", i)).alias(c) for i, c in enumerate(SPLAT_COLUMNS)],
        F.when(F.size("rest") > 0, F.transform("rest", lambda k: F.get(F.col("p"), k).cast("double"))).alias("shn"),
        *[F.when(F.get("rgb", F.lit(i)) >= 0, at("rgb", i)).otherwise(F.lit(255.0)).cast("short").alias(c) for i, c in enumerate("rgb")],
    )


def write_objects(splats: DataFrame, labels: DataFrame, path: str, min_count: int = 10) -> None:
    """One folder per scene and label; objects below ``min_count`` rows are left out, the background is always kept."""
    from scenequarry.operators.scale import attach

    j = splats.join(labels.select("scene_id", "splat_id", "label"), ["scene_id", "splat_id"])
    n = j.groupBy("scene_id", "label").agg(F.count(F.lit(1)).alias("_n"))
    kept = n.filter((F.col("label") == 0) | (F.col("_n") >= min_count)).select("scene_id", "label")
    named = attach(j, kept, ["scene_id", "label"], "left_semi").withColumn(
        "object", F.when(F.col("label") == 0, "background").otherwise(F.format_string("object_%03d", "label"))
    )
    named.write.mode("overwrite").partitionBy("scene_id", "object").parquet(path)


def write_summary(labelled: DataFrame, path: str, min_count: int = 10) -> None:
    """JSON summary per scene: totals and the object list."""
    from scenequarry.operators.aggregates import object_summary

    s = object_summary(labelled, min_count)
    objects = s.filter("label <> 0").groupBy("scene_id").agg(
        F.array_sort(F.collect_list(F.struct("label", "n", "cx", "cy", "cz"))).alias("objects")
    )
    totals = labelled.groupBy("scene_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("label") != 0).alias("labelled"), F.count_if(F.col("label") == 0).alias("background")
    )
    out = totals.join(objects, "scene_id", "left").withColumn("num_objects", F.coalesce(F.size("objects"), F.lit(0)))
    out.write.mode("overwrite").json(path)


def write_hierarchy(lod_rows: DataFrame, merge_nodes: DataFrame, path: str) -> None:
    """Levels partitioned by lod, lineage beside them; node ids are 64-bit."""
    lod_rows.write.mode("overwrite").partitionBy("lod").parquet(f"{path}/lod_rows")
    merge_nodes.write.mode("overwrite").parquet(f"{path}/merge_nodes")


def read_hierarchy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/lod_rows"), spark.read.parquet(f"{path}/merge_nodes")


# ------------------------------------------------------------------ json sources

FRAME = "struct<file_path:string, transform_matrix:array<array<double>>>"
TRANSFORMS_SCHEMA = (
    "w int, h int, fl_x double, fl_y double, cx double, cy double, camera_angle_x double, camera_angle_y double, "
    f"camera_model string, frames array<{FRAME}>, _bad string"
)
DUMMY_FOCAL = 20.0


def read_transforms(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(cameras per frame, error rows). Focal lengths come from fl_x/fl_y or the view angles; without any the camera is

    equirectangular; a missing vertical focal needs a square image. Frames without a 4x4 matrix are errors.
    """
    raw = spark.read.schema(TRANSFORMS_SCHEMA).option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").json(path)
    raw = raw.withColumn("scene", scene_of(F.col("_metadata.file_path")))
    from_angle = lambda size, angle: F.col(size) / (F.lit(2.0) * F.tan(F.col(angle) / 2.0))
    fx = F.coalesce("fl_x", from_angle("w", "camera_angle_x"))
    fy = F.coalesce("fl_y", from_angle("h", "camera_angle_y"))
    none = fx.isNull() & fy.isNull()
    fisheye = F.col("camera_model").isin("FISHEYE", "OPENCV_FISHEYE")
    model = F.when((F.col("camera_model") == "EQUIRECTANGULAR") | none, "EQUIRECTANGULAR").when(fisheye, "FISHEYE").otherwise("PINHOLE")
    d = raw.select(
        "scene", "w", "h", model.alias("model"), F.coalesce(fx, F.when(none, F.lit(DUMMY_FOCAL))).alias("fx"),
        F.coalesce(fy, F.when(none, F.lit(DUMMY_FOCAL)), F.when(F.col("w") == F.col("h"), fx)).alias("fy"),
        F.coalesce("cx", F.col("w") / 2.0).alias("cx"), F.coalesce("cy", F.col("h") / 2.0).alias("cy"), "frames", "_bad",
    )
    reason = (
        F.when(F.col("_bad").isNotNull(), "malformed json").when(F.col("frames").isNull(), "no frames")
        .when(F.col("fy").isNull(), "no vertical focal length and the image is not square")
    )
    d = d.withColumn("error", reason)
    f = d.filter("error is null").select("scene", "w", "h", "model", "fx", "fy", "cx", "cy", F.posexplode("frames").alias("frame", "_f"))
    flat = F.flatten("_f.transform_matrix")
    f = f.select("scene", "frame", F.col("_f.file_path").alias("file_path"), flat.alias("matrix"), "w", "h", "model", "fx", "fy", "cx", "cy")
    ok = F.size("matrix") == 16
    bad = f.filter(~F.coalesce(ok, F.lit(False))).select("scene", F.col("file_path").alias("detail"), F.lit("frame without a 4x4 matrix").alias("error"))
    errors = d.filter("error is not null").select("scene", F.lit(None).cast("string").alias("detail"), "error").unionByName(bad)
    return f.filter(ok), errors


def read_split_list(spark: SparkSession, path: str) -> DataFrame:
    """One image name per line (train or validation list)."""
    return spark.read.text(path).select(F.trim("value").alias("name")).filter("name <> ''")


CLIP_SCHEMA = (
    "name string, tracks array<struct<id:int, type:string, target:string, "
    "keyframes:array<struct<time:double, easing:string, value:array<double>>>>>"
)


def read_clips(spark: SparkSession, path: str) -> DataFrame:
    """Keyframes of all clips: clip, target, type, t, easing, value. Of tracks with one target the first counts."""
    c = spark.read.schema(CLIP_SCHEMA).option("multiLine", True).json(path)
    t = c.select(F.coalesce("name", scene_of(F.col("_metadata.file_path"))).alias("clip"), F.posexplode("tracks").alias("_n", "_t"))
    t = t.filter(F.coalesce(F.col("_t.target"), F.lit("")) != "")
    first = t.groupBy("clip", F.col("_t.target").alias("target")).agg(F.min_by("_t", "_n").alias("_t"))
    k = first.select("clip", "target", F.coalesce("_t.type", F.lit("float")).alias("type"), F.explode("_t.keyframes").alias("k"))
    return k.select("clip", "target", "type", F.coalesce("k.time", F.lit(0.0)).alias("t"), F.coalesce("k.easing", F.lit("linear")).alias("easing"), "k.value")


def flatten_locale(spark: SparkSession, path: str) -> DataFrame:
    """Dotted keys of locale JSON files: lang (file stem), key, text. Keys that start with '_' and non-strings are skipped.

    Values keep their JSON types, so a string that looks like a number, a flag or an object is still a string. Objects are
    opened level by level until none is left. Files that are no JSON objects give no rows.
    """
    whole = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("lang"), F.lit("").alias("key"), F.col("value").alias("json")
    )
    level, found = whole, []
    while True:
        opened = level.withColumn("_m", F.try_parse_json("json")).filter(F.schema_of_variant("_m").startswith("OBJECT"))
        members = cut(_members(opened))
        found.append(members.filter("kind = 'STRING'").select("lang", "key", F.col("text")))
        level = members.filter("kind LIKE 'OBJECT%'").select("lang", "key", "json")
        if level.isEmpty():
            break
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _members(opened: DataFrame) -> DataFrame:
    """Members of the objects in ``_m``: lang, dotted key, kind of the value, its text and its JSON."""
    inner = opened.sparkSession.tvf.variant_explode(F.col("_m").outer()).select(F.col("key").alias("_k"), F.col("value").alias("_v"))
    j = opened.select("lang", "key", "_m").lateralJoin(inner).filter(F.col("_k").isNotNull() & ~F.col("_k").startswith("_"))
    return j.select(
        "lang", F.concat_ws(".", F.nullif("key", F.lit("")), "_k").alias("key"), F.schema_of_variant("_v").alias("kind"), F.try_variant_get("_v", "$", "string").alias("text"), F.to_json("_v").alias("json")
    )


# ------------------------------------------------------------------ logs

METRICS_SCHEMA = "iteration long, psnr double, ssim double, time_per_image double, num_gaussians long"
TRACE_SCHEMA = (
    "timestamp string, stage string, gpus array<struct<index:int, vram_used_mb:double, gpu_util_pct:double, power_w:double>>, "
    "system struct<ram_used_mb:double>"
)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(METRICS_SCHEMA).option("header", True).csv(path)
    return df.withColumn("run", scene_of(F.col("_metadata.file_path")))


def append_metrics(rows: DataFrame, path: str) -> None:
    rows.select("iteration", "psnr", "ssim", "time_per_image", "num_gaussians").write.mode("append").option("header", True).csv(path)


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    """One row per sample and GPU (samples without GPU stay)."""
    t = spark.read.schema(TRACE_SCHEMA).json(path)
    g = t.select(F.to_timestamp("timestamp").alias("ts"), "stage", F.explode_outer("gpus").alias("g"), F.col("system.ram_used_mb").alias("ram_mb"))
    return g.select("ts", "stage", F.col("g.index").alias("gpu"), F.col("g.vram_used_mb").alias("vram_mb"), F.col("g.gpu_util_pct").alias("gpu_util"),
                    F.col("g.power_w").alias("power_w"), "ram_mb")


def write_trace(trace: DataFrame, path: str) -> None:
    trace.write.mode("append").json(path)


# ------------------------------------------------------------------ listings and images


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, size and time of all files below ``path``; contents are never read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def list_sessions(spark: SparkSession, base: str) -> DataFrame:
    """Folders directly below ``base`` with the number of video files directly in them; folders without files count 0."""
    from scenequarry.operators.catalog import VIDEO_EXTENSIONS, extension

    root = spark._jvm.org.apache.hadoop.fs.Path(base)
    listing = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    folders = spark.createDataFrame([(f.getPath().getName(),) for f in listing if f.isDirectory()], "session_id string")
    files = list_files(spark, base).select(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("session_id"), F.regexp_extract("path", r"^(.*)/[^/]+/[^/]+$", 1).alias("_root"), "path")
    top = root.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(root).getPath().toUri().getPath()
    videos = files.filter(F.col("_root").endswith(top.rstrip("/")) & extension(F.col("path")).isin(*VIDEO_EXTENSIONS))
    counts = videos.groupBy("session_id").agg(F.count(F.lit(1)).alias("_n"))
    return folders.join(counts, "session_id", "left").select("session_id", F.coalesce("_n", F.lit(0)).alias("n_sets"))


def frame_listing(spark: SparkSession, path: str, glob: str = "*.{jpg,jpeg,png}") -> DataFrame:
    """Image files with session (folder) and frame_index by name order."""
    f = list_files(spark, path, glob).withColumn("session_id", scene_of(F.col("path")))
    return rank_rows(f, ["session_id"], ["path"], "_rn").withColumn("frame_index", F.col("_rn") - 1).drop("_rn")


def decode_gray(content: bytes) -> np.ndarray | None:
    """8-bit gray image of a portable graymap or NumPy file; other formats need a decoder of the caller."""
    if content[:6] == b"\x93NUMPY":
        import io

        return np.load(io.BytesIO(content), allow_pickle=False)
    m = re.match(rb"P5\s+(\d+)\s+(\d+)\s+255\s", content)
    if m:
        w, h = int(m[1]), int(m[2])
        return np.frombuffer(content, np.uint8, w * h, m.end()).reshape(h, w)
    return None


def _area_resize(img: np.ndarray, n: int) -> np.ndarray:
    """Area-weighted resize to n x n as two matrix products."""

    def weights(size: int) -> np.ndarray:
        edges = np.arange(n + 1) * size / n
        cell = np.arange(size)
        lo = np.maximum(edges[:-1, None], cell[None])
        hi = np.minimum(edges[1:, None], cell[None] + 1)
        w = np.clip(hi - lo, 0, None)
        return w / w.sum(1, keepdims=True)

    return weights(img.shape[0]) @ img.astype(float) @ weights(img.shape[1]).T


def image_metrics(gray: np.ndarray, block: int = 64) -> tuple[float, float, float, int, float]:
    """Laplacian variance, brightness mean and deviation, 64-bit perceptual hash (signed), share of active blocks."""
    g = gray.astype(float)
    p = np.pad(g, 1, mode="reflect")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g
    norm = g / 255.0
    k = np.arange(32)
    basis = np.sqrt(2 / 32) * np.cos(math.pi * (2 * k[None] + 1) * k[:, None] / 64)
    basis[0] = np.sqrt(1 / 32)
    low = (basis @ _area_resize(g, 32) @ basis.T)[:8, :8]
    bits = (low > np.median(low)).ravel()
    value = int("".join("1" if b else "0" for b in bits), 2)
    value = value - (1 << 64) if value >= 1 << 63 else value
    h, w = g.shape
    if h < block or w < block:
        cover = 1.0
    else:
        col, row = p[:-2] + 2 * p[1:-1] + p[2:], p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
        mag = np.hypot(col[:, 2:] - col[:, :-2], row[2:] - row[:-2])
        r, c = h // block, w // block
        cover = float((mag[: r * block, : c * block].reshape(r, block, c, block).mean((1, 3)) > 10.0).mean())
    return float(lap.var()), float(norm.mean()), float(norm.std()), value, cover


def frame_metrics(spark: SparkSession, path: str, glob: str = "*", decode: Callable[[bytes], np.ndarray | None] = decode_gray) -> DataFrame:
    """Quality metrics of every image below ``path``; unreadable files give null metrics."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, content in zip(pdf["path"], pdf["content"]):
                img = decode(content)
                rows.append((p, *(image_metrics(img) if img is not None else [None] * 5)))
            yield pd.DataFrame(rows, columns=["path", "blur_score", "exposure_mean", "exposure_std", "phash", "coverage_score"]).astype({"phash": "Int64"})

    return files.select("path", "content").mapInPandas(
        run, "path string, blur_score double, exposure_mean double, exposure_std double, phash long, coverage_score double"
    )


# ------------------------------------------------------------------ generated tables


def random_cloud(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """n points in [-1, 1]^3 with random colours; the same for any partitioning."""
    from scenequarry.functions.elementwise import key_uniform

    u = lambda s: key_uniform(seed, F.col("id"), s)
    return spark.range(n).select(
        F.col("id").alias("point_id"), *[(u(10 + i) * 2 - 1).alias(a) for i, a in enumerate("xyz")],
        *[F.floor(u(20 + i) * 256).cast("short").alias(c) for i, c in enumerate("rgb")],
    )


def arange(spark: SparkSession, start: float, stop: float, step: float = 1.0) -> DataFrame:
    n = max(0, math.ceil((stop - start) / step))
    return spark.range(n).select("id", (F.lit(start) + F.col("id") * F.lit(step)).alias("v"))


def linspace(spark: SparkSession, lo: float, hi: float, n: int) -> DataFrame:
    step = (hi - lo) / (n - 1) if n > 1 else 0.0
    return spark.range(n).select("id", (F.lit(lo) + F.col("id") * F.lit(step)).alias("v"))


def full(spark: SparkSession, n: int, value: float) -> DataFrame:
    return spark.range(n).select("id", F.lit(value).alias("v"))


def eye(spark: SparkSession, n: int) -> DataFrame:
    """Non-zero cells of the identity matrix."""
    return spark.range(n).select(F.col("id").alias("row"), F.col("id").alias("col"), F.lit(1.0).alias("v"))

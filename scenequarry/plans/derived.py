"""Capture-shaped tables derived from the driver's parquet files by SQL text that Spark and DuckDB both run.

``{xor:a,b}`` and ``{seq:a,b}`` mark the two spots where the dialects differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")

# name -> (tables it reads, SQL text)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "splats": (
        ("orders",),
        """SELECT o_orderkey % 4 AS scene_id, o_orderkey AS splat_id, CAST(floor(o_orderkey / 4e0) AS BIGINT) % 6 AS node_id,
  ((o_orderkey*7919+17) % 10007)/10007e0*10e0-5e0 AS x, ((o_orderkey*104729+31) % 10007)/10007e0*10e0-5e0 AS y,
  ((o_orderkey*1299709+7) % 10007)/10007e0*10e0-5e0 AS z, ((o_orderkey*31337) % 1201)/100e0-6e0 AS opacity_raw,
  ((o_orderkey*613) % 301)/100e0-3e0 AS s0, ((o_orderkey*617) % 301)/100e0-3e0 AS s1, ((o_orderkey*619) % 301)/100e0-3e0 AS s2,
  CASE WHEN o_orderkey % 97 = 0 THEN 0e0 ELSE 1e0 END AS qw,
  CASE WHEN o_orderkey % 97 = 0 THEN 0e0 ELSE ((o_orderkey*17) % 101)/100e0-0.5e0 END AS qx,
  CASE WHEN o_orderkey % 97 = 0 THEN 0e0 ELSE ((o_orderkey*19) % 101)/100e0-0.5e0 END AS qy,
  CASE WHEN o_orderkey % 97 = 0 THEN 0e0 ELSE ((o_orderkey*23) % 101)/100e0-0.5e0 END AS qz,
  ((o_orderkey*11) % 401)/100e0-2e0 AS c0, ((o_orderkey*13) % 401)/100e0-2e0 AS c1, ((o_orderkey*29) % 401)/100e0-2e0 AS c2
FROM orders""",
    ),
    "views": (
        ("supplier",),
        """SELECT s_suppkey % 4 AS scene_id, s_suppkey AS image_id, cos(s_suppkey*0.35e0) AS qw, 0e0 AS qx,
  sin(s_suppkey*0.35e0) AS qy, 0e0 AS qz, 0e0 AS tx, 0e0 AS ty, 12e0 AS tz, 50e0 AS fx, 50e0 AS fy, 32e0 AS cx, 24e0 AS cy,
  64 AS width, 48 AS height FROM supplier""",
    ),
    "mask_pixels": (
        ("supplier",),
        """SELECT scene_id, image_id, px_row, px_col,
  (CAST(floor(px_row/12e0) AS BIGINT)*5 + CAST(floor(px_col/16e0) AS BIGINT)*3 + image_id) % 5 AS label
FROM (SELECT s_suppkey % 4 AS scene_id, s_suppkey AS image_id, px_row, {seq:0,63} AS px_col
      FROM (SELECT s_suppkey, {seq:0,47} AS px_row FROM supplier) r) p
WHERE (CAST(floor(px_row/12e0) AS BIGINT)*5 + CAST(floor(px_col/16e0) AS BIGINT)*3 + image_id) % 5 <> 0""",
    ),
    "frames": (
        ("events",),
        """SELECT session_id, frame_id, frame_index, ts, blur_score, exposure_mean, coverage_score,
  {xor:((session_id*100000 + CAST(floor(frame_index/3e0) AS BIGINT))*2654435761 % 4294967291)*1073741789 % 4611686018427387847,
  CASE frame_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 8 ELSE 16 END} AS phash
FROM (SELECT user_id AS session_id, event_id AS frame_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index, ts,
  value AS blur_score, ((event_id*37) % 256)/255e0 AS exposure_mean, ((event_id*53) % 101)/100e0 AS coverage_score FROM events) f""",
    ),
    "losses": (
        ("events",),
        "SELECT user_id % 8 AS run_id, user_id AS camera, event_id AS step, value/500e0 AS loss FROM events",
    ),
    "trace": (
        ("events",),
        """SELECT event_id, ts, event_type AS stage, value*20e0 AS vram_mb, value*35e0 AS ram_mb,
  (event_id*7) % 101 AS gpu_util, (event_id*13) % 351 AS power_w FROM events""",
    ),
    "keyframes": (
        ("part",),
        """SELECT p_partkey % 20 AS clip_id, floor(p_partkey/20e0)*0.5e0 AS t, p_size*1e0 AS px, p_retailprice/100e0 AS py,
  (p_partkey % 7)*1e0 AS pz, CASE p_partkey % 4 WHEN 0 THEN 'linear' WHEN 1 THEN 'ease_in' WHEN 2 THEN 'ease_out' ELSE 'ease_in_out' END AS easing,
  1e0 AS qw, ((p_partkey*3) % 11)/10e0 AS qx, ((p_partkey*5) % 13)/10e0 AS qy, ((p_partkey*7) % 17)/10e0 AS qz,
  20e0 + p_partkey % 50 AS focal FROM part""",
    ),
    "mesh_faces": (
        ("part",),
        """SELECT j AS face_id, j+2*c AS v0, j+2*c+1 AS v1, j+2*c+2 AS v2
FROM (SELECT p_partkey AS j, CAST(floor(sqrt(p_partkey*1e0)) AS BIGINT) AS c FROM part) s""",
    ),
    "mesh_vertices": (
        ("part",),
        """SELECT v AS vertex_id, ((v*7919) % 1009)/100e0 AS x, ((v*104729) % 1013)/100e0 AS y, ((v*31) % 1019)/100e0 AS z
FROM (SELECT DISTINCT j + k AS v FROM (SELECT p_partkey + 2*CAST(floor(sqrt(p_partkey*1e0)) AS BIGINT) AS j, {seq:0,2} AS k FROM part) s) c""",
    ),
    "nodes": (
        ("region", "nation", "customer"),
        """SELECT CAST(r_regionkey AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS parent_id, r_regionkey % 7 <> 3 AS visible,
  r_regionkey*1e0 AS dx, 0e0 AS dy, 1e0 AS dz FROM region
UNION ALL SELECT 1000 + CAST(n_nationkey AS BIGINT), CAST(n_regionkey AS BIGINT), n_nationkey % 7 <> 3, 0e0, n_nationkey*1e0, 2e0 FROM nation
UNION ALL SELECT 100000 + c_custkey, 1000 + CAST(c_nationkey AS BIGINT), c_custkey % 7 <> 3, (c_custkey % 13)*1e0, 3e0, 0e0 FROM customer""",
    ),
    "assets": (
        ("documents",),
        """SELECT doc_id AS asset_id, 'folder_' || source AS folder, '/data/' || lang || '/asset_' || CAST(doc_id AS VARCHAR(20)) ||
  CASE doc_id % 6 WHEN 0 THEN '.ply' WHEN 1 THEN '.jpg' WHEN 2 THEN '.mp4' WHEN 3 THEN '.obj' WHEN 4 THEN '.json' ELSE '.sog' END AS path,
  lang, source, n_chars AS size FROM documents""",
    ),
    "translations": (
        ("customer",),
        "SELECT c_mktsegment AS lang, c_nationkey AS key, c_custkey FROM customer WHERE c_custkey % 11 <> 0",
    ),
    "metrics": (
        ("events",),
        """SELECT user_id % 8 AS run_id, event_id AS iteration, 15e0 + ((event_id*71) % 2003)/100e0 AS psnr,
  0.5e0 + ((event_id*43) % 499)/1000e0 AS ssim, value/1000e0 AS time_per_image, event_id*10 AS num_gaussians FROM events""",
    ),
}


#: The product of large session numbers passes 64 bits; in two halves of the factor modulo the prime it gives the same remainder.
_HASHED = "(session_id*100000 + CAST(floor(frame_index/3e0) AS BIGINT))*2654435761 % 4294967291"
_GROUP = "((session_id*100000 + CAST(floor(frame_index/3e0) AS BIGINT)) % 4294967291)"
_HASHED_WIDE = f"(({_GROUP} div 65536 * 2654435761) % 4294967291 * 65536 + {_GROUP} % 65536 * 2654435761) % 4294967291"


def _render(sql: str, duck: bool) -> str:
    if duck:
        sql = re.sub(r"\{xor:(.*?),\s*(CASE.*?END)\}", r"xor(\1, \2)", sql, flags=re.S)
        return re.sub(r"\{seq:(\d+),(\d+)\}", lambda m: f"unnest(range({m[1]}, {int(m[2]) + 1}))", sql)
    sql = re.sub(r"\{xor:(.*?),\s*(CASE.*?END)\}", r"(\1) ^ (\2)", sql, flags=re.S)
    sql = sql.replace(_HASHED, _HASHED_WIDE)
    return re.sub(r"\{seq:(\d+),(\d+)\}", r"explode(sequence(CAST(\1 AS BIGINT), CAST(\2 AS BIGINT)))", sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame over the parquet files in ``sf_dir``."""
    if name in SOURCES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    reads, sql = TABLES[name]
    sql = _render(sql, duck=False)
    frames = {}
    for t in reads:
        sql = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", sql)
        rows = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        # each view of a few bytes becomes thousands of pixels, which one file must not make in one task
        frames[t] = rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))) if name == "mask_pixels" else rows
    return spark.sql(sql, **frames)


def ctes(*names: str) -> str:
    """The WITH clause that defines the derived tables for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({_render(TABLES[n][1], duck=True)})" for n in names)

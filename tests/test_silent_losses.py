"""Cases that earlier versions dropped, capped or ended with an error."""

import json

import numpy as np
from pyspark.sql import functions as F

from scenequarry.operators import codebooks as CB
from scenequarry.operators import frames as FR
from scenequarry.operators import graphs as G
from scenequarry.operators import meshes as M
from scenequarry.operators import scale as S
from scenequarry.operators import simplify as SI
from scenequarry.operators import spatial as SP
from scenequarry.operators.catalog import upsert_assets, upsert_ledger
from scenequarry.sources import files


def test_more_splits_than_one_level_draws(spark):
    df = spark.range(6000).select(F.lit(1).alias("k"), F.col("id"))
    b = S.with_buckets(df, ["k"], ["id"], 1)
    sizes = [r["count"] for r in b.df.groupBy("_b").count().collect()]
    assert len(sizes) > 2000 and max(sizes) < 40
    assert [r.rn for r in S.rank_rows(df, ["k"], ["id"], "rn", 1).orderBy("id").collect()] == list(range(1, 6001))


def test_locale_strings_and_depth(spark, tmp_path):
    deep = "end"
    for i in range(12):
        deep = {f"k{i}": deep}
    (tmp_path / "de.json").write_text(json.dumps({"a": "100", "b": "true", "c": "[beta]", "d": "{count} items", "e": 5, "f": None, "_g": "x", "h": {"_i": "y", "j": "{}"}, "deep": deep}))
    (tmp_path / "xx.json").write_text("{broken")
    got = {r.key: r.text for r in files.flatten_locale(spark, str(tmp_path)).collect()}
    assert got == {"a": "100", "b": "true", "c": "[beta]", "d": "{count} items", "h.j": "{}", "deep." + ".".join(f"k{i}" for i in range(11, -1, -1)): "end"}


def test_frames_without_hash_stay(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 1, None), (1, 2, 5), (1, 3, None)], "session_id long, frame_index long, phash long")
    assert {r.frame_index: r.is_duplicate for r in FR.mark_duplicates(df).collect()} == {0: False, 1: False, 2: True, 3: False}


def test_long_chain_of_similar_frames(spark):
    n = 3000
    nodes = spark.range(n).select(F.lit(1).alias("s"), "id")
    pairs = spark.range(n - 1).select(F.lit(1).alias("s"), F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = {r.id: r.suppressed for r in G.first_fit_independent_set(nodes, pairs, ["s"]).collect()}
    assert got == {i: i % 2 == 1 for i in range(n)}


def test_codes_are_exactly_k(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.01, (900, 3)), rng.normal(5, 3, (100, 3))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    centres, labels = CB.kmeans(df, "id", "v", 64, 3, direct_limit=8)
    assert centres.count() == 64 and labels.count() == 1000
    few, own = CB.kmeans(df.limit(10), "id", "v", 64)
    assert few.count() == 10 and own.select("code").distinct().count() == 10


def test_edges_of_three_faces_connect_nothing(spark):
    faces = spark.createDataFrame([(1, 0, 0, 1, 2), (1, 1, 0, 1, 3), (1, 2, 0, 1, 4), (1, 3, 2, 1, 5)], "mesh_id long, face_id long, v0 long, v1 long, v2 long")
    assert {r.face_id: r.component for r in M.face_components(faces, ["mesh_id"]).collect()} == {0: 0, 1: 1, 2: 2, 3: 0}


def test_pair_distances_in_blocks(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.ref_id): r.distance for r in SP.pair_distances(df, df, 2, "vec_id", "ref_id", block_rows=7).collect()}
    assert len(got) == 2500 and all(abs(d - np.linalg.norm(x[a] - x[b])) < 1e-9 for (a, b), d in got.items())
    near = SP.pair_distances(df, df, 2, "vec_id", "ref_id", block_rows=7, max_distance=1.5)
    assert near.count() == sum(d <= 1.5 for d in got.values())


def test_sessions_count_direct_videos_only(spark, tmp_path):
    for f in ("s1/a.MP4", "s1/b.webm", "s1/deep/c.mp4", "s2/notes.txt", "top.mp4"):
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_text("x")
    (tmp_path / "s3").mkdir()
    assert {r.session_id: r.n_sets for r in files.list_sessions(spark, str(tmp_path)).collect()} == {"s1": 1, "s2": 0, "s3": 0}


def test_upserts(spark):
    old = spark.createDataFrame([(None, "a", ["x"], 5, "n"), ("f", "b", None, 7, "m")], "folder string, path string, tags array<string>, size long, name string")
    new = spark.createDataFrame([(None, "a", ["y", "x"], 0, ""), (None, "a", ["z"], 9, None), ("g", "c", ["q"], None, "k")], "folder string, path string, tags array<string>, size long, name string")
    got = {r.path: (r.folder, r.tags, r["size"], r.name, r.state) for r in upsert_assets(old, new, ["size", "name"]).collect()}
    assert got == {"a": (None, ["x", "y", "z"], 9, "n", "updated"), "b": ("f", [], 7, "m", "kept"), "c": ("g", ["q"], None, "k", "added")}
    ledger = spark.createDataFrame([("s", "running", 3, 10)], "session_id string, status string, n_sets long, updated_at long")
    u = upsert_ledger(ledger, spark.createDataFrame([("s", "done", 11), ("t", "new", 1)], "session_id string, status string, updated_at long"))
    assert {tuple(r) for r in u.collect()} == {("s", "done", 3, 11), ("t", "new", None, 1)}


def splats(spark, sizes):
    rng = np.random.default_rng(1)
    rows = [(s, i, *rng.normal(size=3).tolist(), 3.0, -1.0, -1.0, -1.0, 1.0, 0.0, 0.0, 0.0, 0.1, 0.2, 0.3) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "scene_id long, splat_id long, x double, y double, z double, opacity_raw double, s0 double, s1 double, s2 double, qw double, qx double, qy double, qz double, c0 double, c1 double, c2 double")


def test_levels_stop_by_scene(spark):
    h = SI.build_lod(splats(spark, {1: 40, 2: 200}), SI.SimplifyOptions(ratio=0.5, knn_k=4), min_points=64)
    got = {(r.scene_id, r.lod): r["count"] for r in h.lod_rows.groupBy("scene_id", "lod").count().collect()}
    assert got == {(1, 0): 40, (2, 0): 200, (2, 1): 100, (2, 2): 64}
    assert {(r.scene_id, r.lod): r["count"] for r in h.roots.groupBy("scene_id", "lod").count().collect()} == {(1, 0): 40, (2, 2): 64}
    assert {(r.scene_id, r.lod): (r.input, r.after_pruning, r.output) for r in h.counts.collect()} == {(2, 1): (200, 200, 100), (2, 2): (100, 100, 64)}

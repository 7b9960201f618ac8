"""Joins and groups over rows that a small file makes by the thousand: no broadcasts of them, tasks by their number."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenequarry.operators import frames as FR
from scenequarry.operators import graphs as G
from scenequarry.operators import projection as PJ
from scenequarry.operators import spatial as SP
from scenequarry.plans import derived


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("direct", [256, 40])
def test_similar_hashes_without_broadcast(spark, monkeypatch, direct):
    rng = np.random.default_rng(4)
    rows = []
    for session, n in ((1, 90), (2, 30), (3, 1)):
        base = rng.integers(-(2**62), 2**62, 6)
        for i in range(n):
            flips = rng.choice(64, rng.integers(0, 8), replace=False)
            h = (int(base[i % 6]) ^ sum(1 << int(b) for b in flips)) & (2**64 - 1)
            rows.append((session, i, h - 2**64 if h >= 2**63 else h))
    rows += [(2, 30, rows[95][2]), (None, 1, 5), (None, 2, 7)]
    df = spark.createDataFrame(rows, "session_id long, frame_index long, phash long")
    monkeypatch.setattr(FR, "DIRECT_HASHES", direct, raising=False)
    out = FR.similar_hashes(df)
    assert "Broadcast" not in plan(out)
    first = {}
    for s, i, h in rows:
        if s is not None:
            first[s, h] = min(i, first.get((s, h), i))
    want = {
        (s, a, b, first[s, a], first[s, b])
        for (s, a), (t, b) in itertools.product(first, first)
        if s == t and a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 8
    }
    got = [(r.session_id, r.h1, r.h2, r.first1, r.first2) for r in out.collect()]
    assert set(got) == want and len(got) == len(want) and len(want) > 100


def test_tracks_without_broadcast_of_pixels(spark, monkeypatch):
    m = spark.range(2000).select(
        F.lit(1).alias("video_id"), (F.col("id") % 5).alias("frame"), (F.col("id") % 2 + 1).alias("object_id"),
        F.floor(F.col("id") / 50).alias("px_row"), (F.floor(F.col("id") / 5) % 10).alias("px_col"),
    )
    seen = []
    real = G.greedy_matching
    monkeypatch.setattr(G, "greedy_matching", lambda e, keys: seen.append(plan(e)) or real(e, keys))
    FR.track_objects(m)
    assert not [x for x in seen[0].splitlines() if "BroadcastHashJoin" in x and "px_row" in x]


def test_hashes_of_large_sessions(spark, tmp_path):
    users = [3, 90_000, 40_000_000, 3, 3, 3]
    ev = spark.createDataFrame([(i, u, i) for i, u in enumerate(users)], "event_id long, user_id long, t long")
    ev.select("event_id", "user_id", F.timestamp_seconds("t").alias("ts"), F.lit(1.5).alias("value")).write.parquet(str(tmp_path / "events.parquet"))
    got = {r.frame_id: r.phash for r in derived.table(spark, str(tmp_path), "frames").collect()}
    place = {0: 0, 1: 0, 2: 0, 3: 1, 4: 2, 5: 3}
    for i, u in enumerate(users):
        g = u * 100000 + place[i] // 3
        assert got[i] == (g * 2654435761 % 4294967291) * 1073741789 % 4611686018427387847 ^ (1 << i % 5)


def test_label_map_tasks_follow_pixels(spark, monkeypatch):
    monkeypatch.setattr(PJ, "PIXELS_PER_TASK", 50, raising=False)
    m = spark.range(1000).selectExpr("1 AS scene_id", "id % 3 AS image_id", "id % 7 AS px_row", "id % 11 AS px_col", "CASE WHEN id % 13 = 0 THEN null ELSE id END AS object_id")
    out = PJ.label_map(m)
    assert ", 20), REPARTITION_BY_NUM" in plan(out)
    want = m.groupBy("scene_id", "image_id", "px_row", "px_col").agg(F.min("object_id").alias("label"))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect())) and out.columns == want.columns


def test_spread_pixels(spark, tmp_path):
    spark.range(40).withColumnRenamed("id", "s_suppkey").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    assert derived.table(spark, str(tmp_path), "mask_pixels").rdd.getNumPartitions() > 1


@pytest.mark.parametrize("small", [100_000, 1])
def test_nearest_tasks_follow_points(spark, monkeypatch, small):
    monkeypatch.setattr(SP, "POINTS_PER_TASK", 16, raising=False)
    monkeypatch.setattr(SP, "BROADCAST_ROWS", small, raising=False)
    rng = np.random.default_rng(1)
    t = [(k, i, *map(float, rng.integers(0, 6, 3))) for k in (0, 1) for i in range(70)]
    q = [(k, i, *map(float, rng.random(3) * 6)) for k in (0, 1) for i in range(90)]
    names = "k int, id long, x double, y double, z double"
    targets, queries = spark.createDataFrame(t, names), spark.createDataFrame(q, names).withColumnRenamed("id", "qid")
    out = SP.nearest(queries, targets.withColumnRenamed("id", "tid"), ["k"], "qid", "tid")
    got = {(r.k, r.qid): (r.tid, r.d2) for r in out.collect()}
    assert len(got) == len(q)
    for k, i, *p in q:
        d2, tid = min((((p[0] - x) * (p[0] - x) + (p[1] - y) * (p[1] - y)) + (p[2] - z) * (p[2] - z), j) for s, j, x, y, z in t if s == k)
        assert got[k, i] == (tid, d2)
    # one row per query and target leaf is grouped, not one per target point
    assert "explode(_tp" not in plan(out)


@pytest.mark.parametrize("batch", [100_000, 7])
def test_fusion_reads_pixels_in_place(spark, monkeypatch, batch):
    from scenequarry.operators import fusion

    v = spark.range(6).selectExpr(
        "id % 2 AS scene_id", "id AS image_id", "cos(id) AS qw", "0e0 AS qx", "sin(id) AS qy", "0e0 AS qz", "0e0 AS tx", "0e0 AS ty", "4e0 AS tz",
        "8e0 AS fx", "8e0 AS fy", "6e0 AS cx", "5e0 AS cy", "12 AS width", "10 AS height",
    )
    d = spark.range(900).selectExpr(
        "id % 2 AS scene_id", "id % 6 AS image_id", "CAST(id % 10 AS INT) AS px_row", "CAST(id % 12 AS INT) AS px_col", "3.5e0 + id % 5 / 4 AS depth",
        "0.5e0 AS r", "id % 3 / 3 AS g", "0.1e0 AS b", "1e0 + id % 2 AS weight",
    ).withColumn("depth", F.col("depth").cast("double"))
    vox = fusion.candidate_voxels(d, v, 0.5, 0.5)
    plans = []
    real = fusion.cut
    monkeypatch.setattr(fusion, "cut", lambda x: plans.append(plan(x)) or real(x))
    out = fusion.integrate(vox, d, v, 0.5, 0.5, batch)
    assert all("px_row" not in line for p in [*plans, plan(out)] for line in p.splitlines() if "BroadcastHashJoin" in line)
    got = {(r.scene_id, r.ix, r.iy, r.iz): (r.tsdf, r.weight, r.g) for r in out.collect()}
    # the same sums by hand
    from scenequarry.functions.cameras import with_view_matrix

    pix = {}
    for r in d.collect():
        pix.setdefault((r.scene_id, r.image_id, r.px_row, r.px_col), []).append(r)
    cams = with_view_matrix(v).collect()
    want = {}
    for x in vox.collect():
        p = [(x[a] + 0.5) * 0.5 for a in ("ix", "iy", "iz")]
        t = w = g = 0.0
        for c in cams:
            if c.scene_id != x.scene_id:
                continue
            cc = [sum(c[f"_r{i}{k}"] * p[k] for k in range(3)) + (0, 0, 4.0)[i] for i in range(3)]
            if cc[2] <= 0:
                continue
            u, s = 8 * cc[0] / cc[2] + 6, 8 * cc[1] / cc[2] + 5
            if not (0 <= u < 11 and 0 <= s < 9):
                continue
            for r in pix.get((x.scene_id, c.image_id, int(s), int(u)), []):
                sdf = r.depth - cc[2]
                if sdf >= -0.5:
                    t, w, g = t + r.weight * max(-1, min(1, sdf / 0.5)), w + r.weight, g + r.weight * r.g
        if w > 0:
            want[x.scene_id, x.ix, x.iy, x.iz] = (t / w, w, g / w)
    assert got.keys() == want.keys() and len(want) > 20
    assert all(got[k] == pytest.approx(want[k]) for k in want)

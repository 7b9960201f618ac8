"""Simplification where many rows share a position: the same merges as row by row, from few edges a pass."""

import numpy as np

from scenequarry.operators import simplify as SI
from scenequarry.operators import spatial as SP

K = 4


def _rows():
    """60 copies at each of two places, four loose rows; ids dealt over the places."""
    spots = [(0.25, 1.5, -2.0), (0.75, 1.25, -2.5)]
    at = [spots[i % 2] for i in range(120)] + [(3.0 + i, 0.1 * i, 0.3) for i in range(4)]
    rng = np.random.default_rng(5)
    return [(1, i, *p, *rng.uniform(-2.0, -1.0, 3).tolist(), 1.0 + rng.uniform()) for i, p in enumerate(at)]


def _neighbours(ids, xyz, i):
    d = xyz - xyz[i]
    d2 = d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1] + d[:, 2] * d[:, 2]
    return sorted((d2[j], ids[j], j) for j in range(len(ids)) if j != i)[:K]


def _one_by_one(rows, target):
    """(pass, left, right, node) by the rule itself, over all rows in every pass."""
    live = {r["node"]: r for r in rows}
    nxt, start, out, step = max(live) + 1, len(live), [], 0
    while len(live) > target:
        ids = sorted(live)
        xyz = np.array([[live[i][a] for a in "xyz"] for i in ids])
        edges = {(min(ids[i], n), max(ids[i], n)): np.sqrt(d) for i in range(len(ids)) for d, n, _ in _neighbours(ids, xyz, i)}
        used, pairs = set(), []
        for (u, v), _ in sorted(edges.items(), key=lambda e: (e[1], e[0])):
            if not {u, v} & used:
                used |= {u, v}
                pairs.append((u, v))
        pairs = pairs[: min(len(live) - target, start // 2)]
        side = lambda n: {"mean": np.array([[live[n][a] for a in "xyz"]]), "scale": np.array([[live[n][f"s{i}"] for i in range(3)]]),
                          "quat": np.array([[live[n][f"q{a}"] for a in "wxyz"]]), "alpha": np.array([live[n]["alpha"]]), "app": np.array([live[n]["app"]])}
        for u, v in pairs:
            m = SI.merge_batch(side(u), side(v))
            flat = dict(zip("xyz", m["mean"][0])) | {f"s{i}": m["scale"][0][i] for i in range(3)} | dict(zip(("qw", "qx", "qy", "qz"), m["quat"][0]))
            live[nxt] = flat | {"alpha": m["alpha"][0], "app": m["app"][0]}
            del live[u], live[v]
            out.append((step, u, v, nxt))
            nxt += 1
        step += 1
    return out, set(live)


def test_crowded_positions_merge_as_row_by_row_from_few_edges(spark, monkeypatch):
    s = spark.createDataFrame(_rows(), "scene_id int, splat_id long, x double, y double, z double, s0 double, s1 double, s2 double, opacity_raw double")
    s = s.selectExpr("*", "1D qw", "0.1D qx", "0D qy", "0.2D qz", "0.1D c0", "0.2D c1", "0.3D c2")
    rows = SI.to_rows(s)
    seen = []
    match = SI.greedy_matching
    monkeypatch.setattr(SI, "greedy_matching", lambda edges, *a, **k: seen.append(edges.count()) or match(edges, *a, **k))
    out = SI.simplify(rows, SI.SimplifyOptions(ratio=0.92, knn_k=K, opacity_prune=0.0))
    got = sorted((r["pass"], r["left"], r["right"], r["node"]) for r in out.merges.collect())
    want, left = _one_by_one([r.asDict() for r in rows.collect()], int(np.ceil(124 * 0.92)))
    assert got == sorted(want)
    assert {r["node"] for r in out.rows.select("node").collect()} == left
    # before, each of the copies brought its K edges along: some 470 in the first pass
    assert seen[0] < 60


def test_crowded_neighbours_are_the_smallest_ids(spark):
    rows = [(1, i, *((0.5, 0.5, 0.5) if i % 3 else (1.0 + i, 2.0, 3.0))) for i in range(60)]
    df = spark.createDataFrame(rows, "scene_id int, id long, x double, y double, z double")
    xyz = np.array([r[2:] for r in rows])
    want = {(i, n, d) for i in range(60) for d, n, _ in _neighbours(list(range(60)), xyz, i)}
    assert {(r["id"], r["neighbour"], r["d2"]) for r in SP.knn_self(df, ["scene_id"], "id", K).collect()} == want

import numpy as np
import pandas as pd
import pytest

from scenequarry.operators import graphs as G
from scenequarry.operators import meshes as M
from scenequarry.operators import simplify as SI
from scenequarry.operators import spatial as SP


@pytest.fixture(scope="module")
def cloud(spark):
    """Two scenes: a dense clump, scattered points and a pile of copies that holds a third of the rows."""
    rng = np.random.default_rng(5)
    pts = np.concatenate([rng.normal(0, 0.05, (120, 3)), rng.uniform(-5, 5, (100, 3)), np.tile([[1.0, 2.0, 3.0]], (110, 1))])
    pdf = pd.DataFrame(pts, columns=list("xyz"))
    pdf["scene_id"] = 0
    pdf["splat_id"] = rng.permutation(len(pdf))
    few = pd.DataFrame(rng.uniform(0, 1, (4, 3)), columns=list("xyz")).assign(scene_id=1, splat_id=range(4))
    pdf = pd.concat([pdf, few], ignore_index=True)
    return spark.createDataFrame(pdf).repartition(5), pdf


def brute_knn(pdf, k):
    out = set()
    for s, g in pdf.groupby("scene_id"):
        p, ids = g[list("xyz")].to_numpy(), g["splat_id"].to_numpy()
        d = (p[:, None, 0] - p[None, :, 0]) ** 2 + (p[:, None, 1] - p[None, :, 1]) ** 2 + (p[:, None, 2] - p[None, :, 2]) ** 2
        for i in range(len(g)):
            order = sorted((d[i, j], ids[j]) for j in range(len(g)) if j != i)[:k]
            out |= {(s, ids[i], j) for _, j in order}
    return out


@pytest.mark.parametrize("k", [3, 6])
def test_knn_matches_brute_force(cloud, k):
    df, pdf = cloud
    got = {(r["scene_id"], r["id"], r["neighbour"]) for r in SP.knn_self(df, ["scene_id"], "splat_id", k).collect()}
    assert got == brute_knn(pdf, k)


def test_radius_and_nearest_match_brute_force(spark, cloud):
    df, pdf = cloud
    sel = pdf["splat_id"] % 7 == 0
    r = 0.31
    hits = set()
    near = {}
    for s, g in pdf.groupby("scene_id"):
        q, t = g[~sel[g.index]], g[sel[g.index]]
        if t.empty:
            continue
        d = ((q[list("xyz")].to_numpy()[:, None] - t[list("xyz")].to_numpy()[None]) ** 2).sum(2)
        hits |= {(s, i) for i, row in zip(q["splat_id"], d) if row.min() <= r * r}
        for i, row in zip(q["splat_id"], d):
            near[(s, i)] = np.sqrt(row.min())
    q, t = df.filter("splat_id % 7 <> 0"), df.filter("splat_id % 7 = 0")
    got = {(x["scene_id"], x["splat_id"]) for x in SP.within_radius(q, t, ["scene_id"], "splat_id", r).collect()}
    assert got == hits
    n = SP.nearest(q, t.withColumnRenamed("splat_id", "tid"), ["scene_id"], "splat_id", "tid").collect()
    assert {(x["scene_id"], x["splat_id"]): pytest.approx(x["d2"] ** 0.5) for x in n} == near


def sequential_matching(edges):
    used, out = set(), set()
    for c, u, v in sorted(edges):
        if u not in used and v not in used:
            used |= {u, v}
            out.add((u, v))
    return out


@pytest.mark.parametrize("limit", [100_000, 0])
def test_matching_is_the_sequential_one(spark, monkeypatch, limit):
    """Random graph plus a chain of rising costs; with limit 0 no group may be settled in one task."""
    monkeypatch.setattr(G, "COMPONENT_EDGES", limit)
    rng = np.random.default_rng(1)
    edges = {(int(min(a, b)), int(max(a, b))) for a, b in rng.integers(0, 60, (150, 2)) if a != b}
    rows = [(float(rng.integers(0, 6)), u, v) for u, v in edges] + [(float(i), 100 + i, 101 + i) for i in range(14)]
    df = spark.createDataFrame([(0, u, v, c) for c, u, v in rows], "k int, u long, v long, cost double")
    got = {(r["u"], r["v"]) for r in G.greedy_matching(df, ["k"]).collect()}
    assert got == sequential_matching(rows)


def test_components_and_independent_set(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 80, (50, 2)) if a != b] + [(200 + i, 201 + i) for i in range(30)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame([(0, a, b) for a, b in pairs], "k int, u long, v long")
    got = {r["id"]: r["component"] for r in G.connected_components(df, ["k"]).collect()}
    assert got == {x: find(x) for x in parent}

    later = sorted({(min(p), max(p)) for p in pairs})
    gone = set()
    for u in sorted(parent):
        if u not in gone:
            gone |= {b for a, b in later if a == u}
    nodes = spark.createDataFrame([(0, i) for i in parent], "k int, id long")
    e = spark.createDataFrame([(0, a, b) for a, b in later], "k int, u long, v long")
    out = G.first_fit_independent_set(nodes, e, ["k"])
    assert {r["id"] for r in out.filter("suppressed").collect()} == gone


def test_small_components_fall_back_to_the_largest(spark):
    f = spark.createDataFrame([(0, 0, 0, 1, 2), (0, 1, 1, 2, 3), (0, 2, 10, 11, 12)], "m int, face_id long, v0 long, v1 long, v2 long")
    assert {r["face_id"] for r in M.remove_small_components(f, ["m"], 0.01, 100).collect()} == {0, 1}
    assert {r["face_id"] for r in M.remove_small_components(f, ["m"], 0.01, 1).collect()} == {0, 1, 2}


def test_two_point_merge_matches_the_moments():
    a = {"mean": np.array([[0.0, 0, 0]]), "scale": np.array([[0.2, 0.1, 0.05]]), "quat": np.array([[0.9, 0.1, 0.3, 0.2]]), "alpha": np.array([0.6]), "app": np.array([[1.0, 0, 2]])}
    b = {"mean": np.array([[0.4, 0.1, -0.2]]), "scale": np.array([[0.1, 0.3, 0.1]]), "quat": np.array([[1.0, 0, 0, 0]]), "alpha": np.array([0.3]), "app": np.array([[0.0, 1, 1]])}
    m = SI.merge_batch(a, b)
    w = [(2 * np.pi) ** 1.5 * s["alpha"][0] * s["scale"].prod() + 1e-12 for s in (a, b)]
    w = np.array(w) / sum(w)
    mean = w[0] * a["mean"][0] + w[1] * b["mean"][0]
    cov = np.eye(3) * 1e-8
    for wi, s in zip(w, (a, b)):
        r = SI._rotations(s["quat"])[0]
        d = s["mean"][0] - mean
        cov += wi * (r @ np.diag(s["scale"][0] ** 2) @ r.T + np.outer(d, d))
    r = SI._rotations(m["quat"])[0]
    assert np.allclose(m["mean"][0], mean)
    assert np.allclose(r @ np.diag(m["scale"][0] ** 2) @ r.T, cov, atol=1e-9)
    assert m["alpha"][0] == pytest.approx(0.6 + 0.3 - 0.18)
    assert (np.diff(m["scale"][0]) <= 0).all()


def test_simplify_counts_history_and_leaves(spark, cloud):
    df, pdf = cloud
    cols = {f"s{i}": -2.0 - i / 10 for i in range(3)} | {"qw": 1.0, "qx": 0.1, "qy": 0.0, "qz": 0.2, "c0": 0.1, "c1": 0.2, "c2": 0.3, "opacity_raw": 1.0}
    s = df.select("*", *[__import__("pyspark.sql.functions", fromlist=["lit"]).lit(v).alias(c) for c, v in cols.items()])
    out = SI.simplify(SI.to_rows(s), SI.SimplifyOptions(ratio=0.3, knn_k=3))
    n = pdf.groupby("scene_id").size()
    got = {r["scene_id"]: r["count"] for r in out.rows.groupBy("scene_id").count().collect()}
    assert got == {k: int(np.ceil(v * 0.3)) for k, v in n.items()}
    roots = out.rows.select("scene_id", "node")
    leaves = {(r["scene_id"], r["node"]) for r in SI.leaves_below(out.merges, roots).collect()}
    assert leaves == set(zip(pdf["scene_id"], pdf["splat_id"]))


def test_three_points_merge_the_closest_pair(spark):
    rows = [(0, i, float(x), 0.0, 0.0) for i, x in enumerate((0.0, 1.0, 1.3))]
    s = spark.createDataFrame(rows, "scene_id int, splat_id long, x double, y double, z double").selectExpr(
        "*", "2D AS opacity_raw", "-1D AS s0", "-1D AS s1", "-1D AS s2", "1D AS qw", "0D AS qx", "0D AS qy", "0D AS qz", "0D AS c0", "0D AS c1", "0D AS c2")
    out = SI.simplify(SI.to_rows(s), SI.SimplifyOptions(ratio=0.6, knn_k=2))
    m = out.merges.collect()
    assert [(r["left"], r["right"], r["node"]) for r in m] == [(1, 2, 3)]

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenequarry.operators import graphs as G
from scenequarry.operators import transforms as T


def turned(seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    m = np.eye(4)
    m[:3, :3], m[:3, 3] = q * (1 + seed / 3), rng.normal(size=3)
    return m


@pytest.fixture(scope="module")
def splats(spark):
    rng = np.random.default_rng(0)
    rows = [(1, i % 3, i, *rng.normal(size=3).tolist(), *(rng.normal(size=4)).tolist(), *rng.normal(size=3).tolist(), rng.normal(size=45).tolist()) for i in range(30)]
    return spark.createDataFrame(rows, "scene_id long, node_id long, splat_id long, x double, y double, z double, qw double, qx double, qy double, qz double, s0 double, s1 double, s2 double, shn array<double>")


def flat(r):
    return np.array([*[r[c] for c in ("x", "y", "z", "qw", "qx", "qy", "qz", "s0", "s1", "s2")], *r.shn])


def test_each_node_has_its_own_matrix(spark, splats):
    maps = {0: turned(1), 1: turned(2), 2: np.eye(4)}
    table = spark.createDataFrame([(1, n, m.ravel().tolist()) for n, m in maps.items()], "scene_id long, node_id long, world array<double>")
    got = {r.splat_id: flat(r) for r in T.transform_by_node(splats, table).collect()}
    for n, m in maps.items():
        for r in T.transform_splats(splats.filter(F.col("node_id") == n), m.ravel().tolist(), 3).collect():
            assert np.allclose(got[r.splat_id], flat(r), atol=1e-9)


def test_visible_nodes_are_turned_and_scaled(spark, splats):
    local = [(1, 0, None, True, turned(1).ravel().tolist()), (1, 1, 0, True, turned(2).ravel().tolist()), (1, 2, 0, False, np.eye(4).ravel().tolist())]
    nodes = spark.createDataFrame(local, "scene_id long, node_id long, parent_id long, visible boolean, local array<double>")
    got = {r.splat_id: flat(r) for r in G.merge_visible(splats, G.world_transforms(nodes)).collect()}
    assert set(got) == {i for i in range(30) if i % 3 != 2}
    both = (turned(1) @ turned(2)).ravel().tolist()
    for r in T.transform_splats(splats.filter("node_id = 1"), both, 3).collect():
        assert np.allclose(got[r.splat_id], flat(r), atol=1e-6)


def test_positions_alone_and_null_matrix(spark, splats):
    table = spark.createDataFrame([(1, 0, None), (1, 1, turned(3).ravel().tolist())], "scene_id long, node_id long, world array<double>")
    few = splats.select("scene_id", "node_id", "splat_id", "x", "y", "z")
    got = {r.splat_id: r for r in T.transform_by_node(few, table).collect()}
    assert set(got) == {i for i in range(30) if i % 3 != 2}
    old = {r.splat_id: r for r in few.collect()}
    assert all(got[i].x == old[i].x for i in range(0, 30, 3))

import re

import numpy as np
import xxhash

from scenequarry.llm import near_frames as N
from scenequarry.llm.components import connected, ranked


def slow_hash(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(ids, codes, bits):
    low = dict(zip(ids, ids, strict=True))
    while True:
        old = dict(low)
        for a, x in zip(ids, codes, strict=True):
            for b, y in zip(ids, codes, strict=True):
                if bin((x ^ y) & (1 << 64) - 1).count("1") <= bits:
                    low[a] = min(low[a], low[b])
        if low == old:
            return low


def test_hash_of_captions(spark):
    texts = [None, "", " \t\n", "One", "one Two THREE", "a b c d", "A b c d e", "É é ß x y z", "x " * 70_000 + "end", "a b  c d e f\x0bg"]
    df = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "frame_id long, caption string, phash long")
    got = {r.frame_id: r.phash & (1 << 64) - 1 for r in N.caption_phash(df).collect()}
    assert got == {i: slow_hash(t) for i, t in enumerate(texts)}
    assert N.caption_phash(df).columns == ["frame_id", "caption", "phash"]


def test_groups_equal_brute_force(spark, rng):
    base = rng.integers(0, 1 << 63, 60)
    codes = [int(x) for x in base]
    for x in base[:20]:
        y = int(x)
        for _ in range(6):  # chains of near codes, some of them beyond the limit of their start
            for b in rng.integers(0, 63, 2):
                y ^= 1 << int(b)
            codes.append(y)
    codes += codes[:10]
    ids = [int(i) for i in rng.permutation(len(codes))]
    df = spark.createDataFrame(list(zip(ids, codes, strict=True)), "frame_id long, phash long")
    want = slow_groups(ids, codes, 4)
    for leaf in (8, 1024):
        links = N.linked_hashes(df, leaf=leaf)
        parts = {r.node: r.component for r in connected(links, "a", "b").collect()}
        heads = {}
        for i, c in zip(ids, codes, strict=True):
            heads.setdefault(parts.get(c, c), []).append(i)
        assert {i: min(v) for v in heads.values() for i in v} == want
    assert {r.frame_id: r.group_id for r in N.near_frames(df).collect()} == want


def test_tree_visits_hold_all_near_points(rng):
    x = rng.integers(0, 1 << 21, 4000).astype(np.uint64)
    tree = N.VantageTree(x[:500], 5)
    home = tree.homes(x)
    row, leaf = tree.visits(x, 1)
    seen = set(zip(row.tolist(), leaf.tolist(), strict=True))
    for b in range(21):
        y = x ^ np.uint64(1 << b)
        assert all((i, h) in seen for i, h in enumerate(tree.homes(y).tolist()))
    assert all((i, h) in seen for i, h in enumerate(home.tolist()))


def test_nulls_repeats_and_empty(spark):
    schema = "frame_id long, phash long, group_id string, node long"
    rows = [(3, 5, "x", 1), (3, 5, "x", 1), (None, 5, "x", 1), (9, None, "x", 1), (None, None, "x", 1), (8, 4, "x", 1), (7, -1, "x", 1)]
    got = N.near_frames(spark.createDataFrame(rows, schema))
    assert got.columns == ["frame_id", "phash", "node", "group_id"]
    assert sorted((r.frame_id, r.group_id) for r in got.collect() if r.frame_id) == [(3, 3), (3, 3), (7, 7), (8, 3), (9, 9)]
    assert sorted(str(r.group_id) for r in got.collect() if r.frame_id is None) == ["3", "None"]
    assert N.near_frames(spark.createDataFrame([], schema)).collect() == []


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)] + [(5, 5), (None, 3), (7, None)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(301)}
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_ranks_are_gapless(spark):
    df = spark.range(5000).selectExpr("id", "id % 3 = 0 AS g", "hash(id) AS h").unionByName(spark.range(10).selectExpr("id", "null AS g", "0 AS h"))
    got = ranked(df, "g", ["h", "id"], "r", 7).collect()
    for g in (True, False, None):
        own = sorted((r.h, r.id, r.r) for r in got if r.g is g)
        assert [x[2] for x in own] == list(range(len(own)))

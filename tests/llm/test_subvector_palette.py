import hashlib
import math
import random
from fractions import Fraction

import pytest

from scenequarry.llm import subvector_palette as S


def slow(rows, k=40, rounds=5, components=64, scale=256):
    kept = [(i, [math.floor(scale * Fraction(x)) for x in v]) for i, v in rows if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            centroids[j] = [sum(x) // len(g) for x in zip(*g, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    own = {}
    for _, d, j in found:
        own[j] = own.get(j, 0) + d
    fits = lambda d: d if d < 1 << 63 else None
    whole = all(fits(d) is not None for _, d, _ in found)
    lost = {j for _, d, j in found if fits(d) is None}
    return sorted(
        ((i, j, fits(d), None if j in lost else fits(own[j]), fits(sum(own.values())) if whole else None, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, d, j in found),
        key=repr,
    )


def collected(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"splat_id long, features array<{kind}>, cluster int, ids string").repartition(3)


def as_float32(v):
    import numpy as np

    return [float(np.float32(x)) for x in v]


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(S, "CHUNK", 100)
    r = random.Random(seed)
    pieces = [[r.gauss(0, 1) for _ in range(8)] for _ in range(20)]
    rows = [(i, as_float32([x for _ in range(8) for x in r.choice(pieces)])) for i in range(350)]
    rows += [(1000 + i, rows[0][1]) for i in range(120)] + [(7, rows[7][1]), (None, rows[3][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 63 + [float("nan")]), (2004, [float("inf")] * 64), (2005, [None] + [1.0] * 63)]
    assert collected(S.cluster_splats(frame(spark, rows))) == slow(rows)


def test_few_rows_and_other_parameters(spark):
    r = random.Random(3)
    rows = [(i, [float(r.randrange(-3, 3)) for _ in range(10)]) for i in range(30)]
    got = collected(S.cluster_splats(frame(spark, rows, "double"), k=7, rounds=2, components=10, width=4, scale=3))
    assert got == slow(rows, 7, 2, 10, 3)
    assert collected(S.cluster_splats(frame(spark, [(1, [0.5] * 64)]))) == slow([(1, [0.5] * 64)])
    assert S.cluster_splats(frame(spark, [(1, [0.5] * 64)]).limit(0)).collect() == []
    assert S.cluster_splats(frame(spark, [(1, None)])).collect() == []


def test_numbers_beyond_longs(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(64)]) for i in range(60)] + [(100 + i, [3e38 * r.choice([1, -1]) for _ in range(64)]) for i in range(45)] + [(200 + i, [1e5 + i] * 64) for i in range(5)]
    assert collected(S.cluster_splats(frame(spark, rows, "double"))) == slow(rows)


def test_dictionaries_lose_nothing():
    import numpy as np

    x = np.random.default_rng(5).integers(-4, 4, (500, 64))
    c = S.Chunk.unpack(*S.Chunk.encode(x, 8).pack(), True)
    assert (np.concatenate([e[k] for k, e in zip(c.codes, c.entries, strict=True)], axis=1) == x).all()

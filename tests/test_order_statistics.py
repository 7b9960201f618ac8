"""Order statistics by bracket: exact for ties, NaN, nulls, small and crowded keys, in two scans."""

import math
import random

import pytest
from pyspark.sql import functions as F

from scenequarry.operators import scale as S


def slow(values, rank):
    v = sorted((x for x in values if x is not None), key=lambda x: (math.isnan(x), x))
    r = rank(len(v))
    lo, hi = v[math.floor(r)], v[math.ceil(r)]
    return lo + (hi - lo) * (r - math.floor(r))


def rows(seed):
    r = random.Random(seed)
    out = [("big", i, r.gauss(0, 1), float(r.randrange(5))) for i in range(30_000)]
    out += [("ties", i, 1.0 if i % 50 else r.random(), r.choice([None, 2.5, float("inf"), -1.0])) for i in range(20_000)]
    out += [("small", i, r.random(), -0.0) for i in range(7)] + [("one", 0, 4.0, 5.0), ("nan", 0, 1.0, 1.0), ("nan", 1, float("nan"), None), ("none", 0, None, None)]
    out += [("nans", i, float("nan") if i % 3 else r.random(), r.random()) for i in range(6000)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("bucket", [None, 200])
def test_statistics_against_sorting(spark, bucket):
    data = rows(1)
    df = spark.createDataFrame(data, "k string, i long, a double, b double").repartition(6)
    ranks = {"a_mid": ("a", S.percentile(0.5), lambda n: (n - 1) * 0.5), "a_low": ("a", S.percentile(0.01), lambda n: (n - 1) * 0.01), "b_top": ("b", S.percentile(1.0), lambda n: n - 1.0), "b_up": ("b", S.upper_median(), lambda n: float(n // 2) if n // 2 < n else n - 1.0), "a_0": ("a", S.element(lambda n: F.lit(0)), lambda n: 0.0)}
    got = {r.k: r for r in S.order_stats(df, ["k"], {name: (v, p) for name, (v, p, _) in ranks.items()}, bucket).collect()}
    assert set(got) == {"big", "ties", "small", "one", "nan", "nans"}
    for k, r in got.items():
        own = [x for x in data if x[0] == k]
        assert r.n_rows == max(sum(x[c] is not None for x in own) for c in (2, 3))
        for name, (v, _, rank) in ranks.items():
            want = slow([x[2 if v == "a" else 3] for x in own], rank)
            assert r[name] == want or math.isnan(r[name]) and (math.isnan(want))


@pytest.mark.parametrize("bucket", [None, 150])
@pytest.mark.parametrize("k", [0, 1, 37, 5000, 10**6])
def test_smallest_rows_against_sorting(spark, bucket, k):
    data = rows(2)
    df = spark.createDataFrame(data, "k string, i long, a double, b double").repartition(6)
    got = {}
    for r in S.take_smallest(df, ["k"], "b", "i", F.lit(k), bucket).collect():
        got.setdefault(r.k, set()).add(r.i)
    for key in {x[0] for x in data}:
        own = sorted((x[3], x[1]) for x in data if x[0] == key and x[3] is not None)
        assert got.get(key, set()) == {i for _, i in own[:k]}


def test_share_of_rows_and_long_values(spark):
    data = [("a", i, 2**60 + i) for i in range(6000)] + [("b", i, -i) for i in range(10)]
    df = spark.createDataFrame(data, "k string, i long, v long").repartition(4)
    got = S.take_smallest(df, ["k"], "v", "i", F.col("n_rows") - F.floor(F.col("n_rows") * 0.5)).collect()
    assert sorted(r.i for r in got if r.k == "a") == list(range(3000)) and sorted(r.i for r in got if r.k == "b") == [5, 6, 7, 8, 9]


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, i long, a double")
    assert S.order_stats(df, ["k"], {"m": ("a", S.percentile(0.5))}).collect() == []
    assert S.take_smallest(df, ["k"], "a", "i", F.lit(3)).collect() == []


def test_two_scans(spark, tmp_path):
    spark.createDataFrame(rows(3), "k string, i long, a double, b double").write.parquet(str(tmp_path / "t"))
    seen = []
    plain = S.cut

    def counted(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append(plan.count(str(tmp_path)))
        return plain(df)

    S.cut = counted
    try:
        S.order_stats(spark.read.parquet(str(tmp_path / "t")), ["k"], {"m": ("a", S.percentile(0.5)), "q": ("b", S.percentile(0.9))}).collect()
    finally:
        S.cut = plain
    assert sum(seen) == 2

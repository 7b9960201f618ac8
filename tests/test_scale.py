"""Ordered primitives on a table where one key holds most rows and values tie heavily, with buckets far below that size."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scenequarry.operators import ordering as O
from scenequarry.operators import scale as S

SMALL = 37


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 900
    pdf = pd.DataFrame(
        {
            "k": np.where(np.arange(n) < 600, 0, rng.integers(1, 9, n)),
            "id": rng.permutation(n),
            "v": np.where(rng.random(n) < 0.4, 0.5, rng.integers(0, 50, n) / 10.0),
        }
    )
    return spark.createDataFrame(pdf).repartition(7), pdf


def ordered(pdf):
    return pdf.sort_values(["k", "v", "id"])


@pytest.mark.parametrize("rows", [SMALL, None])
def test_rank_and_running_sum(table, rows):
    df, pdf = table
    want = ordered(pdf)
    want = want.assign(rn=want.groupby("k").cumcount() + 1, cum=want.groupby("k")["v"].cumsum())
    got = S.rank_rows(df, ["k"], ["v", "id"], "rn", rows).toPandas().sort_values(["k", "v", "id"])
    assert got["rn"].tolist() == want["rn"].tolist()
    got = S.running_sum(df, ["k"], ["v", "id"], "v", "cum", rows).toPandas().sort_values(["k", "v", "id"])
    assert np.allclose(got["cum"], want["cum"])


@pytest.mark.parametrize("rows", [SMALL, None])
def test_fill_forward_and_neighbours(table, rows):
    df, pdf = table
    marked = df.withColumn("m", F.when(F.col("id") % 11 == 0, F.col("id")))
    want = ordered(pdf).assign(m=lambda d: d["id"].where(d["id"] % 11 == 0))
    want["f"] = want.groupby("k")["m"].ffill()
    got = S.fill_forward(marked, ["k"], ["v", "id"], "m", "f", rows).toPandas().sort_values(["k", "v", "id"])
    assert got["f"].astype(float).fillna(-1).tolist() == want["f"].fillna(-1).tolist()
    got = S.neighbours(df, ["k"], ["v", "id"], ["id"], {"a": -1, "b": 2}, rows).toPandas().sort_values(["k", "v", "id"])
    assert [r["id"] if r is not None else -1 for r in got["a"]] == ordered(pdf).groupby("k")["id"].shift(1).fillna(-1).astype(int).tolist()
    assert [r["id"] if r is not None else -1 for r in got["b"]] == ordered(pdf).groupby("k")["id"].shift(-2).fillna(-1).astype(int).tolist()


@pytest.mark.parametrize("rows", [SMALL, None])
def test_order_stats(table, rows):
    df, pdf = table
    got = S.order_stats(
        df, ["k"], {"med": ("v", S.percentile(0.5)), "p95": ("v", S.percentile(0.95)), "up": ("v", S.upper_median()), "i": ("id", S.percentile(0.3))}, rows
    ).toPandas().set_index("k").sort_index()
    g = pdf.groupby("k")
    assert np.allclose(got["med"], g["v"].median())
    assert np.allclose(got["p95"], g["v"].quantile(0.95))
    assert np.allclose(got["i"], g["id"].quantile(0.3))
    assert np.allclose(got["up"], g["v"].apply(lambda s: np.sort(s)[len(s) // 2]))
    assert got["n_rows"].tolist() == g.size().tolist()


@pytest.mark.parametrize("rows", [SMALL, None])
def test_take_smallest_with_ties(table, rows):
    df, pdf = table
    got = S.take_smallest(df, ["k"], "v", "id", F.floor(F.col("n_rows") * 0.4), rows).toPandas()
    want = ordered(pdf)
    want = want[want.groupby("k").cumcount() < np.floor(want.groupby("k")["id"].transform("size") * 0.4)]
    assert sorted(zip(got["k"], got["id"])) == sorted(zip(want["k"], want["id"]))


def test_draw_with_replacement_buckets_agree(spark, table):
    df, _ = table
    draws = spark.range(400).select((F.col("id") % 9).alias("k"), F.col("id").alias("draw_id"))
    runs = [
        sorted(map(tuple, O.weighted_draw_replace(df.repartition(p), ["k"], F.col("v"), "id", draws, 4, rows).collect()))
        for p, rows in ((1, None), (17, SMALL))
    ]
    present = {r[0] for r in df.select("k").distinct().collect()}
    assert runs[0] == runs[1]
    assert len(runs[0]) == sum(1 for i in range(400) if i % 9 in present)


def test_attach_falls_back_to_a_shuffle_join(table):
    df, pdf = table
    dim = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = S.attach(df, dim, ["k"], max_rows=2)
    assert out.agg(F.sum("n")).first()[0] == int((pdf.groupby("k").size() ** 2).sum())

import numpy as np

from scenequarry.operators import codebooks as CB


def slow_book(values, bins, iterations):
    v = np.array([x for x in values if x is not None], float)
    book = v.min() + (v.max() - v.min()) / (bins - 1) * np.arange(bins)
    for _ in range(iterations):
        below = np.searchsorted(book, v, side="right")
        lo, hi = np.maximum(below - 1, 0), np.minimum(below, bins - 1)
        at = np.where(book[hi] - v < v - book[lo], hi, lo)
        book = np.sort([v[at == i].mean() if (at == i).any() else b for i, b in enumerate(book)])
    return book


def test_books_equal_slow_rounds_with_repeats_and_nulls(spark):
    rng = np.random.default_rng(5)
    rows = [("a", float(x), float(y)) for x, y in zip(rng.choice([0.0, 0.25, 1.0, 3.5], 400), rng.normal(size=400), strict=True)]
    rows += [("b", 2.0, 2.0), ("b", None, 2.0), ("c", None, None)]
    df = spark.createDataFrame(rows, "scene_id string, s0 double, s1 double")
    got = {r.scene_id: r.book for r in CB.codebook_1d(df, ["scene_id"], ["s0", "s1"], bins=8).collect()}
    assert np.allclose(got["a"], slow_book([x for r in rows if r[0] == "a" for x in r[1:]], 8, 10), atol=1e-9)
    assert got["b"] == [2.0] * 8 and got["c"] == [None] * 8


def test_no_rows(spark):
    df = spark.createDataFrame([], "scene_id string, s0 double")
    assert CB.codebook_1d(df, ["scene_id"], ["s0"], bins=8, iterations=2).count() == 0


def test_first_joint_cell_holds_the_first_row_only(spark):
    from scenequarry.operators import aggregates as A

    rows = [("a", 0, 1.0, 0.05), ("a", 1, 1.5, 0.55), ("a", 2, 3.0, 0.95), ("a", 3, float("nan"), 0.05), ("a", 4, None, 0.05)]
    df = spark.createDataFrame(rows, "scene_id string, splat_id long, scale_max double, opacity double")
    args = (df, ("scale_max", "scale_max"), ("opacity", "opacity"))
    assert [r.splat_id for r in A.joint_cell(*args, (0, 0)).collect()] == [0]
    assert sum(r.n for r in A.joint_histogram(*args).collect()) == 3

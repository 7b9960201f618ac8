"""Codebooks: one-dimensional Lloyd iterations and vector k-means with a coarse level for large palettes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.session import cut

VECTOR_SIZES = (1, 2, 3, 4, 9, 12, 15, 24, 27, 45, 48)


def nearest_code(value: Column, book: Column) -> Column:
    """0-based index of the closest entry of a sorted array (the lower one on ties), by halving steps."""
    n = F.size(book)
    below = F.aggregate(
        F.array(*[F.lit(2**i) for i in reversed(range(17))]), F.lit(0),
        lambda pos, s: F.when((pos + s <= n) & (F.get(book, pos + s - 1) <= value), pos + s).otherwise(pos),
    )
    lo = F.greatest(below - 1, F.lit(0))
    hi = F.least(below, n - 1)
    return F.when(F.get(book, hi) - value < value - F.get(book, lo), hi).otherwise(lo)


def codebook_1d(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bins: int = 256, iterations: int = 10) -> DataFrame:
    """Sorted codebook shared by the columns of each key: (keys, book array<double>).

    Starts linear between the extremes; each round assigns values with map-side sums and moves the used entries to their
    mean. The input is read once: rounds run on the written counts of the different values of each key. The books are
    ``bins`` numbers per key; books and sums stay tables, so many keys run in one job. Nulls move no entry; a key of nulls
    alone has a book of nulls.
    """
    from scenequarry.operators.scale import attach

    keys = list(keys)
    values = df.select(*keys, F.explode(F.array(*[F.col(c).cast("double") for c in columns])).alias("v"))
    values = cut(values.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n")))
    ends = values.groupBy(*keys).agg(F.min("v").alias("a"), F.max("v").alias("b"))
    step = (F.col("b") - F.col("a")) / float(bins - 1)
    book = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.col("a") + step * i)
    books = cut(ends.select(*keys, book.alias("book")))
    for _ in range(iterations):
        j = attach(values.filter("v IS NOT NULL"), books, keys, max_rows=5_000, materialise=False)
        sums = j.groupBy(*keys, nearest_code(F.col("v"), F.col("book")).alias("i")).agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("m"))
        moved = sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("i", "m"))).alias("_m"))
        books = cut(
            books.join(moved, keys, "left").select(
                *keys,
                F.array_sort(
                    F.transform(F.col("book"), lambda v, i: F.coalesce(F.try_element_at(F.col("_m"), i), v))
                ).alias("book"),
            )
        )
    return books


def encode_1d(df: DataFrame, books: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace each column by the index of its nearest code (``<column>_code``)."""
    from scenequarry.operators.scale import attach

    j = attach(df, books, list(keys), max_rows=5_000, materialise=False)
    return j.select(*df.columns, *[nearest_code(F.col(c).cast("double"), F.col("book")).alias(f"{c}_code") for c in columns])


def palette_size(n: int) -> int:
    """clamp(min(64, 2^floor(log2(n/1024))) * 1024, 1024, n)."""
    if n < 1024:
        return max(n, 1)
    return min(n, max(1024, min(64, 2 ** int(math.floor(math.log2(n / 1024)))) * 1024))


def kmeans(
    df: DataFrame, id_col: str, vec: str, k: int, iterations: int = 10, seed: int = 0, direct_limit: int = 256
) -> tuple[DataFrame, DataFrame]:
    """(centroids: code, centre; labels: id, code): exactly k codes, all used, or one per different vector if there are no more.

    Rows are grouped by their vector and weighted, so equal rows never take two codes. Up to ``direct_limit`` codes, a
    parameter of the cost and not of the result's form, vectors are compared with all codes. Beyond it a coarse model splits
    the data first and each coarse cell is refined by Lloyd rounds on its own share of codes, so no step compares a vector
    with all k. Codes that end without vectors start again from those farthest from their code. Null vectors take no part.
    """
    from scenequarry.operators.scale import rank_rows

    rows = df.select(id_col, F.transform(vec, lambda v: v.cast("double")).alias("v")).filter("v IS NOT NULL")
    points = cut(rows.groupBy("v").agg(F.min(id_col).alias("_id"), F.count(F.lit(1)).cast("double").alias("w")))
    if points.limit(k + 1).count() <= k:
        # every vector is its own code
        own = cut(rank_rows(points.withColumn("_one", F.lit(0)), ["_one"], ["_id"], "_rn").withColumn("code", (F.col("_rn") - 1).cast("int")))
        return own.select("code", F.col("v").alias("centre")), rows.join(own.select("v", "code"), "v").select(id_col, "code")
    data = points.select("_id", "w", "v", array_to_vector("v").alias("features"))
    first = min(k, direct_limit)
    model = KMeans(k=first, maxIter=iterations, seed=seed, initMode="random", featuresCol="features", predictionCol="code", weightCol="w").fit(data)
    labelled = model.transform(data).select("_id", "v", "w", F.col("code").cast("int").alias("code"))
    if k > direct_limit:
        centres, labels = _refine(labelled.withColumnRenamed("code", "cell"), "_id", k, first, iterations)
        return centres, rows.join(points.select("_id", "v"), "v").join(labels, "_id").select(id_col, "code")
    centres = df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "code int, centre array<double>")
    centres, labelled = _fill(labelled, centres, k)
    return centres, rows.join(labelled.select("v", "code"), "v").select(id_col, "code")


def _distance(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def _fill(labelled: DataFrame, centres: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Centres and labels (``_id``, ``v``, ``code``) of different vectors, more than k, with no code left empty.

    An empty code moves to the vector farthest from its own code, several to as many vectors; only these codes can draw
    vectors. Each time the summed distance falls, so it ends. At most k centres move, a bounded broadcast.
    """
    while True:
        near = cut(labelled.join(F.broadcast(centres), "code").withColumn("d", _distance("v", "centre")).drop("centre"))
        empty = centres.join(near.select("code").distinct(), "code", "left_anti").select("code").orderBy("code").collect()
        if not empty:
            return centres, near.drop("d")
        far = near.filter("d > 0").orderBy(F.desc("d"), "_id").limit(len(empty)).select("v").collect()
        moved = centres.sparkSession.createDataFrame([(e.code, f.v) for e, f in zip(empty, far, strict=False)], "code int, centre array<double>")
        centres = cut(centres.join(F.broadcast(moved.select("code")), "code", "left_anti").unionByName(moved))
        fresh = F.broadcast(moved.agg(F.collect_list(F.struct("code", "centre")).alias("fresh")))
        ways = F.concat(F.array(F.struct("d", "code")), F.transform("fresh", lambda m: F.struct(_distance(F.col("v"), m["centre"]).alias("d"), m["code"].alias("code"))))
        labelled = near.crossJoin(fresh).withColumn("code", F.array_min(ways)["code"]).drop("d", "fresh")


def _refine(rows: DataFrame, id_col: str, k: int, cells: int, iterations: int) -> tuple[DataFrame, DataFrame]:
    """Split each coarse cell of different vectors (``v``, weight ``w``) into its share of k by Lloyd rounds over that cell's codes only."""
    from scenequarry.functions.elementwise import key_uniform
    from scenequarry.operators.scale import attach, rank_rows

    rows = cut(rows)
    # at most ``cells`` rows: each cell's share of k by largest remainder, never more than its vectors
    sizes = {r.cell: r.n for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, k = sum(sizes.values()), min(k, sum(sizes.values()))
    shares = {c: min(n, max(1, int(n * k / total))) for c, n in sizes.items()}
    order = sorted(sizes, key=lambda c: (-(sizes[c] * k / total) % 1, c))
    while (over := sum(shares.values()) - k) != 0:
        for c in order[::-1] if over > 0 else order:
            if over > 0 and shares[c] > 1:
                shares[c], over = shares[c] - 1, over - 1
            elif over < 0 and shares[c] < sizes[c]:
                shares[c], over = shares[c] + 1, over + 1
            if not over:
                break
        else:
            if all(s == 1 for s in shares.values()):
                break
    share = rows.sparkSession.createDataFrame(list(shares.items()), "cell int, share long")
    # starting codes: the vectors of each cell with the smallest keyed hash, as many as its share
    drawn = rank_rows(rows.withColumn("_u", key_uniform(17, F.col(id_col), 6)), ["cell"], ["_u", id_col], "_rn")
    codes = cut(attach(drawn, share, ["cell"], materialise=False).filter(F.col("_rn") <= F.col("share")).select("cell", F.col("_rn").alias("j"), F.col("v").alias("c")))
    rounds = 0
    while True:
        rounds += 1
        table = codes.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("j", "c"))).alias("codes"))
        near = attach(rows, table, ["cell"], max_rows=2_000, materialise=False)
        best = F.array_min(F.transform("codes", lambda c: F.struct(_distance(F.col("v"), c["c"]).alias("d"), c["j"].alias("j"))))
        near = cut(near.withColumn("_b", best).select(id_col, "cell", "v", "w", F.col("_b.j").alias("j"), F.col("_b.d").alias("d")))
        empty = cut(codes.join(near.select("cell", "j").distinct(), ["cell", "j"], "left_anti").select("cell", "j"))
        none_empty = empty.isEmpty()
        if none_empty and rounds >= iterations:
            break
        dims = near.select("cell", "j", "w", F.posexplode("v").alias("p", "x")).groupBy("cell", "j", "p").agg((F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("x"))
        moved = dims.groupBy("cell", "j").agg(F.array_sort(F.collect_list(F.struct("p", "x"))).alias("_e"))
        moved = moved.select("cell", "j", F.transform("_e", lambda e: e["x"]).alias("_c"))
        if not none_empty:
            # the n-th empty code of a cell moves to the n-th farthest vector of it; past the asked rounds the others stay
            far = rank_rows(near.filter("d > 0").withColumn("_far", -F.col("d")), ["cell"], ["_far", id_col], "_rn").select("cell", "_rn", F.col("v").alias("_c"))
            taken = rank_rows(empty, ["cell"], ["j"], "_rn").join(far, ["cell", "_rn"]).select("cell", "j", "_c")
            moved = taken if rounds >= iterations else moved.unionByName(taken)
        codes = cut(codes.join(moved, ["cell", "j"], "left").select("cell", "j", F.coalesce("_c", "c").alias("c")))
    names = cut(rank_rows(codes.withColumn("_one", F.lit(0)), ["_one"], ["cell", "j"], "_rn").select(
        "cell", "j", "c", (F.col("_rn") - 1).cast("int").alias("code")))
    labels = near.join(names.select("cell", "j", "code"), ["cell", "j"]).select(id_col, "code")
    return names.select("code", F.col("c").alias("centre")), labels


def quantisation_error(labels: DataFrame, centres: DataFrame, df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """Mean squared distance of rows to their code."""
    j = df.select(id_col, vec).join(labels, id_col).join(centres, "code")
    d = F.aggregate(F.zip_with(vec, "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return j.agg(F.avg(d).alias("mse"), F.countDistinct("code").alias("used"))


def columns_to_vector(columns: Sequence[str]) -> Column:
    if len(columns) not in VECTOR_SIZES:
        raise ValueError(f"unsupported vector size {len(columns)}")
    return F.array(*[F.col(c).cast("double") for c in columns])



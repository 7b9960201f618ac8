"""Orders, splits, draws and top-k choices. Ranks are exact and never need one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenequarry.functions.codes import lattice, morton
from scenequarry.functions.elementwise import key_uniform
from scenequarry.operators.scale import (
    attach,
    element,
    order_stats,
    rank_rows,
    running_sum,
    take_smallest,
    with_buckets,
)
from scenequarry.session import cut

XYZ = ("x", "y", "z")


def with_morton(points: DataFrame, keys: Sequence[str] = ("scene_id",), out: str = "morton") -> DataFrame:
    """30-bit Morton code of each point inside its scene's bounds."""
    aggs = []
    for a in XYZ:
        aggs += [F.min(a).alias(f"_{a}0"), (F.max(a) - F.min(a)).alias(f"_{a}e")]
    j = attach(points, points.groupBy(*keys).agg(*aggs), list(keys))
    j = j.withColumns({f"_i{a}": lattice(F.col(a), F.col(f"_{a}0"), F.col(f"_{a}e")) for a in XYZ})
    return j.select(*points.columns, morton(*[F.col(f"_i{a}") for a in XYZ]).alias(out))


def morton_sorted(points: DataFrame, tie: str = "splat_id", partitions: int | None = None) -> DataFrame:
    """Whole-table Morton order by range partitioning; nearby rows also share Parquet row groups when written."""
    coded = with_morton(points)
    cols = ["scene_id", "morton", tie]
    ranged = coded.repartitionByRange(partitions, *cols) if partitions else coded.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def morton_rank(points: DataFrame, tie: str = "splat_id", rows_per_bucket: int | None = None) -> DataFrame:
    return rank_rows(with_morton(points), ["scene_id"], ["morton", tie], "morton_rank", rows_per_bucket)


def sort_with_index(
    df: DataFrame, keys: Sequence[str], value: str, index: str, descending: bool = False, rows_per_bucket: int | None = None
) -> DataFrame:
    """Argsort: 0-based ``rank`` of each row by (value, index)."""
    d = df.withColumn("_o", -F.col(value) if descending else F.col(value))
    return rank_rows(d, keys, ["_o", index], "_rn", rows_per_bucket).select(*df.columns, (F.col("_rn") - 1).alias("rank"))


# ------------------------------------------------------------------ draws


def gumbel_key(weight: Column, key: Column, seed: int) -> Column:
    """-ln(-ln u) + ln w with u keyed by (seed, key); null for w <= 0."""
    u = F.least(F.greatest(key_uniform(seed, key), F.lit(1e-10)), F.lit(1.0 - 1e-7))
    return F.when(weight > 0, -F.ln(-F.ln(u)) + F.ln(F.when(weight > 0, weight)))


def weighted_draw(
    df: DataFrame, keys: Sequence[str], weight: Column, key: str, k: Column | int, seed: int,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """k weighted rows per group without replacement. Rows with weight <= 0 are never drawn."""
    k = k if isinstance(k, Column) else F.lit(k)
    keyed = df.withColumn("_g", -gumbel_key(weight, F.col(key), seed)).filter(F.col("_g").isNotNull())
    return take_smallest(keyed, keys, "_g", key, k, rows_per_bucket).drop("_g")


def weighted_draw_replace(
    df: DataFrame, keys: Sequence[str], weight: Column, key: str, draws: DataFrame, seed: int,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Draws with replacement. ``draws`` has the group keys and ``draw_id``; each draw gets the row whose weight interval

    of the group's running sum holds u * total. Both sides are cut into the same weight buckets, so the interval join is
    an equality join on the bucket followed by a merge of the bucket's two sorted lists.
    """
    keys = list(keys)
    rows = df.withColumn("_w", F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0))).filter("_w > 0")
    b = with_buckets(rows, keys, [key], rows_per_bucket)
    sums = b.df.groupBy(*keys, "_b").agg(F.sum("_w").alias("_s"), F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys)
    sums = cut(
        sums.select(
            *keys,
            "_b",
            "_s",
            F.coalesce(F.sum("_s").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_lo"),
            F.sum("_s").over(w).alias("_t"),
        )
    )
    ranges = sums.groupBy(*keys).agg(
        F.max("_t").alias("_t"), F.array_sort(F.collect_list(F.struct("_lo", "_b"))).alias("_edges")
    )
    d = attach(draws, ranges, keys, max_rows=5_000)
    target = key_uniform(seed, F.col("draw_id"), 5) * F.col("_t")
    d = d.withColumn("_x", target).withColumn(
        "_e", F.element_at(F.filter(F.col("_edges"), lambda e: e["_lo"] <= F.col("_x")), -1)
    )
    d = d.select(*draws.columns, F.col("_e._b").alias("_b"), (F.col("_x") - F.col("_e._lo")).alias("_pos"))
    # one ordered stream per bucket: each draw takes the first row whose running weight passes it
    rk = Window.partitionBy(*keys, "_b").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    edges = b.df.withColumn("_pos", F.sum("_w").over(rk)).select(
        *keys, "_b", "_pos", F.lit(1).alias("_side"), F.col(key).alias("_hit"), F.lit(None).cast("long").alias("draw_id")
    )
    stream = edges.unionByName(
        d.select(*keys, "_b", "_pos", F.lit(0).alias("_side"), F.lit(None).cast("long").alias("_hit"), "draw_id")
    )
    nxt = Window.partitionBy(*keys, "_b").orderBy(F.col("_pos").desc(), F.col("_side").desc()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    last = Window.partitionBy(*keys, "_b")
    found = (
        stream.withColumn("_n", F.last("_hit", ignorenulls=True).over(nxt))
        .withColumn("_n", F.coalesce("_n", F.max_by("_hit", "_pos").over(last)))
        .filter("_side = 0")
        .select(*keys, "draw_id", F.col("_n").alias(key))
    )
    return found


def random_rows(
    df: DataFrame, keys: Sequence[str], n: int, key: str, seed: int, frozen: str | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Exactly n rows per group by keyed hash; frozen rows come first."""
    u = key_uniform(seed, F.col(key), 6)
    if frozen:
        u = u + F.when(F.col(frozen), F.lit(0.0)).otherwise(F.lit(2.0))
    return take_smallest(df.withColumn("_u", u), keys, "_u", key, F.lit(n), rows_per_bucket).drop("_u")


def drop_least_opaque(
    df: DataFrame, keys: Sequence[str], ratio: float, key: str, rows_per_bucket: int | None = None
) -> DataFrame:
    """Drop the int(ratio * n) rows of lowest raw opacity per group; ties go by key."""
    d = df.withColumn("_neg", -F.col("opacity_raw")).withColumn("_nk", -F.col(key))
    keep = F.col("n_rows") - F.floor(F.col("n_rows") * F.lit(ratio))
    return take_smallest(d, keys, "_neg", "_nk", keep, rows_per_bucket).drop("_neg", "_nk")


def quantile_value(df: DataFrame, keys: Sequence[str], value: str, q: float, rows_per_bucket: int | None = None) -> DataFrame:
    """Element int(n*q) of the sorted values, clamped."""
    return order_stats(df, keys, {"q_value": (value, element(lambda n: F.floor(n * F.lit(q))))}, rows_per_bucket)


def normalise_by_median(
    df: DataFrame, keys: Sequence[str], value: str, out: str, rows_per_bucket: int | None = None
) -> DataFrame:
    """NaN to 0, then divide by element n/2 of the positive values (at least 1e-9); groups without positives become 0."""
    clean = F.when(F.isnan(value) | F.col(value).isNull(), F.lit(0.0)).otherwise(F.col(value).cast("double"))
    d = df.withColumn("_v", clean)
    med = order_stats(
        d.filter("_v > 0"), keys, {"_med": ("_v", element(lambda n: F.floor(n / 2)))}, rows_per_bucket
    ).drop("n_rows")
    j = attach(d, med, list(keys), "left")
    scaled = F.when(F.col("_med").isNull(), F.lit(0.0)).otherwise(F.col("_v") / F.greatest(F.col("_med"), F.lit(1e-9)))
    return j.withColumn(out, scaled).drop("_v", "_med")


def candidate_draw(
    df: DataFrame, keys: Sequence[str], key: str, budget: int, seed: int, error: str = "error", edge: str = "edge",
    edge_weight: float = 0.5, pool_factor: int = 4, rows_per_bucket: int | None = None,
) -> DataFrame:
    """Weighted choice of ``budget`` rows from the high-error pool.

    Pool: error at or above the (budget * pool_factor)-th largest. Score: error * (1 + w * edge), both divided by their
    positive median; when fewer scores than the budget are positive the edge alone is used, and then equal weights.
    """
    keys = list(keys)
    d = normalise_by_median(normalise_by_median(df, keys, error, "_err", rows_per_bucket), keys, edge, "_edge", rows_per_bucket)
    d = cut(d.withColumn("_nerr", -F.col("_err")))
    thr = order_stats(
        d, keys, {"_thr": ("_nerr", element(lambda n: F.least(n, F.lit(budget * pool_factor)) - 1))}, rows_per_bucket
    ).drop("n_rows")
    d = attach(d, thr, keys)
    score = F.when(F.col("_nerr") <= F.col("_thr"), F.col("_err") * (F.lit(1.0) + F.lit(edge_weight) * F.col("_edge"))).otherwise(0.0)
    d = d.withColumn("_score", score)
    counts = d.groupBy(*keys).agg(F.count_if(F.col("_score") > 0).alias("_ns"), F.count_if(F.col("_edge") > 0).alias("_ne"))
    d = attach(d, counts, keys)
    w = F.when(F.col("_ns") >= budget, F.col("_score")).when(F.col("_ne") > 0, F.col("_edge")).otherwise(F.lit(1.0))
    d = d.withColumn("weight", w)
    return weighted_draw(d, keys, F.col("weight"), key, budget, seed, rows_per_bucket).select(*df.columns, "weight")


def growth_draw(
    df: DataFrame, keys: Sequence[str], key: str, threshold: float, fraction: float, replace_count: int, max_rows: int,
    seed: int, rows_per_bucket: int | None = None,
) -> DataFrame:
    """Replacement and growth rows, disjoint and within the row budget. Columns used: opacity, visible, grad.

    Replacement draws by opacity among visible rows; growth draws by gradient among visible rows above the threshold that
    were not drawn before. Adds ``kind``.
    """
    keys = list(keys)
    grows = (F.col("grad") > threshold) & F.col("visible")
    stats = cut(
        df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(grows).alias("_above"),
            F.count_if(F.col("visible") & (F.col("opacity") > 0)).alias("_rep"),
        )
    )
    budget = F.greatest(F.lit(0), F.lit(max_rows) - F.col("_n"))
    stats = stats.withColumn("_replace", F.least(F.lit(replace_count), budget, F.col("_rep"))).withColumn(
        "_grow",
        F.greatest(
            F.lit(0), F.least(F.floor(F.col("_above") * F.lit(fraction) + 0.5) - F.col("_replace"), budget - F.col("_replace"))
        ),
    )
    d = cut(attach(df, stats.select(*keys, "_replace", "_grow"), keys))
    rep = _draw_by_column(d, keys, F.when(F.col("visible"), F.col("opacity")).otherwise(0.0), key, "_replace", seed, rows_per_bucket)
    rep = cut(rep.select(*keys, key))
    rest = d.filter(grows).join(rep, [*keys, key], "left_anti")
    gro = _draw_by_column(rest, keys, F.col("grad"), key, "_grow", seed + 1, rows_per_bucket)
    return (
        rep.withColumn("kind", F.lit("replace")).unionByName(gro.select(*keys, key).withColumn("kind", F.lit("grow")))
    )


def _draw_by_column(d, keys, weight, key, count_col, seed, rows_per_bucket):
    """Weighted draw where the number of rows is a column that is constant inside the group."""
    keyed = d.withColumn("_g", -gumbel_key(weight, F.col(key), seed)).filter(F.col("_g").isNotNull())
    ranked = rank_rows(keyed, keys, ["_g", key], "_rn", rows_per_bucket)
    return ranked.filter(F.col("_rn") <= F.col(count_col)).drop("_g", "_rn")


def shuffled_epoch(
    df: DataFrame, keys: Sequence[str], key: str, seed: int, epoch: int, batch: int, drop_last: bool = False,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Position and batch number of each row in a keyed shuffle."""
    d = df.withColumn("_u", key_uniform(seed + 7919 * epoch, F.col(key), 7))
    r = rank_rows(d, keys, ["_u", key], "_rn", rows_per_bucket).drop("_u")
    r = r.withColumn("position", F.col("_rn") - 1).withColumn("batch", F.floor((F.col("_rn") - 1) / batch).cast("long"))
    if drop_last:
        n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        r = attach(r, n, list(keys)).filter((F.col("batch") + 1) * batch <= F.col("_n")).drop("_n")
    return r.drop("_rn")


def cumulative_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, rows_per_bucket: int | None = None):
    return running_sum(df, keys, order, value, "cum", rows_per_bucket)


def train_split(df: DataFrame, keys: Sequence[str], name: str, test_every: int, rows_per_bucket: int | None = None) -> DataFrame:
    """Every ``test_every``-th row by name is validation."""
    r = rank_rows(df, keys, [name], "_rn", rows_per_bucket)
    return r.withColumn("is_validation", (F.col("_rn") - 1) % test_every == 0).drop("_rn")


def top_by(df: DataFrame, scope: str, value: str, k: int) -> DataFrame:
    """Largest total per scope, k rows."""
    return (
        df.groupBy(scope)
        .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("total"), scope)
        .limit(k)
    )

"""Building blocks that keep per-group work spread over the cluster when one group holds much of the table.

``attach``        joins a per-group dimension, broadcast only after its row count was checked.
``with_buckets``  splits large groups into ordered buckets, so that no window or sort sees a whole large group.
``rank_rows``, ``running_sum``, ``fill_forward``, ``neighbours``  are exact ordered computations on those buckets.
``order_stats``   gives exact order statistics without sorting or shuffling whole groups.
``take_smallest`` keeps exactly k rows per group, k being data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenequarry.session import cut

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 256 << 20
ROWS_PER_BUCKET = 500_000
SPLITS_PER_GROUP = 1024


def attach(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    materialise: bool = True,
    rows: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a dimension table. It is materialised once, counted, and broadcast only up to ``max_rows`` rows and ``max_bytes``;

    beyond that a shuffle join runs, where adaptive execution splits skewed keys. ``rows`` is the count if known. Columns of
    fixed width count with their width; lists, maps and texts are measured.
    """
    if rows is None and materialise:
        dim = cut(dim)
    wide = [f.name for f in dim.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.StringType, T.BinaryType))]
    if rows is None:
        head = dim.limit(max_rows + 1)
        size = F.sum(F.length(F.to_json(F.struct(*wide))).cast("long")) if wide else F.lit(0).cast("long")
        rows, measured = head.agg(F.count(F.lit(1)), size).first()
        measured = measured or 0
    else:
        measured = 0
    small = rows <= max_rows and measured + 16 * len(dim.columns) * rows <= max_bytes
    return df.join(F.broadcast(dim) if small else dim, list(on), how)


# ------------------------------------------------------------------ ordered buckets


@dataclass
class Buckets:
    """Rows with ``_b`` rising along ``order`` inside each key, and the bucket sizes seen so far."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    split: bool


def _split_position(splits: Column, row: Column, n: int) -> Column:
    """How many entries of the sorted array ``splits`` are below ``row`` (binary search by halving steps); ``n`` bounds its size."""
    step, steps = 1, []
    while step <= n:
        steps.append(step)
        step *= 2
    probe = F.array(*[F.lit(s) for s in reversed(steps)])
    return F.aggregate(
        probe,
        F.lit(0),
        lambda pos, s: F.when(
            (pos + s <= F.size(splits)) & (F.get(splits, pos + s - 1) < row), pos + s
        ).otherwise(pos),
    )


def _cut_large(df: DataFrame, keys: list[str], order: list[str], large: DataFrame, limit: int) -> DataFrame:
    """``df`` with ``_sub``: the ordered part of its key, 0 in keys that ``large`` (keys, _n) doesn't name."""
    row = F.struct(*[F.col(c) for c in order])
    wanted = F.least(F.ceil(F.col("_n") / F.lit(limit)) * 2, F.lit(SPLITS_PER_GROUP))
    # the upper 63 bits of the hash as a share of one: so many rows are drawn as are wanted, however large the key is
    share = F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in keys + order]), 1).cast("double") / F.lit(2.0**63)
    drawn = attach(df.select(*keys, *order), large, keys, materialise=False).filter(share * F.col("_n") < wanted)
    splits = cut(drawn.groupBy(*keys).agg(F.array_sort(F.collect_set(row)).alias("_splits")))
    longest = splits.agg(F.max(F.size("_splits"))).first()[0] or 0
    out = attach(df, splits, keys, how="left", max_rows=2_000, materialise=False)
    return out.withColumn("_sub", F.when(F.col("_splits").isNull(), F.lit(0)).otherwise(_split_position(F.col("_splits"), row, longest)).cast("long")).drop("_splits")


def with_buckets(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_bucket: int | None = None
) -> Buckets:
    """Number ordered buckets inside every key. Keys up to ``rows_per_bucket`` rows stay whole.

    Larger keys are cut at split rows drawn by a hash of the row itself, so a recomputed task makes the same buckets. At most
    about ``SPLITS_PER_GROUP`` splits are drawn at once; buckets that are still far too large are cut again within
    themselves, so their number has no limit while no row carries a long list of splits. ``order`` columns are ascending;
    with a unique last column heavy ties are split as well.
    """
    keys, order = list(keys), list(order)
    limit = rows_per_bucket or ROWS_PER_BUCKET
    large = cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit))
    if large.isEmpty():
        return Buckets(df.withColumn("_b", F.lit(0)), keys, order, False)
    out = _cut_large(df, keys, order, large, limit).withColumnRenamed("_sub", "_b")
    factor = 8 * SPLITS_PER_GROUP
    before = None
    # a second level is needed only where one level of splits can't have been enough
    while not large.filter(F.col("_n") > F.lit(limit) * F.lit(SPLITS_PER_GROUP // 2)).isEmpty():
        out = cut(out)
        sizes = out.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*order)).alias("_lo"), F.max(F.struct(*order)).alias("_hi"))
        large = cut(sizes.filter((F.col("_n") > F.lit(4 * limit)) & (F.col("_lo") < F.col("_hi"))).select(*keys, "_b", "_n"))
        now = large.agg(F.sum("_n")).first()[0]
        if now is None or now == before:
            break
        before = now
        out = _cut_large(out, [*keys, "_b"], order, large, limit).withColumn("_b", F.col("_b") * factor + F.col("_sub")).drop("_sub")
    return Buckets(out.select(*df.columns, "_b"), keys, order, True)


def _before(summary: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Exclusive running sum over the bucket summary (one row per bucket)."""
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(*keys, "_b", F.coalesce(F.sum(value).over(w), F.lit(0)).alias(out))


def rank_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn", rows_per_bucket: int | None = None
) -> DataFrame:
    """Exact 1-based rank of each row inside its key."""
    b = with_buckets(df, keys, order, rows_per_bucket)
    local = F.row_number().over(Window.partitionBy(*b.keys, "_b").orderBy(*b.order)).cast("long")
    if not b.split:
        return b.df.withColumn(out, local).drop("_b")
    sizes = b.df.groupBy(*b.keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    off = _before(sizes, b.keys, "_c", "_off")
    return (
        attach(b.df.withColumn(out, local), off, [*b.keys, "_b"])
        .withColumn(out, F.col(out) + F.col("_off"))
        .drop("_b", "_off")
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "cum",
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Inclusive running sum: in-bucket window plus the sums of the earlier buckets."""
    b = with_buckets(df, keys, order, rows_per_bucket)
    w = Window.partitionBy(*b.keys, "_b").orderBy(*b.order).rowsBetween(Window.unboundedPreceding, 0)
    local = b.df.withColumn(out, F.sum(value).over(w))
    if not b.split:
        return local.drop("_b")
    sums = b.df.groupBy(*b.keys, "_b").agg(F.sum(value).alias("_s"))
    off = _before(sums, b.keys, "_s", "_off")
    return (
        attach(local, off, [*b.keys, "_b"]).withColumn(out, F.col(out) + F.col("_off")).drop("_b", "_off")
    )


def fill_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Last non-null ``value`` at or before each row; across buckets the last value of each bucket is carried on."""
    b = with_buckets(df, keys, order, rows_per_bucket)
    w = Window.partitionBy(*b.keys, "_b").orderBy(*b.order).rowsBetween(Window.unboundedPreceding, 0)
    local = b.df.withColumn(out, F.last(value, ignorenulls=True).over(w))
    if not b.split:
        return local.drop("_b")
    row = F.struct(*[F.col(c) for c in b.order])
    ends = b.df.groupBy(*b.keys, "_b").agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), row)).alias("_v")
    )
    wb = Window.partitionBy(*b.keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*b.keys, "_b", F.last("_v", ignorenulls=True).over(wb).alias("_carry"))
    return (
        attach(local, carry, [*b.keys, "_b"])
        .withColumn(out, F.coalesce(F.col(out), F.col("_carry")))
        .drop("_b", "_carry")
    )


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    offsets: dict[str, int],
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add one struct column per entry of ``offsets`` holding ``cols`` of the row that many places away (null outside)."""
    keys = list(keys)
    payload = F.struct(*[F.col(c) for c in cols])
    b = with_buckets(df, keys, order, rows_per_bucket)
    if not b.split:
        w = Window.partitionBy(*keys).orderBy(*b.order)
        for name, k in offsets.items():
            df = df.withColumn(name, F.lead(payload, k).over(w) if k >= 0 else F.lag(payload, -k).over(w))
        return df
    ranked = cut(rank_rows(df, keys, order, "_rn", rows_per_bucket))
    out = ranked
    for name, k in offsets.items():
        other = ranked.select(*keys, (F.col("_rn") - k).alias("_rn"), payload.alias(name))
        out = out.join(other, [*keys, "_rn"], "left")
    return out.drop("_rn")


# ------------------------------------------------------------------ order statistics


@dataclass(frozen=True)
class Pick:
    """An order statistic: ``rank(n)`` is the fractional 0-based rank; fractional ranks interpolate linearly."""

    rank: Callable[[Column], Column]


def element(index: Callable[[Column], Column]) -> Pick:
    """The element at an integer index that is clamped to the group."""
    return Pick(lambda n: F.greatest(F.lit(0), F.least(index(n).cast("long"), n - 1)).cast("double"))


def upper_median() -> Pick:
    """Element n/2."""
    return element(lambda n: F.floor(n / 2))


def percentile(p: float) -> Pick:
    """Linear interpolation between the two nearest ranks."""
    return Pick(lambda n: (n - 1).cast("double") * F.lit(p))


#: Steps of the grid that a sketch gives, and its accuracy: values at grid places are off by a sixteenth of a step at most.
GRID, ACCURACY = 256, 4096


def _sketches(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key: ``_n_i`` rows with the i-th value and ``_g_i``, its approximate quantiles on the grid (mergeable, one scan)."""
    grid = [k / GRID for k in range(GRID + 1)]
    aggs = []
    for i, v in enumerate(values):
        # NaN sorts last, like infinity
        x = F.col(v).cast("double")
        aggs += [F.count(v).alias(f"_n_{i}"), F.percentile_approx(F.when(F.isnan(x), F.lit(float("inf"))).otherwise(x), grid, ACCURACY).alias(f"_g_{i}")]
    return cut(df.groupBy(*keys).agg(*aggs))


def _at_ranks(df: DataFrame, keys: list[str], asks: list[tuple[str, Callable[[Column], Column], Callable[[Column], Column]]], rows_per_bucket: int | None = None) -> DataFrame:
    """Exact values at ranks: (keys, p, _n, _lo, _hi, _v, _from, _to).

    The p-th entry of ``asks`` names a value column and the lowest and highest wanted rank (0-based, as functions of the
    number of values; with a single value column they may name it ``n_rows``). Rows are those values between which the ranks lie, each once with the ranks ``_from`` to ``_to``
    (exclusive) that it holds. Two scans: a sketch per key brackets the ranks by two grid values that lie at least a step
    outside, as far as its error can't reach; then values in the bracket are counted one by one and all below it at once.
    Keys of up to ``ACCURACY`` rows have no bracket. A crowded bracket is split like any large key.
    """
    values = sorted({v for v, _, _ in asks})
    told = _sketches(df, keys, values)
    told = told.withColumn("n_rows", F.col("_n_0")) if len(values) == 1 else told
    bounds, wanted = [], []
    for p, (v, low, high) in enumerate(asks):
        i = values.index(v)
        n, g = F.col(f"_n_{i}"), F.col(f"_g_{i}")
        lo, hi = low(n).cast("long"), high(n).cast("long")
        step = n / F.lit(GRID)
        below, above = F.floor(lo / step).cast("int") - 1, F.ceil((hi + 1) / step).cast("int") + 1
        large = n > ACCURACY
        upper = F.when(large & (above <= GRID), F.get(g, above))
        bounds += [F.when(large & (below >= 0), F.get(g, below)).alias(f"_lo_{p}"), F.when(upper != float("inf"), upper).alias(f"_hi_{p}")]
        wanted.append(F.struct(F.lit(p).alias("p"), n.alias("_n"), lo.alias("_lo"), hi.alias("_hi")))
    brackets = told.select(*keys, *bounds)
    ranks = told.select(*keys, F.explode(F.array(*wanted)).alias("_w")).select(*keys, "_w.*").filter("_n > 0")
    entries = []
    for p, (v, _, _) in enumerate(asks):
        x = F.col(v).cast("double")
        under = F.coalesce(x < F.col(f"_lo_{p}"), F.lit(False))
        inside = x.isNotNull() & F.coalesce(x <= F.col(f"_hi_{p}"), F.col(f"_hi_{p}").isNull())
        entries.append(F.when(inside, F.struct(F.lit(p).alias("p"), under.alias("_under"), F.when(~under, x).alias("_v"))))
    rows = attach(df.select(*keys, *values), brackets, keys, materialise=False)
    rows = rows.select(*keys, F.explode(F.array_compact(F.array(*entries))).alias("_e")).select(*keys, "_e.*")
    counted = cut(rows.groupBy(*keys, "p", "_under", "_v").agg(F.count(F.lit(1)).alias("_k")))
    under = counted.filter("_under").select(*keys, "p", F.col("_k").alias("_before"))
    inside = running_sum(counted.filter("NOT _under").select(*keys, "p", "_v", "_k"), [*keys, "p"], ["_v"], "_k", "_to", rows_per_bucket)
    placed = attach(attach(inside, under, [*keys, "p"], "left", materialise=False), ranks, [*keys, "p"], materialise=False)
    placed = placed.withColumn("_to", F.col("_to") + F.coalesce("_before", F.lit(0))).withColumn("_from", F.col("_to") - F.col("_k"))
    return placed.filter((F.col("_from") <= F.col("_hi")) & (F.col("_to") > F.col("_lo"))).select(*keys, "p", "_n", "_lo", "_hi", "_v", "_from", "_to")


def order_stats(
    df: DataFrame,
    keys: Sequence[str],
    picks: dict[str, tuple[str, Pick]],
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Exact order statistics per key; ``picks`` maps the output name to (value column, statistic). Adds ``n_rows``.

    Two scans, however many statistics: see ``_at_ranks``.
    """
    keys = list(keys)
    asks = [(v, (lambda n, r=pick.rank: F.floor(r(n))), (lambda n, r=pick.rank: F.ceil(r(n)))) for v, pick in picks.values()]
    hit = _at_ranks(df, keys, asks, rows_per_bucket)
    aggs = [F.max("_n").alias("n_rows")]
    for p, (name, (_, pick)) in enumerate(picks.items()):
        own = F.col("p") == p
        lo = F.max(F.when(own & (F.col("_from") <= F.col("_lo")) & (F.col("_lo") < F.col("_to")), F.col("_v")))
        hi = F.max(F.when(own & (F.col("_from") <= F.col("_hi")) & (F.col("_hi") < F.col("_to")), F.col("_v")))
        r = pick.rank(F.col("_n"))
        aggs.append((lo + (hi - lo) * F.max(F.when(own, r - F.floor(r)))).alias(name))
    return hit.groupBy(*keys).agg(*aggs)


def take_smallest(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    tie: str,
    k: Column,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Keep the ``k(n)`` smallest rows per key by (value, tie). ``k`` may use ``n_rows``, the rows of the key.

    The cut-off comes from ``_at_ranks`` (two scans); in the third, rows pass it by a narrow filter, and only rows equal to
    it are ranked.
    """
    keys = list(keys)

    def last(n: Column) -> Column:
        return F.greatest(F.lit(-1), F.least(k, n) - 1)

    hit = _at_ranks(df, keys, [(value, last, last)], rows_per_bucket)
    cutoff = hit.select(*keys, F.col("_v").alias("_cut"), (F.col("_lo") + 1 - F.col("_from")).alias("_ties"))
    marked = attach(df, cutoff, keys)
    x = F.col(value).cast("double")
    below = marked.filter(x < F.col("_cut")).select(*df.columns)
    equal = rank_rows(marked.filter(x == F.col("_cut")), keys, [value, tie], "_rn", rows_per_bucket)
    return below.unionByName(equal.filter(F.col("_rn") <= F.col("_ties")).select(*df.columns))

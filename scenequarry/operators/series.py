"""Ordered series: averages, convergence, keyframe evaluation, paths and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.functions.elementwise import ease
from scenequarry.operators.scale import attach, fill_forward, neighbours, rank_rows


def loss_average(
    losses: DataFrame, keys: Sequence[str], step: str, loss: str, alpha: float, rows_per_bucket: int | None = None
) -> DataFrame:
    """Exponential moving average per key after its last step, the latest loss and the number of samples.

    ema_n = a*l_n + (1-a)*ema_(n-1) with ema_1 = l_1, that is a weighted sum with weights a*(1-a)^(n-i); the first row
    has weight (1-a)^(n-1). A rank and a sum replace the sequential fold, so one long series is no single task's work.
    """
    keys = list(keys)
    r = rank_rows(losses, keys, [step], "_rn", rows_per_bucket)
    n = losses.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    j = attach(r, n, keys)
    w = F.pow(F.lit(1.0 - alpha), (F.col("_n") - F.col("_rn")).cast("double"))
    w = F.when(F.col("_rn") == 1, w).otherwise(F.lit(alpha) * w)
    return j.groupBy(*keys).agg(
        F.sum(w * F.col(loss)).alias("ema"), F.max_by(loss, step).alias("latest"), F.count(F.lit(1)).alias("samples")
    )


def convergence(
    losses: DataFrame, keys: Sequence[str], step: str, loss: str, window: int, threshold: float,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Whether the last ``window`` losses changed by less than the threshold, relative to the first of them."""
    keys = list(keys)
    back = losses.withColumn("_back", -F.col(step))
    r = rank_rows(back, keys, ["_back"], "_rn", rows_per_bucket)
    g = r.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("_rn") == 1, F.col(loss))).alias("last_loss"),
        F.max(F.when(F.col("_rn") == window, F.col(loss))).alias("first_loss"),
    )
    rel = F.abs(F.col("last_loss") - F.col("first_loss")) / (F.abs("first_loss") + F.lit(1e-12))
    ok = (F.col("n") >= window) & ((F.col("first_loss") == 0) | (rel < threshold))
    return g.withColumn("converged", F.coalesce(ok, F.lit(False)))


def counter_rates(
    samples: DataFrame, scope: str, order: str, value: str, time: str | None = None, rows_per_bucket: int | None = None
) -> DataFrame:
    """Change since the previous sample of the scope, and per second when ``time`` (seconds) is given."""
    cols = [value] + ([time] if time else [])
    d = neighbours(samples, [scope], [order], cols, {"_p": -1}, rows_per_bucket)
    d = d.withColumn("delta", F.col(value) - F.coalesce(F.col(f"_p.{value}"), F.lit(0)))
    if time:
        dt = F.col(time) - F.col(f"_p.{time}")
        d = d.withColumn("rate", F.when(dt > 0, F.col("delta") / dt))
    return d.drop("_p")


# ------------------------------------------------------------------ keyframes


KEYFRAME = ("t", "px", "py", "pz", "qw", "qx", "qy", "qz", "focal", "easing")


def with_segments(keyframes: DataFrame, keys: Sequence[str], rows_per_bucket: int | None = None) -> DataFrame:
    """Each keyframe with its neighbours: ``k0`` (or itself at the start), ``k1`` itself, ``k2``, ``k3`` (clamped)."""
    payload = [c for c in KEYFRAME if c in keyframes.columns]
    d = neighbours(keyframes, keys, ["t"], payload, {"_m1": -1, "_p1": 1, "_p2": 2}, rows_per_bucket)
    me = F.struct(*[F.col(c) for c in payload])
    return d.select(
        *keys, "t", F.coalesce("_m1", me).alias("k0"), me.alias("k1"), F.col("_p1").alias("k2"),
        F.coalesce("_p2", "_p1").alias("k3"),
    )


def slerp(a: Sequence[Column], b: Sequence[Column], t: Column) -> list[Column]:
    """Spherical interpolation along the shorter arc; nearly parallel rotations interpolate linearly."""
    d = sum((x * y for x, y in zip(a[1:], b[1:])), a[0] * b[0])
    sign = F.when(d < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    c = F.least(F.abs(d), F.lit(1.0))
    theta = F.acos(c)
    s = F.sin(theta)
    flat = c > F.lit(1.0 - 1.1920929e-07)
    safe = F.when(flat, F.lit(1.0)).otherwise(s)
    wa = F.when(flat, F.lit(1.0) - t).otherwise(F.sin((F.lit(1.0) - t) * theta) / safe)
    wb = F.when(flat, t).otherwise(F.sin(t * theta) / safe) * sign
    return [wa * x + wb * y for x, y in zip(a, b)]


def catmull_rom(p0: Column, p1: Column, p2: Column, p3: Column, t: Column) -> Column:
    """Cubic through p1 and p2 with half central differences as tangents (Horner form)."""
    a = p1 * 3.0 - p0 - p2 * 3.0 + p3
    b = p0 * 2.0 - p1 * 5.0 + p2 * 4.0 - p3
    return p1 + F.lit(0.5) * t * ((p2 - p0) + t * (b + t * a))


def _normalised(prefix: str) -> list[Column]:
    q = [F.col(f"{prefix}.q{a}") for a in "wxyz"]
    n = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3])
    return [c / F.when(n > 0, n) for c in q]


def evaluate_clip(
    keyframes: DataFrame, times: DataFrame, keys: Sequence[str], spline: bool = False, rows_per_bucket: int | None = None
) -> DataFrame:
    """Value of each clip at query times (keys, qt), clamped to its ends.

    Tracks interpolate linearly on segments [t_i, t_i+1). Splines use (t_i, t_i+1] and the cubic through four keyframes.
    An as-of lookup: keyframes and queries form one ordered stream in which the last keyframe is carried forward.
    """
    keys = list(keys)
    seg = with_segments(keyframes, keys, rows_per_bucket)
    span = keyframes.groupBy(*keys).agg(F.min("t").alias("_t0"), F.max("t").alias("_t1"))
    q = attach(times.select(*keys, "qt"), span, keys).withColumn(
        "t", F.greatest(F.least(F.col("qt"), F.col("_t1")), F.col("_t0"))
    )
    # order inside equal times: a track query follows its keyframe, a spline query precedes it, except at the start
    side = F.when(F.col("t") <= F.col("_t0"), F.lit(2)).otherwise(F.lit(0 if spline else 2))
    line = seg.select(*keys, "t", F.lit(1).alias("_side"), F.lit(None).cast("double").alias("qt"),
                      F.struct("k0", "k1", "k2", "k3").alias("_seg"))
    seg_type = line.schema["_seg"].dataType
    line = line.unionByName(
        q.select(*keys, "t", side.alias("_side"), "qt", F.lit(None).cast(seg_type).alias("_seg"))
    )
    carried = fill_forward(line, keys, ["t", "_side", "qt"], "_seg", "_s", rows_per_bucket).filter("_side <> 1")
    c = carried.select(*keys, "qt", "t", "_s.*")
    length = F.col("k2.t") - F.col("k1.t")
    c = c.withColumn(
        "_u", ease(F.when(length > 0, (F.col("t") - F.col("k1.t")) / length).otherwise(F.lit(0.0)), F.col("k1.easing"))
    )
    c = c.withColumns({"k2": F.coalesce("k2", "k1"), "k3": F.coalesce("k3", "k1"), "_u": F.coalesce("_u", F.lit(0.0))})
    u = F.col("_u")
    if spline:
        pos = [catmull_rom(*[F.col(f"k{i}.p{a}") for i in range(4)], u) for a in "xyz"]
    else:
        pos = [F.col(f"k1.p{a}") + (F.col(f"k2.p{a}") - F.col(f"k1.p{a}")) * u for a in "xyz"]
    out = c.withColumns({f"_a{i}": v for i, v in enumerate(_normalised("k1"))} | {f"_b{i}": v for i, v in enumerate(_normalised("k2"))})
    rot = slerp([F.col(f"_a{i}") for i in range(4)], [F.col(f"_b{i}") for i in range(4)], u)
    return out.select(
        *keys, "qt", *[p.alias(f"p{a}") for p, a in zip(pos, "xyz")], *[r.alias(f"q{a}") for r, a in zip(rot, "wxyz")],
        (F.col("k1.focal") + (F.col("k2.focal") - F.col("k1.focal")) * u).alias("focal"),
    )


def spline_path(keyframes: DataFrame, keys: Sequence[str], samples: int, rows_per_bucket: int | None = None) -> DataFrame:
    """``samples`` points per segment and one more in the last; a single keyframe gives its own position."""
    keys = list(keys)
    seg = with_segments(keyframes, keys, rows_per_bucket)
    n = F.when(F.col("k2").isNull(), F.lit(0)).when(F.col("k3.t") == F.col("k2.t"), F.lit(samples)).otherwise(F.lit(samples - 1))
    alone = F.col("k2").isNull() & (F.col("k0.t") == F.col("k1.t"))
    seg = seg.filter(F.col("k2").isNotNull() | alone).withColumn("_i", F.explode(F.sequence(F.lit(0), n)))
    seg = seg.withColumns({"k2": F.coalesce("k2", "k1"), "k3": F.coalesce("k3", "k1")})
    seg = seg.withColumn("_u", ease(F.col("_i") / F.lit(float(samples)), F.col("k1.easing")))
    pos = [catmull_rom(*[F.col(f"k{i}.p{a}") for i in range(4)], F.col("_u")) for a in "xyz"]
    return seg.select(*keys, F.col("k1.t").alias("segment_start"), F.col("_i").alias("sample"),
                      *[p.alias(f"p{a}") for p, a in zip(pos, "xyz")])


def path_times(keyframes: DataFrame, keys: Sequence[str], step: float | None = None) -> DataFrame:
    """Query times start + i*step before the end, then the end itself."""
    s = step if step and step > 0 else 1.0 / 30.0
    span = keyframes.groupBy(*keys).agg(F.min("t").alias("a"), F.max("t").alias("b"))
    n = F.greatest(F.ceil((F.col("b") - F.col("a")) / s) - 1, F.lit(0))
    inner = span.filter("b > a").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), n)))
    inner = inner.select(*keys, (F.col("a") + F.col("i") * s).alias("qt"), "b").filter("qt < b").select(*keys, "qt")
    return inner.unionByName(span.select(*keys, F.col("b").alias("qt")))


def with_loop_end(keyframes: DataFrame, keys: Sequence[str], gap: float) -> DataFrame:
    """Closing keyframe that repeats the first one ``gap`` after the last; flagged ``synthetic`` so that saves leave it out."""
    keys = list(keys)
    rest = [c for c in keyframes.columns if c not in (*keys, "t")]
    ends = keyframes.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), "t").alias("_first"), (F.max("t") + gap).alias("t"), F.count(F.lit(1)).alias("_n")
    )
    closing = ends.filter("_n > 1").select(*keys, "t", "_first.*", F.lit(True).alias("synthetic"))
    return keyframes.withColumn("synthetic", F.lit(False)).unionByName(closing)


def real_span(keyframes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count and end time without the synthetic keyframe."""
    return keyframes.filter(~F.col("synthetic")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("keyframes"), F.max("t").alias("end_time")
    )



"""Votes, summaries, bounds, histograms, reductions and roll-ups. Everything combines on the map side before it shuffles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.operators.scale import attach, element, order_stats, percentile, rank_rows, upper_median
from scenequarry.session import cut

XYZ = ("x", "y", "z")


# ------------------------------------------------------------------ labels


def majority_vote(votes: DataFrame, splats: DataFrame, min_votes: int = 2) -> DataFrame:
    """Label of each splat: most votes, ties to the label seen in the earliest view, 0 below ``min_votes``.

    ``votes``: scene_id, splat_id, label (> 0), view_index; or counted votes: scene_id, splat_id, label, n, first.
    """
    counted = "view_index" not in votes.columns
    per_label = votes.groupBy("scene_id", "splat_id", "label").agg(
        (F.sum("n") if counted else F.count(F.lit(1))).alias("n"), F.min("first" if counted else "view_index").alias("first")
    )
    best = per_label.groupBy("scene_id", "splat_id").agg(
        F.max_by("label", F.struct("n", -F.col("first"))).alias("label"),
        F.sum("n").alias("votes"),
    )
    best = best.filter(F.col("votes") >= min_votes).select("scene_id", "splat_id", "label")
    out = splats.join(best, ["scene_id", "splat_id"], "left")
    return out.withColumn("label", F.coalesce(F.col("label"), F.lit(0)))


def object_summary(labelled: DataFrame, min_count: int = 10) -> DataFrame:
    """Count, centroid and bounding box per object; small objects are left out, background keeps only its count."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for a in XYZ:
        aggs += [F.avg(a).alias(f"c{a}"), F.min(a).alias(f"min_{a}"), F.max(a).alias(f"max_{a}")]
    g = labelled.groupBy("scene_id", "label").agg(*aggs).filter((F.col("label") == 0) | (F.col("n") >= min_count))
    zero = F.col("label") == 0
    geo = [f"c{a}" for a in XYZ] + [f"{m}_{a}" for a in XYZ for m in ("min", "max")]
    return g.select("scene_id", "label", "n", *[F.when(zero, F.lit(0.0)).otherwise(F.col(c)).alias(c) for c in geo])


def label_distribution(labelled: DataFrame) -> DataFrame:
    counts = cut(labelled.groupBy("scene_id", "label").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("scene_id").agg(F.sum("n").alias("_t"))
    return counts.join(totals, "scene_id").select(
        "scene_id", "label", "n", (F.col("n") * 100.0 / F.col("_t")).alias("pct")
    )


# ------------------------------------------------------------------ bounds


def bounds(
    rows: DataFrame, keys: Sequence[str] = ("scene_id",), padding: float = 0.0, trimmed: bool = False,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Min/max per axis, padded. ``trimmed`` leaves out 1 % at each end in groups of more than 100 rows."""
    keys = list(keys)
    live = rows.filter(~F.col("deleted")) if "deleted" in rows.columns else rows
    if not trimmed:
        return live.groupBy(*keys).agg(
            *[f(a).alias(f"{n}_{a}") for a in XYZ for n, f in (("min", F.min), ("max", F.max))]
        ).select(
            *keys, *[(F.col(f"min_{a}") - padding).alias(f"min_{a}") for a in XYZ],
            *[(F.col(f"max_{a}") + padding).alias(f"max_{a}") for a in XYZ],
        )
    trim = lambda n: F.when(n > 100, F.floor(n / 100)).otherwise(F.lit(0))
    picks = {}
    for a in XYZ:
        picks[f"min_{a}"] = (a, element(trim))
        picks[f"max_{a}"] = (a, element(lambda n: n - 1 - trim(n)))
    s = order_stats(live, keys, picks, rows_per_bucket)
    return s.select(
        *keys,
        *[(F.col(f"min_{a}") - padding).alias(f"min_{a}") for a in XYZ],
        *[(F.col(f"max_{a}") + padding).alias(f"max_{a}") for a in XYZ],
    )


def percentile_box(rows: DataFrame, share: float = 0.75, rows_per_bucket: int | None = None) -> DataFrame:
    """Centre and half extent of the middle ``share`` per axis; median size (twice the middle half extent), max extent."""
    low = (1.0 - share) / 2.0
    picks = {}
    for a in XYZ:
        picks[f"_{a}0"] = (a, element(lambda n: F.floor((n - 1) * F.lit(low))))
        picks[f"_{a}1"] = (a, element(lambda n: F.floor((n - 1) * F.lit(1.0 - low))))
    s = order_stats(rows, ["scene_id"], picks, rows_per_bucket)
    half = [((F.col(f"_{a}1") - F.col(f"_{a}0")) / 2.0) for a in XYZ]
    return s.select(
        "scene_id",
        *[((F.col(f"_{a}1") + F.col(f"_{a}0")) / 2.0).alias(f"{a}_mid") for a in XYZ],
        *[h.alias(f"{a}_half") for a, h in zip(XYZ, half)],
        (F.get(F.array_sort(F.array(*half)), F.lit(1)) * 2.0).alias("median_size"),
        F.greatest(*half).alias("max_extent"),
    )


def scene_scale(rows: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """Element n/2 of the distances to the mean."""
    mean = rows.groupBy("scene_id").agg(*[F.avg(a).alias(f"_m{a}") for a in XYZ])
    j = attach(rows.select("scene_id", *XYZ), mean, ["scene_id"])
    d2 = reduce(lambda p, q: p + q, [(F.col(a) - F.col(f"_m{a}")) * (F.col(a) - F.col(f"_m{a}")) for a in XYZ])
    return order_stats(
        j.withColumn("_d", F.sqrt(d2)), ["scene_id"], {"scene_scale": ("_d", upper_median())}, rows_per_bucket
    )


def scene_radius(rows: DataFrame, padding: float = 1.2, rows_per_bucket: int | None = None) -> DataFrame:
    """98th percentile of the distance to the median, padded bounds and orbit distance."""
    from scenequarry.operators.selection import distance_to_median

    med = order_stats(rows, ["scene_id"], {f"c{a}": (a, percentile(0.5)) for a in XYZ}, rows_per_bucket).drop("n_rows")
    r = order_stats(
        distance_to_median(rows, rows_per_bucket), ["scene_id"], {"radius": ("_dist", percentile(0.98))}, rows_per_bucket
    ).drop("n_rows")
    pad = F.col("radius") * padding
    return med.join(r, "scene_id").select(
        "scene_id", *[f"c{a}" for a in XYZ], "radius",
        *[(F.col(f"c{a}") - pad).alias(f"min_{a}") for a in XYZ],
        *[(F.col(f"c{a}") + pad).alias(f"max_{a}") for a in XYZ],
        (F.col("radius") * 2.5).alias("camera_distance"),
    )


# ------------------------------------------------------------------ histograms


def finite(c: Column) -> Column:
    return F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))


def histogram_bounds(rows: DataFrame, metric: str, value: str) -> DataFrame:
    """Bounds rule per metric: opacity is [0, 1], erank [1, 3], anisotropy starts at 1, others use the finite range."""
    v = F.when(finite(F.col(value)), F.col(value))
    lo, hi = F.min(v), F.max(v)
    if metric == "opacity":
        lo, hi = F.lit(0.0), F.lit(1.0)
    elif metric == "erank":
        lo, hi = F.lit(1.0), F.lit(3.0)
    elif metric == "anisotropy":
        lo = F.lit(1.0)
    b = rows.groupBy("scene_id").agg(lo.alias("lo"), hi.alias("hi"))
    return b.withColumn("hi", F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("lo") + 1.0))


def bin_of(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based bin of a value in [lo, hi]; the top edge belongs to the last bin, outside is null."""
    b = F.floor((value - lo) / (hi - lo) * F.lit(float(bins)))
    return F.when(finite(value) & (value >= lo) & (value <= hi), F.least(b, F.lit(bins - 1)).cast("int"))


def histogram(rows: DataFrame, metric: str, value: str, bins: int = 16) -> DataFrame:
    """Counts per bin and scene with empty bins kept, and the bin edges."""
    b = cut(histogram_bounds(rows, metric, value))
    j = attach(rows.select("scene_id", value), b, ["scene_id"], materialise=False)
    counts = (
        j.select("scene_id", bin_of(F.col(value), F.col("lo"), F.col("hi"), bins).alias("bin"))
        .filter("bin is not null")
        .groupBy("scene_id", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = b.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    step = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, ["scene_id", "bin"], "left").select(
        "scene_id", "bin", (F.col("lo") + step * F.col("bin")).alias("edge_lo"),
        (F.col("lo") + step * (F.col("bin") + 1)).alias("edge_hi"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def joint_histogram(rows: DataFrame, a: tuple[str, str], b: tuple[str, str], bins: int = 8) -> DataFrame:
    """Counts of (bin of metric a, bin of metric b); each argument is (metric, value column)."""
    ba = histogram_bounds(rows, *a).select("scene_id", F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
    bb = histogram_bounds(rows, *b).select("scene_id", F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
    j = attach(rows.select("scene_id", a[1], b[1]), ba.join(bb, "scene_id"), ["scene_id"])
    return (
        j.select(
            "scene_id",
            bin_of(F.col(a[1]), F.col("alo"), F.col("ahi"), bins).alias("bin_a"),
            bin_of(F.col(b[1]), F.col("blo"), F.col("bhi"), bins).alias("bin_b"),
        )
        .filter("bin_a is not null and bin_b is not null")
        .groupBy("scene_id", "bin_a", "bin_b")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def joint_cell(rows: DataFrame, a: tuple[str, str], b: tuple[str, str], cell: tuple[int, int], bins: int = 8) -> DataFrame:
    """Rows that ``joint_histogram`` counts in one cell of their scene; rows without a finite value in either lie in none."""
    ba = histogram_bounds(rows, *a).select("scene_id", F.col("lo").alias("_alo"), F.col("hi").alias("_ahi"))
    bb = histogram_bounds(rows, *b).select("scene_id", F.col("lo").alias("_blo"), F.col("hi").alias("_bhi"))
    j = attach(rows, ba.join(bb, "scene_id"), ["scene_id"])
    at_a, at_b = bin_of(F.col(a[1]), F.col("_alo"), F.col("_ahi"), bins), bin_of(F.col(b[1]), F.col("_blo"), F.col("_bhi"), bins)
    return j.filter((at_a == cell[0]) & (at_b == cell[1])).select(*rows.columns)


# ------------------------------------------------------------------ metric reports


def best_metrics(metrics: DataFrame) -> DataFrame:
    """Best PSNR and SSIM with their first iteration, and the last row, per run."""
    first_best = lambda c: F.max_by("iteration", F.struct(F.col(c), -F.col("iteration")))
    last = F.max(F.struct("iteration", "psnr", "ssim", "time_per_image", "num_gaussians"))
    return metrics.groupBy("run_id").agg(
        F.max("psnr").alias("best_psnr"), first_best("psnr").alias("best_psnr_iteration"),
        F.max("ssim").alias("best_ssim"), first_best("ssim").alias("best_ssim_iteration"), last.alias("_l"),
    ).select(
        "run_id", "best_psnr", "best_psnr_iteration", "best_ssim", "best_ssim_iteration",
        F.col("_l.iteration").alias("final_iteration"), F.col("_l.psnr").alias("final_psnr"),
        F.col("_l.ssim").alias("final_ssim"), F.col("_l.time_per_image").alias("final_time"),
        F.col("_l.num_gaussians").alias("final_gaussians"),
    )


def benchmark_summary(metrics: DataFrame) -> DataFrame:
    """Last row of each scene and, in the row with a null scene, the mean over scenes."""
    last = metrics.groupBy("run_id").agg(F.max(F.struct("iteration", "psnr", "ssim", "num_gaussians")).alias("l"))
    flat = last.select("run_id", "l.psnr", "l.ssim", F.col("l.num_gaussians").alias("num_gaussians"))
    return flat.rollup("run_id").agg(
        F.avg("psnr").alias("psnr"), F.avg("ssim").alias("ssim"), F.avg("num_gaussians").alias("num_gaussians")
    )


def psnr(pixels: DataFrame, keys: Sequence[str], pred: Column, target: Column, weight: Column | None = None) -> DataFrame:
    """Masked mean squared error and PSNR per view (values in [0, 1])."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    d = pred - target
    g = pixels.groupBy(*keys).agg(F.sum(w * d * d).alias("_e"), F.sum(w).alias("_w"))
    mse = F.when(F.col("_w") > 0, F.col("_e") / F.when(F.col("_w") > 0, F.col("_w")))
    g = g.withColumn("mse", mse).drop("_e", "_w")
    db = F.lit(-10.0) * F.log10(F.when(F.col("mse") > 0, F.col("mse")))
    return g.withColumn("psnr", F.when(F.col("mse") == 0, F.lit(float("inf"))).otherwise(db))


def mean_of_finite(per_view: DataFrame, keys: Sequence[str], value: str = "psnr") -> DataFrame:
    return per_view.groupBy(*keys).agg(
        F.avg(F.when(finite(F.col(value)), F.col(value))).alias(f"mean_{value}"),
        F.count_if(finite(F.col(value))).alias("views"),
    )


# ------------------------------------------------------------------ logs


def stage_peaks(trace: DataFrame, stage: str = "stage") -> DataFrame:
    """Peaks and sample count per stage; the null stage is the whole run with the sizing rule applied."""
    g = trace.rollup(stage).agg(
        F.max("vram_mb").alias("peak_vram_mb"), F.max("ram_mb").alias("peak_ram_mb"),
        F.max("gpu_util").alias("peak_gpu_util"), F.max("power_w").alias("peak_power_w"),
        F.count(F.lit(1)).alias("sample_count"),
    )
    return g.withColumn("vram_needed_mb", F.greatest(F.lit(8192.0), F.col("peak_vram_mb") * 1.2)).withColumn(
        "ram_needed_mb", F.greatest(F.lit(16384.0), F.col("peak_ram_mb") * 1.2)
    )


def recent_percentiles(
    samples: DataFrame, scope: str, order: Sequence[str], value: str, last_n: int, qs: dict[str, float],
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Linear percentiles of the last ``last_n`` samples per scope."""
    back = samples.withColumn("_o1", -F.col(order[0]).cast("double")).withColumn("_o2", -F.col(order[-1]).cast("double"))
    recent = rank_rows(back, [scope], ["_o1", "_o2"], "_rn", rows_per_bucket).filter(F.col("_rn") <= last_n)
    return order_stats(
        recent, [scope], {n: (value, percentile(q)) for n, q in qs.items()}, rows_per_bucket
    ).withColumnRenamed("n_rows", "samples")


def status_rollup(findings: DataFrame, element_col: str = "element") -> DataFrame:
    """Worst status per element and overall (null element). ``status`` is pass, warn or fail."""
    sev = F.when(F.col("status") == "fail", 2).when(F.col("status") == "warn", 1).otherwise(0)
    g = findings.withColumn("_s", sev).rollup(element_col).agg(
        F.max("_s").alias("_s"), F.count(F.lit(1)).alias("findings"), F.count_if(F.col("_s") == 2).alias("failures")
    )
    name = F.when(F.col("_s") == 2, "fail").when(F.col("_s") == 1, "warn").otherwise("pass")
    return g.withColumn("status", name).drop("_s")


def person_actions(boxes: DataFrame, drop: float = 0.50, flag: float = 0.15) -> DataFrame:
    """Action per frame from the person coverage: dropped, flagged_inpainted, inpainted or clean."""
    a = (
        F.when(F.col("person_count") == 0, "clean")
        .when(F.col("coverage") > drop, "dropped")
        .when(F.col("coverage") > flag, "flagged_inpainted")
        .otherwise("inpainted")
    )
    return boxes.withColumn("action", a)


def person_summary(actions: DataFrame, key: str = "session_id") -> DataFrame:
    names = ("clean", "inpainted", "flagged_inpainted", "dropped")
    return actions.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("action") == n).alias(n) for n in names]
    )


def tag_counts(*tables: DataFrame) -> DataFrame:
    """How many rows carry each tag, over several tables with a ``tags`` array; tags are trimmed, empty ones skipped."""
    all_tags = reduce(lambda a, b: a.unionByName(b), [t.select("tags") for t in tables])
    return (
        all_tags.select(F.explode(F.transform("tags", lambda t: F.trim(t))).alias("tag"))
        .filter("tag <> ''")
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ------------------------------------------------------------------ array-style reductions


def occurrence_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def scatter_add(target: DataFrame, updates: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """target[key] += sum of updates for the key; keys absent from the target are ignored."""
    add = updates.groupBy(*keys).agg(F.sum(value).alias("_add"))
    return target.join(add, list(keys), "left").withColumn(
        value, F.col(value) + F.coalesce(F.col("_add"), F.lit(0))
    ).drop("_add")


def scatter_put(target: DataFrame, updates: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """target[key] = the update that comes last by ``order``."""
    put = updates.groupBy(*keys).agg(F.max_by(F.struct(F.col(value).alias("v")), F.col(order)).alias("_put"))
    return target.join(put, list(keys), "left").withColumn(
        value, F.when(F.col("_put").isNotNull(), F.col("_put.v")).otherwise(F.col(value))
    ).drop("_put")


def reductions(df: DataFrame, keys: Sequence[str], value: str, index: str, p: float = 3.0) -> DataFrame:
    """sum, mean, max, min, prod, std, var, argmax, argmin, any, all, p-norm and count_nonzero in one pass.

    argmax/argmin give the first index on ties.
    """
    v, i = F.col(value), F.col(index)
    return df.groupBy(*keys).agg(
        F.sum(v).alias("sum"), F.avg(v).alias("mean"), F.max(v).alias("max"), F.min(v).alias("min"),
        F.product(v).alias("prod"), F.stddev_samp(v).alias("std"), F.var_samp(v).alias("var"),
        F.max_by(i, F.struct(v, -i)).alias("argmax"), F.min_by(i, F.struct(v, i)).alias("argmin"),
        F.bool_or(v != 0).alias("any"), F.bool_and(v != 0).alias("all"),
        F.pow(F.sum(F.pow(F.abs(v), F.lit(p))), F.lit(1.0 / p)).alias("norm_p"),
        F.count_if(v != 0).alias("count_nonzero"),
    )


def camera_exposure(frames: DataFrame, frames_per_camera: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """Mean EV and gain 2^EV per camera, where frames are laid out camera after camera.

    ``frames``: rig_id, frame_index, ev. ``frames_per_camera``: rig_id, camera, n.
    """
    from scenequarry.operators.scale import fill_forward, running_sum

    ends = running_sum(frames_per_camera, ["rig_id"], ["camera"], "n", "_end", rows_per_bucket)
    starts = ends.select(
        "rig_id", (F.col("_end") - F.col("n")).alias("frame_index"), F.lit(0).alias("_side"),
        F.when(F.col("n") > 0, F.col("camera")).alias("camera"), F.lit(None).cast("double").alias("ev"),
    )
    line = starts.unionByName(
        frames.select("rig_id", "frame_index", F.lit(1).alias("_side"), F.lit(None).cast("long").alias("camera"), "ev")
    )
    placed = fill_forward(line, ["rig_id"], ["frame_index", "_side", "camera"], "camera", "cam", rows_per_bucket)
    means = placed.filter("_side = 1").groupBy("rig_id", F.col("cam").alias("camera")).agg(F.avg("ev").alias("m"))
    out = frames_per_camera.select("rig_id", "camera").join(means, ["rig_id", "camera"], "left")
    ev = F.coalesce(F.col("m"), F.lit(0.0))
    return out.select("rig_id", "camera", ev.alias("mean_ev"), F.pow(F.lit(2.0), ev).alias("gain"))



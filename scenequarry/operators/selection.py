"""Filters and selections on splat tables. Predicates are columns; per-scene bounds come as dimension rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.functions.splats import QUAT, SCALES, logit, scale_max, sh_to_rgb
from scenequarry.functions.vectors import mat4_point
from scenequarry.operators.scale import attach, order_stats, percentile

XYZ = ("x", "y", "z")


def _point():
    return tuple(F.col(a) for a in XYZ)


# ------------------------------------------------------------------ volumes


def inside_box(m: Column, lo: Column, hi: Column, p=None) -> Column:
    """Inside an oriented box (inclusive): ``m`` is the row-major world-to-local matrix, lo/hi are array<double>(3)."""
    q = mat4_point(m, p or _point())
    out = F.lit(True)
    for i in range(3):
        out = out & (q[i] >= F.get(lo, F.lit(i))) & (q[i] <= F.get(hi, F.lit(i)))
    return out


def inside_ellipsoid(m: Column, radii: Column, p=None) -> Column:
    q = mat4_point(m, p or _point())
    total = F.lit(0.0)
    for i in range(3):
        e = q[i] / F.get(radii, F.lit(i))
        total = total + e * e
    return total <= 1


def crop_boxes(splats: DataFrame, boxes: DataFrame) -> DataFrame:
    """Keep rows inside (or outside, when ``inverse``) their scene's enabled box.

    ``boxes``: scene_id, m array<double>(16), lo, hi array<double>(3), inverse boolean. Scenes without a box pass whole.
    """
    j = attach(splats, boxes, ["scene_id"], "left", materialise=False)
    keep = F.col("m").isNull() | (inside_box(F.col("m"), F.col("lo"), F.col("hi")) != F.col("inverse"))
    return j.filter(keep).select(*splats.columns)


def crop_ellipsoids(splats: DataFrame, ellipsoids: DataFrame) -> DataFrame:
    """As ``crop_boxes`` with columns m, radii, inverse."""
    j = attach(splats, ellipsoids, ["scene_id"], "left", materialise=False)
    keep = F.col("m").isNull() | (inside_ellipsoid(F.col("m"), F.col("radii")) != F.col("inverse"))
    return j.filter(keep).select(*splats.columns)


def soft_crop(splats: DataFrame, volumes: DataFrame, ellipsoid: bool = False) -> DataFrame:
    """Mark rows outside the volume as deleted instead of dropping them."""
    j = attach(splats, volumes, ["scene_id"], "left", materialise=False)
    inside = (
        inside_ellipsoid(F.col("m"), F.col("radii")) if ellipsoid else inside_box(F.col("m"), F.col("lo"), F.col("hi"))
    )
    gone = F.col("m").isNotNull() & (inside == F.col("inverse"))
    before = F.col("deleted") if "deleted" in splats.columns else F.lit(False)
    return j.withColumn("deleted", before | gone).select(*[c for c in splats.columns if c != "deleted"], "deleted")


def refine_selection(
    splats: DataFrame, nodes: DataFrame, boxes: DataFrame | None = None, ellipsoids: DataFrame | None = None,
    selected: str = "selected",
) -> DataFrame:
    """Narrow an existing selection by crop volumes after moving rows into world space by their node matrix.

    ``nodes``: scene_id, node_id, model array<double>(16). Rows without a node keep their own coordinates.
    """
    j = attach(splats, nodes, ["scene_id", "node_id"], "left", materialise=False)
    world = [F.coalesce(v, F.col(a)) for v, a in zip(mat4_point(F.col("model"), _point()), XYZ)]
    keep = F.col(selected)
    if boxes is not None:
        b = boxes.select("scene_id", F.struct("m", "lo", "hi", "inverse").alias("_box"))
        j = attach(j, b, ["scene_id"], "left", materialise=False)
        ok = inside_box(F.col("_box.m"), F.col("_box.lo"), F.col("_box.hi"), world) != F.col("_box.inverse")
        keep = keep & (F.col("_box").isNull() | ok)
    if ellipsoids is not None:
        e = ellipsoids.select("scene_id", F.struct("m", "radii", "inverse").alias("_ell"))
        j = attach(j, e, ["scene_id"], "left", materialise=False)
        ok = inside_ellipsoid(F.col("_ell.m"), F.col("_ell.radii"), world) != F.col("_ell.inverse")
        keep = keep & (F.col("_ell").isNull() | ok)
    return j.withColumn(selected, keep).select(*splats.columns)


def depth_window(m: Column, near: float, far: float, half_width: float) -> Column:
    """Camera-space window: |x| <= half_width and near <= z <= far, with ``m`` the world-to-camera matrix."""
    q = mat4_point(m, _point())
    return q[0].between(-half_width, half_width) & q[2].between(near, far)


# ------------------------------------------------------------------ attributes


def opacity_between(lo: float, hi: float) -> Column:
    """Activated opacity in [lo, hi], stated on the raw column so that it reaches the Parquet scan."""
    out = F.col("opacity_raw").isNotNull()
    if lo > 0:
        out = out & (F.col("opacity_raw") >= F.lit(logit(lo)))
    if hi < 1:
        out = out & (F.col("opacity_raw") <= F.lit(logit(hi)))
    return out


def scale_at_most(t: float) -> Column:
    """Largest activated scale <= t, stated on the raw log columns."""
    import math

    if t <= 0:
        return F.lit(False)
    bound = F.lit(math.log(t))
    return (F.col("s0") <= bound) & (F.col("s1") <= bound) & (F.col("s2") <= bound)


def colour_similar(splats: DataFrame, references: DataFrame, threshold: float) -> DataFrame:
    """Add ``selected``: every channel within ``threshold`` of the scene's reference splat (scene_id, splat_id)."""
    t = min(max(threshold, 0.0), 1.0)
    rgb = F.array(*[sh_to_rgb(F.col(c)) for c in ("c0", "c1", "c2")])
    refs = attach(splats, references, ["scene_id", "splat_id"], "left_semi", materialise=False).select(
        "scene_id", rgb.alias("_ref")
    )
    j = attach(splats, refs, ["scene_id"], "left")
    near = F.lit(True)
    for i in range(3):
        near = near & (F.abs(F.get(rgb, F.lit(i)) - F.get(F.col("_ref"), F.lit(i))) <= t)
    return j.withColumn("selected", F.coalesce(near, F.lit(False))).drop("_ref")


# ------------------------------------------------------------------ screen-space shapes


def in_brush(px: Column, py: Column, mx: float, my: float, radius: float) -> Column:
    dx, dy = px - mx, py - my
    return F.coalesce(dx * dx + dy * dy <= radius * radius, F.lit(False))


def in_rectangle(px: Column, py: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    return F.coalesce(px.between(x0, x1) & py.between(y0, y1), F.lit(False))


def in_polygon(px: Column, py: Column, points: Sequence[tuple[float, float]]) -> Column:
    """Even-odd test with a bounding-box prefilter; fewer than three points select nothing."""
    if len(points) < 3:
        return F.lit(False)
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    odd = F.lit(0)
    for (x0, y0), (x1, y1) in zip(points, [points[-1], *points[:-1]]):
        if y0 == y1:
            continue
        crosses = (F.lit(y0) > py) != (F.lit(y1) > py)
        odd = odd + F.when(crosses & (px < F.lit(x1 - x0) * (py - y0) / F.lit(y1 - y0) + x0), 1).otherwise(0)
    box = in_rectangle(px, py, min(xs), min(ys), max(xs), max(ys))
    return F.coalesce(box & (odd % 2 == 1), F.lit(False))


# ------------------------------------------------------------------ nodes and groups


def filter_nodes(splats: DataFrame, enabled: DataFrame) -> DataFrame:
    """Rows whose (scene_id, node_id) is an enabled node."""
    return attach(splats, enabled.select("scene_id", "node_id"), ["scene_id", "node_id"], "left_semi", materialise=False)


def update_groups(
    rows: DataFrame, groups: DataFrame, group_id: int, mode: str, valid_nodes: DataFrame | None = None
) -> DataFrame:
    """Group update. ``rows`` has selected, group_id (0 = none); ``groups`` has scene_id, group_id, locked.

    replace: selected rows take the group and other rows leave it; add: selected rows take it; remove: selected rows leave
    it. Rows of another locked group and rows of invalid nodes keep their group. Adds ``new_group``.
    """
    locked = groups.filter("locked").select("scene_id", "group_id", F.lit(True).alias("_locked"))
    j = attach(rows, locked, ["scene_id", "group_id"], "left", materialise=False)
    if valid_nodes is not None:
        v = valid_nodes.select("scene_id", "node_id", F.lit(True).alias("_valid")).distinct()
        j = attach(j, v, ["scene_id", "node_id"], "left", materialise=False)
        valid = F.coalesce(F.col("_valid"), F.lit(False))
    else:
        valid = F.lit(True)
    old, g, sel = F.col("group_id"), F.lit(group_id), F.col("selected")
    held = (old != 0) & (old != g) & F.coalesce(F.col("_locked"), F.lit(False))
    join_group = F.when(sel & ~held, g)
    leave = F.when(old == g, F.lit(0))
    if mode == "replace":
        new = F.when(sel, F.coalesce(join_group, old)).otherwise(F.coalesce(leave, old))
    elif mode == "add":
        new = F.coalesce(join_group, old)
    elif mode == "remove":
        new = F.when(sel, F.coalesce(leave, old)).otherwise(old)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return j.withColumn("new_group", F.when(valid, new).otherwise(old).cast("int")).drop("_locked", "_valid")


def group_counts(rows: DataFrame, group: str = "group_id") -> DataFrame:
    return rows.filter(F.col(group) != 0).groupBy("scene_id", group).agg(F.count(F.lit(1)).alias("n"))


def group_deltas(rows: DataFrame) -> DataFrame:
    """Change of each group's size from group_id to new_group, and how many rows changed, per scene."""
    moved = rows.filter(F.col("group_id") != F.col("new_group"))
    parts = moved.select(
        "scene_id",
        F.explode(
            F.array(
                F.struct(F.col("group_id").cast("int").alias("g"), F.lit(-1).alias("d"), F.lit(0).alias("c")),
                F.struct(F.col("new_group").cast("int").alias("g"), F.lit(1).alias("d"), F.lit(1).alias("c")),
            )
        ).alias("e"),
    )
    by_group = parts.groupBy("scene_id", F.col("e.g").alias("group_id")).agg(
        F.sum("e.d").alias("delta"), F.sum("e.c").alias("gained")
    )
    return by_group.filter("group_id <> 0")


def changed_count(rows: DataFrame) -> DataFrame:
    return rows.groupBy("scene_id").agg(F.count_if(F.col("group_id") != F.col("new_group")).alias("changed"))


def invert(selected: Column) -> Column:
    """Complement; without a mask everything becomes selected."""
    return F.coalesce(~selected, F.lit(True))


def pick_row(rows: DataFrame, scene_id: int, splat_id: int, add: bool) -> DataFrame:
    """Select one row by key, adding to or replacing the selection."""
    hit = (F.col("scene_id") == scene_id) & (F.col("splat_id") == splat_id)
    return rows.withColumn("selected", F.col("selected") | hit if add else hit)


def combine_selections(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Set algebra on keyed selections (scene_id, splat_id): 'or', 'and', 'minus'."""
    keys = ["scene_id", "splat_id"]
    if how == "or":
        return a.select(*keys).union(b.select(*keys)).distinct()
    return a.select(*keys).join(b.select(*keys), keys, "left_semi" if how == "and" else "left_anti").distinct()


# ------------------------------------------------------------------ pruning


def is_dead(min_opacity: float) -> Column:
    """Activated opacity at or below the floor, or a quaternion of squared norm below 1e-8."""
    q2 = sum((F.col(q) * F.col(q) for q in QUAT[1:]), F.col("qw") * F.col("qw"))
    low = F.col("opacity_raw") <= F.lit(logit(min_opacity)) if 0 < min_opacity < 1 else F.lit(min_opacity >= 1)
    return low | (q2 < 1e-8)


def prune_reasons(splats: DataFrame, rows_per_bucket: int | None = None, trim: float = 0.75) -> DataFrame:
    """Five prune flags per row: faint, no rotation, vanishing scale, huge scale, far from the scene's percentile box."""
    import math

    from scenequarry.operators.aggregates import percentile_box

    box = percentile_box(splats, trim, rows_per_bucket)
    j = attach(splats, box, ["scene_id"])
    logs = [F.col(s) for s in SCALES]
    far = F.greatest(*[F.abs(F.col(a) - F.col(f"{a}_mid")) for a in XYZ])
    flags = [
        F.col("opacity_raw") < F.lit(logit(1 / 255)),
        sum((F.col(q) * F.col(q) for q in QUAT[1:]), F.col("qw") * F.col("qw")) == 0,
        F.least(*logs) < F.lit(math.log(1e-10)),
        F.greatest(*logs) > F.ln(F.lit(100.0) * F.col("max_extent")),
        far > F.lit(100.0) * F.col("max_extent"),
    ]
    names = ("faint", "no_rotation", "vanishing", "huge", "far")
    return j.select(*splats.columns, *[F.coalesce(f, F.lit(False)).alias(n) for f, n in zip(flags, names)])


def prune_by_opacity(splats: DataFrame, requested: float, rows_per_bucket: int | None = None) -> DataFrame:
    """Keep opacity >= min(requested, scene median), the median being the mean of the two middle values.

    Compared on activated values; the median is taken on activated values as well.
    """
    from scenequarry.functions.splats import opacity

    s = splats.withColumn("_alpha", opacity())
    mid = order_stats(s, ["scene_id"], {"_median": ("_alpha", percentile(0.5))}, rows_per_bucket)
    j = attach(s, mid.select("scene_id", "_median"), ["scene_id"])
    return j.filter(F.col("_alpha") >= F.least(F.lit(requested), F.col("_median"))).select(*splats.columns)


def distance_to_median(splats: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``_dist``: distance to the per-axis median of the scene."""
    med = order_stats(
        splats, ["scene_id"], {f"_m{a}": (a, percentile(0.5)) for a in XYZ}, rows_per_bucket
    ).drop("n_rows")
    j = attach(splats, med, ["scene_id"])
    total = F.lit(0.0)
    for a in XYZ:
        d = F.col(a) - F.col(f"_m{a}")
        total = total + d * d
    return j.withColumn("_dist", F.sqrt(total))


def filter_outliers(splats: DataFrame, pct: float = 95.0, rows_per_bucket: int | None = None) -> DataFrame:
    """Keep rows whose distance to the median is within the percentile of such distances (linear interpolation)."""
    d = distance_to_median(splats, rows_per_bucket)
    cutoff = order_stats(d, ["scene_id"], {"_cut": ("_dist", percentile(pct / 100.0))}, rows_per_bucket)
    j = attach(d, cutoff.select("scene_id", "_cut"), ["scene_id"])
    return j.filter(F.col("_dist") <= F.col("_cut")).select(*splats.columns)


def filter_outliers_staged(
    splats: DataFrame, pct: float = 95.0, min_opacity: float = 0.05, rows_per_bucket: int | None = None
) -> DataFrame:
    """Opacity floor, then the distance percentile of the survivors, then the 99th percentile of their largest scale."""
    kept = filter_outliers(splats.filter(opacity_between(min_opacity, 1.0)), pct, rows_per_bucket)
    kept = kept.withColumn("_big", scale_max())
    cutoff = order_stats(kept, ["scene_id"], {"_cut": ("_big", percentile(0.99))}, rows_per_bucket)
    j = attach(kept, cutoff.select("scene_id", "_cut"), ["scene_id"])
    return j.filter(F.col("_big") <= F.col("_cut")).select(*splats.columns)


def delivery_filter(
    splats: DataFrame, boxes: DataFrame | None, opacity_min: float = 0.05, max_scale: float | None = None
) -> DataFrame:
    """Box, opacity floor and scale limit, with the Morton code for ordering."""
    from scenequarry.operators.ordering import with_morton

    out = splats.filter(opacity_between(opacity_min, 1.0))
    if max_scale is not None:
        out = out.filter(scale_at_most(max_scale))
    if boxes is not None:
        out = crop_boxes(out, boxes)
    return with_morton(out)


# ------------------------------------------------------------------ soft delete, masks, gathers


def soft_delete(rows: DataFrame, keys: DataFrame, deleted: bool = True) -> DataFrame:
    """Set the ``deleted`` flag of the listed (scene_id, splat_id) keys."""
    on = ["scene_id", "splat_id"]
    hit = keys.select(*on).distinct().withColumn("_hit", F.lit(True))
    j = rows.join(hit, on, "left")
    return j.withColumn("deleted", F.when(F.col("_hit"), F.lit(deleted)).otherwise(F.col("deleted"))).drop("_hit")


def compact(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("deleted"))


def visible_count(rows: DataFrame) -> DataFrame:
    return rows.groupBy("scene_id").agg(
        F.count_if(~F.col("deleted")).alias("visible"), F.count_if(F.col("deleted")).alias("deleted")
    )


def filter_by_keys(rows: DataFrame, keys: DataFrame, on: Sequence[str], keep: bool = True) -> DataFrame:
    return rows.join(keys.select(*on), list(on), "left_semi" if keep else "left_anti")


def gather(rows: DataFrame, index: DataFrame, on: Sequence[str], position: str = "pos") -> DataFrame:
    """Rows in the order of an index table (position, keys); repeated keys repeat rows. Sort by ``position`` to read."""
    if position not in index.columns:
        raise ValueError(f"the index table needs a {position!r} column")
    return index.join(rows, list(on))


# ------------------------------------------------------------------ histogram ranges


def in_range(value: Column, lo: float, hi: float, last: bool = False) -> Column:
    """Finite values of a bin range; the last bin includes its upper edge."""
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    upper = value <= hi if last else value < hi
    return F.coalesce(finite & (value >= lo) & upper, F.lit(False))



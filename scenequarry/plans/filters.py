"""Selections and filters over the splat table."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenequarry.functions import splats as SP
from scenequarry.operators import aggregates as A
from scenequarry.operators import selection as S
from scenequarry.operators.projection import project_views
from scenequarry.operators.scale import attach
from scenequarry.plans.columns import MORTON_SQL
from scenequarry.plans.registry import query
from scenequarry.plans.sqltext import ALPHA, SEEN

EYE = [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
# rotation by 30 degrees about z, then a shift
TURN = [0.8660254037844387, 0.5, 0.0, 0.25, -0.5, 0.8660254037844387, 0.0, -0.5, 0.0, 0.0, 1.0, 0.1, 0.0, 0.0, 0.0, 1.0]
LX, LY, LZ = "(0.8660254037844387e0*x+0.5e0*y+0.25e0)", "(-0.5e0*x+0.8660254037844387e0*y-0.5e0)", "(z+0.1e0)"


def _arr(v):
    return F.array(*[F.lit(float(x)) for x in v])


def _scenes(load):
    """One row per scene, read off the splat table."""
    return load("splats").select("scene_id").distinct()


def _boxes(load):
    return _scenes(load).select(
        "scene_id", _arr(TURN).alias("m"), _arr([-2, -3, -1]).alias("lo"), _arr([3, 2, 4]).alias("hi"),
        (F.col("scene_id") % 2 == 1).alias("inverse"),
    )


def _ellipsoids(load):
    return _scenes(load).select(
        "scene_id", _arr(TURN).alias("m"), _arr([3, 2, 4]).alias("radii"), (F.col("scene_id") % 2 == 1).alias("inverse")
    )


BOX_SQL = f"({LX} BETWEEN -2 AND 3 AND {LY} BETWEEN -3 AND 2 AND {LZ} BETWEEN -1 AND 4)"
ELL_SQL = f"(({LX}/3)*({LX}/3)+({LY}/2)*({LY}/2)+({LZ}/4)*({LZ}/4) <= 1)"
ODD = "(scene_id % 2 = 1)"


@query("crop_box", "splats", f"SELECT scene_id, splat_id FROM splats WHERE {BOX_SQL} <> {ODD}")
def _(load):
    return S.crop_boxes(load("splats"), _boxes(load)).select("scene_id", "splat_id")


@query("soft_crop_box", "splats", f"SELECT scene_id, splat_id, {BOX_SQL} = {ODD} AS deleted FROM splats")
def _(load):
    return S.soft_crop(load("splats"), _boxes(load)).select("scene_id", "splat_id", "deleted")


@query("crop_ellipsoid", "splats", f"SELECT scene_id, splat_id FROM splats WHERE {ELL_SQL} <> {ODD}")
def _(load):
    return S.crop_ellipsoids(load("splats"), _ellipsoids(load)).select("scene_id", "splat_id")


@query(
    "refine_selection", "splats",
    f"""SELECT scene_id, splat_id FROM (SELECT scene_id, splat_id, x+node_id*0.5e0 AS x, y-node_id*0.25e0 AS y, z AS z FROM splats WHERE splat_id % 3 <> 0) s
WHERE {BOX_SQL} <> {ODD} AND {ELL_SQL} <> {ODD}""",
)
def _(load):
    s = load("splats")
    n = s.select("scene_id", "node_id").distinct()
    shift = {3: F.col("node_id") * 0.5, 7: F.col("node_id") * -0.25}
    n = n.withColumn("model", F.array(*[shift.get(i, F.lit(v)) for i, v in enumerate(EYE)]))
    sel = s.withColumn("selected", F.col("splat_id") % 3 != 0)
    return S.refine_selection(sel, n, _boxes(load), _ellipsoids(load)).filter("selected").select("scene_id", "splat_id")


@query("depth_window", "splats", f"SELECT splat_id FROM splats WHERE {LX} BETWEEN -0.5 AND 0.5 AND {LZ} BETWEEN 1 AND 4")
def _(load):
    return load("splats").filter(S.depth_window(_arr(TURN), 1.0, 4.0, 0.5)).select("splat_id")


@query("opacity_range", "splats", f"SELECT splat_id FROM splats WHERE {ALPHA} BETWEEN 0.2501e0 AND 0.9003e0")
def _(load):
    return load("splats").filter(S.opacity_between(0.2501, 0.9003)).select("splat_id")


@query("scale_limit", "splats", "SELECT splat_id FROM splats WHERE greatest(exp(s0),exp(s1),exp(s2)) <= 0.4321e0")
def _(load):
    return load("splats").filter(S.scale_at_most(0.4321)).select("splat_id")


_C = [f"least(greatest(0.5e0+0.28209479177387814e0*{{}}.c{i},0e0),1e0)" for i in range(3)]


@query(
    "colour_similarity", "splats",
    "SELECT s.scene_id, s.splat_id FROM splats s JOIN (SELECT a.* FROM splats a JOIN (SELECT scene_id, min(splat_id) AS splat_id FROM splats GROUP BY scene_id) m ON a.scene_id = m.scene_id AND a.splat_id = m.splat_id) q ON s.scene_id = q.scene_id WHERE "
    + " AND ".join(f"abs({c.format('s')}-{c.format('q')}) <= 0.2001e0" for c in _C),
)
def _(load):
    s = load("splats")
    ref = s.groupBy("scene_id").agg(F.min("splat_id").alias("splat_id"))
    return S.colour_similar(s, ref, 0.2001).filter("selected").select("scene_id", "splat_id")


LASSO = [(5.0, 5.0), (58.5, 9.5), (40.5, 24.5), (55.0, 43.5), (10.5, 40.0), (22.5, 22.5)]


def _lasso_sql(px, py):
    terms = []
    for (x0, y0), (x1, y1) in zip(LASSO, [LASSO[-1], *LASSO[:-1]]):
        terms.append(f"CAST(({y0}e0 > {py}) <> ({y1}e0 > {py}) AND {px} < ({x1 - x0}e0)*({py}-{y0}e0)/({y1 - y0}e0)+{x0}e0 AS INTEGER)")
    return "(" + "+".join(terms) + ") % 2 = 1"


@query(
    "screen_shapes", "splats views",
    f"""SELECT splat_id, image_id, (px_col-32)*(px_col-32)+(px_row-24)*(px_row-24) <= 81 AS brush,
px_col BETWEEN 10 AND 50 AND px_row BETWEEN 8 AND 30 AS rect, {_lasso_sql('px_col', 'px_row')} AS lasso FROM seen""",
    then=SEEN,
)
def _(load):
    """Brush, rectangle and lasso on the projected pixels of all views."""
    p = project_views(load("splats"), load("views"))
    x, y = F.col("px_col").cast("double"), F.col("px_row").cast("double")
    return p.select(
        "splat_id", "image_id", S.in_brush(x, y, 32.0, 24.0, 9.0).alias("brush"),
        S.in_rectangle(x, y, 10, 8, 50, 30).alias("rect"), S.in_polygon(x, y, LASSO).alias("lasso"),
    )


@query("node_filter", "splats", "SELECT splat_id FROM splats WHERE (scene_id*6+node_id) % 4 <> 1")
def _(load):
    n = load("splats").select("scene_id", "node_id").distinct().filter((F.col("scene_id") * 6 + F.col("node_id")) % 4 != 1)
    return S.filter_nodes(load("splats"), n).select("splat_id")


def _grouped(load):
    """Splats with a group 0..4, a new selection, group 2 locked, node 5 invalid."""
    s = load("splats").select("scene_id", "splat_id", "node_id")
    s = s.withColumns({"group_id": (F.col("splat_id") % 5).cast("int"), "selected": F.col("splat_id") % 3 == 0})
    keys = s.select("scene_id").distinct()
    g = keys.withColumn("group_id", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3, 4)]))).withColumn("locked", F.col("group_id") == 2)
    valid = s.select("scene_id", "node_id").distinct().filter("node_id <> 5")
    return s, g, valid


_OLD = "CAST(splat_id % 5 AS INTEGER)"
_SEL = "(splat_id % 3 = 0)"
_MODES = {
    "replace": f"CASE WHEN {_SEL} THEN CASE WHEN {_OLD} = 2 THEN 2 ELSE 3 END WHEN {_OLD} = 3 THEN 0 ELSE {_OLD} END",
    "add": f"CASE WHEN {_SEL} AND {_OLD} <> 2 THEN 3 ELSE {_OLD} END",
    "remove": f"CASE WHEN {_SEL} AND {_OLD} = 3 THEN 0 ELSE {_OLD} END",
}
for _mode, _sql in _MODES.items():

    @query(
        f"group_{_mode}", "splats",
        f"SELECT scene_id, splat_id, CASE WHEN node_id = 5 THEN {_OLD} ELSE {_sql} END AS new_group FROM splats",
    )
    def _(load, mode=_mode):
        s, g, valid = _grouped(load)
        return S.update_groups(s, g, 3, mode, valid).select("scene_id", "splat_id", "new_group")


@query(
    "group_deltas", "splats",
    """SELECT scene_id, group_id, CAST(sum(d) AS BIGINT) AS delta FROM (
 SELECT scene_id, g0 AS group_id, -1 AS d FROM n WHERE g0 <> g1 UNION ALL SELECT scene_id, g1, 1 FROM n WHERE g0 <> g1) q
WHERE group_id <> 0 GROUP BY ALL""",
    then=f"n AS (SELECT scene_id, {_OLD} AS g0, CASE WHEN node_id = 5 THEN {_OLD} ELSE {_MODES['replace']} END AS g1 FROM splats)",
)
def _(load):
    s, g, valid = _grouped(load)
    return S.group_deltas(S.update_groups(s, g, 3, "replace", valid)).select("scene_id", "group_id", "delta")


@query("group_counts", "splats", f"SELECT scene_id, {_OLD} AS group_id, count(*) AS n FROM splats WHERE {_OLD} <> 0 GROUP BY ALL")
def _(load):
    return S.group_counts(_grouped(load)[0])


@query("invert_selection", "splats", "SELECT splat_id FROM splats WHERE splat_id % 3 <> 0")
def _(load):
    return load("splats").filter(S.invert(F.col("splat_id") % 3 == 0)).select("splat_id")


@query("dead_rows", "splats", f"SELECT splat_id FROM splats WHERE {ALPHA} <= 0.00501e0 OR qw*qw+qx*qx+qy*qy+qz*qz < 1e-8")
def _(load):
    return load("splats").filter(S.is_dead(0.00501)).select("splat_id")


PBOX_SQL = """o AS (SELECT scene_id, list_sort(list(x)) AS lx, list_sort(list(y)) AS ly, list_sort(list(z)) AS lz, count(*) AS n FROM splats GROUP BY scene_id),
e AS (SELECT scene_id, CAST(floor((n-1)*0.125e0) AS BIGINT)+1 AS i0, CAST(floor((n-1)*0.875e0) AS BIGINT)+1 AS i1, lx, ly, lz FROM o),
pbox AS (SELECT scene_id, (lx[i0]+lx[i1])/2 AS x_mid, (ly[i0]+ly[i1])/2 AS y_mid, (lz[i0]+lz[i1])/2 AS z_mid,
 (lx[i1]-lx[i0])/2 AS x_half, (ly[i1]-ly[i0])/2 AS y_half, (lz[i1]-lz[i0])/2 AS z_half FROM e),
pb AS (SELECT *, greatest(x_half,y_half,z_half) AS max_extent FROM pbox)"""


@query(
    "prune_reasons", "splats",
    """SELECT s.scene_id, splat_id, opacity_raw < ln((1e0/255)/(1-1e0/255)) AS faint, qw*qw+qx*qx+qy*qy+qz*qz = 0 AS no_rotation,
 least(s0,s1,s2) < ln(1e-10) AS vanishing, greatest(s0,s1,s2) > ln(100*max_extent) AS huge,
 greatest(abs(x-x_mid),abs(y-y_mid),abs(z-z_mid)) > 100*max_extent AS far FROM splats s JOIN pb ON s.scene_id = pb.scene_id""",
    then=PBOX_SQL,
)
def _(load):
    return S.prune_reasons(load("splats")).select("scene_id", "splat_id", "faint", "no_rotation", "vanishing", "huge", "far")


@query(
    "opacity_prune", "splats",
    f"""SELECT s.splat_id FROM splats s JOIN (SELECT scene_id, median({ALPHA}) AS m FROM splats GROUP BY scene_id) q ON s.scene_id = q.scene_id
WHERE {ALPHA} >= least(0.6001e0, m)""",
)
def _(load):
    return S.prune_by_opacity(load("splats"), 0.6001).select("splat_id")


MEDIAN_SQL = """med AS (SELECT scene_id, median(x) AS mx, median(y) AS my, median(z) AS mz FROM {rows} GROUP BY scene_id),
dist AS (SELECT s.*, sqrt((x-mx)*(x-mx)+(y-my)*(y-my)+(z-mz)*(z-mz)) AS d FROM {rows} s JOIN med ON s.scene_id = med.scene_id),
near AS (SELECT * FROM (SELECT dist.*, quantile_cont(d, 0.95) OVER (PARTITION BY scene_id) AS cut FROM dist) q WHERE d <= cut)"""


@query("outlier_filter", "splats", "SELECT scene_id, splat_id FROM near", then=MEDIAN_SQL.format(rows="splats"))
def _(load):
    return S.filter_outliers(load("splats"), 95.0).select("scene_id", "splat_id")


@query(
    "outlier_filter_staged", "splats",
    """SELECT scene_id, splat_id FROM (SELECT *, greatest(exp(s0),exp(s1),exp(s2)) AS g, quantile_cont(greatest(exp(s0),exp(s1),exp(s2)), 0.99) OVER (PARTITION BY scene_id) AS t FROM near) w WHERE g <= t""",
    then=f"lit AS (SELECT * FROM splats WHERE {ALPHA} >= 0.05e0), " + MEDIAN_SQL.format(rows="lit"),
)
def _(load):
    return S.filter_outliers_staged(load("splats"), 95.0, 0.05).select("scene_id", "splat_id")


@query(
    "delivery_filter", "splats", "SELECT scene_id, splat_id, morton FROM coded",
    then=f"kept AS (SELECT * FROM splats WHERE {ALPHA} >= 0.05e0 AND greatest(exp(s0),exp(s1),exp(s2)) <= 0.9001e0 AND {BOX_SQL} <> {ODD}), "
    + MORTON_SQL.replace("FROM splats", "FROM kept"),
)
def _(load):
    return S.delivery_filter(load("splats"), _boxes(load), 0.05, 0.9001).select("scene_id", "splat_id", "morton")


@query(
    "soft_delete", "splats",
    "SELECT scene_id, count(*) FILTER (splat_id % 4 <> 1 OR splat_id % 8 = 1) AS visible, count(*) FILTER (splat_id % 4 = 1 AND splat_id % 8 <> 1) AS deleted FROM splats GROUP BY scene_id",
)
def _(load):
    """Delete a key set, undelete a part of it, count what is visible."""
    s = load("splats").select("scene_id", "splat_id").withColumn("deleted", F.lit(False))
    gone = S.soft_delete(s, s.filter("splat_id % 4 = 1"))
    back = S.soft_delete(gone, s.filter("splat_id % 8 = 1"), deleted=False)
    return S.visible_count(back)


@query("compact_rows", "splats", "SELECT splat_id FROM splats WHERE splat_id % 4 <> 1")
def _(load):
    s = load("splats").withColumn("deleted", F.col("splat_id") % 4 == 1)
    return S.compact(s).select("splat_id")


@query(
    "gather_rows", "splats",
    "SELECT l_orderkey*10+l_linenumber AS pos, l_partkey, splat_id, round(x,6)+0e0 AS x FROM lineitem JOIN splats ON splat_id = l_orderkey",
)
def _(load):
    """Gather with repeats: splats in the order of an index table."""
    idx = load("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), "l_partkey", F.col("l_orderkey").alias("splat_id")
    )
    s = load("splats").select("splat_id", "x")
    g = S.gather(s, idx, ["splat_id"])
    return g.select("pos", "l_partkey", "splat_id", (F.round("x", 6) + F.lit(0.0)).alias("x"))


@query(
    "histogram_selection", "splats",
    f"""SELECT splat_id FROM (SELECT s.splat_id, a, lo, hi FROM (SELECT *, {ALPHA} AS a, 0e0 AS lo, 1e0 AS hi FROM splats) s) q
WHERE a >= lo+(hi-lo)*4/16 AND a < lo+(hi-lo)*8/16""",
)
def _(load):
    """Rows of opacity bins 4..7 of 16."""
    s = load("splats").withColumn("opacity", SP.opacity())
    b = A.histogram_bounds(s, "opacity", "opacity")
    j = attach(s, b, ["scene_id"])
    n = A.bin_of(F.col("opacity"), F.col("lo"), F.col("hi"), 16)
    return j.filter(n.between(4, 7)).select("splat_id")


@query("masked_select", "", "SELECT event_id FROM events WHERE value <> 0 AND isfinite(value)")
def _(load):
    from scenequarry.functions.elementwise import UNARY

    return load("events").filter((F.col("value") != 0) & UNARY["isfinite"](F.col("value"))).select("event_id")


@query(
    "pick_row", "splats",
    "SELECT splat_id FROM splats WHERE splat_id % 9 = 0 OR splat_id = (SELECT max(splat_id) FROM splats WHERE scene_id = 1)",
)
def _(load):
    s = load("splats").withColumn("selected", F.col("splat_id") % 9 == 0)
    key = s.filter("scene_id = 1").agg(F.max("splat_id")).first()[0]
    return S.pick_row(s, 1, key, add=True).filter("selected").select("splat_id")


for _how, _cond in (("or", "splat_id % 3 = 0 OR splat_id % 5 = 0"), ("and", "splat_id % 15 = 0"), ("minus", "splat_id % 3 = 0 AND splat_id % 5 <> 0")):

    @query(f"selection_{_how}", "splats", f"SELECT scene_id, splat_id FROM splats WHERE {_cond}")
    def _(load, how=_how):
        s = load("splats")
        return S.combine_selections(s.filter("splat_id % 3 = 0"), s.filter("splat_id % 5 = 0"), how)

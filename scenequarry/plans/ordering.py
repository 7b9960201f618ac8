"""Sorts, draws, splits and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenequarry.functions.elementwise import key_uniform_sql
from scenequarry.functions.splats import opacity
from scenequarry.operators import ordering as O
from scenequarry.plans.columns import MORTON_SQL, rd
from scenequarry.plans.registry import query
from scenequarry.plans.sqltext import ALPHA


def _clamped(u):
    return f"least(greatest({u}, 1e-10), 1-1e-7)"


def _gumbel(seed, key, w):
    return f"(-ln(-ln({_clamped(key_uniform_sql(seed, key))}))+ln({w}))"


@query(
    "morton_order", "splats",
    "SELECT scene_id, splat_id, row_number() OVER (PARTITION BY scene_id ORDER BY morton, splat_id) AS morton_rank FROM coded", then=MORTON_SQL,
)
def _(load):
    return O.morton_rank(load("splats").select("scene_id", "splat_id", "x", "y", "z")).select("scene_id", "splat_id", "morton_rank")


@query(
    "sort_with_index", "splats",
    "SELECT scene_id, splat_id, row_number() OVER (PARTITION BY scene_id ORDER BY opacity_raw DESC, splat_id)-1 AS rank FROM splats",
)
def _(load):
    return O.sort_with_index(load("splats").select("scene_id", "splat_id", "opacity_raw"), ["scene_id"], "opacity_raw", "splat_id", True).select(
        "scene_id", "splat_id", "rank"
    )


@query(
    "weighted_draw", "splats",
    f"SELECT scene_id, splat_id FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY {_gumbel(11, 'splat_id', ALPHA)} DESC, splat_id) AS k FROM splats WHERE splat_id % 7 <> 0) q WHERE k <= 250",
)
def _(load):
    w = F.when(F.col("splat_id") % 7 == 0, 0.0).otherwise(opacity())
    return O.weighted_draw(load("splats"), ["scene_id"], w, "splat_id", 250, 11).select("scene_id", "splat_id")


@query(
    "weighted_draw_replace", "splats",
    f"""SELECT d.scene_id, draw_id, splat_id FROM draws d JOIN cum c ON d.scene_id = c.scene_id AND c.lo <= d.u*c.total AND d.u*c.total < c.hi""",
    then=f"""w AS (SELECT scene_id, splat_id, 1+splat_id % 9 AS wt FROM splats),
cum AS (SELECT scene_id, splat_id, sum(wt) OVER (PARTITION BY scene_id ORDER BY splat_id) AS hi, sum(wt) OVER (PARTITION BY scene_id ORDER BY splat_id)-wt AS lo, sum(wt) OVER (PARTITION BY scene_id) AS total FROM w),
draws AS (SELECT c_custkey % 4 AS scene_id, c_custkey AS draw_id, {key_uniform_sql(5, 'c_custkey', 5)} AS u FROM customer)""",
)
def _(load):
    draws = load("customer").select((F.col("c_custkey") % 4).alias("scene_id"), F.col("c_custkey").alias("draw_id"))
    d = O.weighted_draw_replace(load("splats"), ["scene_id"], F.col("splat_id") % 9 + 1, "splat_id", draws, 5)
    return d.select("scene_id", "draw_id", "splat_id")


@query(
    "random_rows", "splats",
    f"SELECT scene_id, splat_id FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY CASE WHEN splat_id % 100 = 1 THEN 0 ELSE 2 END + {key_uniform_sql(3, 'splat_id', 6)}, splat_id) AS k FROM splats) q WHERE k <= 500",
)
def _(load):
    s = load("splats").withColumn("frozen", F.col("splat_id") % 100 == 1)
    return O.random_rows(s, ["scene_id"], 500, "splat_id", 3, "frozen").select("scene_id", "splat_id")


@query(
    "drop_least_opaque", "splats",
    "SELECT scene_id, splat_id FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY opacity_raw, splat_id) AS k, count(*) OVER (PARTITION BY scene_id) AS n FROM splats) q WHERE k > floor(n*0.35e0)",
)
def _(load):
    return O.drop_least_opaque(load("splats"), ["scene_id"], 0.35, "splat_id").select("scene_id", "splat_id")


@query(
    "quantile_value", "splats",
    "SELECT scene_id, n AS n_rows, round(l[CAST(floor(n*0.9e0) AS BIGINT)+1], 6)+0e0 AS q_value FROM (SELECT scene_id, count(*) AS n, list_sort(list(x)) AS l FROM splats GROUP BY scene_id) q",
)
def _(load):
    return O.quantile_value(load("splats"), ["scene_id"], "x", 0.9).select("scene_id", "n_rows", rd(F.col("q_value"), "q_value"))


_CAND = f"""raw AS (SELECT scene_id, splat_id, greatest(opacity_raw, 0e0) AS error, CASE WHEN splat_id % 3 = 0 THEN 0e0 ELSE (splat_id % 11)/10e0 END AS edge FROM splats),
m AS (SELECT scene_id, list_sort(list(error) FILTER (error > 0)) AS le, list_sort(list(edge) FILTER (edge > 0)) AS lg FROM raw GROUP BY scene_id),
nrm AS (SELECT r.scene_id, splat_id, error/greatest(le[CAST(floor(len(le)/2) AS BIGINT)+1],1e-9) AS e, edge/greatest(lg[CAST(floor(len(lg)/2) AS BIGINT)+1],1e-9) AS g FROM raw r JOIN m ON r.scene_id = m.scene_id),
thr AS (SELECT scene_id, list_sort(list(e), 'DESC')[1200] AS t FROM nrm GROUP BY scene_id),
sc AS (SELECT n.scene_id, splat_id, e*(1+0.5e0*g) AS w FROM nrm n JOIN thr ON n.scene_id = thr.scene_id WHERE e >= t AND e > 0)"""


@query(
    "candidate_draw", "splats",
    f"SELECT scene_id, splat_id, round(w, 6) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY {_gumbel(23, 'splat_id', 'w')} DESC, splat_id) AS k FROM sc) q WHERE k <= 300",
    then=_CAND,
)
def _(load):
    s = load("splats").select(
        "scene_id", "splat_id", F.greatest("opacity_raw", F.lit(0.0)).alias("error"),
        F.when(F.col("splat_id") % 3 == 0, 0.0).otherwise(F.col("splat_id") % 11 / 10.0).alias("edge"),
    )
    d = O.candidate_draw(s, ["scene_id"], "splat_id", 300, 23)
    return d.select("scene_id", "splat_id", rd(F.col("weight"), "weight"))


_GR = f"""g AS (SELECT scene_id, splat_id, {ALPHA} AS a, splat_id % 5 <> 0 AS vis, (splat_id % 101)/100e0 AS grad FROM splats),
rep AS (SELECT scene_id, splat_id FROM (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY {_gumbel(31, 'splat_id', 'a')} DESC, splat_id) AS k FROM g WHERE vis) q WHERE k <= 100),
cnt AS (SELECT scene_id, floor(count(*)*0.2e0+0.5e0)-100 AS want FROM g WHERE vis AND grad > 0.3 GROUP BY scene_id),
gro AS (SELECT scene_id, splat_id FROM (SELECT g.*, want, row_number() OVER (PARTITION BY g.scene_id ORDER BY {_gumbel(32, 'g.splat_id', 'grad')} DESC, g.splat_id) AS k FROM g JOIN cnt ON g.scene_id = cnt.scene_id
 WHERE vis AND grad > 0.3 AND NOT EXISTS (SELECT 1 FROM rep WHERE rep.scene_id = g.scene_id AND rep.splat_id = g.splat_id)) q WHERE k <= want)"""


@query("growth_draw", "splats", "SELECT scene_id, splat_id, 'replace' AS kind FROM rep UNION ALL SELECT scene_id, splat_id, 'grow' FROM gro", then=_GR)
def _(load):
    s = load("splats").select(
        "scene_id", "splat_id", opacity().alias("opacity"), (F.col("splat_id") % 5 != 0).alias("visible"), (F.col("splat_id") % 101 / 100.0).alias("grad")
    )
    return O.growth_draw(s, ["scene_id"], "splat_id", 0.3, 0.2, 100, 10**12, 31)


@query(
    "shuffled_epoch", "views",
    f"SELECT scene_id, image_id, row_number() OVER (PARTITION BY scene_id ORDER BY {key_uniform_sql(9 + 7919 * 2, 'image_id', 7)}, image_id)-1 AS position, CAST(floor((row_number() OVER (PARTITION BY scene_id ORDER BY {key_uniform_sql(9 + 7919 * 2, 'image_id', 7)}, image_id)-1)/4) AS BIGINT) AS batch FROM views",
)
def _(load):
    return O.shuffled_epoch(load("views").select("scene_id", "image_id"), ["scene_id"], "image_id", 9, 2, 4)


@query(
    "top_scopes", "trace",
    "SELECT stage, round(sum(vram_mb), 3) AS total, count(*) AS n FROM trace GROUP BY stage ORDER BY sum(vram_mb) DESC, stage LIMIT 3",
)
def _(load):
    t = O.top_by(load("trace"), "stage", "vram_mb", 3)
    return t.select("stage", rd(F.col("total"), "total", 3), "n")


@query(
    "relocate_dead", "splats",
    f"""SELECT scene_id, splat_id, source_id, 1 + count(*) OVER (PARTITION BY scene_id, source_id) AS copies FROM
(SELECT d.scene_id, d.splat_id, c.splat_id AS source_id FROM dead d JOIN cum c ON d.scene_id = c.scene_id AND c.lo <= d.u*c.total AND d.u*c.total < c.hi) q""",
    then=f"""w AS (SELECT scene_id, splat_id, CAST(1+splat_id % 9 AS DOUBLE) AS wt FROM splats WHERE NOT ({ALPHA} <= 0.00501e0 OR qw*qw+qx*qx+qy*qy+qz*qz < 1e-8)),
cum AS (SELECT scene_id, splat_id, sum(wt) OVER (PARTITION BY scene_id ORDER BY splat_id) AS hi, sum(wt) OVER (PARTITION BY scene_id ORDER BY splat_id)-wt AS lo, sum(wt) OVER (PARTITION BY scene_id) AS total FROM w),
dead AS (SELECT scene_id, splat_id, {key_uniform_sql(5, 'splat_id', 5)} AS u FROM splats WHERE {ALPHA} <= 0.00501e0 OR qw*qw+qx*qx+qy*qy+qz*qz < 1e-8)""",
)
def _(load):
    from scenequarry.operators.resampling import relocate_dead

    r = relocate_dead(load("splats"), 0.00501, F.col("splat_id") % 9 + 1, 5)
    return r.select("scene_id", "splat_id", "source_id", "copies")

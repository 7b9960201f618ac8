"""Nearest-neighbour and radius queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenequarry.operators import spatial as SP
from scenequarry.plans.columns import rd
from scenequarry.plans.registry import query

_D2 = "((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z))"
_KNN = f"""nn AS (SELECT scene_id, id, unnest(best) AS e FROM (SELECT a.scene_id, a.splat_id AS id, min({{'d2': {_D2}, 'nb': b.splat_id}}, 3) AS best
FROM splats a JOIN splats b ON a.scene_id = b.scene_id AND a.splat_id <> b.splat_id GROUP BY a.scene_id, a.splat_id) q)"""


@query("knn", "splats", "SELECT scene_id, id, e.nb AS neighbour, round(e.d2, 6) AS d2 FROM nn", then=_KNN)
def _(load):
    return SP.knn_self(load("splats"), ["scene_id"], "splat_id", 3).select("scene_id", "id", "neighbour", rd(F.col("d2"), "d2"))


@query(
    "knn_edges", "splats",
    "SELECT DISTINCT scene_id, least(id, e.nb) AS u, greatest(id, e.nb) AS v, round(e.d2, 6) AS d2 FROM nn", then=_KNN,
)
def _(load):
    return SP.knn_edges(load("splats"), ["scene_id"], "splat_id", 3).select("scene_id", "u", "v", rd(F.col("d2"), "d2"))


@query(
    "grow_selection", "splats",
    f"""SELECT splat_id FROM splats WHERE splat_id % 50 = 0 UNION SELECT a.splat_id FROM splats a JOIN splats b ON a.scene_id = b.scene_id AND b.splat_id % 50 = 0 AND {_D2} <= 0.360001e0""",
)
def _(load):
    s = load("splats").select("scene_id", "splat_id", "x", "y", "z", (F.col("splat_id") % 50 == 0).alias("selected"))
    return SP.grow_selection(s, 0.360001**0.5).filter("selected").select("splat_id")


@query(
    "shrink_selection", "splats",
    f"""SELECT splat_id FROM splats WHERE splat_id % 50 <> 0 EXCEPT SELECT a.splat_id FROM splats a JOIN splats b ON a.scene_id = b.scene_id AND b.splat_id % 50 = 0 AND {_D2} <= 0.360001e0""",
)
def _(load):
    s = load("splats").select("scene_id", "splat_id", "x", "y", "z", (F.col("splat_id") % 50 != 0).alias("selected"))
    return SP.shrink_selection(s, 0.360001**0.5).filter("selected").select("splat_id")


@query(
    "nearest_transfer", "mesh_vertices splats",
    """SELECT vertex_id, min({'d2': (v.x-s.x)*(v.x-s.x)+(v.y-s.y)*(v.y-s.y)+(v.z-s.z)*(v.z-s.z), 'id': s.splat_id}).id AS splat_id
FROM mesh_vertices v JOIN splats s ON s.scene_id = v.vertex_id % 4 GROUP BY vertex_id""",
)
def _(load):
    """Each mesh vertex takes the colour of the nearest splat of its scene."""
    v = load("mesh_vertices").withColumn("scene_id", (F.col("vertex_id") % 4).cast("long"))
    return SP.transfer_nearest(load("splats"), v, ["scene_id"], "splat_id", "vertex_id", ["c0"]).select("vertex_id", "splat_id")


@query(
    "init_from_points", "splats",
    """SELECT n.id AS splat_id, round(ln(greatest(avg(sqrt(e.d2)), 1e-5)), 5) AS s0, any_value(round(((n.id % 256)/255e0-0.5e0)/0.28209479177387814e0, 6)) AS c0 FROM nn n GROUP BY n.id""",
    then=_KNN,
)
def _(load):
    p = load("splats").select(
        "scene_id", "splat_id", "x", "y", "z", (F.col("splat_id") % 256).alias("r"), F.lit(10).alias("g"), F.lit(20).alias("b")
    )
    return SP.init_from_points(p, ["scene_id"], "splat_id").select("splat_id", rd(F.col("s0"), "s0", 5), rd(F.col("c0"), "c0"))


for _p, _e in ((1, "list_sum(l)"), (2, "sqrt(list_sum(list_transform(l, lambda v: v*v)))"), (3, "pow(list_sum(list_transform(l, lambda v: v*v*v)), 1e0/3)")):

    @query(
        f"pair_distances_p{_p}", "",
        f"""SELECT vec_id, ref_id, round({_e}, 4) AS distance FROM (SELECT a.vec_id, b.label AS ref_id,
list_transform(list_zip(a.embedding, b.m), lambda z: abs(z[1]::DOUBLE - z[2]::DOUBLE)) AS l FROM embeddings a, means b) q""",
        then="""long AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT label, list(x ORDER BY i) AS m FROM (SELECT label, i, avg(x) AS x FROM long GROUP BY label, i) s GROUP BY label)""",
    )
    def _(load, p=_p):
        """Distances of every vector to the mean vector of every label."""
        e = load("embeddings")
        by_place = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
        means = by_place.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("embedding"))
        d = SP.pair_distances(e, means.withColumnRenamed("label", "vec_id"), p, "vec_id", "ref_id")
        return d.select("vec_id", "ref_id", rd(F.col("distance"), "distance", 4))


@query(
    "matrix_product", "",
    """SELECT o_custkey AS row, l_suppkey AS col, round(sum(l_quantity*(o_orderkey % 7)), 4)+0e0 AS v FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def _(load):
    a = load("orders").select(F.col("o_custkey").alias("row"), F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 7).cast("double").alias("v"))
    b = load("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("col"), F.col("l_quantity").alias("v"))
    return SP.matrix_product(a, b).select("row", "col", rd(F.col("v"), "v", 4))


@query(
    "gather_modes", "",
    """SELECT event_id, greatest(0, least(i, 149)) AS clamped, ((i % 150)+150) % 150 AS wrapped FROM (SELECT event_id, event_id*7-20000 AS i FROM events) e""",
)
def _(load):
    i = F.col("event_id") * 7 - 20000
    n = F.lit(150).cast("long")
    return load("events").select(
        "event_id", SP.resolve_index(i, n, "clamp").alias("clamped"), SP.resolve_index(i, n, "wrap").alias("wrapped")
    )

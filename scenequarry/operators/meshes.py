"""Mesh tables: vertices (mesh keys, vertex_id, x, y, z) and faces (mesh keys, face_id, v0, v1, v2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenequarry.functions.vectors import cross
from scenequarry.operators.graphs import connected_components
from scenequarry.operators.scale import attach
from scenequarry.session import cut

XYZ = ("x", "y", "z")
CORNERS = ("v0", "v1", "v2")


def corner_rows(faces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per face corner: keys, face_id, corner, vertex_id."""
    return faces.select(*keys, "face_id", F.posexplode(F.array(*CORNERS)).alias("corner", "vertex_id"))


def with_positions(faces: DataFrame, vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Faces with corner positions as structs p0, p1, p2: one join of corners with vertices and one regroup by face."""
    keys = list(keys)
    c = corner_rows(faces, keys).join(vertices.select(*keys, "vertex_id", *XYZ), [*keys, "vertex_id"])
    p = [F.max(F.when(F.col("corner") == i, F.struct(*XYZ))).alias(f"p{i}") for i in range(3)]
    v = [F.max(F.when(F.col("corner") == i, F.col("vertex_id"))).alias(f"v{i}") for i in range(3)]
    return c.groupBy(*keys, "face_id").agg(*v, *p)


def _edge(i, j):
    return tuple(F.col(f"p{j}.{a}") - F.col(f"p{i}.{a}") for a in XYZ)


def face_areas(faces: DataFrame, vertices: DataFrame, keys: Sequence[str]) -> DataFrame:
    n = cross(_edge(0, 1), _edge(0, 2))
    return with_positions(faces, vertices, keys).withColumn(
        "area", F.lit(0.5) * F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2])
    )


def mesh_edges(faces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Undirected edges of each face: keys, face_id, a < b."""
    pair = lambda i, j: F.struct(F.least(i, j).alias("a"), F.greatest(i, j).alias("b"))
    return faces.select(*keys, "face_id", F.explode(F.array(pair("v0", "v1"), pair("v1", "v2"), pair("v0", "v2"))).alias("e")).select(
        *keys, "face_id", "e.a", "e.b"
    )


def boundary_edges(faces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Edges that are used once."""
    return mesh_edges(faces, keys).groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")


def watertight(faces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Edge counts per mesh and whether every edge is used exactly twice."""
    e = mesh_edges(faces, keys).groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("n"))
    return e.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("edges"), F.count_if(F.col("n") == 1).alias("boundary"), F.bool_and(F.col("n") == 2).alias("watertight")
    )


def clean_faces(faces: DataFrame, vertices: DataFrame, keys: Sequence[str], min_area: float = 1e-8) -> DataFrame:
    """Faces of positive area, one per corner set (the smallest face_id stays)."""
    keys = list(keys)
    good = face_areas(faces, vertices, keys).filter(F.col("area") > min_area)
    corners = F.array_sort(F.array(*CORNERS))
    return (
        good.groupBy(*keys, corners.alias("_k"))
        .agg(F.min(F.struct("face_id", *CORNERS)).alias("_f"))
        .select(*keys, "_f.*")
    )


def referenced_vertices(vertices: DataFrame, faces: DataFrame, keys: Sequence[str]) -> DataFrame:
    used = corner_rows(faces, keys).select(*keys, "vertex_id").distinct()
    return vertices.join(used, [*keys, "vertex_id"], "left_semi")


def remap_faces(faces: DataFrame, mapping: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace corners by ``mapping`` (keys, vertex_id, new_id) and drop faces that collapse."""
    keys = list(keys)
    c = corner_rows(faces, keys).join(mapping, [*keys, "vertex_id"])
    f = c.groupBy(*keys, "face_id").agg(*[F.max(F.when(F.col("corner") == i, F.col("new_id"))).alias(n) for i, n in enumerate(CORNERS)])
    return f.filter("v0 <> v1 and v1 <> v2 and v0 <> v2")


def cluster_vertices(
    vertices: DataFrame, faces: DataFrame, keys: Sequence[str], target_faces: int
) -> tuple[DataFrame, DataFrame]:
    """Vertex clustering towards a face count: (clustered vertices, remaining faces).

    Cell size is a tenth of the box diagonal times 1 - ratio^0.33; each cell becomes the mean of its vertices and takes the
    smallest member id. A mesh that is already small enough keeps its vertices.
    """
    keys = list(keys)
    diag2 = None
    for a in XYZ:
        d = F.max(a) - F.min(a)
        diag2 = d * d if diag2 is None else diag2 + d * d
    box = vertices.groupBy(*keys).agg(F.sqrt(diag2).alias("_d"))
    n = faces.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ratio = F.lit(float(target_faces)) / F.greatest(F.col("_n"), F.lit(1))
    size = box.join(n, keys).select(*keys, (F.col("_d") * (F.lit(1.0) - F.pow(ratio, F.lit(0.33))) * 0.1).alias("_s"))
    j = attach(vertices, size, keys)
    sized = F.col("_s") > 0
    cell = [F.when(sized, F.rint(F.col(a) / F.when(sized, F.col("_s")))).otherwise(F.lit(0.0)).cast("long").alias(f"_k{a}") for a in XYZ]
    solo = F.when(sized, F.lit(-1)).otherwise(F.col("vertex_id")).cast("long").alias("_kid")
    placed = cut(j.select(*keys, "vertex_id", *XYZ, *cell, solo))
    group = [*keys, *[f"_k{a}" for a in XYZ], "_kid"]
    cells = cut(placed.groupBy(*group).agg(F.min("vertex_id").alias("new_id"), *[F.avg(a).alias(a) for a in XYZ]))
    mapping = placed.select(*group, "vertex_id").join(cells.select(*group, "new_id"), group).select(*keys, "vertex_id", "new_id")
    return cells.select(*keys, F.col("new_id").alias("vertex_id"), *XYZ), remap_faces(faces, mapping, keys)


def face_components(faces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Component (smallest face id) of each face; faces are connected by edges that exactly two faces share."""
    keys = list(keys)
    e = mesh_edges(faces, keys)
    shared = e.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("_n"), F.min("face_id").alias("u"), F.max("face_id").alias("v")).filter("_n = 2")
    alone = faces.select(*keys, F.col("face_id").alias("u"), F.col("face_id").alias("v"))
    links = shared.select(*keys, "u", "v").unionByName(alone)
    return connected_components(links, keys).withColumnRenamed("id", "face_id")


def remove_small_components(
    faces: DataFrame, keys: Sequence[str], min_ratio: float = 0.01, min_faces: int = 100
) -> DataFrame:
    """Drop components with fewer faces than max(min_faces, int(ratio * largest)); if none is left the largest stays."""
    keys = list(keys)
    comp = cut(face_components(faces, keys))
    sizes = comp.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.groupBy(*keys).agg(F.max("n").alias("_top"), F.min_by("component", F.struct(-F.col("n"), "component")).alias("_best"))
    limit = F.greatest(F.lit(min_faces), F.floor(F.col("_top") * F.lit(min_ratio)))
    kept = sizes.join(top, keys).filter(
        (F.col("n") >= limit) | ((F.col("_top") < limit) & (F.col("component") == F.col("_best")))
    )
    good = attach(comp, kept.select(*keys, "component"), [*keys, "component"], "left_semi")
    return faces.join(good.select(*keys, "face_id"), [*keys, "face_id"], "left_semi")


def smooth(vertices: DataFrame, faces: DataFrame, keys: Sequence[str], iterations: int = 3, lam: float = 0.5) -> DataFrame:
    """Shrink by ``lam`` and inflate by -lam/(1 - lam/10), alternating; vertices without neighbours stay."""
    keys = list(keys)
    e = mesh_edges(faces, keys).select(*keys, "a", "b").distinct()
    adj = cut(e.unionByName(e.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))))
    mu = -lam / (1.0 - 0.1 * lam)
    pos = vertices.select(*keys, "vertex_id", *XYZ)
    for step in range(2 * iterations):
        f = lam if step % 2 == 0 else mu
        near = adj.join(pos.withColumnRenamed("vertex_id", "b"), [*keys, "b"])
        mean = near.groupBy(*keys, F.col("a").alias("vertex_id")).agg(*[F.avg(a).alias(f"_{a}") for a in XYZ])
        pos = cut(
            pos.join(mean, [*keys, "vertex_id"], "left").select(
                *keys, "vertex_id", *[F.coalesce(F.col(a) + F.lit(f) * (F.col(f"_{a}") - F.col(a)), F.col(a)).alias(a) for a in XYZ]
            )
        )
    return pos


def vertex_normals(vertices: DataFrame, faces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unit normal per vertex from the sum of its faces' unit normals; faceless vertices get zero."""
    keys = list(keys)
    n = cross(_edge(0, 1), _edge(0, 2))
    f = with_positions(faces, vertices, keys).withColumns({f"_n{a}": c for a, c in zip(XYZ, n)})
    length = F.sqrt(F.col("_nx") * F.col("_nx") + F.col("_ny") * F.col("_ny") + F.col("_nz") * F.col("_nz"))
    unit = [F.when(length > 0, F.col(f"_n{a}") / F.when(length > 0, length)).otherwise(F.lit(0.0)).alias(f"u{a}") for a in XYZ]
    per = f.select(*keys, F.explode(F.array(*CORNERS)).alias("vertex_id"), *unit)
    s = per.groupBy(*keys, "vertex_id").agg(*[F.sum(f"u{a}").alias(f"u{a}") for a in XYZ])
    j = vertices.select(*keys, "vertex_id").join(s, [*keys, "vertex_id"], "left")
    total = F.sqrt(F.col("ux") * F.col("ux") + F.col("uy") * F.col("uy") + F.col("uz") * F.col("uz"))
    return j.select(
        *keys, "vertex_id", *[F.when(total > 0, F.col(f"u{a}") / F.when(total > 0, total)).otherwise(F.lit(0.0)).alias(f"n{a}") for a in XYZ]
    )

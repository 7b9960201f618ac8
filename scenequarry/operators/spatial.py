"""Exact nearest-neighbour and radius joins on packed bounding-box trees.

Points are ranked along a space-filling curve and cut into leaves of equal size, so a dense region only means more leaves,
never a larger group. Eight consecutive nodes form a parent. A join descends level by level over (query leaf, target node)
pairs, drops pairs by box distance, and reaches points only for leaf pairs that can matter. The driver loops over levels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenequarry.functions.codes import morton
from scenequarry.operators.scale import BROADCAST_ROWS, attach, rank_rows
from scenequarry.session import cut

XYZ = ("x", "y", "z")
FANOUT_BITS = 3
#: Query points that one task holds with all their candidates.
POINTS_PER_TASK = 20_000


@dataclass
class Tree:
    """``leaves``: keys, leaf, pts array<struct>; ``levels[h]``: keys, node, box (x0 x1 y0 y1 z0 z1), n."""

    keys: list[str]
    leaves: DataFrame
    levels: list[DataFrame]
    sizes: list[int]


def _fine_code(points: DataFrame, keys: list[str]) -> DataFrame:
    """48-bit Morton code inside the group's bounds, for ordering only."""
    aggs = []
    for a in XYZ:
        aggs += [F.min(a).alias(f"_{a}0"), F.max(a).alias(f"_{a}1")]
    j = attach(points, points.groupBy(*keys).agg(*aggs), keys)
    cell = {}
    for a in XYZ:
        span = F.col(f"_{a}1") - F.col(f"_{a}0")
        c = F.floor((F.col(a) - F.col(f"_{a}0")) / F.when(span > 0, span) * F.lit(65536.0))
        cell[f"_i{a}"] = F.coalesce(F.least(c, F.lit(65535)), F.lit(0)).cast("long")
    j = j.withColumns(cell)
    high = {f"_h{a}": F.shiftright(F.col(f"_i{a}"), 8) for a in XYZ} | {f"_l{a}": F.col(f"_i{a}").bitwiseAND(F.lit(255)) for a in XYZ}
    j = j.withColumns(high)
    code = F.shiftleft(morton(*[F.col(f"_h{a}") for a in XYZ]), 24).bitwiseOR(morton(*[F.col(f"_l{a}") for a in XYZ]))
    return j.select(*points.columns, code.alias("_code"))


def build_tree(points: DataFrame, keys: Sequence[str], id_col: str, leaf_rows: int = 16, carry: Sequence[str] = ()) -> Tree:
    """Pack (keys, id, x, y, z) into leaves of ``leaf_rows`` points and levels of boxes above them; points keep ``carry``."""
    keys = list(keys)
    coded = _fine_code(points.select(*keys, F.col(id_col).alias("id"), *XYZ, *carry), keys)
    ranked = rank_rows(coded, keys, ["_code", "id"], "_rn")
    # the remainder joins the last full leaf, so a leaf is short only where the whole group is
    total = coded.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    last = F.greatest(F.floor(F.col("_n") / leaf_rows) - 1, F.lit(0))
    leaf = F.least(F.floor((F.col("_rn") - 1) / leaf_rows), last).cast("long")
    leaves = cut(
        attach(ranked, total, keys)
        .withColumn("leaf", leaf)
        .groupBy(*keys, "leaf")
        .agg(
            F.collect_list(F.struct("id", *XYZ, *carry)).alias("pts"),
            *[f(a).alias(f"{a}{s}") for a in XYZ for s, f in (("0", F.min), ("1", F.max))],
            F.count(F.lit(1)).alias("n"),
        )
    )
    box = [f"{a}{s}" for a in XYZ for s in "01"]
    # leaf numbers are dense per group, so the node counts of all levels follow from the last leaf of each group
    ends = leaves.groupBy(*keys).agg(F.max("leaf").alias("m"))
    heights = range(21)
    totals = ends.agg(F.max("m").alias("top"), *[F.sum(F.shiftright("m", FANOUT_BITS * h) + 1).alias(f"s{h}") for h in heights]).first()
    levels, sizes = [leaves.select(*keys, F.col("leaf").alias("node"), *box, "n")], [totals["s0"] or 0]
    h, top = 0, totals["top"] or 0
    while top > 0:
        h, top = h + 1, top >> FANOUT_BITS
        levels.append(
            leaves.groupBy(*keys, F.shiftright("leaf", FANOUT_BITS * h).alias("node")).agg(
                *[(F.min if c.endswith("0") else F.max)(c).alias(c) for c in box], F.sum("n").alias("n")
            )
        )
        sizes.append(totals[f"s{h}"])
    return Tree(keys, leaves, levels, sizes)


def _gap2(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Squared smallest distance of two boxes given per-axis bounds."""
    total = None
    for i in range(3):
        g = F.greatest(F.lit(0.0), lo_a[i] - hi_b[i], lo_b[i] - hi_a[i])
        total = g * g if total is None else total + g * g
    return total


def _span2(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Squared largest distance of two boxes."""
    total = None
    for i in range(3):
        g = F.greatest(F.abs(hi_a[i] - lo_b[i]), F.abs(hi_b[i] - lo_a[i]))
        total = g * g if total is None else total + g * g
    return total


_LO = [f"{a}0" for a in XYZ]
_HI = [f"{a}1" for a in XYZ]


def _cols(names, prefix=""):
    return [F.col(prefix + n) for n in names]


def _renamed(df: DataFrame, keys: list[str], node: str, prefix: str) -> DataFrame:
    return df.select(*keys, F.col("node").alias(node), *[F.col(c).alias(prefix + c) for c in (*_LO, *_HI)], F.col("n").alias(prefix + "n"))


def _descend(queries: Tree, targets: Tree, prune, extra: DataFrame | None = None) -> DataFrame:
    """Pairs (leaf, node) of query leaves and target leaves that survive ``prune`` on every level.

    ``extra`` adds columns per query leaf (keys, leaf, ...) that ``prune`` may use.
    """
    keys = queries.keys
    a = _renamed(queries.levels[0], keys, "leaf", "a_")
    if extra is not None:
        a = cut(a.join(extra, [*keys, "leaf"]))
    top = targets.levels[-1].select(*keys, "node")
    front = attach(a.select(*keys, "leaf"), top, keys, rows=targets.sizes[-1])
    for h in range(len(targets.levels) - 1, -1, -1):
        c = _renamed(targets.levels[h], keys, "node", "c_")
        if h < len(targets.levels) - 1:
            front = front.withColumn(
                "node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.shiftleft(F.col("node"), FANOUT_BITS) + i))
            )
        pairs = attach(front, c, [*keys, "node"], rows=targets.sizes[h])
        pairs = attach(pairs, a, [*keys, "leaf"], rows=queries.sizes[0])
        pairs = pairs.withColumns(
            {
                "gap2": _gap2(_cols(_LO, "a_"), _cols(_HI, "a_"), _cols(_LO, "c_"), _cols(_HI, "c_")),
                "span2": _span2(_cols(_LO, "a_"), _cols(_HI, "a_"), _cols(_LO, "c_"), _cols(_HI, "c_")),
            }
        )
        front = prune(pairs)
    return front


def _point_box_pairs(queries: Tree, targets: Tree, pairs: DataFrame, bound: Column) -> DataFrame:
    """Query points with the target leaves whose box is within ``bound`` (squared); ``bound`` may use x, y, z and leaf columns."""
    keys = queries.keys
    q = queries.leaves.withColumn("_p", F.explode("pts"))
    q = q.withColumns({"qid": F.col("_p.id")} | {a: F.col(f"_p.{a}") for a in XYZ})
    q = q.select(*keys, "leaf", "qid", *XYZ, bound.alias("bound2"))
    boxes = targets.levels[0].select(*keys, "node", *_LO, *_HI)
    j = pairs.join(q, [*keys, "leaf"])
    j = attach(j, boxes, [*keys, "node"], rows=targets.sizes[0])
    p = _cols(XYZ)
    j = j.withColumns({"gap2": _gap2(p, p, _cols(_LO), _cols(_HI)), "span2": _span2(p, p, _cols(_LO), _cols(_HI))})
    return j.filter(F.col("gap2") <= F.col("bound2")).select(*keys, "qid", *XYZ, "bound2", "node", "span2")


def _with_target_points(pairs: DataFrame, targets: Tree) -> DataFrame:
    keys = targets.keys
    t = targets.leaves.select(*keys, F.col("leaf").alias("node"), F.col("pts").alias("_tp"))
    j = pairs.join(t, [*keys, "node"]).withColumn("_t", F.explode("_tp"))
    d2 = None
    for a in XYZ:
        d = F.col(a) - F.col(f"_t.{a}")
        d2 = d * d if d2 is None else d2 + d * d
    return j.withColumn("d2", d2)


def _nth_distance2(pts: Column, x: Column, y: Column, z: Column, need: int) -> Column:
    """Squared distance to the need-th closest entry of a point array; infinite when it is shorter."""
    d = F.transform(
        pts, lambda p: (x - p["x"]) * (x - p["x"]) + (y - p["y"]) * (y - p["y"]) + (z - p["z"]) * (z - p["z"])
    )
    return F.coalesce(F.get(F.array_sort(d), F.lit(need - 1)), F.lit(float("inf")))


def _asking(tree: Tree) -> Tree:
    """The points of the tree without ``_full`` as queries. Leaves also hold ``around``, all points of the leaf and of those
    before and behind it."""
    keys = tree.keys
    places = F.explode(F.array(F.col("leaf") - 1, F.col("leaf"), F.col("leaf") + 1)).alias("leaf")
    around = tree.leaves.select(*keys, places, "pts").groupBy(*keys, "leaf").agg(F.flatten(F.collect_list("pts")).alias("around"))
    own = tree.leaves.select(*keys, "leaf", F.filter("pts", lambda p: ~p["_full"]).alias("pts")).filter(F.size("pts") > 0)
    side = lambda a: F.transform("pts", lambda p: p[a])
    box = {f"{a}{s}": f(side(a)) for a in XYZ for s, f in (("0", F.array_min), ("1", F.array_max))}
    leaves = cut(own.join(around, [*keys, "leaf"]).withColumns(box | {"n": F.size("pts").cast("long")}))
    return Tree(keys, leaves, [leaves.select(*keys, F.col("leaf").alias("node"), *box, "n")], tree.sizes[:1])


def _reach(tree: Tree, need: int) -> DataFrame:
    """Per leaf: the squared distance within which every one of its points finds ``need`` points around."""
    each = F.transform("pts", lambda p: _nth_distance2(F.col("around"), p["x"], p["y"], p["z"], need))
    return tree.leaves.select(*tree.keys, "leaf", F.array_max(each).alias("reach2"))


def _tasks(tree: Tree, leaf_rows: int) -> int:
    """Tasks for work by point of the tree: their number follows the points, so that none of them grows with the table."""
    return max(int(tree.leaves.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tree.sizes[0] * leaf_rows // POINTS_PER_TASK))


def _prune_knn(keys: list[str], need: int, tasks: int):
    """Keep nodes whose gap is within the distance that is known to hold ``need`` points for every point of the leaf."""

    def prune(pairs: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys, "leaf")
        run = w.orderBy("span2", "node").rowsBetween(Window.unboundedPreceding, 0)
        enough = F.min(F.when(F.col("_cum") >= need, F.col("span2"))).over(w)
        return (
            pairs.withColumn("_cum", F.sum("c_n").over(run))
            .withColumn("_u", enough)
            .filter(F.col("_u").isNull() | (F.col("gap2") <= F.col("_u")))
            .select(*keys, "leaf", "node")
        )

    return lambda pairs: cut(prune(pairs.select(*keys, "leaf", "node", "gap2", "span2", "c_n").repartition(tasks, *keys, "leaf")))


def finite() -> Column:
    """Neither infinite nor NaN in any axis."""
    return (F.col("x") - F.col("x") == 0) & (F.col("y") - F.col("y") == 0) & (F.col("z") - F.col("z") == 0)


def knn_self(points: DataFrame, keys: Sequence[str], id_col: str, k: int, leaf_rows: int | None = None) -> DataFrame:
    """k nearest other points of each point: keys, id, neighbour, d2, rank. Ties go to the smaller id; self is left out by id.

    Of equal positions only the k+1 smallest ids can be anybody's neighbour, so further copies are answered directly. So are
    the rows of positions that hold k+1 ids or more: they have each other at distance zero and ask the tree nothing.
    """
    keys = list(keys)
    pts = points.select(*keys, F.col(id_col).alias("id"), *[F.col(a).cast("double").alias(a) for a in XYZ])
    at = Window.partitionBy(*keys, *XYZ)
    need = k + 1
    first = pts.withColumn("_c", F.row_number().over(at.orderBy("id"))).filter(F.col("_c") <= need)
    ids = F.size(F.collect_set("id").over(at))
    first = cut(first.withColumn("_full", F.coalesce((ids == need) & finite(), F.lit(False))))
    copies = pts.join(first.select(*keys, "id"), [*keys, "id"], "left_anti")
    tree = build_tree(first, keys, "id", leaf_rows or max(8, need), ["_full"])
    asks = _asking(tree)
    within_reach = lambda p: p.filter(F.col("gap2") <= F.col("reach2")).select(*keys, "leaf", "node")
    pairs = _descend(asks, tree, within_reach, _reach(asks, need))
    near = _point_box_pairs(asks, tree, pairs, _nth_distance2(F.col("around"), *_cols(XYZ), need))
    hit = _with_target_points(near, tree).filter((F.col("d2") <= F.col("bound2")) & (F.col("_t.id") != F.col("qid")))
    hit = hit.select(*keys, F.col("qid").alias("id"), F.col("_t.id").alias("neighbour"), "d2")
    at0 = first.filter(F.col("_c") <= k).select(*keys, *XYZ, F.col("id").alias("neighbour"))
    zero = copies.join(at0, [*keys, *XYZ]).select(*keys, "id", "neighbour", F.lit(0.0).alias("d2"))
    full = first.filter("_full")
    own = full.join(full.select(*keys, *XYZ, F.col("id").alias("neighbour")), [*keys, *XYZ]).filter(F.col("id") != F.col("neighbour"))
    zero = zero.unionByName(own.select(*keys, "id", "neighbour", F.lit(0.0).alias("d2")))
    w = Window.partitionBy(*keys, "id").orderBy("d2", "neighbour")
    return hit.unionByName(zero).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def nearest(
    queries: DataFrame, targets: DataFrame, keys: Sequence[str], query_id: str, target_id: str, leaf_rows: int = 8
) -> DataFrame:
    """Nearest target of each query row: keys, query_id, target_id, d2. Ties go to the smaller target id."""
    keys = list(keys)
    t = targets.groupBy(*keys, *XYZ).agg(F.min(target_id).alias(target_id))
    qpos = cut(queries.groupBy(*keys, *XYZ).agg(F.min(query_id).alias("_qid")))
    qt, tt = build_tree(qpos, keys, "_qid", leaf_rows), build_tree(t, keys, target_id, leaf_rows)

    tasks = _tasks(qt, leaf_rows)
    pairs = _descend(qt, tt, _prune_knn(keys, 1, tasks))
    near = _point_box_pairs(qt, tt, pairs, F.lit(float("inf"))).repartition(tasks, *keys, "qid")
    w = Window.partitionBy(*keys, "qid")
    near = near.withColumn("_u", F.min("span2").over(w))
    boxes = tt.levels[0].select(*keys, "node", *_LO, *_HI)
    near = attach(near, boxes, [*keys, "node"], rows=tt.sizes[0])
    p = _cols(XYZ)
    near = near.filter(_gap2(p, p, _cols(_LO), _cols(_HI)) <= F.col("_u")).select(*keys, "qid", *XYZ, "node")
    near = near if tt.sizes[0] <= BROADCAST_ROWS else near.repartition(tasks, *keys, "node")
    points = tt.leaves.select(*keys, F.col("leaf").alias("node"), F.col("pts").alias("_tp"))
    d2 = lambda t: sum(((F.col(a) - t[a]) * (F.col(a) - t[a]) for a in XYZ[1:]), (F.col("x") - t["x"]) * (F.col("x") - t["x"]))
    # the nearest point of each leaf is found inside the row, so only one row per leaf is sorted by query
    one = F.array_min(F.transform("_tp", lambda t: F.struct(d2(t).alias("d2"), t["id"].alias("tid"))))
    d = attach(near, points, [*keys, "node"], rows=tt.sizes[0]).select(*keys, "qid", one.alias("_b"))
    d = d if tt.sizes[0] <= BROADCAST_ROWS else d.repartition(tasks, *keys, "qid")
    best = d.groupBy(*keys, "qid").agg(F.min("_b").alias("_b"))
    by_pos = qpos.join(best.withColumnRenamed("qid", "_qid"), [*keys, "_qid"]).select(
        *keys, *XYZ, F.col("_b.tid").alias(target_id), F.col("_b.d2").alias("d2")
    )
    return queries.select(*keys, query_id, *XYZ).join(by_pos, [*keys, *XYZ]).select(*keys, query_id, target_id, "d2")


def within_radius(queries: DataFrame, targets: DataFrame, keys: Sequence[str], query_id: str, radius: float, leaf_rows: int = 16) -> DataFrame:
    """Queries that have any target within ``radius`` (keys, query_id).

    A query leaf that lies wholly within reach of a target box is settled without looking at points; only leaves on the
    rim of the reach come down to points. Work is per distinct position.
    """
    keys = list(keys)
    r2 = float(radius) * float(radius)
    qpos = cut(queries.select(*keys, *XYZ).distinct().withColumn("_qid", F.xxhash64(*[F.col(a) for a in XYZ])))
    tpos = targets.select(*keys, *XYZ).distinct().withColumn("_tid", F.xxhash64(*[F.col(a) for a in XYZ]))
    qt, tt = build_tree(qpos, keys, "_qid", leaf_rows), build_tree(tpos, keys, "_tid", leaf_rows)
    settled: list[DataFrame] = []

    def prune(pairs: DataFrame) -> DataFrame:
        live = cut(pairs.filter(F.col("gap2") <= r2).select(*keys, "leaf", "node", "span2"))
        sure = live.filter(F.col("span2") <= r2).select(*keys, "leaf").distinct()
        settled.append(sure)
        return live.join(sure, [*keys, "leaf"], "left_anti").select(*keys, "leaf", "node")

    pairs = _descend(qt, tt, prune)
    all_sure = settled[0]
    for s in settled[1:]:
        all_sure = all_sure.unionByName(s)
    whole = qt.leaves.join(all_sure, [*keys, "leaf"], "left_semi").select(*keys, F.explode("pts").alias("_p"))
    whole = whole.select(*keys, *[F.col(f"_p.{a}").alias(a) for a in XYZ])
    near = cut(_point_box_pairs(qt, tt, pairs, F.lit(r2)))
    easy = near.filter(F.col("span2") <= r2).select(*keys, "qid", *XYZ).distinct()
    rest = near.join(easy.select(*keys, "qid"), [*keys, "qid"], "left_anti")
    rim = _with_target_points(rest, tt).filter(F.col("d2") <= r2).select(*keys, *XYZ)
    hit = whole.unionByName(easy.select(*keys, *XYZ)).unionByName(rim).distinct()
    return queries.select(*keys, query_id, *XYZ).join(hit, [*keys, *XYZ], "left_semi").select(*keys, query_id)


# ------------------------------------------------------------------ operators built on the joins


def knn_edges(points: DataFrame, keys: Sequence[str], id_col: str, k: int) -> DataFrame:
    """Undirected union of the k-nearest-neighbour lists: keys, u < v, d2."""
    nn = knn_self(points, keys, id_col, k)
    return (
        nn.select(*keys, F.least("id", "neighbour").alias("u"), F.greatest("id", "neighbour").alias("v"), "d2")
        .groupBy(*keys, "u", "v")
        .agg(F.min("d2").alias("d2"))
    )


def grow_selection(rows: DataFrame, radius: float, iterations: int = 1, id_col: str = "splat_id") -> DataFrame:
    """Unselected rows within ``radius`` of a selected row become selected; repeated ``iterations`` times."""
    keys = ["scene_id"]
    for _ in range(iterations):
        hit = within_radius(rows.filter(~F.col("selected")), rows.filter("selected"), keys, id_col, radius)
        hit = hit.withColumn("_hit", F.lit(True))
        rows = cut(
            rows.join(hit, [*keys, id_col], "left")
            .withColumn("selected", F.col("selected") | F.coalesce(F.col("_hit"), F.lit(False)))
            .drop("_hit")
        )
    return rows


def shrink_selection(rows: DataFrame, radius: float, iterations: int = 1, id_col: str = "splat_id") -> DataFrame:
    """Selected rows with an unselected row within ``radius`` are dropped from the selection."""
    keys = ["scene_id"]
    for _ in range(iterations):
        hit = within_radius(rows.filter("selected"), rows.filter(~F.col("selected")), keys, id_col, radius)
        hit = hit.withColumn("_hit", F.lit(True))
        rows = cut(
            rows.join(hit, [*keys, id_col], "left")
            .withColumn("selected", F.col("selected") & ~F.coalesce(F.col("_hit"), F.lit(False)))
            .drop("_hit")
        )
    return rows


def transfer_nearest(source: DataFrame, target: DataFrame, keys: Sequence[str], source_id: str, target_id: str, cols: Sequence[str]) -> DataFrame:
    """Give each target vertex the attributes of its nearest source vertex."""
    m = nearest(target, source, keys, target_id, source_id)
    return m.join(source.select(*keys, source_id, *cols), [*keys, source_id]).select(*keys, target_id, source_id, *cols)


def init_from_points(points: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Splats from coloured points: log of the mean distance to three neighbours (at least 1e-5), logit 2, SH from colour."""
    from scenequarry.functions.splats import rgb_to_sh

    nn = knn_self(points, keys, id_col, 3)
    s = nn.groupBy(*keys, F.col("id").alias(id_col)).agg(F.avg(F.sqrt("d2")).alias("_m"))
    j = points.join(s, [*keys, id_col], "left")
    scale = F.ln(F.greatest(F.coalesce("_m", F.lit(1e-5)), F.lit(1e-5)))
    return j.select(
        *keys, id_col, *XYZ, *[scale.alias(f"s{i}") for i in range(3)], F.lit(2.0).alias("opacity_raw"),
        F.lit(1.0).alias("qw"), *[F.lit(0.0).alias(f"q{a}") for a in XYZ],
        *[rgb_to_sh(F.col(c).cast("double") / 255.0).alias(f"c{i}") for i, c in enumerate("rgb")],
    )


def pair_distances(rows: DataFrame, refs: DataFrame, p: float, left_id: str, right_id: str, vec: str = "embedding", block_rows: int = 2_000, max_distance: float | None = None) -> DataFrame:
    """p-norm distances of each row to each reference row, or to those within ``max_distance``.

    References are packed into blocks of about ``block_rows`` by hash; a row meets each block once, so the joined sides hold
    rows times blocks, and the full table of pairs exists only if it is what was asked for.
    """
    own = refs.select(F.col(left_id).alias(right_id), F.col(vec).alias("_rv"))
    blocks = max(1, -(-own.count() // block_rows))
    packed = own.groupBy(F.pmod(F.xxhash64(right_id, "_rv"), F.lit(blocks)).cast("int").alias("_b")).agg(F.collect_list(F.struct(right_id, "_rv")).alias("_refs"))
    asked = rows.select(left_id, vec, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_b"))
    j = asked.join(packed, "_b").withColumn("_r", F.explode("_refs"))
    diff = F.zip_with(F.col(vec), F.col("_r._rv"), lambda a, b: F.abs(a.cast("double") - b.cast("double")))
    if p == 1:
        d = F.aggregate(diff, F.lit(0.0), lambda s, v: s + v)
    elif p == 2:
        d = F.sqrt(F.aggregate(diff, F.lit(0.0), lambda s, v: s + v * v))
    else:
        d = F.pow(F.aggregate(diff, F.lit(0.0), lambda s, v: s + F.pow(v, F.lit(float(p)))), F.lit(1.0 / p))
    out = j.select(left_id, F.col(f"_r.{right_id}").alias(right_id), d.alias("distance"))
    return out if max_distance is None else out.filter(F.col("distance") <= max_distance)


def matrix_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sparse product: a(row, k, v) and b(k, col, v) joined on the inner index and summed."""
    j = a.select("row", "k", F.col("v").alias("_a")).join(b.select("k", "col", F.col("v").alias("_b")), "k")
    return j.groupBy("row", "col").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))


def resolve_index(index: Column, size: Column, mode: str) -> Column:
    """Out-of-range rule of a gather: 'clamp' to the ends or 'wrap' around."""
    if mode == "clamp":
        return F.greatest(F.lit(0), F.least(index, size - 1))
    if mode == "wrap":
        return F.pmod(index, size)
    raise ValueError(f"unknown mode {mode!r}")

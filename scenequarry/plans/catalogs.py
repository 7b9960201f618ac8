"""Catalog, ledger, localisation, structural and scene-graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenequarry.operators import catalog as C
from scenequarry.operators import graphs as G
from scenequarry.plans.columns import rd
from scenequarry.plans.registry import query


@query(
    "key_audit", "translations",
    """SELECT lang, key, 'missing' AS issue FROM (SELECT l.lang, r.key FROM (SELECT DISTINCT lang FROM d WHERE lang <> 'BUILDING') l, (SELECT DISTINCT key FROM d WHERE lang = 'BUILDING') r) e WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.lang = e.lang AND d.key = e.key)
UNION ALL SELECT DISTINCT lang, key, 'extra' FROM d WHERE lang <> 'BUILDING' AND key NOT IN (SELECT key FROM d WHERE lang = 'BUILDING')
UNION ALL SELECT DISTINCT 'BUILDING', n_nationkey, 'undefined' FROM nation WHERE n_nationkey NOT IN (SELECT key FROM d WHERE lang = 'BUILDING')""",
    then="d AS (SELECT lang, key FROM translations WHERE (c_custkey % 13 <> 0 OR key > 5) AND NOT (lang = 'BUILDING' AND key IN (3, 9)) AND NOT (lang = 'MACHINERY' AND key = 7))",
)
def _(load):
    d = load("translations").filter("(c_custkey % 13 <> 0 OR key > 5) AND NOT (lang = 'BUILDING' AND key IN (3, 9)) AND NOT (lang = 'MACHINERY' AND key = 7)")
    used = load("nation").select(F.col("n_nationkey").alias("key"))
    return C.audit_keys(d, "BUILDING", used)


_UPS = """o AS (SELECT CASE WHEN asset_id % 7 = 0 THEN NULL ELSE folder END AS folder, path, size, [lang, source] AS tags FROM assets WHERE asset_id % 3 <> 0),
n AS (SELECT asset_id AS k, CASE WHEN asset_id % 7 = 0 THEN NULL ELSE folder END AS folder, path, CASE WHEN asset_id % 5 = 0 THEN NULL WHEN asset_id % 11 = 0 THEN 0 ELSE size*2 END AS size, [lang, 'new'] AS tags FROM assets WHERE asset_id % 2 = 0
UNION ALL SELECT 1000000000 + asset_id, CASE WHEN asset_id % 7 = 0 THEN NULL ELSE folder END, path, CASE WHEN asset_id % 8 = 0 THEN 0 ELSE size*3 END, ['again'] FROM assets WHERE asset_id % 4 = 0),
f AS (SELECT folder, path, arg_max(size, k) FILTER (size <> 0) AS size, flatten(list(tags ORDER BY k)) AS tags FROM n GROUP BY folder, path)"""


@query(
    "asset_upsert", "assets",
    """SELECT CASE WHEN o.path IS NULL THEN f.folder ELSE o.folder END AS folder, coalesce(o.path, f.path) AS path, coalesce(f.size, o.size) AS size,
(SELECT string_agg(t, ',' ORDER BY i) FROM (SELECT t, min(i) AS i FROM (SELECT unnest(list_concat(coalesce(o.tags, []), coalesce(f.tags, []))) AS t, generate_subscripts(list_concat(coalesce(o.tags, []), coalesce(f.tags, [])), 1) AS i) u GROUP BY t) d) AS tags,
CASE WHEN o.path IS NULL THEN 'added' WHEN f.path IS NULL THEN 'kept' ELSE 'updated' END AS state FROM o FULL JOIN f ON o.folder IS NOT DISTINCT FROM f.folder AND o.path = f.path""",
    then=_UPS,
)
def _(load):
    a = load("assets").withColumn("folder", F.when(F.col("asset_id") % 7 != 0, F.col("folder")))
    old = a.filter("asset_id % 3 <> 0").select("folder", "path", "size", F.array("lang", "source").alias("tags"))
    k = F.col("asset_id")
    first = a.filter("asset_id % 2 = 0").select(k.alias("k"), "folder", "path", F.when(k % 5 == 0, None).when(k % 11 == 0, 0).otherwise(F.col("size") * 2).alias("size"), F.array("lang", F.lit("new")).alias("tags"))
    again = a.filter("asset_id % 4 = 0").select((k + 1_000_000_000).alias("k"), "folder", "path", F.when(k % 8 == 0, 0).otherwise(F.col("size") * 3).alias("size"), F.array(F.lit("again")).alias("tags"))
    u = C.upsert_assets(old, first.unionByName(again), ["size"], order="k")
    return u.select("folder", "path", "size", F.array_join("tags", ",").alias("tags"), "state")


_LED = """led AS (SELECT user_id AS session_id, CASE WHEN event_type = 'purchase' THEN 'done' ELSE 'running' END AS status, event_id % 100 AS n_sets, event_id AS updated_at FROM events WHERE event_id % 2 = 0),
upd AS (SELECT user_id AS session_id, CASE WHEN event_id % 3 = 0 THEN 'done' WHEN event_id % 3 = 1 THEN 'failed' END AS status, event_id AS updated_at FROM events WHERE event_id % 2 = 1),
latest AS (SELECT session_id, arg_max(status, updated_at) FILTER (status IS NOT NULL) AS status, arg_max(n_sets, updated_at) FILTER (n_sets IS NOT NULL) AS n_sets, max(updated_at) AS updated_at
FROM (SELECT * FROM led UNION ALL SELECT session_id, status, NULL, updated_at FROM upd) q GROUP BY session_id)"""


def _ledger(load):
    e = load("events")
    led = e.filter("event_id % 2 = 0").select(
        F.col("user_id").alias("session_id"), F.when(F.col("event_type") == "purchase", "done").otherwise("running").alias("status"), (F.col("event_id") % 100).alias("n_sets"), F.col("event_id").alias("updated_at")
    )
    upd = e.filter("event_id % 2 = 1").select(
        F.col("user_id").alias("session_id"), F.when(F.col("event_id") % 3 == 0, "done").when(F.col("event_id") % 3 == 1, "failed").alias("status"), F.col("event_id").alias("updated_at")
    )
    return C.upsert_ledger(led, upd)


@query("ledger_upsert", "", "SELECT * FROM latest", then=_LED)
def _(load):
    return _ledger(load)


@query("pending_sessions", "", "SELECT c_custkey AS session_id FROM customer WHERE c_custkey NOT IN (SELECT session_id FROM latest WHERE status = 'done')", then=_LED)
def _(load):
    return C.pending_sessions(load("customer").select(F.col("c_custkey").alias("session_id")), _ledger(load))


#: Names that meet each rule of the asset scan, by id.
_NAMES = ("final.ply", "img.jpg", "mesh.obj", "run.CKPT", "iter_30.spz", "scene.usdz", "thumb.png", ".hidden", "guide.txt", "head", "iter-7.rad", "x.sog")
_FOLDERS = ("data", "exports", "train_output", "iteration_7", "stuff", "reference")


def _sql_list(items) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


_SCAN = f"""f AS (SELECT asset_id, ({_sql_list(_FOLDERS)})[asset_id % 6 + 1] AS parent, ({_sql_list(_NAMES)})[CAST(floor(asset_id / 6e0) AS BIGINT) % 12 + 1] AS name,
CASE asset_id % 5 WHEN 0 THEN '706C790A' WHEN 1 THEN '53505A01' WHEN 2 THEN '00' END AS head FROM assets),
e AS (SELECT *, lower(regexp_extract(name, '[^/]\\.([^./]+)$', 1)) AS ext FROM f),
h AS (SELECT *, CASE head WHEN '706C790A' THEN 'ply' WHEN '53505A01' THEN 'spz' END AS proved, CASE WHEN ext IN ('ply','spz','sog','rad') THEN ext WHEN ext = 'obj' THEN 'mesh' WHEN ext = 'ckpt' THEN 'checkpoint' WHEN ext = 'usdz' THEN 'usd' END AS byext FROM e),
t AS (SELECT *, CASE WHEN byext IS NULL OR byext IN ('ply','spz') THEN coalesce(proved, byext) ELSE byext END AS type FROM h)"""


def _role_sql(column: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower({column}), '{pattern}') THEN '{role}'" for role, pattern in C.ROLE_NAMES) + " END"


@query(
    "classify_assets", "assets",
    f"""SELECT asset_id, ext AS extension, type, coalesce({_role_sql("name")}, {_role_sql("parent")}, CASE WHEN type = 'checkpoint' THEN 'training_checkpoint' WHEN type IN ('ply','rad','sog','spz') THEN 'trained_output' END, 'unknown') AS role FROM t""",
    then=_SCAN,
)
def _(load):
    i = F.col("asset_id")
    pick = lambda items, k: F.get(F.array(*[F.lit(x) for x in items]), k.cast("int"))
    head = F.when(i % 5 == 0, F.unhex(F.lit("706C790A"))).when(i % 5 == 1, F.unhex(F.lit("53505A01"))).when(i % 5 == 2, F.unhex(F.lit("00")))
    path = F.concat(F.lit("/root/"), pick(_FOLDERS, i % 6), F.lit("/"), pick(_NAMES, F.floor(i / 6) % 12))
    return C.classify_files(load("assets").select("asset_id", path.alias("path"), head.alias("head")), header="head").select("asset_id", "extension", "type", "role")


#: A file of a dataset by (dataset kind, file kind); null: no such file.
_FILES = (
    ("images/a{}.jpg", "images/sub/b{}.PNG", "images/masks/c{}.jpg", "masks/m{}.png", "sparse/0/cameras.bin"),
    ("sparse/images.txt", "readme{}.md", "sparse/p{}.jpg", "database.db", "depth/d{}.png"),
    ("photos/a{}.jpg", "photos/b{}.tif", "cameras.txt", "images.txt", "masks/m{}.png"),
    ("photos/a{}.jpg", "cameras.txt", "notes{}.txt", "images/sub/c{}.jpg", "masks/m{}.png"),
)
_SETS = """x AS (SELECT asset_id, source || '_' || CAST(asset_id % 4 AS VARCHAR) AS dataset, asset_id % 4 AS kind, CAST(floor(asset_id / 4e0) AS BIGINT) % 5 AS j FROM assets),
p AS (SELECT dataset, replace(CASE kind * 5 + j """ + " ".join(f"WHEN {k * 5 + j} THEN '{f}'" for k, row in enumerate(_FILES) for j, f in enumerate(row)) + """ END, '{}', CAST(asset_id AS VARCHAR)) AS path FROM x),
i AS (SELECT dataset, path, regexp_matches(lower(path), '\\.(jpg|jpeg|png|tiff|tif|bmp|webp|exr)$') AS img, regexp_matches(lower(path), '\\.(jpg|jpeg)$') AS jpg, path LIKE 'images/%' AS root,
regexp_matches(lower(CASE WHEN path LIKE 'images/%' THEN substr(path, 8) ELSE path END), '(^|/)(masks?|sparse|dense|stereo|depths?|images_reconstruction|reconstruction|__pycache__)/') AS off FROM p),
g AS (SELECT dataset, bool_or(root) AS rooted, bool_or(img AND regexp_matches(path, '^images/[^/]+$')) AS direct, count(*) FILTER (img AND root AND NOT off) AS below, count(*) FILTER (img AND NOT off) AS anyimg,
count(*) FILTER (jpg AND root AND NOT off) AS jbelow, count(*) FILTER (jpg AND NOT off) AS jany, bool_or(regexp_matches(path, '^sparse/(0/)?(cameras|images|points3D)\\.(bin|txt)$')) AS model, bool_or(path LIKE 'sparse/%') AS sparse,
bool_or(path LIKE 'masks/%') AS masks, bool_or(path = 'database.db') AS db, bool_or(path = 'cameras.txt') AND bool_or(path = 'images.txt') AS txt FROM i GROUP BY dataset),
l AS (SELECT *, direct OR model OR db OR txt AS looks, CASE WHEN NOT (direct OR model OR db OR txt) THEN 0 WHEN rooted THEN below ELSE anyimg END AS n, CASE WHEN rooted THEN jbelow ELSE jany END AS j FROM g)"""


@query(
    "dataset_inventory", "assets",
    """SELECT dataset, n AS image_count, looks AND sparse AS has_sparse, looks AND masks AS has_masks, CASE WHEN n > 0 THEN (n - j) * 1e0 / n ELSE 0e0 END AS non_jpeg_ratio, looks AND (n > 0 OR sparse OR db OR txt) AS is_valid,
concat_ws(';', CASE WHEN NOT looks OR (n = 0 AND NOT (sparse OR db OR txt)) THEN 'No images or sparse model found' END, CASE WHEN looks AND n = 0 AND (sparse OR db OR txt) THEN 'No images found, but COLMAP data exists' END,
CASE WHEN n > 0 AND n < 3 THEN 'Very few images (' || CAST(n AS VARCHAR) || '), may not reconstruct well' END) AS issues FROM l""",
    then=_SETS,
)
def _(load):
    i = F.col("asset_id")
    flat = F.array(*[F.lit(f) for row in _FILES for f in row])
    path = F.replace(F.get(flat, ((i % 4) * 5 + F.floor(i / 4) % 5).cast("int")), F.lit("{}"), i.cast("string"))
    files = load("assets").select(F.concat("source", F.lit("_"), (i % 4).cast("string")).alias("dataset"), path.alias("path"))
    return C.dataset_inventory(files).withColumn("issues", F.array_join("issues", ";"))


@query(
    "layout_errors", "assets",
    """SELECT source AS dataset, 'img_' || CAST(asset_id AS VARCHAR) AS name, 'missing_image' AS error FROM assets WHERE asset_id % 9 = 0
UNION ALL SELECT source, 'img_' || CAST(asset_id AS VARCHAR), 'duplicate_name' FROM assets WHERE asset_id % 9 <> 0 AND asset_id % 11 = 0""",
)
def _(load):
    a = load("assets").select(F.col("source").alias("dataset"), "asset_id", F.concat(F.lit("img_"), F.col("asset_id").cast("string")).alias("name"))
    present = a.filter("asset_id % 9 <> 0").select("dataset", "name")
    nested = a.filter("asset_id % 9 <> 0 AND asset_id % 11 = 0").select("dataset", F.concat(F.lit("sub/"), "name").alias("name"))
    return C.layout_errors(a, present.unionByName(nested))


@query("distinct_paths", "", "SELECT l_partkey AS part, min(l_orderkey*10+l_linenumber) AS pos FROM lineitem GROUP BY l_partkey")
def _(load):
    df = load("lineitem").select(F.col("l_partkey").alias("part"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    return C.distinct_in_order(df, ["part"], "pos")


@query("repeat_rows", "", "SELECT s_suppkey, CAST(unnest(range(3)) AS INTEGER) AS copy FROM supplier")
def _(load):
    return C.repeat_rows(load("supplier").select("s_suppkey"), 3)


@query("concat_tables", "", "SELECT c_custkey AS id, c_acctbal AS v FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def _(load):
    a = load("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v"))
    return a.unionByName(load("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v")))


def _nodes(load):
    n = load("nodes")
    m = [1.0, 0, 0, None, 0, 1.0, 0, None, 0, 0, 1.0, None, 0, 0, 0, 1.0]
    shift = {3: "dx", 7: "dy", 11: "dz"}
    local = F.array(*[F.col(shift[i]) if i in shift else F.lit(float(v or 0)) for i, v in enumerate(m)])
    return n.select(F.lit(0).cast("long").alias("scene_id"), "node_id", "parent_id", "visible", local.alias("local"))


_WORLD = """w AS (SELECT a.node_id, a.visible AS e, a.dx AS x, a.dy AS y, a.dz AS z, 0 AS depth FROM nodes a WHERE parent_id IS NULL
UNION ALL SELECT b.node_id, a.visible AND b.visible, a.dx+b.dx, a.dy+b.dy, a.dz+b.dz, 1 FROM nodes b JOIN nodes a ON a.node_id = b.parent_id WHERE a.parent_id IS NULL
UNION ALL SELECT c.node_id, a.visible AND b.visible AND c.visible, a.dx+b.dx+c.dx, a.dy+b.dy+c.dy, a.dz+b.dz+c.dz, 2 FROM nodes c JOIN nodes b ON b.node_id = c.parent_id JOIN nodes a ON a.node_id = b.parent_id)"""


@query("world_transforms", "nodes", "SELECT node_id, e AS effective, round(x,6)+0e0 AS x, round(y,6)+0e0 AS y, round(z,6)+0e0 AS z, depth FROM w", then=_WORLD)
def _(load):
    w = G.world_transforms(_nodes(load))
    return w.select("node_id", "effective", *[rd(F.get("world", F.lit(i)), a) for i, a in ((3, "x"), (7, "y"), (11, "z"))], "depth")


@query(
    "node_descendants", "nodes",
    "SELECT a.node_id AS root, a.node_id, 0 AS depth FROM nodes a WHERE parent_id IS NULL UNION ALL SELECT parent_id, node_id, 1 FROM nodes WHERE parent_id < 1000 UNION ALL SELECT b.parent_id, c.node_id, 2 FROM nodes c JOIN nodes b ON b.node_id = c.parent_id WHERE c.parent_id >= 1000",
)
def _(load):
    n = _nodes(load)
    return G.descendants(n, n.filter("parent_id is null")).select("root", "node_id", "depth")


@query(
    "merge_visible", "splats nodes",
    "SELECT s.splat_id, round(s.x+w.x,6)+0e0 AS x, round(s.y+w.y,6)+0e0 AS y, round(s.z+w.z,6)+0e0 AS z FROM (SELECT splat_id, x, y, z, 100000+splat_id % 1000 AS node_id FROM splats) s JOIN w ON w.node_id = s.node_id WHERE w.e",
    then=_WORLD,
)
def _(load):
    """Splats spread over the customer-level nodes, moved into world space where the whole ancestry is visible."""
    s = load("splats").select(F.lit(0).cast("long").alias("scene_id"), "splat_id", "x", "y", "z", (F.col("splat_id") % 1000 + 100000).alias("node_id"))
    m = G.merge_visible(s, G.world_transforms(_nodes(load)))
    return m.select("splat_id", *[rd(F.col(a), a) for a in "xyz"])

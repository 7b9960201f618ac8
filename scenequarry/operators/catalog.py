"""Catalog, ledger, dataset and localisation tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pool_videos(frames: DataFrame, session: str = "session_id", video: str = "video") -> DataFrame:
    """One frame set per session: a two-digit set number, from 00 by video name, in front of each frame name.

    Sets are numbered on the distinct (session, video) table, so frames are only joined to their set.
    """
    from scenequarry.operators.scale import attach, rank_rows

    sets = rank_rows(frames.select(session, video).distinct(), [session], [video], "set_no")
    j = attach(frames, sets, [session, video])
    return j.withColumn("pooled_name", F.concat(F.format_string("set%02d_", F.col("set_no") - 1), F.col("frame_name")))


def audit_keys(defined: DataFrame, reference_lang: str, used: DataFrame | None = None) -> DataFrame:
    """Missing and extra keys per language against the reference language, and used keys that nobody defines.

    ``defined``: lang, key. ``used``: key. Result: lang, key, issue.
    """
    d = defined.select("lang", "key").distinct()
    langs = d.filter(F.col("lang") != reference_lang).agg(F.array_sort(F.collect_set("lang")).alias("_langs"))
    # one row per key with the languages that define it; the list of languages is as short as the list of locale files
    by_key = d.groupBy("key").agg(F.collect_set("lang").alias("_in")).join(F.broadcast(langs))
    known = F.array_contains("_in", reference_lang)
    lacks = F.transform(F.array_except("_langs", "_in"), lambda x: F.struct(x.alias("lang"), F.lit("missing").alias("issue")))
    extra = F.transform(F.array_remove("_in", reference_lang), lambda x: F.struct(x.alias("lang"), F.lit("extra").alias("issue")))
    out = by_key.select("key", F.inline(F.when(known, lacks).otherwise(extra))).select("lang", "key", "issue")
    if used is not None:
        ref = d.filter(F.col("lang") == reference_lang).select("key")
        undef = used.select("key").distinct().join(ref, "key", "left_anti")
        out = out.unionByName(undef.select(F.lit(reference_lang).alias("lang"), "key", F.lit("undefined").alias("issue")))
    return out


def fill_missing(defined: DataFrame, audit: DataFrame, marker: str = "TODO") -> DataFrame:
    """Definitions with a marked row for every missing key."""
    todo = audit.filter("issue = 'missing'").select("lang", "key", F.lit(marker).alias("text"))
    return defined.select("lang", "key", "text").unionByName(todo)


def _said(c: Column, kind: str) -> Column:
    """Null for values that an update leaves as they were: null, an empty text, zero."""
    return F.nullif(c, F.lit("")) if kind == "string" else F.nullif(c, F.lit(0).cast(kind)) if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") else c


def upsert_assets(old: DataFrame, new: DataFrame, fields: Sequence[str], keys: Sequence[str] = ("folder", "path"), order: str | None = None) -> DataFrame:
    """Merge by (folder, path), null folders included: tags keep their order without repeats, ids stay.

    A new field wins unless it is null, empty or zero. Several new rows of one key count as updates one after the other, by
    ``order`` (a column of ``new``) or else by their values: the last that says something wins, tags are added in turn.
    """
    keys = list(keys)
    kinds = dict(new.dtypes)
    turn = [order] if order else []
    rest = [f for f in ("tags", *fields) if f not in turn]
    rows = F.array_sort(F.collect_list(F.struct(*turn, *rest)))
    folded = new.groupBy(*keys).agg(rows.alias("_u"))

    def last(f: str) -> Column:
        values = F.filter(F.transform("_u", lambda r: _said(r[f], kinds[f])), lambda x: x.isNotNull())
        return F.get(values, F.size(values) - 1)

    empty = F.array().cast("array<string>")
    b = folded.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.flatten(F.transform("_u", lambda r: F.coalesce(r["tags"], empty))).alias("_t1"), *[last(f).alias(f"_n_{f}") for f in fields])
    a = old.select(*keys, F.coalesce("tags", empty).alias("_t0"), *[F.col(f).alias(f"_o_{f}") for f in fields])
    same = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys])
    j = a.join(b, same, "full_outer")
    tags = F.array_distinct(F.concat(F.coalesce("_t0", empty), F.coalesce("_t1", empty)))
    state = F.when(F.col("_t0").isNull(), "added").when(F.col("_t1").isNull(), "kept").otherwise("updated")
    own = [F.when(F.col("_t0").isNull(), F.col(f"_k_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return j.select(*own, tags.alias("tags"), *[F.coalesce(f"_n_{f}", f"_o_{f}").alias(f) for f in fields], state.alias("state"))


def pending_sessions(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sessions that the ledger does not record as done."""
    return listing.join(ledger.filter("status = 'done'").select("session_id").distinct(), "session_id", "left_anti")


def upsert_ledger(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """One row per session with the latest value of each field by updated_at; a field that an update leaves out or null stays."""
    cols = ledger.columns
    rest = [c for c in cols if c not in ("session_id", "updated_at")]
    given = updates.select("session_id", "updated_at", *[F.col(c) if c in updates.columns else F.lit(None).cast(ledger.schema[c].dataType).alias(c) for c in rest])
    u = ledger.withColumn("_g", F.lit(0)).unionByName(given.withColumn("_g", F.lit(1)))
    when = F.struct("updated_at", "_g")
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c) for c in rest]
    return u.groupBy("session_id").agg(*last, F.max("updated_at").alias("updated_at")).select(*cols)


def distinct_in_order(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Distinct key values with the position of their first appearance."""
    return df.groupBy(*keys).agg(F.min(position).alias(position))


def repeat_rows(df: DataFrame, times: int) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


# Asset type by file extension.
ASSET_TYPES = {
    "ply": "ply", "rad": "rad", "sog": "sog", "spz": "spz", "obj": "mesh", "fbx": "mesh", "gltf": "mesh", "glb": "mesh", "stl": "mesh", "dae": "mesh", "3ds": "mesh", "mesh": "mesh",
    "ckpt": "checkpoint", "resume": "checkpoint", "usd": "usd", "usda": "usd", "usdc": "usd", "usdz": "usd",
}
# First bytes of a file, as text, and the type that they prove.
HEADERS = (("ply\n", "ply"), ("ply\r", "ply"), ("SPZ\0", "spz"), ("SPZ\1", "spz"))
# Roles by parts of a name, the first that fits.
ROLE_NAMES = (
    ("source_dataset", r"dataset|input|source|images|colmap"), ("training_checkpoint", r"checkpoint|ckpt|iteration[_-]?\d+|iter[_-]?\d+|chkpnt"),
    ("trained_output", r"output|trained|result|final|point_cloud|iteration[_-]?\d+"), ("preview", r"preview|thumb|thumbnail|render"), ("export", r"export|output|saved|published"),
    ("reference", r"ref|reference|guide|example"),
)
# Images of a dataset, and folders below its image root whose images don't count.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "tiff", "tif", "bmp", "webp", "exr")
NOT_IMAGES = r"(?i)(^|/)(masks?|sparse|dense|stereo|depths?|images_reconstruction|reconstruction|__pycache__)/"
# Video files of a session.
VIDEO_EXTENSIONS = ("mp4", "mov", "mkv", "avi", "m4v")


def extension(path: Column) -> Column:
    """Lower-case extension of the file name, empty without one; a dot at the start of the name starts none."""
    return F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))


def classify_files(files: DataFrame, path: str = "path", header: str | None = None) -> DataFrame:
    """Adds ``extension``, ``type`` (null if unknown) and ``role``.

    ``header``, a binary column with the first bytes of the file, overrides the extension of ply and spz files and decides
    where the extension tells nothing. The role comes from the file name, else from the folder that holds the file, else
    from the type, else it is ``unknown``.
    """
    p = F.col(path)
    ext = extension(p)
    kind = F.get(F.map_values(F.map_filter(F.create_map(*[F.lit(x) for kv in ASSET_TYPES.items() for x in kv]), lambda k, _: k == ext)), F.lit(0))
    if header:
        head = F.lpad(F.substring(F.hex(header), 1, 8), 8, "0")
        proved = reduce(lambda e, h: F.when(head == h[0].encode().hex().upper(), h[1]).otherwise(e), HEADERS, F.lit(None).cast("string"))
        kind = F.when(kind.isNull() | kind.isin("ply", "spz"), F.coalesce(proved, kind)).otherwise(kind)
    name = F.lower(F.regexp_extract(p, r"([^/]+)/?$", 1))
    parent = F.lower(F.regexp_extract(p, r"([^/]+)/[^/]+/?$", 1))
    said = [F.when(text.rlike(pattern), role) for text in (name, parent) for role, pattern in ROLE_NAMES]
    by_type = F.when(kind == "checkpoint", "training_checkpoint").when(kind.isin("ply", "rad", "sog", "spz"), "trained_output")
    return files.select("*", ext.alias("extension"), kind.alias("type"), F.coalesce(*said, by_type, F.lit("unknown")).alias("role"))


def dataset_inventory(files: DataFrame, key: str = "dataset", path: str = "path") -> DataFrame:
    """Validation of each dataset from its files (paths relative to the dataset): ``image_count, has_sparse, has_masks,
    non_jpeg_ratio, is_valid, issues``.

    A folder is a dataset if it has an image directly below ``images``, a model file in ``sparse`` or ``sparse/0``, a
    database, or both text tables of a model. Images are counted below ``images`` if there is such a folder, else anywhere,
    but not in folders of masks, models and the like.
    """
    p = F.col(path)
    image, inside = extension(p).isin(*IMAGE_EXTENSIONS), p.startswith("images/")
    below = F.when(inside, F.substr(p, F.lit(8))).otherwise(p)
    counts = {
        "_root": inside, "_direct": image & p.rlike(r"^images/[^/]+$"), "_below": image & inside & ~below.rlike(NOT_IMAGES), "_any": image & ~p.rlike(NOT_IMAGES),
        "_jpeg_below": extension(p).isin("jpg", "jpeg") & inside & ~below.rlike(NOT_IMAGES), "_jpeg_any": extension(p).isin("jpg", "jpeg") & ~p.rlike(NOT_IMAGES),
        "_model": p.rlike(r"^sparse/(0/)?(cameras|images|points3D)\.(bin|txt)$"), "_sparse": p.startswith("sparse/"), "_masks": p.startswith("masks/"),
        "_db": p == "database.db", "_cameras": p == "cameras.txt", "_images": p == "images.txt",
    }
    g = files.groupBy(key).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    text = (F.col("_cameras") > 0) & (F.col("_images") > 0)
    looks = (F.col("_direct") > 0) | (F.col("_model") > 0) | (F.col("_db") > 0) | text
    rooted = F.col("_root") > 0
    n = F.when(~looks, 0).when(rooted, F.col("_below")).otherwise(F.col("_any"))
    jpeg = F.when(rooted, F.col("_jpeg_below")).otherwise(F.col("_jpeg_any"))
    model = (F.col("_sparse") > 0) | (F.col("_db") > 0) | text
    issues = F.array_compact(
        F.array(
            F.when(~looks | ((n == 0) & ~model), "No images or sparse model found"),
            F.when(looks & (n == 0) & model, "No images found, but COLMAP data exists"),
            F.when((n > 0) & (n < 3), F.concat(F.lit("Very few images ("), n.cast("string"), F.lit("), may not reconstruct well"))),
        )
    )
    return g.select(
        key, n.cast("long").alias("image_count"), (looks & (F.col("_sparse") > 0)).alias("has_sparse"), (looks & (F.col("_masks") > 0)).alias("has_masks"),
        F.when(n > 0, (n - jpeg) / F.when(n > 0, n)).otherwise(0.0).alias("non_jpeg_ratio"), (looks & ((n > 0) | model)).alias("is_valid"), issues.alias("issues"),
    )


def layout_errors(referenced: DataFrame, files: DataFrame, key: str = "dataset") -> DataFrame:
    """Referenced images that are absent, and base names that occur more than once: dataset, name, error.

    ``referenced``: dataset, name (may have folders). ``files``: dataset, name.
    """
    base = F.regexp_extract(F.col("name"), r"([^/]+)$", 1)
    missing = referenced.select(key, "name").distinct().join(files.select(key, "name"), [key, "name"], "left_anti")
    dup = files.groupBy(key, base.alias("name")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return missing.select(key, "name", F.lit("missing_image").alias("error")).unionByName(
        dup.select(key, "name", F.lit("duplicate_name").alias("error"))
    )

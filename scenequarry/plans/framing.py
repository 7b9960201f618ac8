"""Video frame queries: duplicates, candidates, coverage and tracking."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenequarry.operators import frames as FR
from scenequarry.plans.columns import rd
from scenequarry.plans.registry import query

_DUP = "SELECT a.*, (SELECT min(b.frame_index) FROM frames b WHERE b.session_id = a.session_id AND b.frame_index < a.frame_index AND bit_count(xor(a.phash, b.phash)) <= 8) AS duplicate_of FROM frames a"


@query("near_duplicates", "frames", f"SELECT session_id, frame_index, duplicate_of FROM ({_DUP}) q")
def _(load):
    return FR.near_duplicates(load("frames")).select("session_id", "frame_index", "duplicate_of")


@query(
    "demoted_duplicates", "frames",
    f"SELECT session_id, frame_index, CASE WHEN blur_score < 20 THEN 'marginal' WHEN duplicate_of IS NOT NULL THEN 'marginal' ELSE 'keep' END AS verdict FROM ({_DUP}) q",
)
def _(load):
    f = load("frames").withColumn("verdict", F.when(F.col("blur_score") < 20, "marginal").otherwise("keep"))
    return FR.demote_duplicates(FR.near_duplicates(f)).select("session_id", "frame_index", "verdict")


@query("mark_duplicates")
def _(load):
    return FR.mark_duplicates(load("frames")).select("session_id", "frame_index", "is_duplicate")


def _people(load):
    """Frames with names, and a manifest for two thirds of them."""
    f = load("frames").withColumn("file_name", F.concat(F.lit("f_"), F.col("frame_id").cast("string"), F.lit(".jpg")))
    m = f.filter("frame_id % 3 <> 0").select(
        "session_id", "file_name", F.when(F.col("frame_id") % 7 == 0, "dropped").otherwise("inpainted").alias("action"),
        (F.col("frame_id") % 4).alias("person_count"), (F.col("coverage_score") * 20).alias("coverage_pct"),
    )
    return f, m


_PEOPLE = """p AS (SELECT *, frame_id % 3 <> 0 AND (frame_id % 7 = 0 OR frame_id % 4 > 0) AS has_people, CASE WHEN frame_id % 3 <> 0 AND (frame_id % 7 = 0 OR frame_id % 4 > 0) THEN coverage_score*20 ELSE 0 END AS people_coverage FROM frames)"""


@query("mark_people", "frames", "SELECT frame_id, has_people, round(people_coverage, 4) AS people_coverage FROM p", then=_PEOPLE)
def _(load):
    f, m = _people(load)
    return FR.mark_people(f, m).select("frame_id", "has_people", rd(F.col("people_coverage"), "people_coverage", 4))


_CAND = (
    _PEOPLE
    + """, flags AS (SELECT *, frame_index % 3 = 1 AS is_duplicate FROM p),
cand AS (SELECT * FROM (SELECT *, blur_score >= 50 AND NOT is_duplicate AND NOT (has_people AND people_coverage > 5) AS strict,
 count(*) FILTER (blur_score >= 50 AND NOT is_duplicate AND NOT (has_people AND people_coverage > 5)) OVER (PARTITION BY session_id) AS n FROM flags) q
 WHERE CASE WHEN n < 12 THEN NOT is_duplicate AND blur_score > 20 ELSE strict END)"""
)


def _candidates(load):
    f, m = _people(load)
    d = FR.mark_people(f, m).withColumn("is_duplicate", F.col("frame_index") % 3 == 1)
    return FR.candidates(d, min_frames=12)


@query("frame_candidates", "frames", "SELECT session_id, frame_id FROM cand", then=_CAND)
def _(load):
    return _candidates(load).select("session_id", "frame_id")


@query(
    "spread_choice", "frames",
    """SELECT session_id, frame_id FROM (SELECT *, row_number() OVER (PARTITION BY session_id, even ORDER BY score DESC, frame_index) AS rk, count(*) FILTER (even) OVER (PARTITION BY session_id) AS got FROM
 (SELECT *, n <= 10 OR ((k-1) % greatest(1, CAST(floor(n/10) AS BIGINT)) = 0 AND (k-1)/greatest(1, floor(n/10)) < 10) AS even FROM
 (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY frame_index) AS k, count(*) OVER (PARTITION BY session_id) AS n, 0.4e0*least(blur_score/500e0,1e0)+0.2e0*(1-least(abs(exposure_mean*255e0-128e0)/100e0,1e0)) AS score FROM frames) a) b) c
WHERE even OR rk <= 10-got""",
)
def _(load):
    f = load("frames").withColumn("score", FR.composite_score())
    return FR.spread_choice(f, 10).select("session_id", "frame_id")


def _cams(load):
    """A camera position for each frame on a bumpy sphere."""
    return load("frames").select(
        "session_id", "frame_id", "blur_score", (F.col("frame_id") * 7919 % 1009 / 100.0 - 5.0).alias("x"),
        (F.col("frame_id") * 104729 % 1013 / 100.0 - 5.0).alias("y"), (F.col("frame_id") * 31 % 1019 / 100.0 - 5.0).alias("z"),
    )


_COV = """cams AS (SELECT session_id, frame_id, blur_score, (frame_id*7919 % 1009)/100e0-5 AS x, (frame_id*104729 % 1013)/100e0-5 AS y, (frame_id*31 % 1019)/100e0-5 AS z FROM frames),
c AS (SELECT *, x-avg(x) OVER s AS dx, y-avg(y) OVER s AS dy, z-avg(z) OVER s AS dz, count(*) OVER s AS n FROM cams WINDOW s AS (PARTITION BY session_id)),
lat AS (SELECT n, i, 1-2*(i+0.5e0)/n AS lz, sqrt(1-pow(1-2*(i+0.5e0)/n,2)) AS lr, 2*pi()*i/1.618033988749895e0 AS lt FROM (SELECT n, unnest(range(n)) AS i FROM (SELECT DISTINCT n FROM c) q) w),
cosv AS (SELECT session_id, frame_id, any_value(blur_score) AS q, max((dx*lr*cos(lt)+dy*lr*sin(lt)+dz*lz)/sqrt(dx*dx+dy*dy+dz*dz)) AS v FROM c JOIN lat ON c.n = lat.n GROUP BY session_id, frame_id),
cov AS (SELECT *, (v-min(v) OVER s)/(max(v) OVER s-min(v) OVER s) AS coverage, (q-min(q) OVER s)/(max(q) OVER s-min(q) OVER s) AS quality FROM cosv WINDOW s AS (PARTITION BY session_id))"""


@query("coverage_scores", "frames", "SELECT session_id, frame_id, round(coverage, 5)+0e0 AS coverage FROM cov", then=_COV)
def _(load):
    c = FR.coverage_scores(_cams(load), F.col("n_rows"), "session_id", "frame_id")
    return c.select("session_id", "frame_id", rd(F.col("coverage"), "coverage", 5))


@query(
    "coverage_choice", "frames",
    "SELECT session_id, frame_id FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY 0.6e0*quality+0.4e0*coverage DESC, frame_id) AS k FROM cov) q WHERE k <= 15",
    then=_COV,
)
def _(load):
    return FR.choose_by_coverage(_cams(load), "blur_score", 15).select("session_id", "frame_id")


def object_masks(load):
    """Views of a scene as video frames; a pixel label marks the object."""
    m = load("mask_pixels")
    return m.select(
        F.col("scene_id").alias("video_id"), F.floor(F.col("image_id") / 4).alias("frame"), F.col("label").alias("object_id"), "px_row", "px_col"
    )


@query("object_tracks")
def _(load):
    return FR.track_objects(object_masks(load))


@query(
    "pooled_frames", "",
    "SELECT event_id, 'set' || lpad(CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) - 1 AS VARCHAR), 2, '0') || '_frame_' || lpad(CAST(event_id AS VARCHAR), 6, '0') AS name FROM events",
)
def _(load):
    from scenequarry.operators.catalog import pool_videos

    e = load("events").select(F.col("user_id").alias("session_id"), F.col("event_type").alias("video"), "event_id", F.format_string("frame_%06d", "event_id").alias("frame_name"))
    return pool_videos(e).select("event_id", F.col("pooled_name").alias("name"))

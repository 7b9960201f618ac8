"""Ordered series and keyframe queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenequarry.operators import ordering as O
from scenequarry.operators import series as S
from scenequarry.plans.columns import rd
from scenequarry.plans.registry import query


@query(
    "loss_average", "losses",
    """SELECT run_id, camera, round(sum(CASE WHEN k = 1 THEN pow(0.9e0, n-1) ELSE 0.1e0*pow(0.9e0, n-k) END*loss),6) AS ema, round(max_by(loss, step),6) AS latest, count(*) AS samples FROM
(SELECT *, row_number() OVER (PARTITION BY run_id, camera ORDER BY step) AS k, count(*) OVER (PARTITION BY run_id, camera) AS n FROM losses) q GROUP BY run_id, camera""",
)
def _(load):
    e = S.loss_average(load("losses"), ["run_id", "camera"], "step", "loss", 0.1)
    return e.select("run_id", "camera", rd(F.col("ema"), "ema"), rd(F.col("latest"), "latest"), "samples")


@query(
    "cumulative_sum", "losses",
    "SELECT step, run_id, round(sum(loss) OVER (PARTITION BY run_id ORDER BY step),5)+0e0 AS cum FROM losses",
)
def _(load):
    return O.cumulative_sum(load("losses"), ["run_id"], ["step"], "loss").select("step", "run_id", rd(F.col("cum"), "cum", 5))


@query(
    "convergence", "losses",
    """SELECT run_id, max(k) AS n, coalesce(max(k) >= 100 AND (max(loss) FILTER (k = 100) = 0 OR abs(max(loss) FILTER (k = 1)-max(loss) FILTER (k = 100))/(abs(max(loss) FILTER (k = 100))+1e-12) < 0.5), false) AS converged
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS k FROM losses) q GROUP BY run_id""",
)
def _(load):
    return S.convergence(load("losses"), ["run_id"], "step", "loss", 100, 0.5).select("run_id", "n", "converged")


@query(
    "train_split", "views",
    "SELECT scene_id, name, (row_number() OVER (PARTITION BY scene_id ORDER BY name)-1) % 8 = 0 AS is_validation FROM (SELECT scene_id, 'img_' || CAST(image_id AS VARCHAR) AS name FROM views) v",
)
def _(load):
    v = load("views").select("scene_id", F.concat(F.lit("img_"), F.col("image_id").cast("string")).alias("name"))
    return O.train_split(v, ["scene_id"], "name", 8)


@query(
    "counter_rates", "trace",
    """SELECT event_id, stage, round(vram_mb-coalesce(lag(vram_mb) OVER w, 0),5)+0e0 AS delta FROM trace WINDOW w AS (PARTITION BY stage ORDER BY event_id)""",
)
def _(load):
    d = S.counter_rates(load("trace").select("event_id", "stage", "vram_mb"), "stage", "event_id", "vram_mb")
    return d.select("event_id", "stage", rd(F.col("delta"), "delta", 5))


@query(
    "counter_rate_per_second", "",
    """SELECT event_id, CASE WHEN dt > 0 THEN round(d / dt, 6) + 0e0 END AS rate FROM (SELECT event_id, value - coalesce(lag(value) OVER w, 0) AS d,
    event_id * 0.25e0 - lag(event_id * 0.25e0) OVER w AS dt FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id)) q""",
)
def _(load):
    """Four samples a second, one counter for each kind of event."""
    e = load("events").select("event_id", "event_type", "value", (F.col("event_id") * 0.25).cast("double").alias("seconds"))
    d = S.counter_rates(e, "event_type", "event_id", "value", "seconds")
    return d.select("event_id", rd(F.col("rate"), "rate"))


_EASE = """CASE easing WHEN 'ease_in' THEN u*u*u WHEN 'ease_out' THEN 1-(1-u)*(1-u)*(1-u) WHEN 'ease_in_out' THEN CASE WHEN u < 0.5 THEN 4*u*u*u ELSE 1-(2-2*u)*(2-2*u)*(2-2*u)/2 END ELSE u END"""
_TIMES = "SELECT c_custkey, c_custkey % 20 AS clip_id, (c_custkey % 977)/10e0-3e0 AS qt FROM customer"


def _times(load):
    return load("customer").select(
        (F.col("c_custkey") % 20).alias("clip_id"), (F.col("c_custkey") % 977 / 10.0 - 3.0).alias("qt")
    ).distinct()


_SEG = """k AS (SELECT *, lag(px) OVER w AS ax, lead(t) OVER w AS t2, lead(px) OVER w AS bx, lead(px, 2) OVER w AS cx, lead(focal) OVER w AS f2, row_number() OVER w AS i, count(*) OVER (PARTITION BY clip_id) AS n,
 min(t) OVER (PARTITION BY clip_id) AS t0, max(t) OVER (PARTITION BY clip_id) AS t1, lead(py) OVER w AS by FROM keyframes WINDOW w AS (PARTITION BY clip_id ORDER BY t)),
times AS (SELECT DISTINCT clip_id, qt FROM (""" + _TIMES + """) c),
clamped AS (SELECT q.clip_id, q.qt, greatest(least(q.qt, s.t1), s.t0) AS ct, s.t0 FROM times q JOIN (SELECT DISTINCT clip_id, t0, t1 FROM k) s ON q.clip_id = s.clip_id)"""


@query(
    "track_values", "keyframes",
    f"""SELECT clip_id, qt, round(px+(coalesce(bx,px)-px)*e,5)+0e0 AS px, round(py+(coalesce("by",py)-py)*e,5)+0e0 AS py, round(focal+(coalesce(f2,focal)-focal)*e,5) AS focal FROM
(SELECT *, {_EASE} AS e FROM (SELECT c.clip_id, c.qt, k.*  EXCLUDE (clip_id), CASE WHEN t2 IS NULL THEN 0 ELSE (ct-t)/(t2-t) END AS u FROM clamped c JOIN k ON c.clip_id = k.clip_id AND ct >= t AND (ct < t2 OR t2 IS NULL)) a) b""",
    then=_SEG,
)
def _(load):
    e = S.evaluate_clip(load("keyframes"), _times(load), ["clip_id"])
    return e.select("clip_id", "qt", *[rd(F.col(c), c, 5) for c in ("px", "py", "focal")])


@query(
    "spline_values", "keyframes",
    f"""SELECT clip_id, qt, round(0.5e0*(2*px+(bx-p0)*e+(2*p0-5*px+4*bx-p3)*e*e+(3*px-p0-3*bx+p3)*e*e*e),5)+0e0 AS px, round(focal+(f2-focal)*e,5) AS focal FROM
(SELECT *, {_EASE} AS e, coalesce(ax, px) AS p0, coalesce(cx, bx) AS p3 FROM (SELECT c.clip_id, c.qt, k.* EXCLUDE (clip_id), (ct-t)/(t2-t) AS u FROM clamped c JOIN k ON c.clip_id = k.clip_id
 AND ((ct > t AND ct <= t2) OR (ct = c.t0 AND t = c.t0))) a) b""",
    then=_SEG,
)
def _(load):
    e = S.evaluate_clip(load("keyframes"), _times(load), ["clip_id"], spline=True)
    return e.select("clip_id", "qt", rd(F.col("px"), "px", 5), rd(F.col("focal"), "focal", 5))


@query(
    "spline_path", "keyframes",
    f"""SELECT clip_id, segment_start, CAST(s AS INTEGER) AS sample, round(0.5e0*(2*px+(bx-p0)*e+(2*p0-5*px+4*bx-p3)*e*e+(3*px-p0-3*bx+p3)*e*e*e),5)+0e0 AS px FROM
(SELECT *, {_EASE} AS e, coalesce(ax, px) AS p0, coalesce(cx, bx) AS p3 FROM (SELECT *, t AS segment_start, s/4e0 AS u FROM (SELECT *, unnest(range(CASE WHEN i = n-1 THEN 5 ELSE 4 END)) AS s FROM k WHERE i < n) z) a) b""",
    then=_SEG,
)
def _(load):
    p = S.spline_path(load("keyframes"), ["clip_id"], 4)
    return p.select("clip_id", "segment_start", "sample", rd(F.col("px"), "px", 5))


@query(
    "timed_path", "keyframes",
    """SELECT clip_id, round(qt,5) AS qt, round(0.5e0*(2*px+(bx-p0)*e+(2*p0-5*px+4*bx-p3)*e*e+(3*px-p0-3*bx+p3)*e*e*e),5)+0e0 AS px FROM
(SELECT *, """ + _EASE + """ AS e, coalesce(ax, px) AS p0, coalesce(cx, bx) AS p3 FROM (SELECT c.clip_id, c.qt, k.* EXCLUDE (clip_id), (qt-t)/(t2-t) AS u FROM steps c JOIN k ON c.clip_id = k.clip_id
 AND ((qt > t AND qt <= t2) OR (qt = c.t0 AND t = c.t0))) a) b""",
    then=_SEG + """, sp AS (SELECT DISTINCT clip_id, t0, t1 FROM k),
steps AS (SELECT clip_id, t0, qt FROM (SELECT clip_id, t0, t1, t0+unnest(range(CAST(ceil((t1-t0)/0.7e0) AS BIGINT)))*0.7e0 AS qt FROM sp) w WHERE qt < t1 UNION ALL SELECT clip_id, t0, t1 FROM sp)""",
)
def _(load):
    k = load("keyframes")
    e = S.evaluate_clip(k, S.path_times(k, ["clip_id"], 0.7), ["clip_id"], spline=True)
    return e.select("clip_id", rd(F.col("qt"), "qt", 5), rd(F.col("px"), "px", 5))


@query(
    "loop_end", "keyframes",
    """SELECT clip_id, t, round(px,5)+0e0 AS px, false AS synthetic FROM keyframes UNION ALL
SELECT clip_id, max(t)+1.5, round(min_by(px, t),5)+0e0, true FROM keyframes GROUP BY clip_id HAVING count(*) > 1""",
)
def _(load):
    k = S.with_loop_end(load("keyframes"), ["clip_id"], 1.5)
    return k.select("clip_id", "t", rd(F.col("px"), "px", 5), "synthetic")


@query("real_span", "keyframes", "SELECT clip_id, count(*) AS keyframes, max(t) AS end_time FROM keyframes GROUP BY clip_id")
def _(load):
    return S.real_span(S.with_loop_end(load("keyframes"), ["clip_id"], 1.5), ["clip_id"])

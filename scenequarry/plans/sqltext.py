"""Small SQL text helpers shared by the DuckDB counterparts."""

from __future__ import annotations


def r(expr: str, name: str, digits: int = 6) -> str:
    """Rounded and aliased."""
    return f"round({expr}, {digits}) + 0e0 AS {name}"


def quat_rows(q=("qw", "qx", "qy", "qz")) -> list[list[str]]:
    """The nine entries of the rotation matrix of a unit quaternion."""
    w, x, y, z = q
    return [
        [f"(1-2*({y}*{y}+{z}*{z}))", f"(2*({x}*{y}-{z}*{w}))", f"(2*({x}*{z}+{y}*{w}))"],
        [f"(2*({x}*{y}+{z}*{w}))", f"(1-2*({x}*{x}+{z}*{z}))", f"(2*({y}*{z}-{x}*{w}))"],
        [f"(2*({x}*{z}-{y}*{w}))", f"(2*({y}*{z}+{x}*{w}))", f"(1-2*({x}*{x}+{y}*{y}))"],
    ]


UNIT_VIEWS = """unit_views AS (SELECT scene_id, image_id, qw/n AS qw, qx/n AS qx, qy/n AS qy, qz/n AS qz, tx, ty, tz, fx, fy, cx, cy, width, height
  FROM (SELECT *, sqrt(qw*qw+qx*qx+qy*qy+qz*qz) AS n FROM views) v)"""

_R = quat_rows(("v.qw", "v.qx", "v.qy", "v.qz"))

SEEN = f"""{UNIT_VIEWS},
cam AS (SELECT s.scene_id, s.splat_id, v.image_id, v.fx, v.fy, v.cx, v.cy, v.width, v.height,
  {_R[0][0]}*s.x+{_R[0][1]}*s.y+{_R[0][2]}*s.z+v.tx AS a, {_R[1][0]}*s.x+{_R[1][1]}*s.y+{_R[1][2]}*s.z+v.ty AS b,
  {_R[2][0]}*s.x+{_R[2][1]}*s.y+{_R[2][2]}*s.z+v.tz AS d
  FROM splats s JOIN unit_views v ON s.scene_id = v.scene_id),
px AS (SELECT *, round_even(fx*a/d+cx, 0) AS u, round_even(fy*b/d+cy, 0) AS w FROM cam WHERE d > 1e-6),
seen AS (SELECT scene_id, splat_id, image_id, CAST(w AS INTEGER) AS px_row, CAST(u AS INTEGER) AS px_col, d AS depth
  FROM px WHERE u >= 0 AND u < width AND w >= 0 AND w < height)"""

VOTES = """votes AS (SELECT s.scene_id, s.splat_id, m.label, s.image_id FROM seen s JOIN mask_pixels m
  ON s.scene_id = m.scene_id AND s.image_id = m.image_id AND s.px_row = m.px_row AND s.px_col = m.px_col),
per_label AS (SELECT scene_id, splat_id, label, count(*) AS n, min(image_id) AS f FROM votes GROUP BY ALL),
best AS (SELECT scene_id, splat_id, label FROM (SELECT *, sum(n) OVER (PARTITION BY scene_id, splat_id) AS t,
  row_number() OVER (PARTITION BY scene_id, splat_id ORDER BY n DESC, f) AS k FROM per_label) q WHERE k = 1 AND t >= 2),
labelled AS (SELECT s.*, coalesce(b.label, 0) AS label FROM splats s LEFT JOIN best b
  ON s.scene_id = b.scene_id AND s.splat_id = b.splat_id)"""

ALPHA = "(1e0/(1e0+exp(-opacity_raw)))"


def percentile_sql(rows: str, key: str, value: str, p: float, name: str) -> str:
    """Linear percentile per key as a sub-select."""
    return f"SELECT {key}, quantile_cont({value}, {p}) AS {name} FROM {rows} GROUP BY {key}"


def lloyd_sql(rows: str, key: str, columns: tuple[str, ...], bins: int = 256, iterations: int = 10) -> str:
    """CTEs of one-dimensional Lloyd rounds: ``book`` (key, code, value) and ``coded`` (key, v, code)."""

    def nearest(book: str) -> str:
        return f"""SELECT v.{key}, v.v, v.n, CASE WHEN b.code IS NULL THEN 0 WHEN b.nxt - v.v < v.v - b.value THEN b.code + 1 ELSE b.code END AS code
  FROM vals v ASOF LEFT JOIN (SELECT * FROM (SELECT *, lead(value) OVER (PARTITION BY {key} ORDER BY code) AS nxt FROM {book}) q
    WHERE nxt IS NULL OR nxt > value) b ON v.{key} = b.{key} AND v.v >= b.value"""

    parts = [
        f"vals AS MATERIALIZED (SELECT {key}, v, count(*) AS n FROM (SELECT {key}, unnest([{', '.join(columns)}]) AS v FROM {rows}) q GROUP BY ALL)",
        f"""book0 AS MATERIALIZED (SELECT {key}, i AS code, a + (b - a) / {bins - 1}e0 * i AS value
  FROM (SELECT {key}, min(v) AS a, max(v) AS b FROM vals GROUP BY ALL) e, range({bins}) t(i))""",
    ]
    for k in range(iterations):
        parts.append(f"means{k} AS MATERIALIZED (SELECT {key}, code, sum(v * n) / sum(n) AS m FROM ({nearest(f'book{k}')}) q GROUP BY ALL)")
        parts.append(f"""book{k + 1} AS MATERIALIZED (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY value) - 1 AS code, value
  FROM (SELECT b.{key}, coalesce(m.m, b.value) AS value FROM book{k} b LEFT JOIN means{k} m ON b.{key} = m.{key} AND b.code = m.code) q)""")
    parts += [f"book AS (SELECT * FROM book{iterations})", f"coded AS MATERIALIZED ({nearest(f'book{iterations}')})"]
    return ",\n".join(parts)

"""Projections: splat, camera, frame and elementwise formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenequarry.functions import cameras as C
from scenequarry.functions import codes, elementwise, splats
from scenequarry.functions import vectors as V
from scenequarry.operators import frames as frame_ops
from scenequarry.operators import ordering
from scenequarry.operators import transforms
from scenequarry.plans.registry import query
from scenequarry.plans.sqltext import ALPHA, SEEN, UNIT_VIEWS, quat_rows, r


def quaternion():
    """Columns of a rotation; made when asked for, so that this module loads without a session."""
    return tuple(F.col(c) for c in ("qw", "qx", "qy", "qz"))



def rd(c, name, digits=6):
    """Rounded to the digits that both engines agree on; adding zero removes the sign of -0."""
    return (F.round(c, digits) + F.lit(0.0)).alias(name)


@query(
    "splat_activation", "splats",
    f"""SELECT splat_id, {r(ALPHA, 'opacity')}, {r('exp(s0)', 'scale_x')}, {r('exp(s1)', 'scale_y')}, {r('exp(s2)', 'scale_z')},
{r('CASE WHEN n < 1e-12 THEN 1e0 ELSE qw/n END', 'rw')}, {r('CASE WHEN n < 1e-12 THEN 0e0 ELSE qx/n END', 'rx')},
{r('CASE WHEN n < 1e-12 THEN 0e0 ELSE qy/n END', 'ry')}, {r('CASE WHEN n < 1e-12 THEN 0e0 ELSE qz/n END', 'rz')}
FROM (SELECT *, sqrt(qw*qw+qx*qx+qy*qy+qz*qz) AS n FROM splats) s""",
)
def _(load):
    sc, rot = splats.scales(), splats.rotation()
    return load("splats").select(
        "splat_id", rd(splats.opacity(), "opacity"), *[rd(s, f"scale_{a}") for s, a in zip(sc, "xyz")],
        *[rd(q, f"r{a}") for q, a in zip(rot, "wxyz")],
    )


_RGB = [f"least(greatest(0.5e0 + 0.28209479177387814e0*c{i}, 0e0), 1e0)" for i in range(3)]


@query(
    "sh_to_rgb", "splats",
    "SELECT splat_id, " + ", ".join(r(c, n) for c, n in zip(_RGB, "rgb")) + ", "
    + ", ".join(r(f"({c}-0.5e0)/0.28209479177387814e0", f"b{i}") for i, c in enumerate(_RGB)) + " FROM splats",
)
def _(load):
    rgb = [splats.sh_to_rgb(F.col(f"c{i}")) for i in range(3)]
    return load("splats").select(
        "splat_id", *[rd(c, n) for c, n in zip(rgb, "rgb")],
        *[rd(splats.rgb_to_sh(c), f"b{i}") for i, c in enumerate(rgb)],
    )


def _basis_sql(x, y, z):
    xx, yy, zz = f"({x}*{x})", f"({y}*{y})", f"({z}*{z})"
    c2, c3 = splats.SH_C2, splats.SH_C3
    polys2 = [f"{x}*{y}", f"{y}*{z}", f"(2*{zz}-{xx}-{yy})", f"{x}*{z}", f"({xx}-{yy})"]
    four = f"(4*{zz}-{xx}-{yy})"
    polys3 = [f"{y}*(3*{xx}-{yy})", f"{x}*{y}*{z}", f"{y}*{four}", f"{z}*(2*{zz}-3*({xx}+{yy}))", f"{x}*{four}",
              f"{z}*({xx}-{yy})", f"{x}*({xx}-3*{yy})"]
    c1 = splats.SH_C1
    return [f"-{c1}e0*{y}", f"{c1}e0*{z}", f"-{c1}e0*{x}"] + [f"({c}e0)*{p}" for c, p in zip(c2, polys2)] + [
        f"({c}e0)*{p}" for c, p in zip(c3, polys3)]


_B = _basis_sql("ux", "uy", "uz")


def _rest_sql(i, ch):
    return f"(((splat_id*{3 * i + ch + 2}) % 41)/100e0-0.2e0)"


@query(
    "sh_colour", "splats",
    "SELECT splat_id, "
    + ", ".join(
        r(f"least(greatest(0.5e0+{splats.SH_C0}e0*c{ch}+" + "+".join(f"({b})*{_rest_sql(i, ch)}" for i, b in enumerate(_B)) + ",0e0),1e0)",
          n) for ch, n in enumerate("rgb"))
    + " FROM (SELECT *, (x-0.1e0)/d AS ux, (y-0.2e0)/d AS uy, (z+12e0)/d AS uz FROM (SELECT *, sqrt((x-0.1e0)*(x-0.1e0)+(y-0.2e0)*(y-0.2e0)+(z+12e0)*(z+12e0)) AS d FROM splats) a) s",
)
def _(load):
    d = [F.col("x") - 0.1, F.col("y") - 0.2, F.col("z") + 12.0]
    n = V.norm(d)
    unit = tuple(c / n for c in d)
    rest = F.transform(
        F.sequence(F.lit(2), F.lit(46)), lambda k: F.pmod(F.col("splat_id") * k, F.lit(41)) / F.lit(100.0) - F.lit(0.2)
    )
    s = load("splats").withColumn("shn", rest)
    return s.select("splat_id", *[rd(splats.sh_colour(F.col(f"c{i}"), F.col("shn"), i, unit, 3), n) for i, n in enumerate("rgb")])


_HAM = {
    "pw": "qw*0.8e0-qx*0.6e0", "px": "qw*0.6e0+qx*0.8e0", "py": "qy*0.8e0+qz*0.6e0", "pz": "qz*0.8e0-qy*0.6e0",
}
_U = quat_rows(("uw", "ux", "uy", "uz"))


@query(
    "quaternion_algebra", "splats",
    f"""SELECT splat_id, {', '.join(r(v, k) for k, v in _HAM.items())},
{r(f"CASE WHEN n < 1e-12 THEN 1e0 ELSE {_U[0][0]} END", 'm00')}, {r(f"CASE WHEN n < 1e-12 THEN 0e0 ELSE {_U[1][2]} END", 'm12')},
{r("CASE WHEN n < 1e-12 THEN 1e0 ELSE abs(uw) END", 'bw', 5)}, {r("CASE WHEN n < 1e-12 THEN 0e0 ELSE abs(ux) END", 'bx', 5)}
FROM (SELECT *, qw/nullif(n,0e0) AS uw, qx/nullif(n,0e0) AS ux, qy/nullif(n,0e0) AS uy, qz/nullif(n,0e0) AS uz
 FROM (SELECT *, sqrt(qw*qw+qx*qx+qy*qy+qz*qz) AS n FROM splats) a) s""",
)
def _(load):
    """Product with (0.8, 0.6, 0, 0), rotation matrix entries, and the quaternion recovered from the matrix."""
    p = V.quat_multiply(quaternion(), (F.lit(0.8), F.lit(0.6), F.lit(0.0), F.lit(0.0)))
    m = [[F.col(f"_m{i}{j}") for j in range(3)] for i in range(3)]
    made = V.quat_matrix(quaternion())
    back = V.matrix_quat(m)
    return load("splats").withColumns({f"_m{i}{j}": made[i][j] for i in range(3) for j in range(3)}).select(
        "splat_id", *[rd(c, f"p{a}") for c, a in zip(p, "wxyz")], rd(m[0][0], "m00"), rd(m[1][2], "m12"),
        rd(F.abs(back[0]), "bw", 5), rd(F.abs(back[1]), "bx", 5),
    )


_VR = quat_rows()
_CEN = [f"-({_VR[0][i]}*tx+{_VR[1][i]}*ty+{_VR[2][i]}*tz)" for i in range(3)]


@query("camera_centres", "views", f"SELECT image_id, {', '.join(r(c, n) for c, n in zip(_CEN, ('px', 'py', 'pz')))} FROM unit_views", then=UNIT_VIEWS)
def _(load):
    c = C.camera_centre(quaternion(), tuple(F.col(t) for t in ("tx", "ty", "tz")))
    return load("views").select("image_id", *[rd(v, n) for v, n in zip(c, ("px", "py", "pz"))])


@query(
    "yup_poses", "views",
    f"""SELECT image_id, {r(_CEN[0] + '*0.5e0', 'px')}, {r('(' + _CEN[1] + ')*(-0.5e0)', 'py')}, {r('(' + _CEN[2] + ')*(-0.5e0)', 'pz')},
{r('-qx', 'rw')}, {r('qw', 'rx')}, {r('-qz', 'ry')}, {r('qy', 'rz')}, true AS round_trip FROM unit_views""",
    then=UNIT_VIEWS,
)
def _(load):
    """Y-up position and rotation, and whether converting back restores the pose."""
    q = V.quat_normalise(quaternion())
    v = load("views").select("image_id", *[c.alias(f"u{a}") for c, a in zip(q, "wxyz")], "tx", "ty", "tz")
    u, t = V.cols("uw", "ux", "uy", "uz"), V.cols("tx", "ty", "tz")
    pos = C.yup_position(C.camera_centre(u, t))
    v = v.withColumns({f"p{a}": c for a, c in zip("xyz", pos)} | {f"r{a}": c for a, c in zip("wxyz", C.yup_rotation(u))})
    q0, t0 = C.from_yup(V.cols("px", "py", "pz"), V.cols("rw", "rx", "ry", "rz"))
    v = v.withColumns({f"b{i}": c for i, c in enumerate((*q0, *t0))})
    ok = F.lit(True)
    for i, c in enumerate((*u, *t)):
        ok = ok & (F.abs(F.col(f"b{i}") - c) < 1e-6)
    return v.select("image_id", *[rd(F.col(n), n) for n in ("px", "py", "pz", "rw", "rx", "ry", "rz")], ok.alias("round_trip"))


@query(
    "yup_matrices", "views",
    f"""SELECT image_id, {r(_VR[0][0], 'm0')}, {r('-' + _VR[1][0], 'm4')}, {r('-' + _VR[2][2], 'm10')}, {r(_CEN[0] + '*0.5e0', 'm12')}
FROM unit_views""", then=UNIT_VIEWS,
)
def _(load):
    m = C.yup_transform(quaternion(), tuple(F.col(c) for c in ("tx", "ty", "tz")))
    return load("views").select(
        "image_id", *[rd(F.get(m, F.lit(i)), f"m{i}") for i in (0, 4, 10, 12)]
    )


# a quarter turn about z, scale 2, shift (1, -2, 0.5)
QUARTER = [0.0, -2.0, 0.0, 1.0, 2.0, 0.0, 0.0, -2.0, 0.0, 0.0, 2.0, 0.5, 0.0, 0.0, 0.0, 1.0]
_H = 0.7071067811865476


@query(
    "affine_transform", "splats",
    f"""SELECT splat_id, {r('1e0-2*y', 'x')}, {r('2*x-2e0', 'y')}, {r('2*z+0.5e0', 'z')},
{r(f'{_H}e0*(qw-qz)', 'qw')}, {r(f'{_H}e0*(qx-qy)', 'qx')}, {r(f'{_H}e0*(qy+qx)', 'qy')}, {r(f'{_H}e0*(qz+qw)', 'qz')},
{r('s0+ln(2e0)', 's0')}, {r('0.1e0*((splat_id % 5)-2)', 'h0')}, {r('0.3e0*((splat_id % 7)-3)', 'h1')}, {r('-0.2e0*((splat_id % 3)-1)', 'h2')} FROM splats""",
)
def _(load):
    """Affine map of means, rotations, scales and the first SH band, which a quarter turn about z permutes."""
    s = load("splats")
    first = [
        F.lit(0.2) * (F.col("splat_id") % 3 - 1),
        F.lit(0.3) * (F.col("splat_id") % 7 - 3),
        F.lit(0.1) * (F.col("splat_id") % 5 - 2),
    ]
    s = s.withColumn("shn", F.array(*[c for c in first for _ in range(3)]))
    out = transforms.transform_splats(s, QUARTER, degree=1)
    at = lambda i: F.get("shn", F.lit(3 * i))
    return out.select(
        "splat_id", *[rd(F.col(c), c) for c in ("x", "y", "z", "qw", "qx", "qy", "qz", "s0")],
        rd(at(0), "h0"), rd(at(1), "h1"), rd(at(2), "h2"),
    )


_SQ = [f"exp(2*s{i})" for i in range(3)]
_TOT = "(" + "+".join(_SQ) + ")"


@query(
    "shape_metrics", "splats",
    f"""SELECT splat_id, {r('greatest(exp(s0),exp(s1),exp(s2))', 'scale_max')}, {r('4e0/3e0*pi()*exp(s0)*exp(s1)*exp(s2)', 'volume')},
{r('greatest(exp(s0),exp(s1),exp(s2))/least(exp(s0),exp(s1),exp(s2))', 'anisotropy')},
{r('exp(-(' + '+'.join(f'{q}/{_TOT}*ln({q}/{_TOT})' for q in _SQ) + '))', 'erank')}, {r('sqrt(x*x+y*y+z*z)', 'origin_distance')} FROM splats""",
)
def _(load):
    return load("splats").select(
        "splat_id", rd(splats.scale_max(), "scale_max"), rd(splats.volume(), "volume"), rd(splats.anisotropy(), "anisotropy"),
        rd(splats.effective_rank(), "erank"), rd(splats.distance_to(0.0, 0.0, 0.0), "origin_distance"),
    )


def _spread_sql(e):
    return "(" + "+".join(f"((({e}) >> {i}) & 1) * {8 ** i}" for i in range(10)) + ")"


_CELL = {a: f"CAST(least(1023, floor(({a}-{a}0)/({a}1-{a}0)*1024e0)) AS BIGINT)" for a in "xyz"}
MORTON_SQL = f"""b AS (SELECT scene_id, {', '.join(f'min({a}) AS {a}0, max({a}) AS {a}1' for a in 'xyz')} FROM splats GROUP BY scene_id),
cell AS (SELECT s.*, {', '.join(f'{_CELL[a]} AS i{a}' for a in 'xyz')} FROM splats s JOIN b ON s.scene_id = b.scene_id),
coded AS (SELECT *, {_spread_sql('iz')}*4 + {_spread_sql('iy')}*2 + {_spread_sql('ix')} AS morton FROM cell)"""


@query("morton_codes", "splats", "SELECT scene_id, splat_id, morton FROM coded", then=MORTON_SQL)
def _(load):
    return ordering.with_morton(load("splats").select("scene_id", "splat_id", "x", "y", "z")).select(
        "scene_id", "splat_id", "morton"
    )


def _fold(a):
    return f"(sign({a})*ln(1e0+abs({a})))"


_CODE = {a: f"CAST(floor(65535e0*({_fold(a)}-{a}0)/({a}1-{a}0)) AS BIGINT)" for a in "xyz"}


@query(
    "position_quantise", "splats",
    "SELECT scene_id, splat_id, " + ", ".join(f"CAST(k{a} & 255 AS INTEGER) AS lo_{a}, CAST(k{a} >> 8 AS INTEGER) AS hi_{a}" for a in "xyz")
    + ", true AS close FROM coded",
    then=f"""b AS (SELECT scene_id, {', '.join(f'min({_fold(a)}) AS {a}0, max({_fold(a)}) AS {a}1' for a in 'xyz')} FROM splats GROUP BY scene_id),
coded AS (SELECT s.scene_id, splat_id, {', '.join(f'{_CODE[a]} AS k{a}' for a in 'xyz')} FROM splats s JOIN b ON s.scene_id = b.scene_id)""",
)
def _(load):
    """Two bytes per axis, and whether decoding returns the position within the lattice step."""
    s = load("splats").select("scene_id", "splat_id", "x", "y", "z")
    return transforms.quantise_positions(s).select(
        "scene_id", "splat_id", *[f"{p}_{a}" for a in "xyz" for p in ("lo", "hi")], "close"
    )


_UNITQ = [f"(q{a}/n)" for a in "wxyz"]
_BIG = "greatest(" + ", ".join(f"abs({u})" for u in _UNITQ) + ")"
_AT = "CASE " + " ".join(f"WHEN abs({u}) = big THEN {i}" for i, u in enumerate(_UNITQ)) + " END"


@query(
    "rotation_pack", "splats",
    """SELECT splat_id, CAST(b[1] AS INTEGER) AS b0, CAST(b[2] AS INTEGER) AS b1, CAST(b[3] AS INTEGER) AS b2, CAST(252+ax AS INTEGER) AS b3, true AS close
FROM (SELECT splat_id, ax, list_transform(list_filter([0,1,2,3], lambda i: i <> ax),
  lambda i: floor(255e0*(u[i+1]*sg*sqrt(2e0)*0.5e0+0.5e0))) AS b FROM withsign) t""",
    then=f"""norms AS (SELECT *, sqrt(qw*qw+qx*qx+qy*qy+qz*qz) AS n FROM splats WHERE qw*qw+qx*qx+qy*qy+qz*qz > 0),
bigs AS (SELECT *, {_BIG} AS big FROM norms),
ats AS (SELECT splat_id, n, [{', '.join(_UNITQ)}] AS u, {_AT} AS ax FROM bigs),
withsign AS (SELECT *, CASE WHEN u[ax+1] < 0 THEN -1e0 ELSE 1e0 END AS sg FROM ats)""",
)
def _(load):
    """Smallest-three bytes of every non-zero rotation; unpacking gives the same rotation within the byte step."""
    s = load("splats").withColumn("code", codes.pack_quaternion(quaternion())).filter("code is not null")
    unit = V.quat_normalise(quaternion())
    back = codes.unpack_quaternion(F.col("code"))
    agree = sum((unit[i] * F.get(back, F.lit(i)) for i in range(1, 4)), unit[0] * F.get(back, F.lit(0)))
    return s.select("splat_id", *[F.get("code", F.lit(i)).alias(f"b{i}") for i in range(4)], (F.abs(agree) > 0.999).alias("close"))


@query("opacity_bytes", "splats", f"SELECT splat_id, CAST(floor(least(greatest({ALPHA}*255e0,0e0),255e0)) AS INTEGER) AS code FROM splats")
def _(load):
    return load("splats").select("splat_id", codes.opacity_byte(F.col("opacity_raw")).alias("code"))


_T = "((p_partkey % 131)/100e0-0.15e0)"
_TC = f"least(greatest({_T},0e0),1e0)"


@query(
    "easing", "", f"""SELECT p_partkey, {r(f'''CASE p_partkey % 4 WHEN 0 THEN {_TC} WHEN 1 THEN pow({_TC},3) WHEN 2 THEN 1-pow(1-{_TC},3)
 ELSE CASE WHEN {_TC} < 0.5 THEN 4*pow({_TC},3) ELSE 1-pow(2-2*{_TC},3)/2 END END''', 'eased')} FROM part""",
)
def _(load):
    kinds = F.array(*[F.lit(k) for k in ("linear", "ease_in", "ease_out", "ease_in_out")])
    k = F.get(kinds, (F.col("p_partkey") % 4).cast("int"))
    t = (F.col("p_partkey") % 131) / F.lit(100.0) - F.lit(0.15)
    return load("part").select("p_partkey", rd(elementwise.ease(t, k), "eased"))


@query(
    "pinhole_projection", "splats views", f"SELECT scene_id, splat_id, image_id, px_row, px_col, {r('depth', 'depth')} FROM seen", then=SEEN
)
def _(load):
    from scenequarry.operators.projection import project_views

    p = project_views(load("splats"), load("views"))
    return p.select("scene_id", "splat_id", "image_id", "px_row", "px_col", rd(F.col("depth"), "depth"))


_MODELS = ("SIMPLE_PINHOLE", "PINHOLE", "SIMPLE_RADIAL", "OPENCV", "FOV")


@query(
    "camera_intrinsics", "",
    """SELECT s_suppkey, model, p[1] AS fx, CASE WHEN two THEN p[2] ELSE p[1] END AS fy, CASE WHEN two THEN p[3] ELSE p[2] END AS cx,
 CASE WHEN two THEN p[4] ELSE p[3] END AS cy, valid FROM (SELECT s_suppkey, model, model IN ('PINHOLE','OPENCV') AS two,
 [s_suppkey+100e0, s_suppkey+101e0, s_suppkey+102e0, s_suppkey+103e0] AS p, model IN ('PINHOLE','SIMPLE_RADIAL') AS valid FROM
 (SELECT s_suppkey, ['SIMPLE_PINHOLE','PINHOLE','SIMPLE_RADIAL','OPENCV','FOV'][CAST(s_suppkey % 5 AS INTEGER)+1] AS model FROM supplier) a) b""",
)
def _(load):
    model = F.get(F.array(*[F.lit(m) for m in _MODELS]), (F.col("s_suppkey") % 5).cast("int"))
    params = F.array(*[F.col("s_suppkey") + F.lit(100.0 + i) for i in range(4)])
    c = load("supplier").select("s_suppkey", model.alias("model"), params.alias("params"))
    k = C.intrinsics(F.col("model"), F.col("params"))
    return c.select(
        "s_suppkey", "model", *[v.alias(n) for n, v in k.items()], C.param_count_ok(F.col("model"), F.col("params")).alias("valid")
    )


_BAD = "(CAST(blur_score < 100e0 AS INTEGER) + CAST(exposure_mean < 0.1e0 AS INTEGER) + CAST(exposure_mean > 0.9e0 AS INTEGER) + CAST(coverage_score < 0.3e0 AS INTEGER))"


@query(
    "frame_verdict", "frames",
    f"SELECT frame_id, {_BAD} AS issues, CASE WHEN {_BAD} >= 2 THEN 'drop' WHEN {_BAD} = 1 THEN 'marginal' ELSE 'keep' END AS verdict FROM frames",
)
def _(load):
    return frame_ops.with_verdict(load("frames")).select("frame_id", "issues", "verdict")


@query(
    "frame_score", "frames",
    f"""SELECT frame_id, {r('0.4e0*least(blur_score/500e0,1e0)+0.2e0*(1-least(abs(exposure_mean*255e0-128e0)/100e0,1e0))', 'score')},
{r('0.4e0*least(blur_score/500e0,1e0)+0.2e0*(1-least(abs(exposure_mean-128e0)/100e0,1e0))', 'legacy_score')} FROM frames""",
)
def _(load):
    return load("frames").select(
        "frame_id", rd(frame_ops.composite_score(), "score"), rd(frame_ops.composite_score(legacy=True), "legacy_score")
    )


@query(
    "hash_distance", "frames",
    """SELECT a.frame_id, CAST(bit_count(xor(a.phash, b.phash)) AS INTEGER) AS distance FROM frames a JOIN frames b
 ON a.session_id = b.session_id AND b.frame_index = a.frame_index + 1""",
)
def _(load):
    f = load("frames").select("session_id", "frame_index", "frame_id", "phash")
    nxt = f.select("session_id", (F.col("frame_index") - 1).alias("frame_index"), F.col("phash").alias("other"))
    return f.join(nxt, ["session_id", "frame_index"]).select(
        "frame_id", frame_ops.hamming(F.col("phash"), F.col("other")).alias("distance")
    )


_G = "1.618033988749895e0"


@query(
    "sphere_layout", "",
    f"""SELECT p_partkey AS point_id, {r(f'sin(phi)*cos(th)', 'x')}, {r(f'sin(phi)*sin(th)', 'y')}, {r('cos(phi)', 'z')}
FROM (SELECT p_partkey, acos(1-2*(p_partkey+0.5e0)/n) AS phi, 2*pi()*p_partkey/{_G} AS th FROM part, (SELECT count(*)*1e0 AS n FROM part) c) s""",
)
def _(load):
    p = load("part")
    total = p.agg(F.count(F.lit(1)).cast("double").alias("n"))
    j = p.select("p_partkey").crossJoin(F.broadcast(total))
    x, y, z = C.sphere_point(F.col("p_partkey").cast("double"), F.col("n"))
    return j.select(F.col("p_partkey").alias("point_id"), rd(x, "x"), rd(y, "y"), rd(z, "z"))


@query(
    "orbit_cameras", "splats",
    f"""SELECT scene_id, i AS view_index, {r('mx+3e0*sin(i*pi()/2)', 'ex')}, {r('my', 'ey')}, {r('mz+3e0*cos(i*pi()/2)', 'ez')},
{r('mx*sin(i*pi()/2)+3e0+mz*cos(i*pi()/2)', 'm11', 5)} FROM (SELECT scene_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM splats GROUP BY scene_id) s,
(SELECT unnest([0,1,2,3]) AS i) k""",
)
def _(load):
    c = load("splats").groupBy("scene_id").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.avg("z").alias("cz"))
    o = C.orbit_cameras(c, "canonical_4", 3.0)
    return o.select(
        "scene_id", "view_index", *[rd(F.col(e), e) for e in ("ex", "ey", "ez")],
        rd(-F.get("view_matrix", F.lit(11)), "m11", 5),
    )


@query(
    "orbit_matrices", "splats",
    """SELECT scene_id, view_index, k, round(CASE k WHEN 0 THEN rx WHEN 1 THEN ry WHEN 2 THEN rz WHEN 3 THEN -(rx*ex+ry*ey+rz*ez) WHEN 4 THEN ux WHEN 5 THEN uy WHEN 6 THEN uz WHEN 7 THEN -(ux*ex+uy*ey+uz*ez)
WHEN 8 THEN dx WHEN 9 THEN dy WHEN 10 THEN dz WHEN 11 THEN -(dx*ex+dy*ey+dz*ez) WHEN 15 THEN 1e0 ELSE 0e0 END, 6) + 0e0 AS v, label FROM (SELECT *, ry*dz2 - rz*dy2 AS ux, rz*dx2 - rx*dz2 AS uy, rx*dy2 - ry*dx2 AS uz FROM
(SELECT *, (fy*upz - fz*upy)/l AS rx, (fz*upx - fx*upz)/l AS ry, (fx*upy - fy*upx)/l AS rz, fx AS dx2, fy AS dy2, fz AS dz2, -fx AS dx, -fy AS dy, -fz AS dz FROM
(SELECT *, sqrt((fy*upz - fz*upy)*(fy*upz - fz*upy) + (fz*upx - fx*upz)*(fz*upx - fx*upz) + (fx*upy - fy*upx)*(fx*upy - fy*upx)) AS l FROM
(SELECT scene_id, view_index, label, -cos(radians(el))*sin(radians(az)) AS fx, -sin(radians(el)) AS fy, -cos(radians(el))*cos(radians(az)) AS fz, mx+2e0*cos(radians(el))*sin(radians(az)) AS ex, my+2e0*sin(radians(el)) AS ey, mz+2e0*cos(radians(el))*cos(radians(az)) AS ez,
0e0 AS upx, CASE WHEN abs(el) > 75 THEN 0e0 ELSE 1e0 END AS upy, CASE WHEN abs(el) <= 75 THEN 0e0 WHEN el > 0 THEN -1e0 ELSE 1e0 END AS upz
FROM (SELECT scene_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM splats GROUP BY scene_id) s,
(VALUES (0,0e0,0e0,'front'),(1,90e0,0e0,'left'),(2,180e0,0e0,'back'),(3,270e0,0e0,'right'),(4,45e0,30e0,'front_left_up'),(5,135e0,30e0,'back_left_up'),(6,225e0,30e0,'back_right_up'),(7,315e0,30e0,'front_right_up'),
(8,0e0,80e0,'top_front'),(9,180e0,80e0,'top_back'),(10,0e0,-30e0,'bottom_front'),(11,180e0,-30e0,'bottom_back')) w(view_index, az, el, label)) a) b) c) d, (SELECT unnest(range(16)) AS k) e""",
)
def _(load):
    c = load("splats").groupBy("scene_id").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.avg("z").alias("cz"))
    o = C.orbit_cameras(c, "hunyuan_mv", 2.0, 12)
    return o.select("scene_id", "view_index", "label", F.posexplode("view_matrix").alias("k", "v")).withColumn("v", rd(F.col("v"), "v"))


@query(
    "clean_names", "",
    """SELECT p_partkey, CASE WHEN regexp_matches(s, '^[A-Za-z_]') THEN s ELSE '_' || s END AS clean FROM
(SELECT p_partkey, regexp_replace(CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS VARCHAR) || p_brand ELSE p_name END, '[^A-Za-z0-9_]', '_', 'g') AS s FROM part) q""",
)
def _(load):
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_partkey").cast("string"), "p_brand")).otherwise(F.col("p_name"))
    return load("part").select("p_partkey", transforms.clean_name(raw).alias("clean"))


_UNARY_SQL = {
    "abs": "abs(v)", "neg": "-v", "exp": "exp(v)", "exp2": "pow(2e0,v)", "log1p": "CASE WHEN v > -1 THEN ln(1+v) END",
    "sqrt": "sqrt(abs(v))", "square": "v*v", "sin": "sin(v)", "cos": "cos(v)", "tan": "tan(v)", "atan": "atan(v)",
    "sinh": "(exp(v)-exp(-v))/2", "cosh": "(exp(v)+exp(-v))/2", "tanh": "(exp(v)-exp(-v))/(exp(v)+exp(-v))",
    "sigmoid": "1/(1+exp(-v))", "relu": "greatest(v,0e0)", "swish": "v/(1+exp(-v))", "floor": "floor(v)", "ceil": "ceil(v)",
    "round": "round_even(v,0)", "trunc": "trunc(v)", "sign": "sign(v)*1e0",
    "gelu": "0.5*v*(1+(exp(g)-exp(-g))/(exp(g)+exp(-g)))",
}


@query(
    "elementwise_math", "",
    "SELECT o_orderkey, " + ", ".join(r(s, n) for n, s in _UNARY_SQL.items())
    + " FROM (SELECT *, sqrt(2/pi())*(v+0.044715e0*v*v*v) AS g FROM (SELECT o_orderkey, ((o_orderkey*37) % 601)/100e0-3e0+0.001e0 AS v FROM orders) a) b",
)
def _(load):
    v = F.pmod(F.col("o_orderkey") * 37, F.lit(601)) / F.lit(100.0) - F.lit(3.0) + F.lit(0.001)
    d = load("orders").select("o_orderkey", v.alias("v"))
    out = []
    for n in _UNARY_SQL:
        c = elementwise.UNARY[n](F.abs("v") if n == "sqrt" else F.col("v"))
        if n == "log1p":
            c = F.when(F.col("v") > -1, c)
        out.append(rd(c, n))
    return d.select("o_orderkey", *out)


@query(
    "comparison_logic", "",
    """SELECT o_orderkey, a < b AS lt, a <= b AS le, a = b AS eq, (a > 50) AND (b > 50) AS both_high, CASE WHEN a > b THEN a ELSE b END AS larger,
 CASE WHEN a > 90 THEN -1 ELSE a END AS filled, CASE WHEN b = 0 THEN 1 ELSE 0 END AS zero_divisor
FROM (SELECT o_orderkey, (o_orderkey*7) % 101 AS a, (o_orderkey*11) % 97 AS b FROM orders) s""",
)
def _(load):
    a, b = F.col("o_orderkey") * 7 % 101, F.col("o_orderkey") * 11 % 97
    op = elementwise.BINARY
    quotient = op["div"](a, b)
    return load("orders").select(
        "o_orderkey", op["lt"](a, b).alias("lt"), op["le"](a, b).alias("le"), op["eq"](a, b).alias("eq"),
        op["logical_and"](a > 50, b > 50).alias("both_high"), elementwise.where(a > b, a, b).alias("larger"),
        elementwise.masked_fill(a, a > 90, -1).alias("filled"),
        F.when(~elementwise.UNARY["isfinite"](quotient), 1).otherwise(0).alias("zero_divisor"),
    )


@query(
    "keyed_random", "",
    f"""SELECT o_orderkey, {r(elementwise.key_uniform_sql(7, 'o_orderkey', 0), 'u')},
CAST(10 + floor(({elementwise.key_uniform_sql(7, 'o_orderkey', 3)})*90) AS BIGINT) AS k, {elementwise.key_uniform_sql(7, 'o_orderkey', 4)} < 0.25e0 AS coin,
{r(f"sqrt(-2*ln({elementwise.key_uniform_sql(7, 'o_orderkey', 1)}))*cos(2*pi()*({elementwise.key_uniform_sql(7, 'o_orderkey', 2)}))", 'g', 5)} FROM orders""",
)
def _(load):
    k = F.col("o_orderkey")
    return load("orders").select(
        "o_orderkey", rd(elementwise.key_uniform(7, k), "u"), elementwise.key_randint(7, k, 10, 100).alias("k"),
        elementwise.key_bernoulli(7, k, 0.25).alias("coin"), rd(elementwise.key_normal(7, k), "g", 5),
    )


@query(
    "row_products", "",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 4) AS self_dot,
round(list_sum(list_transform(list_zip(embedding, range(64)), lambda z: z[1]::DOUBLE * ((z[2] % 3) - 1))), 4) + 0e0 AS m0,
round(list_sum(list_transform(list_zip(embedding, range(64)), lambda z: z[1]::DOUBLE * ((z[2] % 5) * 0.5e0))), 4) + 0e0 AS m1 FROM embeddings""",
)
def _(load):
    m = [[float(i % 3 - 1), (i % 5) * 0.5] for i in range(64)]
    e = load("embeddings")
    prod = V.array_matmul(F.col("embedding"), m)
    return e.select(
        "vec_id", rd(V.array_dot(F.col("embedding"), F.col("embedding")), "self_dot", 4),
        rd(F.get(prod, F.lit(0)), "m0", 4), rd(F.get(prod, F.lit(1)), "m1", 4),
    )



"""Scalar formulas on splat columns: x y z, opacity_raw, s0 s1 s2 (log scale), qw qx qy qz, c0 c1 c2 (first SH band)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scenequarry.functions.vectors import quat_normalise

# Real spherical harmonics constants per band.
SH_C0 = 0.28209479177387814
SH_C1 = 0.4886025119029199
SH_C2 = (1.0925484305920792, -1.0925484305920792, 0.31539156525252005, -1.0925484305920792, 0.5462742152960396)
SH_C3 = (
    -0.5900435899266435,
    2.890611442640554,
    -0.4570457994644658,
    0.3731763325901154,
    -0.4570457994644658,
    1.445305721320277,
    -0.5900435899266435,
)

SCALES = ("s0", "s1", "s2")
QUAT = ("qw", "qx", "qy", "qz")


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def logit(p: float) -> float:
    return -math.inf if p <= 0 else math.inf if p >= 1 else math.log(p / (1 - p))


def opacity() -> Column:
    return sigmoid(F.col("opacity_raw"))


def scales() -> list[Column]:
    return [F.exp(F.col(s)) for s in SCALES]


def rotation() -> tuple[Column, ...]:
    return quat_normalise(tuple(F.col(q) for q in QUAT))


def clamp(c: Column, lo, hi) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def sh_to_rgb(c: Column) -> Column:
    return clamp(F.lit(0.5) + F.lit(SH_C0) * c, 0.0, 1.0)


def rgb_to_sh(c: Column) -> Column:
    return (c - F.lit(0.5)) / F.lit(SH_C0)


def sh_basis(x: Column, y: Column, z: Column, degree: int) -> list[Column]:
    """Basis values of bands 1..degree in coefficient order."""
    xx, yy, zz = x * x, y * y, z * z
    out: list[Column] = []
    if degree >= 1:
        out += [-F.lit(SH_C1) * y, F.lit(SH_C1) * z, -F.lit(SH_C1) * x]
    if degree >= 2:
        polys = [x * y, y * z, F.lit(2.0) * zz - xx - yy, x * z, xx - yy]
        out += [F.lit(c) * p for c, p in zip(SH_C2, polys)]
    if degree >= 3:
        four = F.lit(4.0) * zz - xx - yy
        polys = [
            y * (F.lit(3.0) * xx - yy),
            x * y * z,
            y * four,
            z * (F.lit(2.0) * zz - F.lit(3.0) * (xx + yy)),
            x * four,
            z * (xx - yy),
            x * (xx - F.lit(3.0) * yy),
        ]
        out += [F.lit(c) * p for c, p in zip(SH_C3, polys)]
    return out


def sh_colour(dc: Column, rest: Column, channel: int, direction: tuple[Column, Column, Column], degree: int) -> Column:
    """Colour of one channel; ``rest`` holds coefficient-major triples (r, g, b per coefficient)."""
    total = F.lit(SH_C0) * dc
    for i, b in enumerate(sh_basis(*direction, degree)):
        total = total + b * F.get(rest, F.lit(3 * i + channel))
    return clamp(total + F.lit(0.5), 0.0, 1.0)


def scale_max() -> Column:
    return F.greatest(*scales())


def scale_min() -> Column:
    return F.least(*scales())


def volume() -> Column:
    s = scales()
    return F.lit(4.0 / 3.0 * math.pi) * s[0] * s[1] * s[2]


def anisotropy() -> Column:
    return scale_max() / F.greatest(scale_min(), F.lit(1e-12))


def effective_rank() -> Column:
    """exp of the entropy of the normalised squared scales."""
    sq = [s * s for s in scales()]
    total = sq[0] + sq[1] + sq[2]
    terms = [F.when(q / total > 0, (q / total) * F.ln(q / total)).otherwise(F.lit(0.0)) for q in sq]
    return F.exp(-reduce(lambda a, b: a + b, terms))


def distance_to(cx, cy, cz) -> Column:
    d = [F.col(a) - (c if isinstance(c, Column) else F.lit(c)) for a, c in zip("xyz", (cx, cy, cz))]
    return F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])

"""Affine maps of splat tables, position quantisation and name clean-up."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenequarry.functions import codes
from scenequarry.functions.splats import SH_C1, SH_C2, SH_C3
from scenequarry.functions.vectors import quat_multiply
from scenequarry.operators.scale import attach

# executors get the batch functions by value and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

XYZ = ("x", "y", "z")


def _basis(d: np.ndarray, band: int) -> np.ndarray:
    x, y, z = d.T
    xx, yy, zz = x * x, y * y, z * z
    if band == 1:
        return np.stack([-y, z, -x], 1) * SH_C1
    if band == 2:
        return np.stack([x * y, y * z, 2 * zz - xx - yy, x * z, xx - yy], 1) * np.array(SH_C2)
    four = 4 * zz - xx - yy
    polys = [y * (3 * xx - yy), x * y * z, y * four, z * (2 * zz - 3 * (xx + yy)), x * four, z * (xx - yy), x * (xx - 3 * yy)]
    return np.stack(polys, 1) * np.array(SH_C3)


def sh_rotation(rotation: np.ndarray, band: int) -> np.ndarray:
    """Matrix M with M @ old coefficients = new coefficients after rotating the splat: a fixed-size least-squares fit."""
    n = 64
    i = np.arange(n) + 0.5
    z = 1 - 2 * i / n
    t = math.pi * (1 + 5**0.5) * i
    dirs = np.stack([np.sqrt(1 - z * z) * np.cos(t), np.sqrt(1 - z * z) * np.sin(t), z], 1)
    # value of the rotated lobe in direction d is the old lobe in direction R^T d
    m, *_ = np.linalg.lstsq(_basis(dirs, band), _basis(dirs @ rotation, band), rcond=None)
    return m


def _quat_of(r: np.ndarray) -> tuple[float, ...]:
    """Unit quaternion of a rotation matrix as the dominant eigenvector of its symmetric 4x4 form."""
    k = np.array(
        [
            [r.trace(), r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1]],
            [0, r[0, 0] - r[1, 1] - r[2, 2], r[0, 1] + r[1, 0], r[0, 2] + r[2, 0]],
            [0, 0, r[1, 1] - r[0, 0] - r[2, 2], r[1, 2] + r[2, 1]],
            [0, 0, 0, r[2, 2] - r[0, 0] - r[1, 1]],
        ]
    )
    k = k + np.triu(k, 1).T
    q = np.linalg.eigh(k)[1][:, -1]
    return tuple(float(v) for v in (q if q[0] >= 0 else -q))


def transform_splats(splats: DataFrame, matrix: Sequence[float], degree: int = 0) -> DataFrame:
    """Apply one row-major 4x4 affine matrix to means, rotations, log scales and SH bands (``shn`` up to ``degree``)."""
    m = np.array(matrix, dtype=float).reshape(4, 4)
    lin = m[:3, :3]
    scale = np.linalg.norm(lin, axis=0)
    rot = lin / np.where(scale > 0, scale, 1.0)
    q = _quat_of(rot)
    turned = abs(q[0]) < 1 - 1e-12
    new: dict[str, Column] = {}
    for i, a in enumerate(XYZ):
        new[a] = sum((F.lit(float(m[i, j])) * F.col(b) for j, b in enumerate(XYZ)), F.lit(float(m[i, 3])))
    if turned:
        out = quat_multiply(tuple(F.lit(v) for v in q), tuple(F.col(f"q{a}") for a in "wxyz"))
        new |= {f"q{a}": c for a, c in zip("wxyz", out)}
        if degree and "shn" in splats.columns:
            parts, start = [], 0
            for band in range(1, degree + 1):
                mat = sh_rotation(rot, band)
                for row in mat:
                    for ch in range(3):
                        parts.append(
                            sum((F.lit(float(v)) * F.get("shn", F.lit(3 * (start + k) + ch)) for k, v in enumerate(row)), F.lit(0.0))
                        )
                start += 2 * band + 1
            new["shn"] = F.array(*parts)
    if np.any(np.abs(scale - 1) > 1e-6):
        shift = math.log(float(scale.mean()))
        new |= {f"s{i}": F.col(f"s{i}") + F.lit(shift) for i in range(3)}
    return splats.withColumns(new)


def map_parts(matrix: Sequence[float], degree: int) -> tuple[list[float], list[float], list[list[float]]]:
    """(quaternion, [log scale], SH matrices by band) of a row-major 4x4 matrix; an unturned one keeps its SH bands."""
    lin = np.array(matrix, dtype=float).reshape(4, 4)[:3, :3]
    scale = np.linalg.norm(lin, axis=0)
    rot = lin / np.where(scale > 0, scale, 1.0)
    q = _quat_of(rot)
    turned = abs(q[0]) < 1 - 1e-12
    bands = [(sh_rotation(rot, b) if turned else np.eye(2 * b + 1)).ravel().tolist() for b in range(1, degree + 1)]
    mean = float(scale.mean())
    return list(q if turned else (1.0, 0.0, 0.0, 0.0)), [math.log(mean) if mean > 0 and np.any(np.abs(scale - 1) > 1e-6) else 0.0], bands


def transform_by_node(splats: DataFrame, maps: DataFrame, keys: Sequence[str] = ("scene_id", "node_id"), matrix: str = "world") -> DataFrame:
    """Apply to each splat the affine matrix of its row in ``maps`` (keys, row-major 4x4 ``matrix``); splats without one drop out.

    Means, and where the table has them rotations (``qw`` to ``qz``), log scales (``s0`` to ``s2``) and SH coefficients
    (``shn``, three channels each, bands 1 to 3) are mapped. What depends on the matrix alone is worked out once per row of
    ``maps``. A null matrix leaves the splat as it is.
    """
    keys = list(keys)
    has = set(splats.columns)
    turn, size, sh = {"qw", "qx", "qy", "qz"} <= has, {"s0", "s1", "s2"} <= has, "shn" in has
    degree = 3 if sh else 0

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [map_parts(np.eye(4).ravel() if m is None else m, degree) for m in b[matrix]]
            out = b[keys].copy()
            out["_m"] = [np.eye(4).ravel().tolist() if m is None else [float(v) for v in m] for m in b[matrix]]
            out["_q"], out["_s"], out["_b"] = [r[0] for r in rows], [r[1][0] for r in rows], [r[2] for r in rows]
            yield out

    kinds = ", ".join(f"`{k}` {maps.schema[k].dataType.simpleString()}" for k in keys)
    table = maps.select(*keys, matrix).mapInPandas(parts, f"{kinds}, _m array<double>, _q array<double>, _s double, _b array<array<double>>")
    j = attach(splats, table, keys)
    at = lambda i: F.get("_m", F.lit(i))
    new: dict[str, Column] = {a: sum((at(4 * i + k) * F.col(b) for k, b in enumerate(XYZ)), at(4 * i + 3)) for i, a in enumerate(XYZ)}
    if turn:
        new |= dict(zip(("qw", "qx", "qy", "qz"), quat_multiply(tuple(F.get("_q", F.lit(i)) for i in range(4)), tuple(F.col(f"q{a}") for a in "wxyz")), strict=True))
    if size:
        new |= {f"s{i}": F.col(f"s{i}") + F.col("_s") for i in range(3)}
    if sh:
        bands, start = [], 0
        for band in range(1, degree + 1):
            n = 2 * band + 1
            bands.append(F.when(F.size("shn") >= 3 * (start + n), _turned_band(F.get("_b", F.lit(band - 1)), start, n)).otherwise(F.array().cast("array<double>")))
            start += n
        new["shn"] = F.concat(*bands)
    return j.withColumns(new).drop("_m", "_q", "_s", "_b")


def _turned_band(mat: Column, start: int, n: int) -> Column:
    """Coefficients of one SH band after its matrix, three channels each."""

    def one(i: Column) -> Column:
        row, channel = F.floor(i / 3).cast("int"), i % 3
        terms = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.get(mat, row * n + k) * F.get("shn", (k + start) * 3 + channel).cast("double"))
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)

    return F.transform(F.sequence(F.lit(0), F.lit(3 * n - 1)), one)


def quantise_positions(points: DataFrame) -> DataFrame:
    """lo_/hi_ byte per axis within the scene's folded bounds; ``close`` checks the decoded value against the step."""
    aggs = []
    for a in XYZ:
        f = codes.log_fold(F.col(a))
        aggs += [F.min(f).alias(f"_{a}0"), F.max(f).alias(f"_{a}1")]
    j = attach(points, points.groupBy("scene_id").agg(*aggs), ["scene_id"])
    for a in XYZ:
        j = j.withColumn(f"_k{a}", codes.position_code(F.col(a), F.col(f"_{a}0"), F.col(f"_{a}1")))
    close = F.lit(True)
    out = [F.col(c) for c in points.columns]
    for a in XYZ:
        lo8, hi8 = codes.low_byte(F.col(f"_k{a}")), codes.high_byte(F.col(f"_k{a}"))
        out += [lo8.alias(f"lo_{a}"), hi8.alias(f"hi_{a}")]
        back = codes.position_value(lo8, hi8, F.col(f"_{a}0"), F.col(f"_{a}1"))
        step = (F.col(f"_{a}1") - F.col(f"_{a}0")) / 65535.0
        close = close & (F.abs(codes.log_fold(back) - codes.log_fold(F.col(a))) <= step * 1.001)
    bound = [F.col(f"_{a}{i}").alias(f"{n}_{a}") for a in XYZ for i, n in ((0, "fold_min"), (1, "fold_max"))]
    return j.select(*out, close.alias("close"), *bound)


def clean_name(c: Column) -> Column:
    """Identifier with letters, digits and underscores that does not start with a digit; empty becomes '_'."""
    s = F.regexp_replace(c, "[^A-Za-z0-9_]", "_")
    return F.when(s.rlike("^[A-Za-z_]"), s).otherwise(F.concat(F.lit("_"), s))

"""Morton codes and the byte-level quantisation of positions, rotations and opacities."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from scenequarry.functions.splats import clamp, sigmoid


def spread_bits(c: Column) -> Column:
    """Move bit i of a 10-bit number to bit 3i, one term per bit, so that the operand is not copied into itself."""
    terms = [F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1)), 3 * i) for i in range(10)]
    out = terms[0]
    for t in terms[1:]:
        out = out.bitwiseOR(t)
    return out


def lattice(c: Column, lo: Column, extent: Column) -> Column:
    """10-bit lattice coordinate inside [lo, lo + extent]; a flat axis gives 0."""
    cell = F.when(extent > 0, F.floor((c - lo) / extent * F.lit(1024.0))).otherwise(F.lit(0))
    return F.greatest(F.lit(0), F.least(cell, F.lit(1023))).cast("long")


def morton(x: Column, y: Column, z: Column) -> Column:
    """z-major interleave of three lattice coordinates."""
    return (
        F.shiftleft(spread_bits(z), 2).bitwiseOR(F.shiftleft(spread_bits(y), 1)).bitwiseOR(spread_bits(x))
    )


def log_fold(c: Column) -> Column:
    """sign(v) * ln(1 + |v|)."""
    return F.signum(c) * F.log1p(F.abs(c))


def log_unfold(c: Column) -> Column:
    return F.signum(c) * F.expm1(F.abs(c))


def position_code(c: Column, lo: Column, hi: Column) -> Column:
    """16-bit code of a folded coordinate; ``lo``/``hi`` are the folded bounds."""
    span = hi - lo
    v = F.when(span > 0, F.lit(65535.0) * (log_fold(c) - lo) / span).otherwise(F.lit(0.0))
    return F.floor(clamp(v, 0.0, 65535.0)).cast("int")


def low_byte(code: Column) -> Column:
    return code.bitwiseAND(F.lit(0xFF))


def high_byte(code: Column) -> Column:
    return F.shiftright(code, 8).bitwiseAND(F.lit(0xFF))


def position_value(lo8: Column, hi8: Column, lo: Column, hi: Column) -> Column:
    return log_unfold(lo + (hi - lo) * (lo8 + hi8 * 256) / F.lit(65535.0))


def pack_quaternion(q: tuple[Column, Column, Column, Column]) -> Column:
    """array<int>(4): the three smaller components in order, then 252 + index of the largest. Zero norm gives null."""
    n = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3])
    unit = F.array(*[c / F.when(n > 0, n) for c in q])
    largest = F.array_max(F.transform(unit, lambda v: F.abs(v)))
    at = (F.array_position(F.transform(unit, lambda v: F.abs(v)), largest) - 1).cast("int")
    sign = F.when(F.get(unit, at) < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    rest = F.filter(unit, lambda v, i: i != at)
    code = F.transform(
        rest, lambda v: F.floor(F.lit(255.0) * (v * sign * F.lit(math.sqrt(2.0)) * F.lit(0.5) + F.lit(0.5))).cast("int")
    )
    return F.when(n > 0, F.concat(code, F.array(at + 252)))


def unpack_quaternion(code: Column) -> Column:
    """array<double>(4) in w, x, y, z order from the packed bytes."""
    at = F.get(code, F.lit(3)) - 252
    at = F.when((at < 0) | (at > 3), F.lit(0)).otherwise(at)
    small = F.transform(F.slice(code, 1, 3), lambda b: (b / F.lit(255.0) - F.lit(0.5)) * F.lit(math.sqrt(2.0)))
    sq = F.aggregate(small, F.lit(0.0), lambda s, v: s + v * v)
    big = F.sqrt(clamp(F.lit(1.0) - sq, 0.0, 1.0))
    full = F.concat(
        F.filter(small, lambda v, i: i < at), F.array(big), F.filter(small, lambda v, i: i >= at)
    )
    n = F.sqrt(F.aggregate(full, F.lit(0.0), lambda s, v: s + v * v))
    return F.transform(full, lambda v: F.when(n > 0, v / n).otherwise(v))


def opacity_byte(raw: Column) -> Column:
    return F.floor(clamp(sigmoid(raw) * 255.0, 0.0, 255.0)).cast("int")

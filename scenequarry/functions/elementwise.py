"""Elementwise math with float semantics (division by zero gives inf or nan), easing curves and keyed random columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")


def divide(a: Column, b: Column) -> Column:
    """IEEE division; Spark would give null or an error for a zero divisor."""
    a, b = a.cast("double"), b.cast("double")
    return (
        F.when(b != 0, a / F.when(b != 0, b))
        .when(b.isNull() | a.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(b) | F.isnan(a) | (a == 0), F.lit(NAN))
        .when(a > 0, F.lit(INF))
        .otherwise(F.lit(-INF))
    )


def _domain(c: Column, ok: Column, value: Column, at_zero: float = NAN) -> Column:
    return F.when(c.isNull(), F.lit(None).cast("double")).when(ok, value).when(c == 0, F.lit(at_zero)).otherwise(F.lit(NAN))


def _gelu(c: Column) -> Column:
    inner = F.lit(math.sqrt(2 / math.pi)) * (c + F.lit(0.044715) * c * c * c)
    return F.lit(0.5) * c * (F.lit(1.0) + F.tanh(inner))


def _sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


# Names follow the array API of the capture tools; each entry maps a double column to a column.
UNARY = {
    "abs": F.abs,
    "neg": lambda c: -c,
    "exp": F.exp,
    "exp2": lambda c: F.pow(F.lit(2.0), c),
    "log": lambda c: _domain(c, c > 0, F.ln(F.when(c > 0, c)), -INF),
    "log2": lambda c: _domain(c, c > 0, F.log2(F.when(c > 0, c)), -INF),
    "log10": lambda c: _domain(c, c > 0, F.log10(F.when(c > 0, c)), -INF),
    "log1p": lambda c: _domain(c + 1, c > -1, F.log1p(F.when(c > -1, c)), -INF),
    "sqrt": F.sqrt,
    "rsqrt": lambda c: divide(F.lit(1.0), F.sqrt(c)),
    "square": lambda c: c * c,
    "sin": F.sin,
    "cos": F.cos,
    "tan": F.tan,
    "asin": F.asin,
    "acos": F.acos,
    "atan": F.atan,
    "sinh": F.sinh,
    "cosh": F.cosh,
    "tanh": F.tanh,
    "sigmoid": _sigmoid,
    "relu": lambda c: F.greatest(c, F.lit(0.0)),
    "gelu": _gelu,
    "swish": lambda c: c * _sigmoid(c),
    "floor": lambda c: F.floor(c).cast("double"),
    "ceil": lambda c: F.ceil(c).cast("double"),
    "round": F.rint,
    "trunc": lambda c: F.signum(c) * F.floor(F.abs(c)).cast("double"),
    "sign": F.signum,
    "reciprocal": lambda c: divide(F.lit(1.0), c),
    "isnan": F.isnan,
    "isinf": lambda c: F.abs(c) == F.lit(INF),
    "isfinite": lambda c: ~F.isnan(c) & (F.abs(c) != F.lit(INF)),
}

BINARY = {
    "add": lambda a, b: a + b,
    "sub": lambda a, b: a - b,
    "mul": lambda a, b: a * b,
    "div": divide,
    "pow": F.pow,
    "maximum": lambda a, b: F.greatest(a, b),
    "minimum": lambda a, b: F.least(a, b),
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
    "logical_and": lambda a, b: a & b,
    "logical_or": lambda a, b: a | b,
    "logical_xor": lambda a, b: a != b,
}


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def where(cond: Column, a: Column, b: Column) -> Column:
    return F.when(cond, a).otherwise(b)


def masked_fill(c: Column, mask: Column, value) -> Column:
    return F.when(mask, F.lit(value)).otherwise(c)


def ease(t: Column, kind: Column) -> Column:
    """linear, ease_in (t^3), ease_out, ease_in_out; t is clamped to [0, 1]."""
    t = clamp(t, 0.0, 1.0)
    u = F.lit(1.0) - t
    late = F.lit(2.0) * u
    return (
        F.when(kind == "ease_in", t * t * t)
        .when(kind == "ease_out", F.lit(1.0) - u * u * u)
        .when(
            kind == "ease_in_out",
            F.when(t < 0.5, F.lit(4.0) * t * t * t).otherwise(F.lit(1.0) - late * late * late / 2.0),
        )
        .otherwise(t)
    )


# ------------------------------------------------------------------ keyed random columns

_PRIME = 2147483647


def key_uniform(seed: int, key: Column, stream: int = 0) -> Column:
    """Uniform in (0, 1) that depends only on (seed, stream, key): a lattice hash in 64-bit integers that SQL can repeat.

    Two rounds of multiply-and-reduce modulo 2^31-1 after folding the key.
    """
    m = F.lit(_PRIME).cast("long")
    k = F.pmod(key.cast("long"), m)
    h = F.pmod(k * F.lit(48271).cast("long") + F.lit(seed % 65536 * 16807 + stream * 69621 + 11).cast("long"), m)
    h = F.pmod(h.bitwiseXOR(F.shiftright(h, 13)) * F.lit(69621).cast("long") + F.lit(7).cast("long"), m)
    h = F.pmod(h.bitwiseXOR(F.shiftright(h, 11)) * F.lit(39373).cast("long") + F.lit(3).cast("long"), m)
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(_PRIME))


def key_uniform_sql(seed: int, key: str, stream: int = 0) -> str:
    """The same number as SQL text for DuckDB."""
    m = _PRIME
    h = f"(((({key}) % {m}) * 48271 + {seed % 65536 * 16807 + stream * 69621 + 11}) % {m})"
    h = f"((xor({h}, {h} >> 13) * 69621 + 7) % {m})"
    h = f"((xor({h}, {h} >> 11) * 39373 + 3) % {m})"
    return f"(({h}) + 0.5e0) / {m}e0"


def key_normal(seed: int, key: Column) -> Column:
    """Box-Muller on two keyed uniforms."""
    u, v = key_uniform(seed, key, 1), key_uniform(seed, key, 2)
    return F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(2 * math.pi) * v)


def key_randint(seed: int, key: Column, lo: int, hi: int) -> Column:
    return (F.lit(lo) + F.floor(key_uniform(seed, key, 3) * (hi - lo))).cast("long")


def key_bernoulli(seed: int, key: Column, p: float) -> Column:
    return key_uniform(seed, key, 4) < p

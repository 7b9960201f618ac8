"""Column arithmetic for vectors, quaternions (w, x, y, z) and row-major 4x4 matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Quat = tuple[Column, Column, Column, Column]
Vec = tuple[Column, Column, Column]


def cols(*names: str) -> tuple[Column, ...]:
    return tuple(F.col(n) for n in names)


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    out = a[0] * b[0]
    for x, y in zip(a[1:], b[1:]):
        out = out + x * y
    return out


def cross(a: Vec, b: Vec) -> Vec:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def norm(v: Sequence[Column]) -> Column:
    return F.sqrt(dot(v, v))


def quat_multiply(a: Quat, b: Quat) -> Quat:
    """Hamilton product: scalar part minus the dot, vector part by the cross product."""
    av, bv = a[1:], b[1:]
    c = cross(av, bv)
    return (a[0] * b[0] - dot(av, bv), *[a[0] * bv[i] + b[0] * av[i] + c[i] for i in range(3)])


def quat_conjugate(q: Quat) -> Quat:
    return (q[0], -q[1], -q[2], -q[3])


def quat_normalise(q: Quat, floor: float = 1e-12) -> Quat:
    """Unit quaternion; the identity when the norm is below ``floor``."""
    n = norm(q)
    tiny = n < floor
    safe = F.when(tiny, F.lit(1.0)).otherwise(n)
    return (F.when(tiny, F.lit(1.0)).otherwise(q[0] / safe), *[F.when(tiny, F.lit(0.0)).otherwise(c / safe) for c in q[1:]])


def quat_matrix(q: Quat) -> list[list[Column]]:
    """3x3 rotation of the normalised quaternion."""
    w, x, y, z = quat_normalise(q)
    v = (x, y, z)
    # R = (w^2 - |v|^2) I + 2 v v^T + 2 w [v]x, with unit norm: diagonal 1 - 2 (|v|^2 - v_i^2)
    sq = dot(v, v)
    skew = [[None, -z, y], [z, None, -x], [-y, x, None]]
    return [
        [
            F.lit(1.0) - F.lit(2.0) * (sq - v[i] * v[i]) if i == j else F.lit(2.0) * (v[i] * v[j] + w * skew[i][j])
            for j in range(3)
        ]
        for i in range(3)
    ]


def matrix_quat(m: list[list[Column]]) -> Quat:
    """Unit quaternion of a rotation matrix; the pivot is the largest of trace and diagonal (four cases)."""
    d = [m[i][i] for i in range(3)]
    trace = d[0] + d[1] + d[2]

    def by_axis(i: int) -> list[Column]:
        j, k = (i + 1) % 3, (i + 2) % 3
        s = F.lit(2.0) * F.sqrt(F.greatest(F.lit(1.0) + d[i] - d[j] - d[k], F.lit(1e-300)))
        v: list[Column] = [F.lit(0.0)] * 3
        v[i] = F.lit(0.25) * s
        v[j] = (m[i][j] + m[j][i]) / s
        v[k] = (m[i][k] + m[k][i]) / s
        return [(m[k][j] - m[j][k]) / s, *v]

    r = F.sqrt(F.greatest(trace + 1.0, F.lit(1e-300)))
    by_trace = [F.lit(0.5) * r, *[(m[(i + 2) % 3][(i + 1) % 3] - m[(i + 1) % 3][(i + 2) % 3]) / (F.lit(2.0) * r) for i in range(3)]]
    cases = [by_axis(0), by_axis(1), by_axis(2)]
    raw = tuple(
        F.when(trace > 0, by_trace[c])
        .when((d[0] > d[1]) & (d[0] > d[2]), cases[0][c])
        .when(d[1] > d[2], cases[1][c])
        .otherwise(cases[2][c])
        for c in range(4)
    )
    n = norm(raw)
    return tuple(c / n for c in raw)


def mat3_vec(m: list[list[Column]], v: Sequence[Column]) -> Vec:
    return tuple(dot(m[i], v) for i in range(3))


def mat4_point(m: Column, v: Sequence[Column]) -> Vec:
    """Apply a row-major 16-element array column to a point."""
    at = lambda i: F.get(m, F.lit(i))
    return tuple(at(4 * i) * v[0] + at(4 * i + 1) * v[1] + at(4 * i + 2) * v[2] + at(4 * i + 3) for i in range(3))


def mat4_product(a: Column, b: Column) -> Column:
    """Row-major product of two 16-element array columns."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(15)),
        lambda i: F.aggregate(
            F.sequence(F.lit(0), F.lit(3)),
            F.lit(0.0),
            lambda acc, k: acc
            + F.get(a, F.floor(i / 4).cast("int") * 4 + k) * F.get(b, k * 4 + F.pmod(i, F.lit(4))),
        ),
    )


def array_dot(a: Column, b: Column) -> Column:
    """Dot product of two array columns, in double."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v
    )


def array_matmul(v: Column, matrix: Sequence[Sequence[float]]) -> Column:
    """Row vector times a constant d x m matrix."""
    width = len(matrix[0])
    return F.array(*[array_dot(v, F.array(*[F.lit(float(r[j])) for r in matrix])) for j in range(width)])

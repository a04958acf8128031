"""Scalar geometry as column expressions: angles, local coordinates and 3x3 matrices.

Not-a-number policy: inside plans a value that cannot be computed is NULL.
A matrix is a list of nine columns in row order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
PROJECTIVE_EPS = 1e-12
Matrix = list[Column]


def floor_mod(a: Column, b: float) -> Column:
    return a - F.floor(a / b) * b


def wrap(angle: Column) -> Column:
    """To [-pi, pi), by floor modulus."""
    return floor_mod(angle + math.pi, 2 * math.pi) - math.pi


def wrap_degrees(angle: Column) -> Column:
    return floor_mod(angle + 180.0, 360.0) - 180.0


def local_xy(lat: Column, lon: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """East and north metres from an origin on a sphere."""
    east = F.radians(lon - lon0) * EARTH_RADIUS_M * F.cos(F.radians(lat0))
    return east, F.radians(lat - lat0) * EARTH_RADIUS_M


def usable_fix(lat: Column, lon: Column) -> Column:
    """Both present, finite and in range."""
    return F.coalesce((F.abs(lat) <= 90.0) & (F.abs(lon) <= 180.0) & ~F.isnan(lat) & ~F.isnan(lon), F.lit(False))


def yaw_from(yaw: Column, reference: Column) -> Column:
    """Yaw in degrees relative to the reference's, in [-180, 180)."""
    return wrap_degrees(yaw - reference)


def pixels_per_metre(diagonal_px: Column, altitude_m: Column, fov_deg: Column) -> Column:
    return diagonal_px / (2 * altitude_m * F.tan(F.radians(fov_deg) / 2))


def matrix(prefix: str = "h") -> Matrix:
    return [F.col(f"{prefix}{i}{j}") for i in range(3) for j in range(3)]


def named(m: Matrix, prefix: str = "h") -> list[Column]:
    return [c.alias(f"{prefix}{k // 3}{k % 3}") for k, c in enumerate(m)]


def multiply(a: Matrix, b: Matrix) -> Matrix:
    return [sum((a[3 * i + k] * b[3 * k + j] for k in range(1, 3)), a[3 * i] * b[j]) for i in range(3) for j in range(3)]


def determinant(m: Matrix) -> Column:
    return m[0] * (m[4] * m[8] - m[5] * m[7]) - m[1] * (m[3] * m[8] - m[5] * m[6]) + m[2] * (m[3] * m[7] - m[4] * m[6])


def inverse(m: Matrix) -> Matrix:
    """By the adjugate; NULL if singular."""
    det = determinant(m)
    safe = F.when(F.abs(det) > 0, det)
    adj = [
        m[4] * m[8] - m[5] * m[7], m[2] * m[7] - m[1] * m[8], m[1] * m[5] - m[2] * m[4],
        m[5] * m[6] - m[3] * m[8], m[0] * m[8] - m[2] * m[6], m[2] * m[3] - m[0] * m[5],
        m[3] * m[7] - m[4] * m[6], m[1] * m[6] - m[0] * m[7], m[0] * m[4] - m[1] * m[3],
    ]
    return [x / safe for x in adj]


def normalise(m: Matrix) -> Matrix:
    """Divide by the last element unless it is next to zero."""
    return [F.when(F.abs(m[8]) > PROJECTIVE_EPS, x / m[8]).otherwise(x) for x in m]


def project(m: Matrix, x: Column, y: Column) -> tuple[Column, Column]:
    """Image of a point; NULL where the projective weight is next to zero."""
    w = m[6] * x + m[7] * y + m[8]
    safe = F.when(F.abs(w) >= PROJECTIVE_EPS, w)
    return (m[0] * x + m[1] * y + m[2]) / safe, (m[3] * x + m[4] * y + m[5]) / safe


def jacobian(m: Matrix, x: Column, y: Column) -> Matrix:
    """Analytic 2x2 Jacobian at a point, as four columns."""
    w = m[6] * x + m[7] * y + m[8]
    safe = F.when(F.abs(w) >= PROJECTIVE_EPS, w)
    u, v = (m[0] * x + m[1] * y + m[2]) / safe, (m[3] * x + m[4] * y + m[5]) / safe
    return [(m[0] - u * m[6]) / safe, (m[1] - u * m[7]) / safe, (m[3] - v * m[6]) / safe, (m[4] - v * m[7]) / safe]


def central_jacobian(m: Matrix, x: Column, y: Column, step: Column) -> Matrix:
    """2x2 Jacobian by central differences, as four columns; NULL if one of the four points does not project."""
    (xr, yr), (xl, yl), (xd, yd), (xu, yu) = (project(m, *p) for p in ((x + step, y), (x - step, y), (x, y + step), (x, y - step)))
    return [v / (2 * step) for v in (xr - xl, xd - xu, yr - yl, yd - yu)]


def relative_rotation(m: Matrix, x: Column, y: Column) -> Column:
    """Rotation of an edge at its source centre; NULL where orientation is reversed."""
    a, b, c, d = jacobian(m, x, y)
    return F.when(a * d - b * c > 0, -F.atan2(c - b, a + d))


def singular_ratio_log(a: Column, b: Column, c: Column, d: Column) -> Column:
    """|ln(s1 / s2)| of a 2x2 matrix; NULL if the lesser singular value is at most 1e-9."""
    p, q = F.hypot(a + d, b - c), F.hypot(a - d, b + c)
    big, small = (p + q) / 2, F.abs(p - q) / 2
    return F.when(small > 1e-9, F.abs(F.log(big / F.when(small > 1e-9, small))))

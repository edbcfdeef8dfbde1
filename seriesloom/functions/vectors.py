"""Small 3-D vector algebra on tuples of Spark Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]


def named(prefix: str) -> Vector:
    """Vector of the columns ``prefix_x``, ``prefix_y`` and ``prefix_z``."""
    x, y, z = (F.col(f"{prefix}_{axis}") for axis in "xyz")
    return x, y, z


def as_columns(v: Vector, prefix: str) -> list[Column]:
    return [c.alias(f"{prefix}_{axis}") for c, axis in zip(v, "xyz")]


def cross(u: Vector, v: Vector) -> Vector:
    ux, uy, uz = u
    vx, vy, vz = v
    return uy * vz - uz * vy, uz * vx - ux * vz, ux * vy - uy * vx


def dot(a: Vector, b: Vector) -> Column:
    x, y, z = (p * q for p, q in zip(a, b))
    return x + y + z


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))

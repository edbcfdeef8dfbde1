"""Is a series a regularly spaced 3-D volume?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import all_equal, element_number, items, nth, slash_joined
from ..functions.vectors import Vector, as_columns, cross, dot, named, norm
from ..lookups import CT_CLASS, MR_CLASS, PT_CLASS
from ..operators.fragments import gap_summary, with_next_value
from .core import INSTANCE, SERIES

VOLUME_CLASSES = (CT_CLASS, MR_CLASS, PT_CLASS)


def _in_volume_class() -> Column:
    return F.col("SOPClassUID").isin(*VOLUME_CLASSES)


def _is_overview() -> Column:
    """Scout and projection images, which do not belong to a volume."""
    return F.exists(items("ImageType"), lambda t: (t == "LOCALIZER") | t.like("%MIP%"))


def _triple(df: DataFrame, array: str, start: int) -> Vector:
    """Three neighbouring elements of an array as numbers, NULL beyond its end."""
    number = element_number(df, array)
    x, y, z = (number(nth(array, start + i)) for i in range(3))
    return x, y, z


def _with_geometry(rows: DataFrame) -> DataFrame:
    """Add the slice normal and the projections of the position on it and on the plane.

    Built in steps, so each cast and each product is computed once per row.
    """
    point, row, col, normal = (named(n) for n in ("_point", "_row", "_col", "normal"))
    vectors = rows.select(
        "*",
        *as_columns(_triple(rows, "ImagePositionPatient", 0), "_point"),
        *as_columns(_triple(rows, "ImageOrientationPatient", 0), "_row"),
        *as_columns(_triple(rows, "ImageOrientationPatient", 3), "_col"),
    )
    return vectors.select("*", *as_columns(cross(row, col), "normal")).select(
        *rows.columns,
        dot(point, normal).alias("slice_position"),
        norm(normal).alias("normal_length"),
        dot(point, row).alias("in_plane_row"),
        dot(point, col).alias("in_plane_col"),
        *normal,
    )


def slice_positions(instances: DataFrame) -> DataFrame:
    """Per instance of a volume class: place along the slice normal and in the plane."""
    rows = instances.where(_in_volume_class()).select(
        SERIES, INSTANCE, "ImagePositionPatient", "ImageOrientationPatient"
    )
    return _with_geometry(rows).drop("ImagePositionPatient", "ImageOrientationPatient")


def _obliquity() -> Column:
    """Angle between the normal and the nearest axis, NULL unless the normal is complete."""
    parts = [F.abs(c) for c in named("normal")]
    length = F.col("normal_length")
    # rounding may push the cosine just above one
    cosine = F.least(F.lit(1.0), F.try_divide(F.greatest(*parts), length))
    return F.when(
        length.isNotNull() & (length > 0), F.round(F.acos(cosine) * 180 / F.acos(F.lit(-1.0)), 2)
    )


def volume_geometry_index(
    instances: DataFrame,
    slice_tol: float = 0.01,
    in_plane_tol: float = 0.1,
    orientation_tol: float = 0.01,
) -> DataFrame:
    """Eight regularity checks, their conjunction, and the obliquity, per series.

    Everything but the slice gaps is hash aggregation with map-side combine; series with
    an overview image are recognised by a flag in it, without an anti join.  The
    gaps need an order, so (series, position) alone goes through range fragments, which
    keeps a series of any size off a single task.
    """
    member, overview = F.col("_member"), F.col("_overview")
    rows = (
        instances.select(
            SERIES,
            "Rows",
            "Columns",
            "PixelSpacing",
            _in_volume_class().alias("_member"),
            _is_overview().alias("_overview"),
            *[
                F.when(_in_volume_class(), F.col(c)).alias(c)
                for c in (INSTANCE, "ImagePositionPatient", "ImageOrientationPatient")
            ],
        )
        # rows of other classes only matter for their overview flag
        .where(member | overview)
    )
    geometry = _with_geometry(rows).withColumns(
        {
            "_orientation": F.when(member, slash_joined("ImageOrientationPatient")),
            "_spacing": F.when(member, slash_joined("PixelSpacing")),
            "_rows": F.when(member, F.col("Rows")),
            "_columns": F.when(member, F.col("Columns")),
        }
    )
    looks = ("_orientation", "_spacing", "_rows", "_columns")
    ranged = ("slice_position", "normal_length", "in_plane_row", "in_plane_col")
    # A series has few looks (one, if it is regular): folding to them first keeps texts
    # in the grouping key, so instances are hash-aggregated and never sorted.
    per_look = geometry.groupBy(SERIES, *looks).agg(
        F.bool_or(member).alias("_member"),
        F.bool_or(overview).alias("_overview"),
        F.count_if(member).alias("n"),
        F.count(INSTANCE).alias("n_instances"),
        *[F.min(c).alias(f"min_{c}") for c in ranged],
        *[F.max(c).alias(f"max_{c}") for c in ranged],
        F.min(_obliquity()).alias("obliquity_degrees"),
    )
    checks = (
        per_look.groupBy(SERIES)
        .agg(
            F.bool_or(member).alias("_member"),
            F.bool_or(overview).alias("_overview"),
            F.sum("n").alias("n"),
            F.sum("n_instances").alias("n_instances"),
            *[F.min(f"min_{c}").alias(f"min_{c}") for c in ranged],
            *[F.max(f"max_{c}").alias(f"max_{c}") for c in ranged],
            F.min("obliquity_degrees").alias("obliquity_degrees"),
            *[all_equal(c).alias(c) for c in looks],
        )
        .where(member & ~overview)
    )
    gaps = gap_summary(
        slice_positions(instances).select(SERIES, INSTANCE, "slice_position"),
        SERIES,
        "slice_position",
        tie=F.xxhash64(INSTANCE),
    )

    def spread(name: str) -> Column:
        return F.col(f"max_{name}") - F.col(f"min_{name}")

    expected = F.try_divide(spread("slice_position"), F.col("n") - 1)
    worst = F.greatest(
        F.abs(F.col("max_gap") - F.col("expected")), F.abs(F.col("min_gap") - F.col("expected"))
    )
    low, high = 1 - orientation_tol, 1 + orientation_tol
    flags = {
        "single_orientation": F.col("_orientation"),
        "orthogonal_orientation": F.col("min_normal_length").between(low, high)
        & F.col("max_normal_length").between(low, high),
        "unique_slice_positions": F.col("n_instances")
        == F.coalesce("distinct_values", F.lit(0)),
        "consistent_in_plane_row": spread("in_plane_row") < in_plane_tol,
        "consistent_in_plane_col": spread("in_plane_col") < in_plane_tol,
        "consistent_pixel_spacing": F.col("_spacing"),
        "consistent_image_dimensions": F.col("_rows") & F.col("_columns"),
        "uniform_slice_spacing": worst < slice_tol * F.abs("expected"),
    }
    table = (
        checks.join(gaps, SERIES, "left")
        .withColumn("expected", expected)
        .select(SERIES, *[c.alias(name) for name, c in flags.items()], "obliquity_degrees")
    )
    all_true = F.lit(True)
    for name in flags:
        all_true = all_true & F.col(name)
    return table.withColumn("regularly_spaced_3d_volume", all_true)


def slice_intervals(instances: DataFrame) -> DataFrame:
    """Per instance: distance to the next slice, and the spacing expected of the series."""
    rows = slice_positions(instances).select(SERIES, INSTANCE, "slice_position")
    led = with_next_value(
        rows, SERIES, "slice_position", F.col(INSTANCE), "next_position", ("lowest", "highest", "n")
    )
    return led.select(
        SERIES,
        INSTANCE,
        "slice_position",
        (F.col("next_position") - F.col("slice_position")).alias("slice_interval"),
        F.try_divide(F.col("highest") - F.col("lowest"), F.col("n") - 1).alias("expected_spacing"),
    )

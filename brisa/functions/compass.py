"""Compass point -> angle lookup as a map literal (no join, no UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 16-point compass rose and its angle in degrees.
COMPASS_DEGREES = {
    "N": 0.0, "NNE": 22.5, "NE": 45.0, "ENE": 67.5,
    "E": 90.0, "ESE": 112.5, "SE": 135.0, "SSE": 157.5,
    "S": 180.0, "SSW": 202.5, "SW": 225.0, "WSW": 247.5,
    "W": 270.0, "WNW": 292.5, "NW": 315.0, "NNW": 337.5,
}
COMPASS_POINTS = list(COMPASS_DEGREES)


def _map_literal() -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in COMPASS_DEGREES.items()))


def compass_angle(col, strict: bool = False) -> Column:
    """Angle of a compass point; unknown point -> null, or an error if ``strict``."""
    c = F.col(col) if isinstance(col, str) else col
    angle = F.try_element_at(_map_literal(), c)
    if strict:
        return F.when(angle.isNull(), F.raise_error(F.concat(F.lit("unknown compass point: "),
                                                               F.coalesce(c, F.lit("NULL"))))
                      ).otherwise(angle)
    return angle


def compass_point(index_col) -> Column:
    """Point name for an index 0..15 (clockwise from north)."""
    c = F.col(index_col) if isinstance(index_col, str) else index_col
    arr = F.array(*[F.lit(p) for p in COMPASS_POINTS])
    return F.try_element_at(arr, (F.pmod(c, F.lit(16)) + 1).cast("int"))

"""Run stamps written as un-padded ``Y-M-D-h-m-s`` text, and epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: un-padded stamp layout used in prediction file names.
STAMP_PATTERN = "yyyy-M-d-H-m-s"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stamp_text(ts) -> Column:
    return F.date_format(_c(ts), STAMP_PATTERN)


def parse_stamp(text) -> Column:
    """Parse the stamp back to a timestamp without time zone."""
    return F.to_timestamp_ntz(_c(text), F.lit(STAMP_PATTERN))


def stamp_to_int(text) -> Column:
    """Literal integer form (dashes deleted).  Ambiguous across widths; prefer
    :func:`stamp_epoch`."""
    return F.regexp_replace(_c(text), "-", "").cast("bigint")


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal that does not pass through any time zone.

    ``F.lit(datetime)`` builds a zoned timestamp (Python local zone, then the
    session zone on the cast); going through the ISO text does not.
    """
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


_EPOCH = "1970-01-01 00:00:00"


def stamp_epoch(text) -> Column:
    """Seconds since the epoch of a stamp read as UTC wall-clock time."""
    return F.timestamp_diff("SECOND", ntz_lit(_EPOCH), parse_stamp(text))


def epoch_seconds(col) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ in UTC wall-clock time (zone independent)."""
    return ntz_lit(_EPOCH) + F.make_dt_interval(secs=_c(col).cast("decimal(18,6)"))

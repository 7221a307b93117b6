"""Lenient parsing (F1, F2, F10): invalid input becomes NULL instead of failing.

ANSI mode is on, so a plain ``cast`` of bad text throws; every lenient parse
here is a ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_timestamp_lenient(c) -> Column:
    """text/date/timestamp -> TIMESTAMP_NTZ, NULL when unparseable.

    Accepts ``yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]`` with ``T`` or space and an
    optional trailing ``Z``.
    """
    return _col(c).try_cast("timestamp_ntz")


def to_date_lenient(c) -> Column:
    """``.dt.date`` of a lenient timestamp parse."""
    return F.to_date(to_timestamp_lenient(c))


def to_number(c, dtype: str = "double") -> Column:
    """numeric coercion, NULL when not a number."""
    return _col(c).try_cast(dtype)

"""Model feature expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txguard.functions.parsing import to_number, to_timestamp_lenient

# Mean Earth radius (km) and days per year used by the reference.
EARTH_RADIUS_KM = 6371.0
DAYS_PER_YEAR = 365.25


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def customer_age(current_time, dob) -> Column:
    """whole elapsed days between ``dob`` and ``current_time`` / 365.25.

    Whole days are floored, as a timedelta's ``days`` field is.
    """
    ct = to_timestamp_lenient(_col(current_time))
    birth = to_timestamp_lenient(_col(dob))
    seconds = F.timestamp_diff("SECOND", birth, ct)
    return F.floor(seconds / F.lit(86400)).cast("double") / F.lit(DAYS_PER_YEAR)


def transaction_hour(current_time) -> Column:
    """F4."""
    return F.hour(to_timestamp_lenient(_col(current_time)))


def transaction_dayofweek(current_time) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(to_timestamp_lenient(_col(current_time)))


def transaction_month(current_time) -> Column:
    """F6."""
    return F.month(to_timestamp_lenient(_col(current_time)))


def is_weekend(current_time) -> Column:
    """1 on Saturday/Sunday, 0 otherwise and when the time is missing."""
    dow = transaction_dayofweek(current_time)
    return F.coalesce(dow.isin(5, 6), F.lit(False)).cast("int")


def _haversine_a(lat1, lon1, lat2, lon2) -> Column:
    p1, l1 = F.radians(to_number(_col(lat1))), F.radians(to_number(_col(lon1)))
    p2, l2 = F.radians(to_number(_col(lat2))), F.radians(to_number(_col(lon2)))
    return (F.pow(F.sin((p2 - p1) / 2), 2)
            + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """F8: great-circle distance, ``2·asin(√a)`` form, unrounded, NULL-propagating."""
    a = _haversine_a(lat1, lon1, lat2, lon2)
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.asin(F.sqrt(a)))


def haversine_km_atan2(lat1, lon1, lat2, lon2) -> Column:
    """The ``2·atan2(√a, √(1−a))`` form, unrounded; NULL when any coordinate is
    missing or not numeric."""
    a = _haversine_a(lat1, lon1, lat2, lon2)
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def haversine_km_rounded(lat1, lon1, lat2, lon2) -> Column:
    """F9 as one column expression (fine over column references; over computed
    inputs prefer ``with_haversine_rounded``, which stages the rounding)."""
    from txguard.functions.formatting import round_half_even

    return round_half_even(haversine_km_atan2(lat1, lon1, lat2, lon2), 2)


def with_haversine_rounded(df, out: str, lat1, lon1, lat2, lon2):
    """adds ``out`` = atan2-form distance rounded to 2 decimals (Python
    ``round``), computed once per row."""
    from txguard.functions.formatting import with_rounded

    staged = df.withColumn(out, haversine_km_atan2(lat1, lon1, lat2, lon2))
    return with_rounded(staged, {out: (F.col(out), 2)})

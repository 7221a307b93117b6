"""Scalar column functions (F1–F23): all native Spark expressions, no UDFs."""

from txguard.functions.parsing import to_number, to_timestamp_lenient, to_date_lenient
from txguard.functions.features import (
    customer_age, haversine_km, haversine_km_atan2, haversine_km_rounded, transaction_hour,
    with_haversine_rounded,
    transaction_dayofweek, transaction_month, is_weekend,
)
from txguard.functions.formatting import (
    fixed, format_probability, format_threshold, format_amount,
    format_coordinates, format_distance, format_datetime, location_text,
    first_present, threshold_label, round_half_even, with_alert_message, with_fixed,
    with_rounded,
)

__all__ = [
    "to_number", "to_timestamp_lenient", "to_date_lenient", "customer_age",
    "haversine_km", "haversine_km_rounded", "transaction_hour",
    "transaction_dayofweek", "transaction_month", "is_weekend", "fixed",
    "format_probability", "format_threshold", "format_amount",
    "format_coordinates", "format_distance", "format_datetime",
    "location_text", "with_alert_message", "first_present", "threshold_label",
    "round_half_even", "with_fixed", "with_rounded", "haversine_km_atan2",
    "with_haversine_rounded",
]

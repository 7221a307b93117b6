"""Schemas, column lists and the required-column guard."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- Fixed values: these lists must equal the reference's (names and order). ---

# 17 columns of a raw transaction, in order; also the business validator's
# non-null (critical) set.
RAW_INPUT_COLUMNS = [
    "cc_num", "merchant", "category", "amt", "gender", "city", "state", "zip",
    "lat", "long", "city_pop", "job", "dob", "trans_num", "merch_lat",
    "merch_long", "current_time",
]
CRITICAL_COLUMNS = list(RAW_INPUT_COLUMNS)

# 21 columns an incoming labelled transaction must carry.
INCOMING_REQUIRED_COLUMNS = [
    "cc_num", "merchant", "category", "amt", "first", "last", "gender",
    "street", "city", "state", "zip", "lat", "long", "city_pop", "job", "dob",
    "trans_num", "merch_lat", "merch_long", "is_fraud", "current_time",
]

# 19 model features, in order.
MODEL_FEATURE_COLUMNS = [
    "merchant", "category", "amt", "gender", "city", "state", "zip", "lat",
    "long", "city_pop", "job", "merch_lat", "merch_long", "customer_age",
    "transaction_hour", "transaction_dayofweek", "transaction_month",
    "is_weekend", "distance_customer_merchant_km",
]
NUMERIC_FEATURES = [
    "amt", "zip", "lat", "long", "city_pop", "merch_lat", "merch_long",
    "customer_age", "transaction_hour", "transaction_dayofweek",
    "transaction_month", "is_weekend", "distance_customer_merchant_km",
]
CATEGORICAL_FEATURES = ["merchant", "category", "gender", "city", "state", "job"]

# Training-set type normalisation.
TRAINING_STRING_COLUMNS = [
    "trans_num", "merchant", "category", "first", "last", "gender", "street",
    "city", "state", "job",
]
TRAINING_NUMERIC_COLUMNS = [
    "cc_num", "amt", "zip", "lat", "long", "city_pop", "merch_lat",
    "merch_long", "is_fraud",
]
TRAINING_DATETIME_COLUMNS = ["dob", "current_time"]

# Sink column lists.
PREDICTION_INPUT_COLUMNS = [
    "trans_num", "cc_num", "amt", "category", "current_time",
    "is_fraud_predicted", "fraud_probability", "fraud_alert_threshold",
    "model_name", "model_alias",
]
ALERT_REQUIRED_COLUMNS = [
    "trans_num", "amt", "category", "current_time", "is_fraud_predicted",
    "fraud_probability", "fraud_alert_threshold", "model_name", "model_alias",
]
ALERT_OPTIONAL_COLUMNS = [
    "cc_num", "merchant", "city", "state", "lat", "long", "merch_lat",
    "merch_long", "customer_merchant_distance_km",
]
LABELED_INPUT_COLUMNS = [
    "trans_num", "cc_num", "merchant", "category", "amt", "first", "last",
    "gender", "street", "city", "state", "zip", "lat", "long", "city_pop",
    "job", "dob", "merch_lat", "merch_long", "is_fraud", "current_time",
]

# Alternative names the alert message accepts, first non-null wins.
ALERT_FIELD_ALTERNATIVES = {
    "trans_num": ["trans_num", "transaction_id"],
    "fraud_probability": ["fraud_probability", "fraud_proba", "prediction_probability"],
    "fraud_alert_threshold": ["fraud_alert_threshold", "alert_threshold", "threshold"],
    "amount": ["amt", "amount"],
    "merchant": ["merchant"],
    "category": ["category"],
    "customer_id": ["cc_num", "customer_id"],
    "city": ["city"],
    "state": ["state"],
    "customer_lat": ["lat", "customer_lat"],
    "customer_lon": ["long", "lon", "customer_long", "customer_lon"],
    "merchant_lat": ["merch_lat", "merchant_lat"],
    "merchant_lon": ["merch_long", "merchant_long", "merchant_lon"],
    "distance_km": ["distance_km", "customer_merchant_distance_km",
                    "distance_customer_merchant_km"],
    "transaction_datetime": ["trans_date_trans_time", "transaction_datetime",
                             "transaction_time"],
}

DEFAULT_THRESHOLDS = [0.50, 0.60, 0.70, 0.80, 0.90, 0.95]
DEFAULT_ALERT_THRESHOLD = 0.90
DEFAULT_MIN_NEW_LABELS = 100
DEFAULT_CHANNEL = "discord"

# --- end of fixed values ---

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_TS, _DT, _B = T.TimestampNTZType(), T.DateType(), T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TRANSACTION_SCHEMA = _struct(
    ("trans_num", _S), ("cc_num", _L), ("merchant", _S), ("category", _S),
    ("amt", _D), ("first", _S), ("last", _S), ("gender", _S), ("street", _S),
    ("city", _S), ("state", _S), ("zip", _L), ("lat", _D), ("long", _D),
    ("city_pop", _L), ("job", _S), ("dob", _DT), ("merch_lat", _D),
    ("merch_long", _D), ("is_fraud", _I), ("current_time", _TS),
)

PREDICTIONS_SCHEMA = _struct(
    ("trans_num", _S), ("cc_num", _L), ("amt", _D), ("category", _S),
    ("transaction_time", _TS), ("is_fraud_predicted", _I),
    ("fraud_probability", _D), ("fraud_alert_threshold", _D),
    ("model_name", _S), ("model_alias", _S), ("predicted_at", _TS),
)

ALERTS_SCHEMA = _struct(
    ("trans_num", _S), ("cc_num", _L), ("amt", _D), ("merchant", _S),
    ("category", _S), ("city", _S), ("state", _S), ("lat", _D), ("long", _D),
    ("merch_lat", _D), ("merch_long", _D),
    ("customer_merchant_distance_km", _D), ("transaction_time", _TS),
    ("fraud_probability", _D), ("fraud_alert_threshold", _D),
    ("model_name", _S), ("model_alias", _S), ("notification_channel", _S),
    ("notification_status", _S), ("created_at", _TS),
)

LABELED_SCHEMA = _struct(
    ("trans_num", _S), ("cc_num", _L), ("merchant", _S), ("category", _S),
    ("amt", _D), ("first_name", _S), ("last_name", _S), ("gender", _S),
    ("street", _S), ("city", _S), ("state", _S), ("zip", _I), ("lat", _D),
    ("long", _D), ("city_pop", _I), ("job", _S), ("dob", _DT),
    ("merch_lat", _D), ("merch_long", _D), ("is_fraud", _I),
    ("transaction_time", _TS), ("received_at", _TS),
)

DECISIONS_SCHEMA = _struct(
    ("model_name", _S), ("champion_version", _S), ("challenger_version", _S),
    ("champion_average_precision", _D), ("challenger_average_precision", _D),
    ("champion_recall_fraud", _D), ("challenger_recall_fraud", _D),
    ("champion_precision_fraud", _D), ("challenger_precision_fraud", _D),
    ("promoted", _B), ("decision_reason", _S), ("decided_at", _TS),
)

# Append-only ledgers that replace the mutable flag columns (no UPDATE).
ALERT_STATUS_EVENTS_SCHEMA = _struct(
    ("trans_num", _S), ("notification_status", _S), ("at", _TS))
MODEL_VERSIONS_SCHEMA = _struct(
    ("model_name", _S), ("version", _L), ("run_id", _S), ("candidate", _S),
    ("model_uri", _S), ("registered_at", _TS))
MODEL_ALIAS_EVENTS_SCHEMA = _struct(
    ("model_name", _S), ("alias", _S), ("version", _L), ("at", _TS), ("seq", _L))
MODEL_METRICS_SCHEMA = _struct(
    ("model_name", _S), ("version", _L), ("metric", _S), ("value", _D))
REGISTRY_DECISIONS_SCHEMA = T.StructType(DECISIONS_SCHEMA.fields + [T.StructField("run_id", _S, True)])
MODEL_EXPORTS_SCHEMA = _struct(
    ("model_name", _S), ("version", _L), ("run_id", _S), ("uri", _S), ("at", _TS), ("seq", _L))
CANDIDATE_METRICS_SCHEMA = _struct(
    ("run_id", _S), ("candidate", _S), ("metric", _S), ("value", _D))
CANDIDATE_SCORES_SCHEMA = _struct(
    ("run_id", _S), ("model", _S), ("trans_num", _S), ("label", _I), ("score", _D))


def missing_columns(columns: Iterable[str], required: Iterable[str]) -> list[str]:
    present = set(columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame | Iterable[str], required: Iterable[str],
                    context: str = "input") -> None:
    """Raise naming every missing column (plan-time, no Spark job)."""
    cols = df.columns if isinstance(df, DataFrame) else list(df)
    missing = missing_columns(cols, required)
    if missing:
        raise ValueError(f"missing columns for {context}: {missing}")

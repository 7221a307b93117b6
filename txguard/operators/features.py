"""Feature preparation (P1, P8, M1, M2): one lazy ``select`` of column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.functions import (
    customer_age, haversine_km, is_weekend, to_date_lenient,
    to_timestamp_lenient, transaction_dayofweek, transaction_hour,
    transaction_month,
)
from txguard.schemas import MODEL_FEATURE_COLUMNS, require_columns

TIME_FALLBACK_COLUMN = "trans_date_trans_time"


def transaction_time_column(df: DataFrame) -> Column:
    """``current_time``, else ``trans_date_trans_time``, else raise."""
    if "current_time" in df.columns:
        return F.col("current_time")
    if TIME_FALLBACK_COLUMN in df.columns:
        return F.col(TIME_FALLBACK_COLUMN)
    raise ValueError(
        "missing time column: neither 'current_time' nor "
        f"'{TIME_FALLBACK_COLUMN}' is present")


def feature_columns(df: DataFrame) -> dict[str, Column]:
    """The six derived features, as expressions over ``df``."""
    ct = to_timestamp_lenient(transaction_time_column(df))
    dob = to_timestamp_lenient(F.col("dob")) if "dob" in df.columns else F.lit(None).cast("timestamp_ntz")
    return {
        "customer_age": customer_age(ct, dob),
        "transaction_hour": transaction_hour(ct),
        "transaction_dayofweek": transaction_dayofweek(ct),
        "transaction_month": transaction_month(ct),
        "is_weekend": is_weekend(ct),
        "distance_customer_merchant_km": haversine_km("lat", "long", "merch_lat", "merch_long"),
    }


def with_features(df: DataFrame) -> DataFrame:
    """All input columns plus the derived features (``current_time`` parsed)."""
    ct = to_timestamp_lenient(transaction_time_column(df))
    derived = feature_columns(df)
    out = df.withColumns({**derived, "current_time": ct})
    if "dob" in df.columns:
        out = out.withColumn("dob", to_date_lenient(F.col("dob")))
    return out


def prepare_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """M1 (+P1): the 19 ordered model features, plus ``keep`` columns in front."""
    derived = feature_columns(df)
    exprs = []
    missing = []
    for name in MODEL_FEATURE_COLUMNS:
        if name in derived:
            exprs.append(derived[name].alias(name))
        elif name in df.columns:
            exprs.append(F.col(name))
        else:
            missing.append(name)
    if missing:
        raise ValueError(f"missing feature columns after preprocessing: {missing}")
    return df.select(*[F.col(k) for k in keep], *exprs)


def prepare_features_and_target(df: DataFrame, keep: Sequence[str] = ("trans_num",)) -> DataFrame:
    """M2: features plus the integer target ``is_fraud``."""
    require_columns(df, ["is_fraud"], "training target")
    carried = [k for k in keep if k in df.columns and k != "is_fraud"]
    features = prepare_features(df.withColumn("_target", F.col("is_fraud").cast("int")),
                                keep=[*carried, "_target"])
    return features.withColumnRenamed("_target", "is_fraud")

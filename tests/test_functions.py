from __future__ import annotations

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import incoming_df, incoming_row
from txguard.functions import (
    fixed, haversine_km, haversine_km_rounded, round_half_even, with_alert_message, with_fixed,
    with_haversine_rounded, with_rounded,
)
from txguard.operators.features import prepare_features


def _py_haversine_asin(lat1, lon1, lat2, lon2):
    p1, l1, p2, l2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 6371.0 * (2 * math.asin(math.sqrt(a)))


def _py_haversine_atan2(lat1, lon1, lat2, lon2):
    p1, l1, p2, l2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return round(6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)), 2)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(min_value=-1e7, max_value=1e7, allow_nan=False), min_size=1, max_size=40),
       st.sampled_from([0, 2, 4, 6]))
def test_fixed_matches_python_formatting(spark, values, decimals):
    extra = [1736.655, 0.125, 2.675, -0.001, 0.0, 1e-7, 12.345]
    rows = [(float(v),) for v in values + extra]
    df = spark.createDataFrame(rows, "x double")
    out = df.select("x", fixed("x", decimals).alias("s"), round_half_even("x", decimals).alias("r"))
    staged = with_rounded(with_fixed(out, {"s2": (F.col("x") * 1.0, decimals)}), {"r2": (F.col("x") + 0.0, decimals)})
    for r in staged.collect():
        assert r["s"] == f"{r['x']:.{decimals}f}", r
        assert r["s2"] == r["s"], r
        assert r["r"] == round(r["x"], decimals), r
        assert r["r2"] == r["r"], r


def test_fixed_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert [r[0] for r in df.select(fixed("x", 2)).collect()] == [None, None]


def test_haversine_forms(spark):
    pts = [(48.8566, 2.3522, 40.7128, -74.0060), (-36.27, 143.15, -27.93, -69.11), (0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    out = with_haversine_rounded(
        df.select("*", haversine_km("a", "b", "c", "d").alias("h1"),
                  haversine_km_rounded("a", "b", "c", "d").alias("h2")), "h3", "a", "b", "c", "d").collect()
    for (a, b, c, d), r in zip(pts, out):
        assert abs(r["h1"] - _py_haversine_asin(a, b, c, d)) < 1e-9
        assert r["h2"] == r["h3"] == _py_haversine_atan2(a, b, c, d)


def test_features_of_reference_row(spark):
    df = incoming_df(spark, [incoming_row()])
    f = prepare_features(df).first()
    # 2026-06-04 is a Thursday
    assert (f["transaction_hour"], f["transaction_dayofweek"], f["transaction_month"], f["is_weekend"]) == (10, 3, 6, 0)
    days = (math.floor((1780567200 - 631152000) / 86400))
    assert abs(f["customer_age"] - days / 365.25) < 1e-12
    assert list(prepare_features(df).columns)[0] == "merchant"


def test_missing_time_column_raises(spark):
    import pytest
    df = incoming_df(spark, [incoming_row()]).drop("current_time")
    with pytest.raises(ValueError, match="time column"):
        prepare_features(df)


def _py_message(a):
    def f(v, d):
        return "N/A" if v is None else f"{v:.{d}f}"

    def u(v, unit):
        return "N/A" if v is None else f"{v:.2f}{unit}"
    loc = ", ".join(x for x in (a["city"], a["state"]) if x) or "N/A"
    coords = "N/A" if a["lat"] is None or a["long"] is None else f"{a['lat']:.4f}, {a['long']:.4f}"
    mcoords = "N/A" if a["merch_lat"] is None else f"{a['merch_lat']:.6f}, {a['merch_long']:.6f}"
    return ("\U0001F6A8 Fraud alert detected\n\n"
            f"Transaction ID: {a['trans_num']}\n"
            f"Fraud probability: {f(a['fraud_probability'], 4)}\n"
            f"Alert threshold: {f(a['fraud_alert_threshold'], 2)}\n\n"
            f"Amount: {u(a['amt'], ' USD')}\n"
            f"Merchant: {a['merchant'] or 'N/A'}\n"
            f"Category: {a['category']}\n"
            f"Customer ID: {a['cc_num']}\n\n"
            f"Customer location: {loc}\n"
            f"Customer coordinates: {coords}\n"
            f"Merchant coordinates: {mcoords}\n"
            f"Customer ↔ merchant distance: {u(a['customer_merchant_distance_km'], ' km')}\n\n"
            f"Transaction datetime: {a['transaction_time'].isoformat()}")


def test_alert_message_layout(spark):
    import datetime as dt
    rows = [("tx_1", 4000000000000123, 1736.655, "M1", "cat", "Paris", "FR", 48.8566, 2.3522, 48.85, 2.35,
             0.47, dt.datetime(2026, 6, 4, 10, 0), 0.987654, 0.9),
            ("tx_2", 4000000000000124, 10.0, None, "cat", "", None, None, 2.0, 1.0, 2.0,
             None, dt.datetime(2026, 6, 4, 10, 0, 1), 0.91, 0.9)]
    cols = ("trans_num string, cc_num long, amt double, merchant string, category string, city string, "
            "state string, lat double, long double, merch_lat double, merch_long double, "
            "customer_merchant_distance_km double, transaction_time timestamp_ntz, "
            "fraud_probability double, fraud_alert_threshold double")
    df = spark.createDataFrame(rows, cols)
    got = with_alert_message(df, "m").collect()
    for r in got:
        assert r["m"] == _py_message(r.asDict()), r["m"]


def test_no_python_udf_in_feature_plan(spark):
    df = incoming_df(spark, [incoming_row()])
    plan = prepare_features(df).select(fixed(F.col("amt"), 2))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan

"""Registered queries: sources/sinks (S*), projections (P*), scalar functions (F*),
feature and scoring operators (M1, M2, M10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from txguard.functions import (
    customer_age, first_present, fixed, format_amount, format_coordinates,
    format_datetime, format_distance, format_probability, format_threshold,
    haversine_km, is_weekend, location_text, to_number, with_haversine_rounded,
    to_date_lenient, to_timestamp_lenient, transaction_dayofweek, transaction_hour, transaction_month,
)
from txguard.operators.alerts import alert_messages, alert_rows, new_alerts, predicted_frauds
from txguard.operators.dedupe import new_keys_only, present_keys_only
from txguard.operators.features import prepare_features, prepare_features_and_target
from txguard.operators.labels import to_pipeline_names, to_table_names
from txguard.operators.quality import require_non_empty
from txguard.operators.scoring import decision, predict_fraud
from txguard.operators.training_set import normalize_training_types
from txguard.plans.catalog import V, r6, register, scored_cte
from txguard.schemas import MODEL_FEATURE_COLUMNS, TRANSACTION_SCHEMA
from txguard.session import fresh_shared_path
from txguard.sources import files, sinks
from txguard.sources.payload import parse_payloads, rejected_payloads, to_split_payloads

TX_COLS = [f.name for f in TRANSACTION_SCHEMA.fields]
TX_SQL_COLS = ", ".join(f'"{c}"' for c in TX_COLS)
FLOAT_FEATURES = {"amt", "lat", "long", "merch_lat", "merch_long", "customer_age",
                  "distance_customer_merchant_km"}


def tx(spark, sf):
    return V(spark, sf, "transactions")


def scored(spark, sf):
    return predict_fraud(tx(spark, sf))


def _key_bigint():
    return F.col("trans_num").cast("bigint")


# ------------------------------------------------------------------ sources / sinks

@register("s1_parse_payload", f"SELECT {TX_SQL_COLS} FROM transactions")
def s1(spark, sf):
    t = tx(spark, sf).select(*TX_COLS)
    docs = to_split_payloads(t)
    return parse_payloads(docs).select(*TX_COLS)


def _one_payload_of_each_shape(spark, sf):
    """Per transaction a document of one of the four shapes, every third of
    them as a JSON string, and beside every 50th one that fits no shape."""
    t = tx(spark, sf).select(*TX_COLS)
    text = F.create_map(*[x for c in TX_COLS for x in (F.lit(c), F.col(c).cast("string"))])
    record = F.to_json(F.array(text), {"ignoreNullFields": "false"})
    lists = F.to_json(F.transform_values(text, lambda k, v: F.array(v)))
    columns = F.to_json(F.transform_values(text, lambda k, v: F.create_map(F.lit("0"), v)))
    split = F.to_json(F.struct(F.array(*[F.lit(c) for c in TX_COLS]).alias("columns"), F.array(F.lit(0)).alias("index"),
                               F.array(F.array(*[F.col(c).cast("string") for c in TX_COLS])).alias("data")))
    key = F.col("trans_num").cast("bigint")
    doc = F.element_at(F.array(record, lists, columns, split), (key % 4 + 1).cast("int"))
    quoted = F.regexp_replace(F.to_json(F.array(doc)), r"^\[|\]$", "")
    good = t.select("trans_num", F.when(key % 3 == 0, quoted).otherwise(doc).alias("payload"))
    bad = F.element_at(F.array(F.lit("not json"), F.lit('{"columns": ["amt"], "data": [["1"]]}'), F.lit('{"amt": 1, "zip": 2}'),
                               F.lit('{"amt": ["1"], "zip": ["2", "3"]}'), F.lit(None).cast("string")), (key % 5 + 1).cast("int"))
    return good.unionByName(t.where(key % 50 < 5).select("trans_num", bad.alias("payload")))


@register("s1_payload_shapes", f"SELECT {TX_SQL_COLS} FROM transactions")
def s1_shapes(spark, sf):
    return parse_payloads(_one_payload_of_each_shape(spark, sf), on_reject="skip").select(*TX_COLS)


@register("s1_rejected_payloads", "SELECT trans_num FROM transactions WHERE CAST(trans_num AS BIGINT) % 50 < 5")
def s1_rejects(spark, sf):
    return rejected_payloads(_one_payload_of_each_shape(spark, sf)).select("trans_num")


@register("s2_landing_batch", f"SELECT {TX_SQL_COLS} FROM transactions")
def s2(spark, sf):
    path = fresh_shared_path(spark, "landing")
    tx(spark, sf).select(*TX_COLS).write.json(path)
    return files.read_landing(spark, path, "json")


@register("s3_empty_guard", "SELECT count(*) AS n_rows, count(*) = 0 AS is_empty FROM transactions")
def s3(spark, sf):
    require_non_empty(tx(spark, sf), "transactions")
    return tx(spark, sf).agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", (F.col("n_rows") == 0).alias("is_empty"))


_NORMALIZED_SQL = ", ".join(
    'CAST(dob AS TIMESTAMP) AS dob' if c == "dob" else f'"{c}"' for c in TX_COLS)


@register("s4_csv_scan", f"SELECT {_NORMALIZED_SQL} FROM transactions")
def s4(spark, sf):
    path = fresh_shared_path(spark, "csv")
    files.write_csv(tx(spark, sf).select(*TX_COLS), path)
    return normalize_training_types(files.read_csv(spark, path)).select(*TX_COLS)


@register("s5_parquet_scan",
          "SELECT trans_num, amt, category FROM (SELECT trans_num, amt, category FROM transactions) x "
          "WHERE amt > 1000")
def s5(spark, sf):
    path = fresh_shared_path(spark, "parquet")
    tx(spark, sf).select(*TX_COLS).write.parquet(path)
    return files.read_parquet(spark, path).where(F.col("amt") > 1000).select(
        "trans_num", "amt", "category")


@register("s6_parquet_sink", f"SELECT {_NORMALIZED_SQL} FROM transactions")
def s6(spark, sf):
    path = fresh_shared_path(spark, "parquet-sink")
    files.write_parquet(tx(spark, sf).select(*TX_COLS), path, normalize=True)
    return files.read_parquet(spark, path).select(*TX_COLS)


@register("s7_csv_sink", f"SELECT {TX_SQL_COLS} FROM transactions")
def s7(spark, sf):
    path = fresh_shared_path(spark, "csv-sink")
    files.write_csv(tx(spark, sf).select(*TX_COLS), path)
    return spark.read.option("header", "true").schema(TRANSACTION_SCHEMA).csv(path)


@register("s8_load_or_initialize", f"SELECT {_NORMALIZED_SQL} FROM transactions")
def s8(spark, sf):
    raw = fresh_shared_path(spark, "raw-history")
    files.write_csv(tx(spark, sf).select(*TX_COLS), raw)
    processed = fresh_shared_path(spark, "processed")
    return files.load_or_initialize_training_set(spark, raw, processed).select(*TX_COLS)


_PRED_SQL = """trans_num, cc_num, amt, category, "current_time" AS transaction_time,
 is_fraud_predicted, round(fraud_probability, 6) AS fraud_probability, fraud_alert_threshold,
 model_name, model_alias"""

_PRED_COLS = ["trans_num", "cc_num", "amt", "category", "transaction_time", "is_fraud_predicted",
              "fraud_probability", "fraud_alert_threshold", "model_name", "model_alias"]


def _pred_out(df):
    return df.select(*[r6(c).alias(c) if c == "fraud_probability" else F.col(c) for c in _PRED_COLS])


@register("s9_predictions_sink", f"WITH {scored_cte()} SELECT {_PRED_SQL} FROM scored2")
def s9(spark, sf):
    path = fresh_shared_path(spark, "fraud_predictions")
    sinks.store_predictions(scored(spark, sf), path, "b1")
    sinks.store_predictions(scored(spark, sf), path, "b1")     # replay: same partition
    return _pred_out(spark.read.parquet(path))


_LABELED_SQL = """trans_num, cc_num, merchant, category, amt, "first" AS first_name,
 "last" AS last_name, gender, street, city, state, CAST(zip AS INTEGER) AS zip, lat, "long",
 CAST(city_pop AS INTEGER) AS city_pop, job, dob, merch_lat, merch_long, is_fraud,
 "current_time" AS transaction_time"""
_LABELED_COLS = ["trans_num", "cc_num", "merchant", "category", "amt", "first_name", "last_name",
                 "gender", "street", "city", "state", "zip", "lat", "long", "city_pop", "job",
                 "dob", "merch_lat", "merch_long", "is_fraud", "transaction_time"]
_CUTOFF = "1998-01-01 00:00:00"


@register("s10_labeled_insert",
          f"SELECT {_LABELED_SQL} FROM transactions WHERE \"current_time\" >= TIMESTAMP '{_CUTOFF}'")
def s10(spark, sf):
    t = tx(spark, sf)
    path = fresh_shared_path(spark, "labeled_transactions")
    early = t.where(F.col("current_time") < F.lit(_CUTOFF).cast("timestamp_ntz"))
    sinks.store_labeled(spark, early, path, "b0")
    late_copy = t.where(F.col("current_time") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    sinks.store_labeled(spark, t.unionByName(late_copy), path, "b1")
    return spark.read.parquet(path).where(F.col("batch_id") == "b1").select(*_LABELED_COLS)


_ALERT_COLS = ["trans_num", "cc_num", "amt", "merchant", "category", "city", "state", "lat", "long",
               "merch_lat", "merch_long", "customer_merchant_distance_km", "transaction_time",
               "fraud_probability", "fraud_alert_threshold", "model_name", "model_alias",
               "notification_channel", "notification_status"]
_ALERT_SQL = """trans_num, cc_num, amt, merchant, category, city, state, lat, "long", merch_lat,
 merch_long, round(round(6371.0 * (2.0 * atan2(sqrt(a), sqrt(1.0 - a))), 2), 6)
 AS customer_merchant_distance_km, "current_time" AS transaction_time,
 round(fraud_probability, 6) AS fraud_probability, fraud_alert_threshold, model_name, model_alias,
 'discord' AS notification_channel, 'created' AS notification_status"""
_HAV_A = """pow(sin((radians(merch_lat) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(merch_lat))
 * pow(sin((radians(merch_long) - radians("long")) / 2), 2) AS a"""


def _alert_out(df):
    return df.select(*[r6(c).alias(c) if c in ("fraud_probability", "customer_merchant_distance_km")
                       else F.col(c) for c in _ALERT_COLS])


@register("s11_new_alerts", f"""WITH {scored_cte()},
 al AS (SELECT *, {_HAV_A} FROM scored2 WHERE is_fraud_predicted = 1)
SELECT {_ALERT_SQL} FROM al WHERE "current_time" >= TIMESTAMP '{_CUTOFF}'""")
def s11(spark, sf):
    sc = scored(spark, sf)
    path = fresh_shared_path(spark, "fraud_alerts")
    sinks.store_alerts(spark, sc.where(F.col("current_time") < F.lit(_CUTOFF).cast("timestamp_ntz")),
                       path, "b0")
    created = sinks.store_alerts(spark, sc, path, "b1")
    return _alert_out(created)


# ------------------------------------------------------------------ projections

@register("p1_feature_projection", f"""WITH {scored_cte()}
SELECT merchant, category, amt, gender, city, state, zip, lat, "long", city_pop, job, merch_lat,
 merch_long, round(customer_age, 6) AS customer_age, CAST(transaction_hour AS INTEGER) AS transaction_hour,
 CAST(transaction_dayofweek AS INTEGER) AS transaction_dayofweek,
 CAST(transaction_month AS INTEGER) AS transaction_month, is_weekend,
 round(distance_customer_merchant_km, 6) AS distance_customer_merchant_km FROM feat""")
def p1(spark, sf):
    f = prepare_features(tx(spark, sf))
    return f.select(*[r6(c).alias(c) if c in ("customer_age", "distance_customer_merchant_km")
                      else F.col(c) for c in MODEL_FEATURE_COLUMNS])


@register("p2_rename_roundtrip", """SELECT trans_num, "first" AS first_name, "last" AS last_name,
 "current_time" AS transaction_time, "first" AS first_back FROM transactions""")
def p2(spark, sf):
    renamed = to_table_names(tx(spark, sf))
    back = to_pipeline_names(renamed)
    return renamed.select("trans_num", "first_name", "last_name", "transaction_time") \
        .join(back.select("trans_num", F.col("first").alias("first_back")), "trans_num")


@register("p3_sink_projection", f"WITH {scored_cte()} SELECT {_PRED_SQL} FROM scored2")
def p3(spark, sf):
    return _pred_out(sinks.prediction_rows(scored(spark, sf)))


@register("p4_predicted_frauds", f"""WITH {scored_cte()}
SELECT trans_num, round(fraud_probability, 6) AS fraud_probability FROM scored2 WHERE is_fraud_predicted = 1""")
def p4(spark, sf):
    return predicted_frauds(scored(spark, sf)).select("trans_num", r6("fraud_probability").alias("fraud_probability"))


_OPTIONAL_NULLS_SQL = """trans_num, CAST(NULL AS BIGINT) AS cc_num, CAST(NULL AS VARCHAR) AS merchant,
 CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS DOUBLE) AS lat,
 CAST(NULL AS DOUBLE) AS "long", CAST(NULL AS DOUBLE) AS merch_lat, CAST(NULL AS DOUBLE) AS merch_long,
 CAST(NULL AS DOUBLE) AS customer_merchant_distance_km"""


@register("p7_optional_backfill", f"""WITH {scored_cte()}
SELECT {_OPTIONAL_NULLS_SQL} FROM scored2 WHERE is_fraud_predicted = 1""")
def p7(spark, sf):
    from txguard.schemas import ALERT_OPTIONAL_COLUMNS, ALERT_REQUIRED_COLUMNS
    narrow = scored(spark, sf).select(*ALERT_REQUIRED_COLUMNS)
    return predicted_frauds(narrow).select("trans_num", *ALERT_OPTIONAL_COLUMNS)


@register("p8_time_fallback", f"""WITH {scored_cte()}
SELECT trans_num, round(customer_age, 6) AS customer_age, CAST(transaction_hour AS INTEGER) AS transaction_hour,
 CAST(transaction_dayofweek AS INTEGER) AS transaction_dayofweek,
 CAST(transaction_month AS INTEGER) AS transaction_month, is_weekend FROM feat""")
def p8(spark, sf):
    t = tx(spark, sf).withColumnRenamed("current_time", "trans_date_trans_time")
    f = prepare_features(t, keep=["trans_num"])
    return f.select("trans_num", r6("customer_age").alias("customer_age"), "transaction_hour",
                    "transaction_dayofweek", "transaction_month", "is_weekend")


@register("p9_nan_to_null", f"""WITH {scored_cte()}
SELECT trans_num, CASE WHEN CAST(trans_num AS BIGINT) % 101 = 0 THEN NULL ELSE amt END AS amt
FROM scored2""")
def p9(spark, sf):
    sc = scored(spark, sf).withColumn(
        "amt", F.when(_key_bigint() % 101 == 0, F.lit(float("nan"))).otherwise(F.col("amt")))
    return sinks.prediction_rows(sc).select("trans_num", "amt")


@register("p10_constant_annotation", f"""WITH {scored_cte()}
SELECT trans_num, fraud_alert_threshold, model_name, model_alias FROM scored2""")
def p10(spark, sf):
    return scored(spark, sf).select("trans_num", "fraud_alert_threshold", "model_name", "model_alias")


@register("p11_threshold_decision", """SELECT trans_num,
 CASE WHEN champion_score >= 0.9 THEN 1 ELSE 0 END AS is_fraud_predicted FROM scores""")
def p11(spark, sf):
    s = V(spark, sf, "scores")
    return s.select("trans_num", decision(F.col("champion_score"), 0.9).alias("is_fraud_predicted"))


_DIRTY_TEXT = ["trans_num", "cc_num", "merchant", "category", "amt", "lat", "long", "merch_lat",
               "merch_long", "is_fraud", "current_time_raw", "copy_no"]


@register("p12_normalize_types", """SELECT trans_num, TRY_CAST(cc_num AS BIGINT) AS cc_num, merchant, category,
 TRY_CAST(CASE WHEN CAST(trans_num AS BIGINT) % 7 = 0 THEN 'abc' ELSE CAST(amt AS VARCHAR) END AS DOUBLE) AS amt,
 lat, "long", merch_lat, merch_long,
 CAST(COALESCE(TRY_CAST(CASE WHEN category IS NULL THEN NULL ELSE CAST(is_fraud AS VARCHAR) END AS DOUBLE), 0) AS INTEGER) AS is_fraud,
 TRY_CAST(current_time_raw AS TIMESTAMP) AS "current_time", copy_no FROM transactions_dirty""")
def p12(spark, sf):
    d = V(spark, sf, "transactions_dirty")
    text = d.select(
        "trans_num", F.col("cc_num").cast("string").alias("cc_num"), "merchant", "category",
        F.when(_key_bigint() % 7 == 0, F.lit("abc")).otherwise(F.col("amt").cast("string")).alias("amt"),
        *[F.col(c).cast("string").alias(c) for c in ("lat", "long", "merch_lat", "merch_long")],
        F.when(F.col("category").isNull(), F.lit(None).cast("string"))
        .otherwise(F.col("is_fraud").cast("string")).alias("is_fraud"),
        F.col("current_time_raw").alias("current_time"), "copy_no")
    return normalize_training_types(text)


@register("p13_isin_membership", """SELECT n.trans_num,
 EXISTS (SELECT 1 FROM training_base b WHERE b.trans_num = n.trans_num) AS in_training
FROM labeled_new n""")
def p13(spark, sf):
    new, base = V(spark, sf, "labeled_new"), V(spark, sf, "training_base")
    flagged = [rows.select("trans_num", F.lit(flag).alias("in_training")) for rows, flag in (
        (present_keys_only(new, base, "trans_num"), True), (new_keys_only(new, base, "trans_num"), False))]
    return flagged[0].unionByName(flagged[1])


@register("p14_channel_default", f"""WITH {scored_cte()}
SELECT trans_num, 'discord' AS notification_channel FROM scored2 WHERE is_fraud_predicted = 1""")
def p14(spark, sf):
    return alert_rows(scored(spark, sf), channel=None).select("trans_num", "notification_channel")


# ------------------------------------------------------------------ scalar functions

@register("f1_parse_timestamp", """SELECT trans_num, copy_no,
 TRY_CAST(current_time_raw AS TIMESTAMP) AS "current_time" FROM transactions_dirty""")
def f1(spark, sf):
    d = V(spark, sf, "transactions_dirty")
    return d.select("trans_num", "copy_no", to_timestamp_lenient("current_time_raw").alias("current_time"))


@register("f2_to_numeric", """SELECT trans_num, copy_no,
 TRY_CAST(CASE WHEN current_time_raw = 'bad-date' THEN 'n/a' ELSE CAST(amt AS VARCHAR) END AS DOUBLE) AS amt_num
FROM transactions_dirty""")
def f2(spark, sf):
    d = V(spark, sf, "transactions_dirty")
    text = F.when(F.col("current_time_raw") == "bad-date", F.lit("n/a")).otherwise(F.col("amt").cast("string"))
    return d.select("trans_num", "copy_no", to_number(text).alias("amt_num"))


def _feature_query(name, expr_fn, sql_expr, rounded=False):
    sql = f"SELECT trans_num, {sql_expr} AS {name} FROM feat"
    if rounded:
        sql = f"SELECT trans_num, round({sql_expr}, 6) AS {name} FROM feat"

    def fn(spark, sf):
        col = expr_fn()
        return tx(spark, sf).select("trans_num", (F.round(col, 6) if rounded else col).alias(name))
    return fn, f"WITH {scored_cte()} {sql}"


for _id, _name, _fn, _sql, _rnd in [
    ("f3", "customer_age", lambda: customer_age("current_time", "dob"), "customer_age", True),
    ("f4", "transaction_hour", lambda: transaction_hour("current_time"), "CAST(transaction_hour AS INTEGER)", False),
    ("f5", "transaction_dayofweek", lambda: transaction_dayofweek("current_time"),
     "CAST(transaction_dayofweek AS INTEGER)", False),
    ("f6", "transaction_month", lambda: transaction_month("current_time"), "CAST(transaction_month AS INTEGER)", False),
    ("f7", "is_weekend", lambda: is_weekend("current_time"), "is_weekend", False),
    ("f8", "distance_customer_merchant_km", lambda: haversine_km("lat", "long", "merch_lat", "merch_long"),
     "distance_customer_merchant_km", True),
]:
    _q, _o = _feature_query(_name, _fn, _sql, _rnd)
    register(f"{_id}_{_name}", _o)(_q)


@register("f9_haversine_rounded", f"""SELECT trans_num,
 round(round(6371.0 * (2.0 * atan2(sqrt(a), sqrt(1.0 - a))), 2), 6) AS distance_km
FROM (SELECT trans_num, {_HAV_A} FROM transactions) x""")
def f9(spark, sf):
    d = with_haversine_rounded(tx(spark, sf), "distance_km", "lat", "long", "merch_lat", "merch_long")
    return d.select("trans_num", F.round("distance_km", 6).alias("distance_km"))


@register("f10_to_date", """SELECT trans_num, CAST("current_time" AS DATE) AS transaction_date FROM transactions""")
def f10(spark, sf):
    return tx(spark, sf).select("trans_num", to_date_lenient("current_time").alias("transaction_date"))


@register("f11_fillna_int", """SELECT trans_num, copy_no,
 CAST(COALESCE(CASE WHEN category IS NULL THEN NULL ELSE is_fraud END, 0) AS INTEGER) AS is_fraud
FROM transactions_dirty""")
def f11(spark, sf):
    d = V(spark, sf, "transactions_dirty")
    raw = F.when(F.col("category").isNull(), F.lit(None)).otherwise(F.col("is_fraud"))
    return normalize_training_types(d.select("trans_num", "copy_no", raw.alias("is_fraud")))


@register("f12_key_as_string", """SELECT trans_num, copy_no, CAST(cc_num AS VARCHAR) AS cc_text,
 CAST(CAST(trans_num AS BIGINT) AS VARCHAR) AS key_text FROM transactions_dirty""")
def f12(spark, sf):
    d = V(spark, sf, "transactions_dirty")
    keyed = normalize_training_types(d.select(_key_bigint().alias("trans_num"), F.col("trans_num").alias("key"), "copy_no", "cc_num"))
    return keyed.select(F.col("key").alias("trans_num"), "copy_no", F.col("cc_num").cast("string").alias("cc_text"), F.col("trans_num").alias("key_text"))


@register("f13_first_present", f"""WITH {scored_cte()}
SELECT trans_num, round(COALESCE(CASE WHEN isnan(fp) THEN NULL ELSE fp END,
 CASE WHEN isnan(alt) THEN NULL ELSE alt END), 6) AS probability
FROM (SELECT trans_num,
  CASE WHEN CAST(trans_num AS BIGINT) % 3 = 0 THEN CAST('NaN' AS DOUBLE) ELSE fraud_probability END AS fp,
  CASE WHEN CAST(trans_num AS BIGINT) % 2 = 0 THEN CAST('NaN' AS DOUBLE) ELSE fraud_probability / 2 END AS alt
 FROM scored2) x""")
def f13(spark, sf):
    nan = F.lit(float("nan"))
    s = scored(spark, sf).select(
        "trans_num",
        F.when(_key_bigint() % 3 == 0, nan).otherwise(F.col("fraud_probability")).alias("fraud_probability"),
        F.when(_key_bigint() % 2 == 0, nan).otherwise(F.col("fraud_probability") / 2).alias("fraud_proba"))
    return s.select("trans_num", F.round(first_present(s, ["fraud_probability", "fraud_proba",
                                                            "prediction_probability"], "double"), 6)
                    .alias("probability"))


def _fmt(sql_value, decimals):
    return (f"CASE WHEN {sql_value} IS NULL OR isnan({sql_value}) THEN NULL "
            f"ELSE printf('%.{decimals}f', {sql_value}) END")


@register("f14_format_probability", f"""WITH {scored_cte()}
SELECT trans_num, COALESCE({_fmt('fraud_probability', 4)}, 'N/A') AS text FROM scored2""")
def f14(spark, sf):
    return scored(spark, sf).select("trans_num", format_probability("fraud_probability").alias("text"))


@register("f15_format_threshold", f"""WITH {scored_cte()}
SELECT trans_num, COALESCE({_fmt('fraud_alert_threshold', 2)}, 'N/A') AS text FROM scored2""")
def f15(spark, sf):
    return scored(spark, sf).select("trans_num", format_threshold("fraud_alert_threshold").alias("text"))


@register("f16_format_amount", f"""SELECT trans_num, COALESCE({_fmt('amt', 2)} || ' USD', 'N/A') AS text
FROM transactions""")
def f16(spark, sf):
    return tx(spark, sf).select("trans_num", format_amount("amt").alias("text"))


@register("f17_format_coordinates", f"""SELECT trans_num,
 COALESCE({_fmt('lat', 4)} || ', ' || {_fmt('"long"', 4)}, 'N/A') AS customer_text,
 COALESCE({_fmt('merch_lat', 6)} || ', ' || {_fmt('merch_long', 6)}, 'N/A') AS merchant_text
FROM (SELECT trans_num, CASE WHEN CAST(trans_num AS BIGINT) % 11 = 0 THEN NULL ELSE lat END AS lat,
  "long", merch_lat, merch_long FROM transactions) x""")
def f17(spark, sf):
    t = tx(spark, sf).withColumn("lat", F.when(_key_bigint() % 11 == 0, F.lit(None)).otherwise(F.col("lat")))
    return t.select("trans_num", format_coordinates("lat", "long", 4).alias("customer_text"),
                    format_coordinates("merch_lat", "merch_long", 6).alias("merchant_text"))


@register("f18_format_distance", f"""WITH {scored_cte()}
SELECT trans_num, COALESCE({_fmt('distance_customer_merchant_km', 2)} || ' km', 'N/A') AS text FROM feat""")
def f18(spark, sf):
    t = tx(spark, sf)
    return t.select("trans_num", format_distance(haversine_km("lat", "long", "merch_lat", "merch_long"))
                    .alias("text"))


@register("f19_format_datetime", """SELECT trans_num,
 COALESCE(strftime("current_time", '%Y-%m-%dT%H:%M:%S'), 'N/A') AS text FROM transactions""")
def f19(spark, sf):
    return tx(spark, sf).select("trans_num", format_datetime("current_time").alias("text"))


@register("f20_location_text", """SELECT trans_num,
 COALESCE(NULLIF(concat_ws(', ', NULLIF(city, ''), NULLIF(state, '')), ''), 'N/A') AS text
FROM (SELECT trans_num,
  CASE WHEN CAST(trans_num AS BIGINT) % 5 = 0 THEN '' ELSE city END AS city,
  CASE WHEN CAST(trans_num AS BIGINT) % 3 = 0 THEN NULL ELSE state END AS state FROM transactions) x""")
def f20(spark, sf):
    t = tx(spark, sf).select(
        "trans_num",
        F.when(_key_bigint() % 5 == 0, F.lit("")).otherwise(F.col("city")).alias("city"),
        F.when(_key_bigint() % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("state")).alias("state"))
    return t.select("trans_num", location_text("city", "state").alias("text"))


_MESSAGE_SQL = f"""concat('\U0001F6A8 Fraud alert detected', chr(10), chr(10),
 'Transaction ID: ', trans_num, chr(10),
 'Fraud probability: ', COALESCE({_fmt('fraud_probability', 4)}, 'N/A'), chr(10),
 'Alert threshold: ', COALESCE({_fmt('fraud_alert_threshold', 2)}, 'N/A'), chr(10), chr(10),
 'Amount: ', COALESCE({_fmt('amt', 2)} || ' USD', 'N/A'), chr(10),
 'Merchant: ', COALESCE(merchant, 'N/A'), chr(10),
 'Category: ', COALESCE(category, 'N/A'), chr(10),
 'Customer ID: ', COALESCE(CAST(cc_num AS VARCHAR), 'N/A'), chr(10), chr(10),
 'Customer location: ', COALESCE(NULLIF(concat_ws(', ', NULLIF(city, ''), NULLIF(state, '')), ''), 'N/A'), chr(10),
 'Customer coordinates: ', COALESCE({_fmt('lat', 4)} || ', ' || {_fmt('"long"', 4)}, 'N/A'), chr(10),
 'Merchant coordinates: ', COALESCE({_fmt('merch_lat', 6)} || ', ' || {_fmt('merch_long', 6)}, 'N/A'), chr(10),
 'Customer ↔ merchant distance: ', COALESCE({_fmt('dist', 2)} || ' km', 'N/A'), chr(10), chr(10),
 'Transaction datetime: ', COALESCE(strftime("current_time", '%Y-%m-%dT%H:%M:%S'), 'N/A'))"""


@register("f21_alert_message", f"""WITH {scored_cte()},
 al AS (SELECT *, {_HAV_A} FROM scored2 WHERE is_fraud_predicted = 1),
 al2 AS (SELECT *, round(6371.0 * (2.0 * atan2(sqrt(a), sqrt(1.0 - a))), 2) AS dist FROM al)
SELECT trans_num, {_MESSAGE_SQL} AS message FROM al2""")
def f21(spark, sf):
    return alert_messages(new_alerts(scored(spark, sf), None))


@register("f23_dropna_keys", "SELECT trans_num, copy_no FROM transactions_dirty WHERE trans_num IS NOT NULL")
def f23(spark, sf):
    d = V(spark, sf, "transactions_dirty")
    return d.where(F.col("trans_num").isNotNull()).select("trans_num", "copy_no")


# ------------------------------------------------------------------ features / scoring

@register("m1_prepare_features", f"""WITH {scored_cte()}
SELECT trans_num, merchant, category, amt, gender, city, state, zip, lat, "long", city_pop, job, merch_lat,
 merch_long, round(customer_age, 6) AS customer_age, CAST(transaction_hour AS INTEGER) AS transaction_hour,
 CAST(transaction_dayofweek AS INTEGER) AS transaction_dayofweek,
 CAST(transaction_month AS INTEGER) AS transaction_month, is_weekend,
 round(distance_customer_merchant_km, 6) AS distance_customer_merchant_km FROM feat""")
def m1(spark, sf):
    f = prepare_features(tx(spark, sf), keep=["trans_num"])
    return f.select("trans_num", *[r6(c).alias(c) if c in ("customer_age", "distance_customer_merchant_km")
                                   else F.col(c) for c in MODEL_FEATURE_COLUMNS])


@register("m2_features_and_target", f"""WITH {scored_cte()}
SELECT trans_num, round(customer_age, 6) AS customer_age, CAST(transaction_hour AS INTEGER) AS transaction_hour,
 round(distance_customer_merchant_km, 6) AS distance_customer_merchant_km, is_fraud FROM feat""")
def m2(spark, sf):
    f = prepare_features_and_target(tx(spark, sf))
    return f.select("trans_num", r6("customer_age").alias("customer_age"), "transaction_hour",
                    r6("distance_customer_merchant_km").alias("distance_customer_merchant_km"), "is_fraud")


@register("m10_predict_fraud", f"""WITH {scored_cte()}
SELECT trans_num, round(fraud_probability, 6) AS fraud_probability, is_fraud_predicted,
 fraud_alert_threshold, model_name, model_alias FROM scored2""")
def m10(spark, sf):
    return scored(spark, sf).select("trans_num", r6("fraud_probability").alias("fraud_probability"),
                                    "is_fraud_predicted", "fraud_alert_threshold", "model_name", "model_alias")


__all__ = ["fixed"]

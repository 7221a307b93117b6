"""Registered queries: key joins (J1–J4, J6), union (U1), ledgers and gates
(A1, A2, P5, S13, G1–G6), top-k reports (O1, O3–O5), streaming (T1–T4) and
monitoring aggregates (D1–D10)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.operators.alerts import new_alerts, outbox, status_events
from txguard.operators.dedupe import insert_if_absent, new_keys_only, present_keys_only
from txguard.operators.labels import (
    count_unintegrated, fetch_unintegrated, integration_events_for, labeled_rows,
    reconciliation_keys, retraining_gate, unintegrated,
)
from txguard.operators.metrics import Evaluation, long_scores
from txguard.operators.monitoring import (
    cost_optimal_threshold, frauds_by_segment, kpis_by_period, performance_by, pseudonymised_customer,
    psi, score_histogram, target_drift, top_k,
)
from txguard.operators.scoring import predict_fraud
from txguard.operators.training_set import append_to_training_set, merge_training_set
from txguard.plans.catalog import V, dbl, r6, register, scored_cte
from txguard.plans.entries_core import (
    TX_COLS, _ALERT_COLS, _HAV_A, _PRED_SQL, _alert_out, _pred_out, scored, tx,
)
from txguard.plans.entries_model import METRIC_CTES, THRESHOLDS, _PAIR_SQL
from txguard.session import fresh_shared_path
from txguard.sources import sinks
from txguard.streaming import stream as st

CUTOFF = "1998-01-01 00:00:00"
SALT = "txguard:"


def _cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def _labeled_state(spark, sf):
    """Labelled table = every transaction; integration ledger = the keys already
    in the training base."""
    table = labeled_rows(tx(spark, sf))
    events = V(spark, sf, "training_base").select(
        "trans_num", F.current_timestamp().cast("timestamp_ntz").alias("integrated_at"))
    return table, events


_UNINTEGRATED = """(SELECT * FROM transactions t WHERE NOT EXISTS
 (SELECT 1 FROM training_base b WHERE b.trans_num = t.trans_num))"""

_FETCH_SQL = """trans_num, cc_num, merchant, category, amt, "first", "last", gender, street, city, state,
 CAST(zip AS INTEGER) AS zip, lat, "long", CAST(city_pop AS INTEGER) AS city_pop, job, dob, merch_lat, merch_long,
 is_fraud, "current_time\""""


# ------------------------------------------------------------------ ledgers, gates

@register("a1_count_unintegrated", f"SELECT count(*) AS n_unintegrated FROM {_UNINTEGRATED} u")
def a1(spark, sf):
    return count_unintegrated(*_labeled_state(spark, sf))


@register("g1_retraining_gate", f"""SELECT count(*) AS n_unintegrated, 100 AS min_new,
 count(*) >= 100 AS fires FROM {_UNINTEGRATED} u""")
def g1(spark, sf):
    return retraining_gate(*_labeled_state(spark, sf), min_new=100)


@register("p5_unintegrated_filter", f"SELECT trans_num FROM {_UNINTEGRATED} u")
def p5(spark, sf):
    return unintegrated(*_labeled_state(spark, sf)).select("trans_num")


@register("s13_fetch_unintegrated", f"SELECT {_FETCH_SQL} FROM {_UNINTEGRATED} u")
def s13(spark, sf):
    return fetch_unintegrated(*_labeled_state(spark, sf))


@register("o1_fetch_order", f"SELECT {_FETCH_SQL} FROM {_UNINTEGRATED} u")
def o1(spark, sf):
    return fetch_unintegrated(*_labeled_state(spark, sf), ordered=True)


_MARK_SQL = """SELECT DISTINCT n.trans_num FROM labeled_new n
 WHERE EXISTS (SELECT 1 FROM transactions t WHERE t.trans_num = n.trans_num)
 AND NOT EXISTS (SELECT 1 FROM training_base b WHERE b.trans_num = n.trans_num)"""


@register("j4_key_list_update", _MARK_SQL)
def j4(spark, sf):
    table, events = _labeled_state(spark, sf)
    return integration_events_for(V(spark, sf, "labeled_new"), table, events).select("trans_num")


@register("g2_mark_integrated", f"SELECT count(*) AS n_marked FROM ({_MARK_SQL}) m")
def g2(spark, sf):
    table, events = _labeled_state(spark, sf)
    marked = integration_events_for(V(spark, sf, "labeled_new"), table, events)
    return marked.agg(F.count(F.lit(1)).alias("n_marked"))


_J1_SQL = """SELECT n.* FROM labeled_new n
 WHERE NOT EXISTS (SELECT 1 FROM training_base b WHERE b.trans_num = n.trans_num)"""


@register("j1_new_rows_anti", _J1_SQL)
def j1(spark, sf):
    return new_keys_only(V(spark, sf, "labeled_new"), V(spark, sf, "training_base"), "trans_num")


@register("j2_present_semi", """SELECT n.trans_num FROM labeled_new n
 WHERE EXISTS (SELECT 1 FROM training_base b WHERE b.trans_num = n.trans_num)""")
def j2(spark, sf):
    return merge_training_set(V(spark, sf, "training_base"), V(spark, sf, "labeled_new")).already_present


@register("j3_insert_if_absent", """SELECT d.* FROM transactions_dirty d
 WHERE d.trans_num IS NOT NULL AND d.copy_no = 1
 AND NOT EXISTS (SELECT 1 FROM training_base b WHERE b.trans_num = d.trans_num)""")
def j3(spark, sf):
    batch = V(spark, sf, "transactions_dirty")
    return insert_if_absent(batch, V(spark, sf, "training_base"), "trans_num", order_cols=("copy_no",))


@register("j6_prediction_label_join", f"""WITH {scored_cte()}
SELECT s.trans_num, round(s.fraud_probability, 6) AS fraud_probability, b.is_fraud AS label
FROM scored2 s JOIN training_base b ON s.trans_num = b.trans_num""")
def j6(spark, sf):
    labels = V(spark, sf, "training_base").select("trans_num", F.col("is_fraud").alias("label"))
    return scored(spark, sf).select("trans_num", r6("fraud_probability").alias("fraud_probability")) \
        .join(labels, "trans_num")


@register("u1_aligned_union", f"""SELECT trans_num, amt, is_fraud, CAST(NULL AS VARCHAR) AS merchant FROM training_base
UNION ALL {_J1_SQL}""")
def u1(spark, sf):
    return merge_training_set(V(spark, sf, "training_base"), V(spark, sf, "labeled_new")).merged


@register("g5_merge_training_set", f"""SELECT
 (SELECT count(*) FROM training_base) + (SELECT count(*) FROM ({_J1_SQL}) a) AS n_merged,
 (SELECT count(*) FROM ({_J1_SQL}) a) AS n_added,
 (SELECT count(*) FROM labeled_new n WHERE EXISTS (SELECT 1 FROM training_base b WHERE b.trans_num = n.trans_num)) AS n_present""")
def g5(spark, sf):
    m = merge_training_set(V(spark, sf, "training_base"), V(spark, sf, "labeled_new"))
    tagged = (m.merged.select(F.lit("merged").alias("part"))
              .unionByName(m.integrated.select(F.lit("added").alias("part")))
              .unionByName(m.already_present.select(F.lit("present").alias("part"))))
    part = F.col("part")
    return tagged.agg(F.count_if(part == "merged").alias("n_merged"),
                      F.count_if(part == "added").alias("n_added"),
                      F.count_if(part == "present").alias("n_present"))


@register("g6_append_training_set", f"SELECT trans_num FROM ({_J1_SQL}) a")
def g6(spark, sf):
    path = fresh_shared_path(spark, "training_set")
    append_to_training_set(spark, path, V(spark, sf, "training_base"))
    return append_to_training_set(spark, path, V(spark, sf, "labeled_new"))


@register("g4_reconciliation", f"SELECT trans_num FROM ({_J1_SQL}) a")
def g4(spark, sf):
    new, base = V(spark, sf, "labeled_new"), V(spark, sf, "training_base")
    merged = merge_training_set(base, new)
    return reconciliation_keys(new, merged.integrated)


@register("g4_reconciliation_all_present", """SELECT n.trans_num FROM labeled_new n
 WHERE EXISTS (SELECT 1 FROM training_base b WHERE b.trans_num = n.trans_num)""")
def g4b(spark, sf):
    new, base = V(spark, sf, "labeled_new"), V(spark, sf, "training_base")
    fetched = present_keys_only(new, base, "trans_num")      # every fetched row is already known
    merged = merge_training_set(base, fetched)
    return reconciliation_keys(fetched, merged.integrated)


@register("a2_batch_counts", f"""WITH {scored_cte()}
SELECT count(*) AS n_rows, CAST(sum(is_fraud_predicted) AS BIGINT) AS n_predicted_frauds FROM scored2""")
def a2(spark, sf):
    return scored(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.sum("is_fraud_predicted").cast("long").alias("n_predicted_frauds"))


# ------------------------------------------------------------------ alerts: notify, outbox, reports

_ALERTS_CTE = f"""{scored_cte()},
 al AS (SELECT *, {_HAV_A} FROM scored2 WHERE is_fraud_predicted = 1)"""


@register("g3_mark_notified", f"""WITH {_ALERTS_CTE}
SELECT trans_num, 'sent' AS notification_status FROM al""")
def g3(spark, sf):
    alerts = new_alerts(scored(spark, sf), None)
    return status_events(alerts.select("trans_num"), "sent").select("trans_num", "notification_status")


@register("t3_outbox", f"""WITH {_ALERTS_CTE}
SELECT trans_num, 'created' AS notification_status, notification_channel FROM
 (SELECT *, 'discord' AS notification_channel FROM al) a WHERE "current_time" >= TIMESTAMP '{CUTOFF}'""")
def t3(spark, sf):
    alerts = new_alerts(scored(spark, sf), None)
    sent = status_events(alerts.where(F.col("transaction_time") < _cutoff()).select("trans_num"), "sent")
    return outbox(alerts, sent).select("trans_num", "notification_status", "notification_channel")


@register("t3_outbox_delivery", f"""WITH {_ALERTS_CTE},
 p AS (SELECT trans_num, CAST('0x' || substr(md5(trans_num), 1, 8) AS BIGINT) %
  greatest(1, (SELECT CAST(ceil(count(*) / 100.0) AS BIGINT) FROM al)) AS portion FROM al)
SELECT trans_num, 'sent' AS notification_status, CAST(CASE WHEN portion = 1 THEN 2 ELSE 1 END AS BIGINT) AS sends FROM p""")
def t3_delivery(spark, sf):
    """The notifier twice; in the first run its second portion fails after it
    was handed over.  Only that portion is handed over again."""
    from txguard.operators.alerts import current_alert_status
    from txguard.plans.inference import NotificationError, PortionsFailed, TablePaths, notify
    base = fresh_shared_path(spark, "outbox")
    paths = TablePaths(*[f"{base}/{n}" for n in ("predictions", "alerts", "labeled", "quarantine", "integration_events", "alert_status_events")])
    sinks.store_alerts(spark, scored(spark, sf), paths.alerts, "b1")

    def send(rows, fails):
        rows.select("trans_num").write.mode("append").parquet(f"{base}/handed")
        if fails and not rows.where("portion = 1").isEmpty():
            raise PortionsFailed({1: OSError("channel is down")})

    for fails in (True, False):
        try:
            notify(spark, paths, "discord", lambda rows, fails=fails: send(rows, fails), 100, portions_at_once=1000)
        except NotificationError:
            pass
    handed = spark.read.parquet(f"{base}/handed").groupBy("trans_num").agg(F.count(F.lit(1)).alias("sends"))
    now = current_alert_status(sinks.read_table(spark, paths.alerts), sinks.read_table(spark, paths.alert_status_events))
    return now.join(handed, "trans_num").select("trans_num", "notification_status", "sends")


@register("o3_latest_alerts", f"""WITH {_ALERTS_CTE}
SELECT trans_num, round(fraud_probability, 6) AS fraud_probability, fraud_alert_threshold,
 'discord' AS notification_channel, 'created' AS notification_status, "current_time" AS transaction_time,
 CAST(NULL AS TIMESTAMP) AS notified_at FROM al ORDER BY "current_time" DESC, trans_num DESC LIMIT 10""")
def o3(spark, sf):
    from txguard.operators.alerts import current_alert_status
    alerts = current_alert_status(new_alerts(scored(spark, sf), None), None)
    top = top_k(alerts, 10, [F.col("created_at").desc(), F.col("transaction_time").desc(),
                             F.col("trans_num").desc()])
    return top.select("trans_num", r6("fraud_probability").alias("fraud_probability"), "fraud_alert_threshold",
                      "notification_channel", "notification_status", "transaction_time", "notified_at")


@register("o4_latest_predictions", f"""WITH {scored_cte()}
SELECT trans_num, round(fraud_probability, 6) AS fraud_probability, fraud_alert_threshold, is_fraud_predicted,
 model_name, model_alias FROM scored2 ORDER BY "current_time" DESC, trans_num DESC LIMIT 10""")
def o4(spark, sf):
    rows = sinks.prediction_rows(scored(spark, sf))
    top = top_k(rows, 10, [F.col("predicted_at").desc(), F.col("transaction_time").desc(),
                           F.col("trans_num").desc()])
    return top.select("trans_num", r6("fraud_probability").alias("fraud_probability"), "fraud_alert_threshold",
                      "is_fraud_predicted", "model_name", "model_alias")


@register("o5_latest_decisions", f"""WITH {_PAIR_SQL}
SELECT model_name, CAST(champion_version AS VARCHAR) AS champion_version,
 CAST(challenger_version AS VARCHAR) AS challenger_version, promoted, decision_reason FROM dec2 LIMIT 10""")
def o5(spark, sf):
    from txguard.operators.promotion import cd_decisions, decide
    from txguard.plans.entries_model import _pairs
    path = fresh_shared_path(spark, "model_cd_decisions")
    sinks.store_decisions(cd_decisions(decide(_pairs(spark, sf))), path, "b1")
    top = top_k(spark.read.parquet(path), 10, [F.col("decided_at").desc()])
    return top.select("model_name", "champion_version", "challenger_version", "promoted", "decision_reason")


# ------------------------------------------------------------------ streaming

LANDED_ROWS = 500_000       # of a landed file at the most: a file is written, and may be read, by one task


def _landed_files(rows: int, least: int) -> int:
    return max(least, -(-rows // LANDED_ROWS))


def _landing(spark, df, parts: int = 4):
    path = fresh_shared_path(spark, "stream-in")
    df.repartition(_landed_files(df.count(), parts)).write.parquet(path)
    return path


@register("t1_scoring_stream", f"""WITH {scored_cte()} SELECT {_PRED_SQL}, files_per_trigger
FROM scored2 CROSS JOIN (SELECT unnest([1, 100]) AS files_per_trigger) f""")
def t1(spark, sf):
    """Repeats inside a file and across files are scored once, whether each
    file is a micro-batch or all are one."""
    from txguard.plans.inference import TablePaths
    t, repeats = tx(spark, sf).select(*TX_COLS), [F.expr(f"int(coalesce(CAST(trans_num AS BIGINT) % {k} = 0, false))") for k in (7, 11)]
    src = _landing(spark, t.withColumn("_copy", F.explode(F.sequence(F.lit(0), sum(repeats, F.lit(0))))).drop("_copy"))     # one pass
    out = None
    for files_per_trigger in (1, 100):
        base = fresh_shared_path(spark, "stream-tables")
        paths = TablePaths(*[f"{base}/{n}" for n in ("predictions", "alerts", "labeled", "quarantine",
                                                     "integration_events", "alert_status_events")])
        st.run_to_completion(st.start_scoring_stream(spark, src, paths, f"{base}/_checkpoint", max_files_per_trigger=files_per_trigger))
        rows = _pred_out(spark.read.parquet(paths.predictions)).withColumn("files_per_trigger", F.lit(files_per_trigger))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("t2_stream_dedupe", """SELECT DISTINCT trans_num FROM transactions_dirty
 WHERE trans_num IS NOT NULL AND TRY_CAST(current_time_raw AS TIMESTAMP) IS NOT NULL""")
def t2(spark, sf):
    d = V(spark, sf, "transactions_dirty").withColumnRenamed("current_time_raw", "current_time")
    src = _landing(spark, d)
    out = fresh_shared_path(spark, "dedupe-out")
    stream = spark.readStream.schema(d.schema).parquet(src)
    q = (st.dedupe_by_key(stream).writeStream.format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", out + "_ckpt")
         .trigger(availableNow=True).start())
    st.run_to_completion(q)
    return spark.read.schema(d.schema).parquet(out).select("trans_num")


_DIRTY_COLS = ["trans_num", "cc_num", "category", "amt", "lat", "gender", "city", "state", "zip", "city_pop", "job", "dob", "is_fraud", "current_time_raw"]
_DIRTY_LIST = ", ".join(_DIRTY_COLS)


@register("t2_late_rows_dedupe", f"""SELECT DISTINCT {_DIRTY_LIST} FROM transactions_dirty WHERE trans_num IS NOT NULL
UNION ALL SELECT {_DIRTY_LIST} FROM transactions_dirty WHERE trans_num IS NULL""")
def t2_late(spark, sf):
    """Files in descending event time, a few per trigger, the first copies
    repeated at the end, the stream stopped and restarted between: every key once, no
    row lost, all columns."""
    base = fresh_shared_path(spark, "late")
    src, out = f"{base}/in", f"{base}/out"
    V(spark, sf, "transactions_dirty").select(*_DIRTY_COLS).write.parquet(f"{base}/rows")       # once: six passes follow
    d = spark.read.parquet(f"{base}/rows")
    start = lambda: st.run_to_completion(st.start_dedupe_stream(spark, src, out, f"{base}/_checkpoint", d.schema, max_files_per_trigger=3))
    year = F.year(F.col("current_time_raw").try_cast("timestamp_ntz"))
    half = F.coalesce(year % 2, F.lit(0)) == 0
    n = d.agg(F.count_if(half).alias("half"), F.count_if(~half).alias("rest"), F.count("trans_num").alias("again")).first()
    latest = [F.col("current_time_raw").desc(), F.col("trans_num")]         # the key cuts a time of many rows, as that of the bad dates
    d.where(half).repartitionByRange(_landed_files(n["half"], 4), *latest).write.parquet(src)
    start()
    d.where(~half).repartitionByRange(_landed_files(n["rest"], 3), *latest).write.mode("append").parquet(src)
    d.where("trans_num IS NOT NULL").repartition(_landed_files(n["again"], 1)).write.mode("append").parquet(src)
    start()
    return spark.read.schema(d.schema).parquet(out).select(*_DIRTY_COLS)


_T4_SQL = f"""WITH {scored_cte()}
SELECT time_bucket(INTERVAL 2 HOUR, "current_time") AS window_start,
 time_bucket(INTERVAL 2 HOUR, "current_time") + INTERVAL 2 HOUR AS window_end,
 count(*) AS n_transactions, CAST(sum(is_fraud_predicted) AS BIGINT) AS n_predicted_frauds,
 round(CAST(sum(is_fraud_predicted) AS DOUBLE) / count(*), 6) AS fraud_rate,
 round(sum(CASE WHEN is_fraud_predicted = 1 THEN amt ELSE 0.0 END), 6) AS fraud_amount
FROM scored2 GROUP BY 1, 2"""


@register("t4_late_windows", _T4_SQL)
def t4_late(spark, sf):
    """The same windows by a stream whose files come in no order of time, a
    few per trigger, stopped and restarted: nothing is late."""
    from txguard.streaming.windows import WindowTable, start_window_stream
    base = fresh_shared_path(spark, "windows")
    rows = scored(spark, sf).select("trans_num", "current_time", "amt", "is_fraud_predicted")
    for half in (1, 0):
        rows.where(F.col("trans_num").cast("bigint") % 2 == half).repartition(6, "trans_num").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
        st.run_to_completion(start_window_stream(stream, f"{base}/table", f"{base}/_checkpoint", fan=4))
    w = WindowTable(spark, f"{base}/table").read()
    return w.select("window_start", "window_end", "n_transactions", "n_predicted_frauds",
                    r6("fraud_rate").alias("fraud_rate"), r6("fraud_amount").alias("fraud_amount"))


@register("t4_tumbling_fraud_rate", _T4_SQL)
def t4(spark, sf):
    w = st.fraud_rate_windows(scored(spark, sf))
    return w.select("window_start", "window_end", "n_transactions", "n_predicted_frauds",
                    r6("fraud_rate").alias("fraud_rate"), r6("fraud_amount").alias("fraud_amount"))


# ------------------------------------------------------------------ monitoring

def _psi_sql(source_cte: str, columns: list[str], ref_cond: str, fixed: tuple | None = None) -> str:
    cols = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in columns)
    ins = ", ".join(f'"{c}"' for c in columns)
    edges = ("SELECT feature, CAST(0.0 AS DOUBLE) AS lo, CAST(1.0 AS DOUBLE) AS hi FROM (SELECT DISTINCT feature FROM lng) f"
             if fixed else "SELECT feature, min(value) AS lo, max(value) AS hi FROM lng WHERE ref GROUP BY feature")
    return f"""WITH {source_cte},
 base AS (SELECT {ref_cond} AS ref, {cols} FROM src),
 lng AS (SELECT ref, feature, value FROM base UNPIVOT (value FOR feature IN ({ins})) WHERE NOT isnan(value)),
 edges AS ({edges}),
 b AS (SELECT l.feature, l.ref, CAST(least(greatest(CASE WHEN hi - lo > 0 THEN floor((value - lo) / (hi - lo) * 10)
  ELSE 0 END, 0), 9) AS INTEGER) AS bucket FROM lng l JOIN edges e USING (feature)),
 c AS (SELECT feature, bucket, count(*) FILTER (WHERE ref) AS ref_n, count(*) FILTER (WHERE NOT ref) AS cur_n
  FROM b GROUP BY feature, bucket),
 s AS (SELECT feature, greatest(ref_n / sum(ref_n) OVER (PARTITION BY feature), {dbl(1e-6)}) AS p,
  greatest(cur_n / sum(cur_n) OVER (PARTITION BY feature), {dbl(1e-6)}) AS q FROM c)
SELECT feature, round(sum((q - p) * ln(q / p)), 6) AS psi FROM s GROUP BY feature"""


_D1_COLS = ["amt", "customer_age", "distance_customer_merchant_km"]


@register("d1_feature_drift_psi", _psi_sql(f"{scored_cte()}, src AS (SELECT * FROM feat)", _D1_COLS,
                                           f"\"current_time\" < TIMESTAMP '{CUTOFF}'"))
def d1(spark, sf):
    from txguard.operators.features import with_features
    f = with_features(tx(spark, sf))
    return psi(f, _D1_COLS, F.col("current_time") < _cutoff()).select("feature", r6("psi").alias("psi"))


_DRIFT_NUM, _DRIFT_CAT = ["amt", "lat", "zip", "city_pop"], ["gender", "category", "state", "job", "merchant"]
_DRIFT_SRC = """src AS (SELECT year(TRY_CAST(current_time_raw AS TIMESTAMP)) AS period, * FROM transactions_dirty WHERE TRY_CAST(current_time_raw AS TIMESTAMP) IS NOT NULL)"""
_CUT_YEAR = 1998


@register("d1_quantile_drift", f"""WITH {_DRIFT_SRC},
 lng AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, period, CAST({c} AS DOUBLE) AS v FROM src" for c in _DRIFT_NUM)}),
 e AS (SELECT feature, quantile_disc(v, [{", ".join(f"{i}/10.0::DOUBLE" for i in range(1, 10))}]) AS edges FROM lng WHERE period < {_CUT_YEAR} GROUP BY feature),
 b AS (SELECT lng.feature, period, CASE WHEN v IS NULL THEN 10 ELSE len(list_filter(edges, lambda x: x < v)) END AS bin FROM lng JOIN e USING (feature)),
 r AS (SELECT feature, bin, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS p FROM b WHERE period < {_CUT_YEAR} GROUP BY 1, 2),
 c AS (SELECT feature, period, bin, count(*) / sum(count(*)) OVER (PARTITION BY feature, period) AS q FROM b WHERE period >= {_CUT_YEAR} GROUP BY 1, 2, 3),
 g AS (SELECT feature, period, bin FROM (SELECT DISTINCT feature, period FROM c), range(11) t(bin)),
 s AS (SELECT g.*, greatest(coalesce(p, 0), 1e-6::DOUBLE) AS p, greatest(coalesce(q, 0), 1e-6::DOUBLE) AS q FROM g LEFT JOIN r USING (feature, bin) LEFT JOIN c USING (feature, period, bin)),
 n AS (SELECT feature, period, count(*) AS n_rows, count(*) - count(v) AS n_missing FROM lng GROUP BY 1, 2)
SELECT feature, CAST(period AS INT) AS period, n_rows, n_missing, round(sum((q - p) * ln(q / p)), 6) AS psi FROM s JOIN n USING (feature, period) GROUP BY ALL""")
def d1_quantile(spark, sf):
    """Per year against the years before, from stored sketches; with a sketch
    larger than the input of the check its quantiles are exact."""
    from txguard.operators import drift
    d = V(spark, sf, "transactions_dirty").where(F.col("current_time_raw").try_cast("timestamp_ntz").isNotNull())
    path, k = fresh_shared_path(spark, "sketches"), 60_000
    drift.numeric_sketches(d, _DRIFT_NUM, F.year(F.col("current_time_raw").try_cast("timestamp_ntz")), k).write.parquet(path)
    found = drift.numeric_drift(spark.read.parquet(path), F.col("period") < _CUT_YEAR, k=k)
    return found.select("feature", "period", "n_rows", "n_missing", r6("psi").alias("psi"))


@register("d1_category_drift", f"""WITH {_DRIFT_SRC},
 lng AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, period, coalesce('=' || {c}, 'missing') AS bin FROM src" for c in _DRIFT_CAT)}),
 r AS (SELECT feature, bin, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS p FROM lng WHERE period < {_CUT_YEAR} GROUP BY 1, 2),
 x AS (SELECT l.feature, l.period, CASE WHEN r.bin IS NULL AND l.bin <> 'missing' THEN 'unseen' ELSE l.bin END AS bin
  FROM lng l LEFT JOIN r USING (feature, bin) WHERE l.period >= {_CUT_YEAR}),
 c AS (SELECT feature, period, bin, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY feature, period) AS q FROM x GROUP BY 1, 2, 3),
 g AS (SELECT feature, period, bin FROM c UNION SELECT feature, period, r.bin FROM (SELECT DISTINCT feature, period FROM c) JOIN r USING (feature)),
 s AS (SELECT g.*, greatest(coalesce(p, 0), 1e-6::DOUBLE) AS p, greatest(coalesce(q, 0), 1e-6::DOUBLE) AS q, coalesce(c.n, 0) AS n
  FROM g LEFT JOIN r USING (feature, bin) LEFT JOIN c USING (feature, period, bin))
SELECT feature, CAST(period AS INT) AS period, CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE bin = 'missing'), 0) AS BIGINT) AS n_missing,
 CAST(coalesce(sum(n) FILTER (WHERE bin = 'unseen'), 0) AS BIGINT) AS n_unseen, round(sum((q - p) * ln(q / p)), 6) AS psi FROM s GROUP BY ALL""")
def d1_category(spark, sf):
    from txguard.operators import drift
    d = V(spark, sf, "transactions_dirty").where(F.col("current_time_raw").try_cast("timestamp_ntz").isNotNull())
    counts = drift.category_counts(d, _DRIFT_CAT, F.year(F.col("current_time_raw").try_cast("timestamp_ntz")))
    return drift.category_drift(counts, F.col("period") < _CUT_YEAR).select(
        "feature", "period", "n_rows", "n_missing", "n_unseen", r6("psi").alias("psi"))


@register("d2_prediction_drift_psi", _psi_sql(
    "src AS (SELECT s.champion_score, t.\"current_time\" FROM scores s JOIN transactions t USING (trans_num))",
    ["champion_score"], f"\"current_time\" < TIMESTAMP '{CUTOFF}'", fixed=(0.0, 1.0)))
def d2(spark, sf):
    s = V(spark, sf, "scores").join(tx(spark, sf).select("trans_num", "current_time"), "trans_num")
    return psi(s, ["champion_score"], F.col("current_time") < _cutoff(), fixed_range=(0.0, 1.0)) \
        .select("feature", r6("psi").alias("psi"))


@register("d3_target_drift", f"""WITH p AS (SELECT year("current_time") AS period, count(*) AS n,
 CAST(sum(is_fraud) AS BIGINT) AS n_fraud,
 count(*) FILTER (WHERE "current_time" < TIMESTAMP '{CUTOFF}') AS ref_n,
 sum(CASE WHEN "current_time" < TIMESTAMP '{CUTOFF}' THEN is_fraud ELSE 0 END) AS ref_f
 FROM transactions GROUP BY 1),
 r AS (SELECT *, CAST(n_fraud AS DOUBLE) / n AS fraud_rate, sum(ref_f) OVER () / sum(ref_n) OVER () AS reference_rate FROM p)
SELECT CAST(period AS INTEGER) AS period, n, n_fraud, round(fraud_rate, 6) AS fraud_rate,
 round(reference_rate, 6) AS reference_rate, round(fraud_rate - reference_rate, 6) AS rate_change FROM r""")
def d3(spark, sf):
    t = tx(spark, sf)
    d = target_drift(t, F.year("current_time"), F.col("current_time") < _cutoff())
    return d.select("period", "n", "n_fraud", *[r6(c).alias(c) for c in ("fraud_rate", "reference_rate", "rate_change")])


_PERF_SQL = """count(*) FILTER (WHERE is_fraud = 1 AND pred) AS tp, count(*) FILTER (WHERE is_fraud = 0 AND pred) AS fp,
 count(*) FILTER (WHERE is_fraud = 1 AND NOT pred) AS fn"""


def _perf_select(key):
    return f"""SELECT {key}, tp, fp, fn,
 round(COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0), 6) AS precision,
 round(COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0), 6) AS recall"""


@register("d4_performance_drift", f"""WITH j AS (SELECT year(t."current_time") AS period, s.is_fraud,
 s.champion_score >= 0.9 AS pred FROM scores s JOIN transactions t USING (trans_num)),
 g AS (SELECT period, {_PERF_SQL} FROM j GROUP BY period)
{_perf_select('CAST(period AS INTEGER) AS period')} FROM g""")
def d4(spark, sf):
    j = V(spark, sf, "scores").join(tx(spark, sf).select("trans_num", "current_time"), "trans_num")
    p = performance_by(j, [F.year("current_time").alias("period")], "is_fraud", F.col("champion_score") >= 0.9)
    return p.select("period", "tp", "fp", "fn", r6("precision").alias("precision"), r6("recall").alias("recall"))


_OUTCOME_SQL = """o AS (SELECT s.trans_num, t."current_time" AS seen, s.champion_score AS p, CASE WHEN s.champion_score >= 0.9 THEN 1 ELSE 0 END AS pred,
  CASE WHEN CAST(s.trans_num AS BIGINT) % 5 <> 0 AND CAST(s.trans_num AS BIGINT) % 96 <= 72 THEN s.is_fraud END AS y
  FROM scores s JOIN transactions t USING (trans_num)),
 h AS (SELECT year(seen) AS period, p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM o WHERE y IS NOT NULL GROUP BY 1, 2),
 c AS (SELECT *, sum(pos) OVER w AS cpos, sum(neg) OVER w AS cneg FROM h WINDOW w AS (PARTITION BY period ORDER BY p DESC)),
 k AS (SELECT period, sum(neg * (cpos - pos / 2.0::DOUBLE)) / nullif(sum(pos) * sum(neg), 0) AS roc_auc,
  sum(pos * cpos / (cpos + cneg)::DOUBLE) / nullif(sum(pos), 0) AS average_precision FROM c GROUP BY period)"""


@register("d4_label_join_stream", f"""WITH {_OUTCOME_SQL},
 n AS (SELECT year(seen) AS period, count(*) AS n_predictions, count(*) FILTER (WHERE y IS NULL) AS n_outstanding,
  count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn FROM o GROUP BY 1)
SELECT CAST(n.period AS INT) AS period, n_predictions, n_outstanding, tp, fp, fn, tn,
 round(COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0), 6) AS precision, round(COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0), 6) AS recall,
 round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM n LEFT JOIN k USING (period)""")
def d4_stream(spark, sf):
    """Predictions and labels as two file streams, the labels up to four days
    later or never, files out of order inside the delay."""
    from txguard.streaming import performance as perf
    key, late = F.col("trans_num").cast("bigint"), F.expr("make_dt_interval(0, CAST(CAST(trans_num AS BIGINT) % 96 AS INT), 0, 0)")
    rows = V(spark, sf, "scores").join(tx(spark, sf).select("trans_num", "current_time"), "trans_num")
    predictions = rows.select("trans_num", F.col("current_time").alias("predicted_time"), F.col("champion_score").alias("fraud_probability"),
                              (F.col("champion_score") >= 0.9).cast("int").alias("is_fraud_predicted"))
    labels = rows.where(key % 5 != 0).select("trans_num", (F.col("current_time") + late).alias("label_time"), "is_fraud")
    base = fresh_shared_path(spark, "outcomes")
    # two years a file; inside a pair of files any order
    for df, time, name in ((predictions, "predicted_time", "p"), (labels, "label_time", "y")):
        df.repartitionByRange(4, time).write.parquet(f"{base}/{name}")
    # what closes the books: a row that is no transaction on either side, long after
    # (not one with a NULL key: a join's filter on its key takes that before the watermark sees it)
    end = spark.createDataFrame([("end",)], "trans_num string").withColumn("at", F.lit("2100-01-01").cast("timestamp_ntz"))
    run = lambda: st.run_to_completion(perf.start_outcomes_stream(spark, f"{base}/p", f"{base}/y", f"{base}/out", f"{base}/_checkpoint", delay="3650 days"))
    run()
    end.select("trans_num", F.col("at").alias("predicted_time"), F.lit(None).cast("double").alias("fraud_probability"),
               F.lit(None).cast("int").alias("is_fraud_predicted")).write.mode("append").parquet(f"{base}/p")
    end.select("trans_num", F.col("at").alias("label_time"), F.lit(None).cast("int").alias("is_fraud")).write.mode("append").parquet(f"{base}/y")
    run()
    known = spark.read.schema(T.StructType(perf.PREDICTED_SCHEMA.fields + [T.StructField("is_fraud", T.IntegerType())])).parquet(f"{base}/out")
    found = perf.performance_by_period(known.where("trans_num <> 'end'"), F.year("predicted_time"))
    return found.select("period", "n_predictions", "n_outstanding", "tp", "fp", "fn", "tn",
                        *[r6(c).alias(c) for c in ("precision", "recall", "roc_auc", "average_precision")])


@register("d5_kpi_by_period", f"""WITH {scored_cte()}
SELECT CAST(date_trunc('month', "current_time") AS TIMESTAMP) AS period, count(*) AS n_transactions,
 count(*) FILTER (WHERE is_fraud_predicted = 1) AS n_predicted_frauds,
 round(sum(CASE WHEN is_fraud_predicted = 1 THEN amt ELSE 0.0 END), 6) AS predicted_fraud_amount,
 round(sum(CASE WHEN is_fraud = 1 THEN amt ELSE 0.0 END), 6) AS fraud_amount,
 round(CAST(count(*) FILTER (WHERE is_fraud_predicted = 1) AS DOUBLE) / count(*), 6) AS predicted_fraud_rate
FROM scored2 GROUP BY 1""")
def d5(spark, sf):
    k = kpis_by_period(scored(spark, sf), F.date_trunc("month", "current_time").cast("timestamp_ntz"))
    return k.select("period", "n_transactions", "n_predicted_frauds",
                    *[r6(c).alias(c) for c in ("predicted_fraud_amount", "fraud_amount", "predicted_fraud_rate")])


@register("d6_frauds_by_segment", f"""WITH {scored_cte()}, fr AS (SELECT * FROM scored2 WHERE is_fraud_predicted = 1)
SELECT 'category' AS dimension, category AS value, count(*) AS n_frauds, round(sum(amt), 6) AS fraud_amount FROM fr GROUP BY category
UNION ALL SELECT 'state', state, count(*), round(sum(amt), 6) FROM fr GROUP BY state
UNION ALL SELECT 'merchant', merchant, count(*), round(sum(amt), 6) FROM fr GROUP BY merchant""")
def d6(spark, sf):
    seg = frauds_by_segment(scored(spark, sf), ["category", "state", "merchant"])
    return seg.select("dimension", "value", "n_frauds", r6("fraud_amount").alias("fraud_amount"))


@register("d6_top_merchants", f"""WITH {scored_cte()}
SELECT merchant, count(*) AS n_frauds FROM scored2 WHERE is_fraud_predicted = 1
GROUP BY merchant ORDER BY n_frauds DESC, merchant ASC LIMIT 10""")
def d6_top(spark, sf):
    seg = frauds_by_segment(scored(spark, sf), ["merchant"])
    top = top_k(seg, 10, [F.col("n_frauds").desc(), F.col("value").asc()])
    return top.select(F.col("value").alias("merchant"), "n_frauds")


@register("d7_alert_status_by_day", f"""WITH {_ALERTS_CTE}
SELECT CAST("current_time" AS DATE) AS day, CASE WHEN "current_time" < TIMESTAMP '{CUTOFF}' THEN 'sent' ELSE 'created' END
 AS notification_status, count(*) AS n_alerts FROM al GROUP BY 1, 2""")
def d7(spark, sf):
    from txguard.operators.alerts import current_alert_status
    alerts = new_alerts(scored(spark, sf), None)
    sent = status_events(alerts.where(F.col("transaction_time") < _cutoff()).select("trans_num"), "sent")
    cur = current_alert_status(alerts, sent)
    return cur.groupBy(F.to_date("transaction_time").alias("day"), "notification_status") \
        .agg(F.count(F.lit(1)).alias("n_alerts"))


@register("d8_score_histogram", f"""WITH {scored_cte()}
SELECT CAST(least(floor(fraud_probability * 20), 19) AS INTEGER) AS bucket, count(*) AS n FROM scored2 GROUP BY 1""")
def d8(spark, sf):
    return score_histogram(scored(spark, sf))


@register("d9_pseudonymised_customer", f"""SELECT trans_num,
 sha256('{SALT}' || CAST(cc_num AS VARCHAR)) AS customer_hash FROM transactions""")
def d9(spark, sf):
    return tx(spark, sf).select("trans_num", pseudonymised_customer(tx(spark, sf), SALT).alias("customer_hash"))


@register("d10_segment_metrics", f"""WITH j AS (SELECT t.category, s.is_fraud, s.champion_score >= 0.9 AS pred
 FROM scores s JOIN transactions t USING (trans_num)),
 g AS (SELECT category, {_PERF_SQL} FROM j GROUP BY category)
{_perf_select('category')} FROM g""")
def d10(spark, sf):
    j = V(spark, sf, "scores").join(tx(spark, sf).select("trans_num", "category"), "trans_num")
    p = performance_by(j, [F.col("category")], "is_fraud", F.col("champion_score") >= 0.9)
    return p.select("category", "tp", "fp", "fn", r6("precision").alias("precision"), r6("recall").alias("recall"))


@register("d10_cost_threshold", f"""WITH {METRIC_CTES},
 c AS (SELECT model, threshold, fn * 10.0 + fp * 1.0 AS cost FROM sweep),
 r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY cost ASC, threshold ASC) AS rn FROM c)
SELECT model, threshold, round(cost, 6) AS cost FROM r WHERE rn = 1""")
def d10_cost(spark, sf):
    ev = Evaluation(long_scores(V(spark, sf, "scores"), {"champion": "champion_score",
                                                         "challenger": "challenger_score"}))
    best = cost_optimal_threshold(ev.sweep(THRESHOLDS))
    return best.select("model", "threshold", r6("cost").alias("cost"))


__all__ = ["_ALERT_COLS", "_alert_out", "predict_fraud"]

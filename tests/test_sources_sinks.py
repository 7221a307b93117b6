from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, incoming_df, incoming_row
from txguard.fixtures import view
from txguard.operators.alerts import new_alerts
from txguard.operators.scoring import predict_fraud
from txguard.sources import files, sinks
from txguard.sources.payload import parse_payloads


def _docs(spark, docs):
    return spark.createDataFrame([(d,) for d in docs], "payload string")


def test_payload_shapes(spark):
    split = json.dumps({"columns": ["trans_num", "amt", "is_fraud", "current_time"], "index": [0, 1],
                        "data": [["tx_1", 10.5, 0, "2026-06-04T10:00:00"], ["tx_2", "bad", 1, None]]})
    records = json.dumps([{"trans_num": "tx_3", "amt": 3.0, "current_time": 1780567200000}])
    lists = json.dumps({"trans_num": ["tx_4", "tx_5"], "amt": [4.0, 5.0]})
    cols = json.dumps({"trans_num": {"0": "tx_6"}, "amt": {"0": 6.0}, "is_fraud": {"0": 1.0}})
    out = {r["trans_num"]: r for r in parse_payloads(_docs(spark, [split, records, lists, cols])).collect()}
    assert set(out) == {"tx_1", "tx_2", "tx_3", "tx_4", "tx_5", "tx_6"}
    assert out["tx_1"]["amt"] == 10.5 and out["tx_2"]["amt"] is None
    assert str(out["tx_1"]["current_time"]) == "2026-06-04 10:00:00"
    assert str(out["tx_3"]["current_time"]) == "2026-06-04 10:00:00"
    assert out["tx_6"]["is_fraud"] == 1


def test_missing_sink_columns_raise(spark):
    df = spark.createDataFrame([("tx", 1)], "trans_num string, cc_num long")
    with pytest.raises(ValueError, match="is_fraud_predicted"):
        sinks.prediction_rows(df)
    with pytest.raises(ValueError, match="fraud_probability"):
        new_alerts(df, None)


def test_prediction_sink_replay_is_idempotent(spark, scratch):
    scored = predict_fraud(view(spark, SF_SMALL, "transactions"))
    sinks.store_predictions(scored, scratch, "b1")
    sinks.store_predictions(scored, scratch, "b1")
    sinks.store_predictions(scored.limit(10), scratch, "b2")
    df = spark.read.parquet(scratch)
    assert df.where("batch_id = 'b1'").count() == 1500
    assert df.count() == 1510


def test_alert_insert_if_absent_returns_created_only(spark, scratch):
    scored = predict_fraud(view(spark, SF_SMALL, "transactions"))
    first = sinks.store_alerts(spark, scored, scratch, "b1").count()
    again = sinks.store_alerts(spark, scored, scratch, "b2").count()
    replay = sinks.store_alerts(spark, scored, scratch, "b1").count()
    assert first > 0 and again == 0 and replay == first


def test_labeled_insert_counts_true_rows(spark, scratch):
    rows = [incoming_row(trans_num=f"tx_{i}") for i in range(250)] + [incoming_row(trans_num="tx_1")]
    df = incoming_df(spark, rows)
    assert sinks.store_labeled(spark, df, scratch, "b1") == 250
    assert sinks.store_labeled(spark, df, scratch, "b2") == 0


def test_csv_roundtrip_and_initialize(spark, scratch):
    t = view(spark, SF_SMALL, "transactions")
    files.write_csv(t, scratch + "/raw")
    loaded = files.load_or_initialize_training_set(spark, scratch + "/raw", scratch + "/processed")
    assert loaded.count() == 1500
    assert dict(loaded.dtypes)["amt"] == "double"
    # second call reads the processed set
    again = files.load_or_initialize_training_set(spark, scratch + "/missing", scratch + "/processed")
    assert again.count() == 1500


def test_parquet_scan_prunes_and_pushes_down(spark, scratch):
    view(spark, SF_SMALL, "transactions").write.parquet(scratch)
    q = files.read_parquet(spark, scratch).where(F.col("amt") > 1000).select("trans_num", "amt")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(amt), GreaterThan(amt,1000.0)]" in plan
    assert "ReadSchema: struct<trans_num:string,amt:double>" in plan


def test_insert_if_absent_is_idempotent(spark):
    from txguard.operators.dedupe import insert_if_absent
    batch = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), (None, 1)], "trans_num string, seq int")
    first = insert_if_absent(batch, None, order_cols=("seq",))
    assert sorted(tuple(r) for r in first.collect()) == [("a", 1), ("b", 1)]
    assert insert_if_absent(batch, first, order_cols=("seq",)).count() == 0


def test_landing_formats(spark, scratch):
    t = view(spark, SF_SMALL, "transactions")
    from txguard.schemas import TRANSACTION_SCHEMA
    cols = [f.name for f in TRANSACTION_SCHEMA.fields]
    t.select(*cols).write.parquet(scratch + "/p")
    t.select(*cols).write.option("header", "true").csv(scratch + "/c")
    a = files.read_landing(spark, scratch + "/p", "parquet")
    b = files.read_landing(spark, scratch + "/c", "csv")
    assert a.count() == b.count() == 1500
    assert a.exceptAll(b).count() == 0

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from txguard.fixtures import views
from txguard.operators.labels import reconciliation_keys
from txguard.operators.training_set import append_to_training_set, merge_training_set, normalize_training_types


def _frame(spark, rows, cols="trans_num string, amt double, is_fraud int"):
    return spark.createDataFrame(rows, cols)


def test_normalize_types(spark):
    df = spark.createDataFrame(
        [("tx_001", "1990-01-01", "2026-06-04T10:00:00", "10.5", None),
         ("tx_002", "not a date", "2026-06-04 11:00:00", "abc", 1)],
        "trans_num string, dob string, current_time string, amt string, is_fraud int")
    out = normalize_training_types(df).orderBy("trans_num").collect()
    assert out[0]["amt"] == 10.5 and out[1]["amt"] is None
    assert out[0]["dob"] == dt.datetime(1990, 1, 1) and out[1]["dob"] is None
    assert out[0]["current_time"] == dt.datetime(2026, 6, 4, 10, 0)
    assert out[0]["is_fraud"] == 0 and out[1]["is_fraud"] == 1


def test_merge_adds_only_new(spark):
    train = _frame(spark, [("tx_001", 10.0, 0), ("tx_002", 20.0, 1)])
    new = _frame(spark, [("tx_002", 20.0, 1), ("tx_003", 30.0, 0)])
    m = merge_training_set(train, new)
    assert m.merged.count() == 3
    assert [r[0] for r in m.integrated.collect()] == ["tx_003"]
    assert [r[0] for r in m.already_present.collect()] == ["tx_002"]


def test_merge_all_known(spark):
    train = _frame(spark, [("tx_001", 10.0, 0)])
    new = _frame(spark, [("tx_001", 10.0, 0)])
    m = merge_training_set(train, new)
    assert m.merged.count() == 1
    assert m.integrated.count() == 0
    assert [r[0] for r in m.already_present.collect()] == ["tx_001"]


def test_reconciliation_marks_only_new_when_some_are_new(spark):
    train = _frame(spark, [("tx_001", 10.0, 0), ("tx_002", 20.0, 1)])
    new = _frame(spark, [("tx_001", 10.0, 0), ("tx_003", 30.0, 0)])
    m = merge_training_set(train, new)
    assert m.merged.count() == 3
    assert sorted(r[0] for r in reconciliation_keys(new, m.integrated).collect()) == ["tx_003"]
    assert [r[0] for r in m.already_present.collect()] == ["tx_001"]
    # nothing new: every fetched key is marked
    m2 = merge_training_set(train, train)
    assert sorted(r[0] for r in reconciliation_keys(train, m2.integrated).collect()) == ["tx_001", "tx_002"]


def test_aligned_union_column_order(spark):
    train = _frame(spark, [("tx_001", 10.0, 0)])
    new = spark.createDataFrame([("tx_009", 9.0, 1, "m")], "trans_num string, amt double, is_fraud int, merchant string")
    m = merge_training_set(train, new)
    assert m.merged.columns == ["trans_num", "amt", "is_fraud", "merchant"]


def test_fixture_merge_counts(spark):
    v = views(spark, SF_SMALL, "training_base", "labeled_new")
    m = merge_training_set(v["training_base"], v["labeled_new"])
    assert (m.merged.count(), m.integrated.count(), m.already_present.count()) == (1500, 600, 150)


def test_append_is_incremental(spark, scratch):
    v = views(spark, SF_SMALL, "training_base", "labeled_new")
    first = append_to_training_set(spark, scratch, v["training_base"]).count()
    added = append_to_training_set(spark, scratch, v["labeled_new"]).count()
    again = append_to_training_set(spark, scratch, v["labeled_new"]).count()
    assert (first, added, again) == (900, 600, 0)


@settings(max_examples=15, deadline=None)
@given(st.sets(st.integers(0, 40), max_size=15), st.lists(st.integers(0, 40), max_size=15))
def test_merge_invariants(spark, base_keys, new_keys):
    train = _frame(spark, [(f"k{k}", 1.0, 0) for k in sorted(base_keys)] or [("zz", 1.0, 0)])
    new = _frame(spark, [(f"k{k}", 2.0, 1) for k in new_keys], "trans_num string, amt double, is_fraud int")
    m = merge_training_set(train, new)
    integrated = [r[0] for r in m.integrated.collect()]
    present = [r[0] for r in m.already_present.collect()]
    assert sorted(integrated + present) == sorted(f"k{k}" for k in new_keys)
    assert m.merged.count() == train.count() + len(integrated)
    # idempotent: merging the merged set with the same batch adds nothing
    assert merge_training_set(m.merged, new).integrated.count() == 0


def test_thresholds_union(spark):
    from txguard.operators.metrics import build_thresholds, thresholds_column, thresholds_union
    assert build_thresholds(0.9) == [0.5, 0.6, 0.7, 0.8, 0.9, 0.95]
    assert build_thresholds(0.85) == [0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95]
    df = spark.createDataFrame([(0.85,), (0.9,)], "fraud_alert_threshold double")
    assert thresholds_union(df).first()[0] == [0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95]
    assert spark.range(1).select(thresholds_column(0.75)).first()[0] == [0.5, 0.6, 0.7, 0.75, 0.8, 0.9, 0.95]


def test_category_encoder_by_broadcast_and_by_shuffle(spark):
    from pyspark.sql import functions as F
    from txguard.operators.preprocess import fit_categories
    columns = ["gender", "city"]
    fit = [("F", "Paris"), ("F", "Rome"), ("M", "Rome"), ("F", None), (None, "Oslo")]
    ask = [("M", "Rome"), ("X", "Bonn"), (None, None), ("F", "Oslo")] + [("F", "Paris")] * 50
    encoder = fit_categories(spark.createDataFrame(fit, "gender string, city string"), columns)
    assert encoder.sizes == {"gender": 2, "city": 3} and encoder.modes == {"gender": "F", "city": "Rome"}
    want = [[1, 4], [], [0, 4], [0, 2]] + [[0, 3]] * 50        # F, M; Oslo, Paris, Rome
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ask)], "i int, gender string, city string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            got = [sorted(r["one_hot"]) for r in encoder.one_hot(df).orderBy("i").collect()]
            assert got == want and encoder.one_hot(df).columns == [*df.columns, "one_hot"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    empty = fit_categories(df.where(F.lit(False)).select("gender", "city"), columns)
    assert empty.sizes == {"gender": 0, "city": 0} and all(r["one_hot"] == [] for r in empty.one_hot(df).collect())

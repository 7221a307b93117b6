from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, incoming_df, incoming_row
from txguard.fixtures import view
from txguard.operators.quality import (
    DataQualityError, business_report, expectation_report, split_quarantine,
    validate_incoming_transactions, validate_transactions,
)


def test_valid_batch_passes(spark):
    df = incoming_df(spark, [incoming_row()])
    validate_incoming_transactions(df)
    validate_transactions(df)


def test_negative_amount_fails(spark):
    df = incoming_df(spark, [incoming_row(amt=-10.0)])
    with pytest.raises(DataQualityError, match="amt"):
        validate_incoming_transactions(df)
    with pytest.raises(DataQualityError, match="negative"):
        validate_transactions(df)


def test_invalid_label_fails(spark):
    df = incoming_df(spark, [incoming_row(is_fraud=3)])
    with pytest.raises(DataQualityError, match="is_fraud"):
        validate_incoming_transactions(df)


def test_duplicate_key_fails(spark):
    df = incoming_df(spark, [incoming_row(), incoming_row()])
    with pytest.raises(DataQualityError, match="Unique"):
        validate_incoming_transactions(df)


def test_empty_batch_fails(spark):
    df = incoming_df(spark, [incoming_row()]).limit(0)
    with pytest.raises(DataQualityError, match="empty"):
        validate_incoming_transactions(df)


def test_missing_columns_fail(spark):
    df = incoming_df(spark, [incoming_row()]).drop("street", "merchant")
    with pytest.raises(DataQualityError, match="street"):
        validate_incoming_transactions(df)


def test_business_validator_stops_at_first_failure(spark):
    # null merchant AND bad latitude: the null check is reported first
    df = incoming_df(spark, [incoming_row(merchant=None, lat=95.0)])
    with pytest.raises(DataQualityError, match="null values in: \\['merchant'\\]"):
        validate_transactions(df)
    df2 = incoming_df(spark, [incoming_row(lat=95.0)])
    with pytest.raises(DataQualityError, match="latitude"):
        validate_transactions(df2)


def test_nan_coordinate_is_invalid_for_business_but_ignored_by_range_expectation(spark):
    df = incoming_df(spark, [incoming_row(lat=float("nan"))])
    rep = business_report(df).first()
    assert rep["range:lat"] == 1
    exp = expectation_report(df).first()
    assert exp["ExpectColumnValuesToBeBetween:lat"] == 0


def test_report_counts_match_fixture_expectations(spark):
    d = view(spark, SF_SMALL, "transactions_dirty")
    rep = expectation_report(d, "current_time_raw").first().asDict()
    assert rep["total"] == 1514
    assert rep["ExpectColumnValuesToNotBeNull:trans_num"] == 13
    assert rep["ExpectColumnValuesToBeUnique:trans_num"] == 26
    assert rep["ExpectColumnValuesToNotBeNull:category"] == 12
    assert rep["ExpectColumnValuesToBeBetween:amt"] == 16
    assert rep["ExpectColumnValuesToBeBetween:lat"] == 14
    assert rep["ExpectColumnValuesToBeInSet:is_fraud"] == 15
    biz = business_report(d, "current_time_raw").first().asDict()
    assert biz["current_time_parseable"] == 13
    assert biz["not_null:lat"] == 16


def test_quarantine_partitions_rows(spark):
    d = view(spark, SF_SMALL, "transactions_dirty")
    good, bad = split_quarantine(d)
    assert good.count() + bad.count() == d.count()
    assert bad.where(F.size("dq_violations") == 0).count() == 0


def test_failed_expectations_name_the_values_that_break_them(spark):
    import pytest
    from tests.conftest import incoming_df, incoming_row
    from txguard.operators.quality import DataQualityError, unexpected_values, validate_incoming_transactions
    rows = [incoming_row(trans_num=f"t{i}", lat=95.0 if i < 3 else 91.5 if i < 4 else 10.0, is_fraud=i % 2 if i > 5 else 7) for i in range(8)]
    rows += [incoming_row(trans_num="t1"), incoming_row(trans_num=None), incoming_row(trans_num="x", merchant=None)]
    df = incoming_df(spark, rows)
    found = {}
    for r in unexpected_values(df).collect():
        found.setdefault(r["rule"], []).append((r["rank"], r["value"], r["n"]))
    assert sorted(found["ExpectColumnValuesToBeBetween:lat"]) == [(1, "95.0", 3), (2, "91.5", 1)]
    assert found["ExpectColumnValuesToBeUnique:trans_num"] == [(1, "t1", 2)] and found["ExpectColumnValuesToBeInSet:is_fraud"] == [(1, "7", 6)]
    assert found["ExpectColumnValuesToNotBeNull:trans_num"] == [(1, None, 1)]
    assert [r["value"] for r in unexpected_values(df, most=1).where("rule LIKE '%lat'").collect()] == ["95.0"]
    with pytest.raises(DataQualityError, match=r"95.0 \(3\), 91.5 \(1\)"):
        validate_incoming_transactions(df)

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from txguard.session import get_spark

    conf = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    s = get_spark("local[4]", "txguard-tests", conf)
    # tests only: a scratch checkpoint folder when the session names none
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        d = tempfile.mkdtemp(prefix="txguard-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def scratch(spark):
    from txguard.session import fresh_shared_path

    return fresh_shared_path(spark, "test")


def incoming_row(**overrides):
    """The reference's one-row incoming transaction, as a dict."""
    import datetime as dt

    row = {
        "cc_num": 123456789, "merchant": "fraud_Test Merchant", "category": "shopping_pos",
        "amt": 10.0, "first": "John", "last": "Doe", "gender": "M", "street": "1 Test Street",
        "city": "Paris", "state": "FR", "zip": 75000, "lat": 48.8566, "long": 2.3522,
        "city_pop": 2000000, "job": "Engineer", "dob": dt.date(1990, 1, 1), "trans_num": "tx_001",
        "merch_lat": 48.85, "merch_long": 2.35, "is_fraud": 0,
        "current_time": dt.datetime(2026, 6, 4, 10, 0, 0),
    }
    row.update(overrides)
    return row


def incoming_df(spark, rows):
    from txguard.schemas import TRANSACTION_SCHEMA

    names = [f.name for f in TRANSACTION_SCHEMA.fields]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], TRANSACTION_SCHEMA)

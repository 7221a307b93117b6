"""The registered queries against their statements; the learned ones by held-out
accuracy on the given labels (the pipeline: ``test_pipeline``)."""

from __future__ import annotations

import math

import duckdb
import pytest

import corpus_pipeline
from txguard.llm.common import table
from txguard.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in values), key=repr)


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_statement(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = db.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_a_row_per_document(spark, name):
    got = QUERIES[name](spark, SF)
    ids = sorted(r["doc_id"] for r in got.select("doc_id").collect())
    assert ids == sorted(r["doc_id"] for r in table(spark, SF, "documents").select("doc_id").collect())


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents").persist()
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        assert kept.exceptAll(docs).count() == 0, name
        docs = kept.persist()
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().join(docs, "doc_id", "left_anti").count() == 0
    tokens = corpus_pipeline.STAGES[4][1](spark, mixed, SF)
    assert tokens.count() == mixed.count()


@pytest.mark.parametrize("k", range(5))
def test_pipeline_stage_of_an_empty_table(spark, k):
    docs = table(spark, SF, "documents").limit(0)
    assert corpus_pipeline.STAGES[k][1](spark, docs, SF).count() == 0


@pytest.mark.parametrize("name, modulus, held, label, floor", [("op5_toxicity", 3, 1, "toxic", 0.94), ("op8_quality_qda", 5, 0, "quality", 0.9)])
def test_classifiers_hold_out_and_predict(spark, name, modulus, held, label, floor):
    import zlib

    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r[label] for r in table(spark, sf, "labels").collect() if r[label] is not None}
    rows = QUERIES[name](spark, sf).collect()
    threshold = {"toxic": 0.7, "quality": 0.3}[label]
    assert len(rows) == table(spark, sf, "documents").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    right = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    common = max(sum(labels.values()), len(labels) - sum(labels.values())) / len(labels)
    print(name, len(right), sum(right) / len(right), common)
    assert len(right) > 20 and sum(right) / len(right) >= floor > common


def test_languages_are_held_out_and_found(spark):
    import re
    import zlib

    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in table(spark, sf, "documents").collect()}
    rows = QUERIES["op6_language_id"](spark, sf).collect()
    learned = {d["lang"] for d in docs.values()} - {None}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        letters = re.search(r"[^\W\d_]", docs[r["doc_id"]]["text"] or "")
        assert r["lang_pred"] in learned if letters else r["lang_pred"] == "und"
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"]]
    print(len(right), sum(right) / len(right))
    assert len(rows) == len(docs) and sum(right) / len(right) > 0.95

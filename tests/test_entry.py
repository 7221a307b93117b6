from __future__ import annotations

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "message" in df.columns
    assert df.count() > 0


def library_queries():
    """The registered queries without those of the training-data operators,
    which have tests of their own."""
    return {k: f for k, f in E.queries().items() if k != "pipeline" and not k.startswith("op")}


def test_every_query_has_an_id_key_and_most_have_oracles():
    assert set(E.oracle_sql()) <= set(E.queries())
    q = library_queries()
    o = set(E.oracle_sql()) & set(q)
    assert len(q) >= 100
    for name in q:
        head = name.split("_")[0]
        assert head[0] in "spqjaoufmgtd" and head[1:].isdigit(), name
    # what a fit has learned has no SQL: test_retraining recomputes its metrics
    without = sorted(set(q) - set(o))
    assert without == ["m12_candidate_evaluation", "m7_logistic_regression", "m8_random_forest", "m9_boosted_trees"]


def test_plans_have_no_python_udf(spark):
    q = library_queries()
    for name in ["m10_predict_fraud", "f21_alert_message", "q20_expectation_results", "s1_parse_payload",
                 "a16_median_impute"]:
        plan = q[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_no_cross_joins_or_python_in_any_registered_plan(spark):
    """Plan hygiene over every registered query (MLlib training excluded: slow)."""
    bad_words = ["BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython",
                 "ArrowEvalPython"]
    bad = []
    for name, fn in library_queries().items():
        if name.startswith(("m7_", "m8_", "m9_")):
            continue
        plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        bad += [(name, w) for w in bad_words if w in plan]
    assert bad == []

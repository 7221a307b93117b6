from __future__ import annotations

from pyspark.sql import functions as F

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_MEDIUM, SF_SMALL
from txguard.fixtures import view
from txguard.operators.metrics import Evaluation, build_thresholds, long_scores
from txguard.operators.ranking import exact_medians

SCORES = {"champion": "champion_score", "challenger": "challenger_score"}


def _brute(y, p):
    """Exact AUC (ties share a step) and AP (step-wise) by enumeration."""
    y, p = np.asarray(y), np.asarray(p)
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    ap = 0.0
    for s in np.unique(p)[::-1]:
        sel = p >= s
        tp = (y[sel] == 1).sum()
        ap += ((y[p == s] == 1).sum() / len(pos)) * (tp / sel.sum())
    return auc, ap


def test_fixture_ap_auc_and_sweep(spark):
    ev = Evaluation(long_scores(view(spark, SF_SMALL, "scores"), SCORES))
    rk = {r["model"]: r for r in ev.ranking().collect()}
    assert abs(rk["champion"]["average_precision"] - 0.824685613) < 1e-9
    assert abs(rk["champion"]["roc_auc"] - 0.949171612) < 1e-9
    assert abs(rk["challenger"]["average_precision"] - 0.883228149) < 1e-9
    assert abs(rk["challenger"]["roc_auc"] - 0.973407298) < 1e-9
    sw = {(r["model"], r["threshold"]): r for r in ev.sweep(build_thresholds(0.9)).collect()}
    c = sw[("champion", 0.9)]
    assert (c["true_positives"], c["false_positives"], c["false_negatives"], c["true_negatives"]) == (42, 1, 160, 1297)


def test_fixture_sweep_sf001(spark):
    ev = Evaluation(long_scores(view(spark, SF_MEDIUM, "scores"), SCORES))
    sw = {(r["model"], r["threshold"]): r for r in ev.sweep(build_thresholds(0.9)).collect()}
    expect = {("champion", 0.5): (1675, 2235, 335, 10755), ("challenger", 0.95): (166, 7, 1844, 12983)}
    for k, v in expect.items():
        r = sw[k]
        assert (r["true_positives"], r["false_positives"], r["false_negatives"], r["true_negatives"]) == v


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30)), min_size=4, max_size=80))
def test_ap_auc_against_brute_force(spark, pairs):
    ys = [y for y, _ in pairs]
    if len(set(ys)) < 2:
        return
    rows = [("m", f"k{i}", y, s / 30.0) for i, (y, s) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "model string, trans_num string, label int, score double")
    r = Evaluation(df, n_ranges=3).ranking().first()
    auc, ap = _brute(ys, [s / 30.0 for _, s in pairs])
    assert abs(r["roc_auc"] - auc) < 1e-12
    assert abs(r["average_precision"] - ap) < 1e-12


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=60))
def test_exact_median_matches_numpy(spark, values):
    vals = [None if v is None else float(v) for v in values]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["feature"]: r["median"] for r in exact_medians(df, ["x"]).collect()}
    present = [v for v in vals if v is not None]
    if not present:
        assert "x" not in got
    else:
        assert got["x"] == float(np.median(present))


def test_metric_rows_names(spark):
    ev = Evaluation(long_scores(view(spark, SF_SMALL, "scores"), SCORES))
    names = {r["metric"] for r in ev.metric_rows(0.9).where("model = 'champion'").collect()}
    assert {"average_precision", "roc_auc", "precision_threshold_0_9", "f1_threshold_0_95",
            "production_recall", "production_true_positives"} <= names


def test_no_single_task_window_in_ranking_plan(spark, scratch):
    # stored first: the plan of the view itself counts two tables
    view(spark, SF_SMALL, "scores").write.parquet(scratch)
    ev = Evaluation(long_scores(spark.read.parquet(scratch), SCORES))
    plan = ev.ranking()._jdf.queryExecution().executedPlan().toString()
    # every window is partitioned by the range id (and the model)
    assert "SinglePartition" not in plan


def plain_ranking(rows):
    pos, neg = (sorted(s for s, y in rows if y == k) for k in (1, 0))
    import bisect
    auc = sum(bisect.bisect_left(neg, s) + (bisect.bisect_right(neg, s) - bisect.bisect_left(neg, s)) / 2 for s in pos) / (len(pos) * len(neg))
    every, ap = sorted({s for s, _ in rows}, reverse=True), 0.0
    for s in every:
        tp, n = len(pos) - bisect.bisect_left(pos, s), len(rows) - bisect.bisect_left(sorted(x for x, _ in rows), s)
        ap += (bisect.bisect_right(pos, s) - bisect.bisect_left(pos, s)) / len(pos) * tp / n
    return auc, ap


def test_ranking_over_distinct_scores_and_over_one_heavy_score(spark):
    import random
    rng = random.Random(6)
    distinct = [(rng.random() ** 3, int(rng.random() < 0.2)) for _ in range(900)]
    heavy = [(0.0, int(rng.random() < 0.05)) for _ in range(800)] + [(rng.random() * 1e-3, 1) for _ in range(60)] + [(float("inf"), 1), (-5.0, 0)]
    for rows in (distinct, heavy):
        df = spark.createDataFrame([("m", y, s) for s, y in rows], "model string, label int, score double").repartition(5)
        r = Evaluation(df, n_ranges=16).ranking().first()
        auc, ap = plain_ranking(rows)
        assert abs(r["roc_auc"] - auc) < 1e-9 and abs(r["average_precision"] - ap) < 1e-9


def test_ranges_follow_from_the_value_and_need_no_checkpoint(spark):
    import bisect
    from txguard.operators.ranking import RANGE_ID, range_bounds, range_of, valued_ranges
    df = spark.range(2000).selectExpr("'m' AS model", "CAST(id % 7 = 0 AS INT) AS label", "CAST(CASE WHEN id % 3 = 0 THEN 0.25 ELSE id / 1999.0 END AS DOUBLE) AS score")
    bounds = range_bounds(df, "score", 20)
    assert bounds == sorted(set(bounds)) and 20 <= len(bounds) <= 38
    got = df.selectExpr("score", f"{range_of('score', bounds)} AS r").collect()
    assert all(r["r"] == bisect.bisect_left(bounds, r["score"]) for r in got)
    sizes = [r["n"] for r in valued_ranges(df.select("score").distinct(), "score", bounds).groupBy(RANGE_ID).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * sum(sizes) / 20
    assert range_bounds(df.limit(0), "score", 20) == [] and range_bounds(df, "score", 1) == [] and range_of("score", []) == "0"
    plan = Evaluation(df).ranking()._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "rangepartitioning" not in plan


def test_medians_by_narrowing_brackets(spark, monkeypatch):
    import random
    import statistics
    from txguard.operators import ranking
    monkeypatch.setattr(ranking, "FEW", 300)
    rng = random.Random(3)
    n = 4001
    columns = {"normal": [rng.gauss(0, 1) for _ in range(n)], "ties": [float(rng.randrange(3)) for _ in range(n)], "one": [7.5] * n,
               "gaps": [None if i % 3 else float(i) for i in range(n)], "nans": [float("nan") if i % 2 else i / 7 for i in range(n)],
               "two": [0.0] * 2000 + [1.0] * 2000 + [None], "nothing": [None] * n, "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-200, 200) for _ in range(n)]}
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(4)
    got = {r["feature"]: r["median"] for r in ranking.exact_medians(df, list(columns)).collect()}
    want = {c: statistics.median(x for x in v if x is not None and x == x) for c, v in columns.items() if c != "nothing"}
    assert got == want
    # a sketch that is off is noticed, and the bracket widened
    monkeypatch.setattr(ranking, "SKETCH_K", 8)
    got = {r["feature"]: r["median"] for r in ranking.exact_medians(df, ["normal", "wide"]).collect()}
    assert got == {c: want[c] for c in ("normal", "wide")}

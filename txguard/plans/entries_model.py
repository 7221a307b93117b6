"""Registered queries: metrics (A3–A19, F22), preprocessing fits (M3, M4), split
(M6), candidates (M7–M9), evaluation/selection (M11, M12), registry and
promotion (J5, M13–M15, S12)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from txguard.operators.alerts import distance_all_null, predicted_frauds
from txguard.operators.features import prepare_features
from txguard.operators.metrics import (
    Evaluation, best_candidate, build_thresholds, class_counts, class_distribution, long_scores,
)
from txguard.operators.preprocess import category_dictionary, category_modes, fit_numeric
from txguard.operators.promotion import cd_decisions, decide
from txguard.operators.registry import ModelRegistry, champion_challenger_pairs, current_aliases
from txguard.operators.scoring import predict_fraud
from txguard.plans.catalog import V, dbl, r6, register, scored_cte
from txguard.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from txguard.session import fresh_shared_path
from txguard.sources import sinks
from txguard.sources.commits import Manifest

MODEL_NAME = "fraud_detection_model"
THRESHOLDS = build_thresholds(0.9)
SCORE_COLS = {"champion": "champion_score", "challenger": "challenger_score"}
ORDINALS = {"champion": 0, "challenger": 1}
VERSIONS = {"champion": 1, "challenger": 2}


def evaluation(spark, sf) -> Evaluation:
    return Evaluation(long_scores(V(spark, sf, "scores"), SCORE_COLS))


_THR_VALUES = ", ".join(f"({dbl(t)})" for t in THRESHOLDS)
_RATIO = "COALESCE(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0), 0.0)"


def ratio(n, d):
    return _RATIO.format(n=n, d=d)


METRIC_CTES = f"""ls AS (SELECT 'champion' AS model, trans_num, is_fraud AS label, champion_score AS score FROM scores
  UNION ALL SELECT 'challenger' AS model, trans_num, is_fraud AS label, challenger_score AS score FROM scores),
 hist AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM ls WHERE score IS NOT NULL GROUP BY model, score),
 cum AS (SELECT model, score, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
  CAST(sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cpos,
  CAST(sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cneg
  FROM hist),
 rk AS (SELECT model, sum(neg * (cpos - pos / 2.0)) / (sum(pos) * sum(neg)) AS roc_auc,
  sum(pos * cpos / (cpos + cneg)) / sum(pos) AS average_precision FROM cum GROUP BY model),
 tot AS (SELECT model, CAST(sum(pos) AS BIGINT) AS P, CAST(sum(neg) AS BIGINT) AS N FROM hist GROUP BY model),
 thr AS (SELECT t AS threshold FROM (VALUES {_THR_VALUES}) v(t)),
 sw AS (SELECT h.model, thr.threshold,
  CAST(sum(CASE WHEN h.score >= thr.threshold THEN pos ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN h.score >= thr.threshold THEN neg ELSE 0 END) AS BIGINT) AS fp
  FROM hist h CROSS JOIN thr GROUP BY h.model, thr.threshold),
 sweep AS (SELECT sw.model, threshold, tp, fp, P - tp AS fn, N - fp AS tn,
  {ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'P')} AS recall,
  {ratio('2 * tp', '2 * tp + fp + (P - tp)')} AS f1_score FROM sw JOIN tot USING (model)),
 dm0 AS (SELECT model, CAST(sum(CASE WHEN score > 0.5 THEN pos ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN score > 0.5 THEN neg ELSE 0 END) AS BIGINT) AS fp FROM hist GROUP BY model),
 dm AS (SELECT model, tp, fp, P - tp AS fn, N - fp AS tn,
  {ratio('tp + (N - fp)', 'P + N')} AS accuracy, {ratio('tp', 'tp + fp')} AS precision,
  {ratio('tp', 'P')} AS recall, {ratio('2 * tp', '2 * tp + fp + (P - tp)')} AS f1_score
  FROM dm0 JOIN tot USING (model)),
 summ AS (SELECT model, accuracy, precision, recall, f1_score, roc_auc, average_precision,
  CASE model WHEN 'champion' THEN 0 ELSE 1 END AS ordinal,
  CASE model WHEN 'champion' THEN 1 ELSE 2 END AS version FROM dm JOIN rk USING (model))"""

METRIC_ROWS_CTE = """mrows AS (
 SELECT model, metric, value FROM summ UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1_score, roc_auc, average_precision))
 UNION ALL SELECT model, stem || '_threshold_' || replace(CAST(threshold AS VARCHAR), '.', '_') AS metric, value FROM (
  SELECT model, threshold, 'precision' AS stem, precision AS value FROM sweep
  UNION ALL SELECT model, threshold, 'recall', recall FROM sweep
  UNION ALL SELECT model, threshold, 'f1', f1_score FROM sweep
  UNION ALL SELECT model, threshold, 'false_positives', CAST(fp AS DOUBLE) FROM sweep
  UNION ALL SELECT model, threshold, 'false_negatives', CAST(fn AS DOUBLE) FROM sweep
  UNION ALL SELECT model, threshold, 'true_positives', CAST(tp AS DOUBLE) FROM sweep) s
 UNION ALL SELECT model, metric, value FROM (
  SELECT model, 'production_precision' AS metric, precision AS value FROM sweep WHERE threshold = 0.9
  UNION ALL SELECT model, 'production_recall', recall FROM sweep WHERE threshold = 0.9
  UNION ALL SELECT model, 'production_f1_score', f1_score FROM sweep WHERE threshold = 0.9
  UNION ALL SELECT model, 'production_false_positives', CAST(fp AS DOUBLE) FROM sweep WHERE threshold = 0.9
  UNION ALL SELECT model, 'production_false_negatives', CAST(fn AS DOUBLE) FROM sweep WHERE threshold = 0.9
  UNION ALL SELECT model, 'production_true_positives', CAST(tp AS DOUBLE) FROM sweep WHERE threshold = 0.9) p)"""


# ------------------------------------------------------------------ classification metrics

@register("a3_class_distribution", """SELECT is_fraud AS label, count(*) AS n,
 round(count(*) / sum(count(*)) OVER (), 6) AS share FROM transactions GROUP BY is_fraud""")
def a3(spark, sf):
    d = class_distribution(V(spark, sf, "transactions"))
    return d.select("label", "n", r6("share").alias("share"))


@register("a4_imbalance_ratio", """SELECT count(*) FILTER (WHERE is_fraud = 0) AS negatives,
 count(*) FILTER (WHERE is_fraud = 1) AS positives,
 round(CAST(count(*) FILTER (WHERE is_fraud = 0) AS DOUBLE) / count(*) FILTER (WHERE is_fraud = 1), 6) AS ratio
FROM transactions""")
def a4(spark, sf):
    c = class_counts(V(spark, sf, "transactions"))
    return c.select("negatives", "positives", r6("ratio").alias("ratio"))


@register("a5_all_null_check", f"""WITH {scored_cte()}
SELECT count(CAST(NULL AS DOUBLE)) AS n_non_null, count(CAST(NULL AS DOUBLE)) = 0 AS all_null
FROM scored2 WHERE is_fraud_predicted = 1""")
def a5(spark, sf):
    frauds = predicted_frauds(predict_fraud(V(spark, sf, "transactions")))
    return distance_all_null(frauds)


@register("a6_confusion_matrix", f"WITH {METRIC_CTES} SELECT model, tn, fp, fn, tp FROM dm")
def a6(spark, sf):
    return evaluation(spark, sf).default().select("model", "tn", "fp", "fn", "tp")


def _one_metric(metric, source):
    def fn(spark, sf):
        ev = evaluation(spark, sf)
        df = ev.default() if source == "dm" else ev.ranking()
        return df.select("model", r6(metric).alias(metric))
    return fn, f"WITH {METRIC_CTES} SELECT model, round({metric}, 6) AS {metric} FROM {source}"


for _id, _m, _src in [("a7", "accuracy", "dm"), ("a8", "precision", "dm"), ("a9", "recall", "dm"),
                      ("a10", "f1_score", "dm"), ("a11", "roc_auc", "rk"),
                      ("a12", "average_precision", "rk")]:
    _fn, _sql = _one_metric(_m, _src)
    register(f"{_id}_{_m}", _sql)(_fn)


@register("a13_threshold_sweep", f"""WITH {METRIC_CTES}
SELECT model, threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
 round(f1_score, 6) AS f1_score, tn AS true_negatives, fp AS false_positives, fn AS false_negatives,
 tp AS true_positives FROM sweep""")
def a13(spark, sf):
    s = evaluation(spark, sf).sweep(THRESHOLDS)
    return s.select("model", "threshold", *[r6(c).alias(c) for c in ("precision", "recall", "f1_score")],
                    "true_negatives", "false_positives", "false_negatives", "true_positives")


_REPORT_SQL = f"""WITH {METRIC_CTES},
 c AS (SELECT model, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn,
  CAST(tn AS DOUBLE) AS tn FROM dm),
 k AS (SELECT model,
  {ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0, {ratio('2 * tn', '2 * tn + fn + fp')} AS f0, tn + fp AS s0,
  {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1, {ratio('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS s1,
  {ratio('tp + tn', 'tp + fp + fn + tn')} AS acc, tp + fp + fn + tn AS n FROM c),
 rep AS (
  SELECT model, '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM k
  UNION ALL SELECT model, '1', p1, r1, f1, s1 FROM k
  UNION ALL SELECT model, 'accuracy', acc, acc, acc, n FROM k
  UNION ALL SELECT model, 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, n FROM k
  UNION ALL SELECT model, 'weighted avg', {ratio('p0 * s0 + p1 * s1', 'n')}, {ratio('r0 * s0 + r1 * s1', 'n')},
   {ratio('f0 * s0 + f1 * s1', 'n')}, n FROM k)
SELECT model, class_label, round(precision, 6) AS precision, round(recall, 6) AS recall,
 round(f1_score, 6) AS f1_score, round(support, 6) AS support FROM rep"""


@register("a14_classification_report", _REPORT_SQL)
def a14(spark, sf):
    r = evaluation(spark, sf).report()
    return r.select("model", "class_label", *[r6(c).alias(c) for c in ("precision", "recall", "f1_score", "support")])


@register("a15_best_candidate", f"""WITH {METRIC_CTES}
SELECT model, ordinal, round(average_precision, 6) AS average_precision FROM summ
ORDER BY average_precision DESC, ordinal ASC LIMIT 1""")
def a15(spark, sf):
    rk = evaluation(spark, sf).ranking()
    ords = F.when(F.col("model") == "champion", 0).otherwise(1)
    best = best_candidate(rk.select("model", ords.alias("ordinal"), "average_precision"))
    return best.select("model", "ordinal", r6("average_precision").alias("average_precision"))


_DEFAULT_THR_SQL = ", ".join(f"({dbl(t)})" for t in [0.5, 0.6, 0.7, 0.8, 0.9, 0.95])


@register("o2_threshold_set", f"""WITH {scored_cte()}
SELECT array_to_string(list_sort(list_distinct(list(t))), ',') AS thresholds FROM (
 SELECT t FROM (VALUES {_DEFAULT_THR_SQL}) v(t) UNION ALL SELECT DISTINCT fraud_alert_threshold FROM scored2) x""")
def o2(spark, sf):
    from txguard.operators.metrics import thresholds_union
    return thresholds_union(predict_fraud(V(spark, sf, "transactions"))).select(
        F.array_join(F.transform("thresholds", lambda t: t.cast("string")), ",").alias("thresholds"))


@register("u2_threshold_union", f"""WITH {scored_cte()}
SELECT DISTINCT t AS threshold FROM (SELECT t FROM (VALUES {_DEFAULT_THR_SQL}) v(t)
 UNION ALL SELECT fraud_alert_threshold FROM scored2) x""")
def u2(spark, sf):
    from txguard.operators.metrics import thresholds_union
    return thresholds_union(predict_fraud(V(spark, sf, "transactions"))).select(
        F.explode("thresholds").alias("threshold"))


# ------------------------------------------------------------------ preprocessing fits

_NUM_LIST = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in NUMERIC_FEATURES)
_NUM_IN = ", ".join(f'"{c}"' for c in NUMERIC_FEATURES)
_NUM_CTE = f"""{scored_cte()},
 nums AS (SELECT {_NUM_LIST} FROM feat),
 lng AS (SELECT feature, value FROM nums UNPIVOT INCLUDE NULLS (value FOR feature IN ({_NUM_IN}))),
 med AS (SELECT feature, median(value) AS median FROM lng GROUP BY feature),
 imp AS (SELECT l.feature, COALESCE(l.value, m.median) AS value, m.median FROM lng l JOIN med m USING (feature)),
 fit AS (SELECT feature, any_value(median) AS median, avg(value) AS mean,
  CASE WHEN stddev_pop(value) = 0 OR stddev_pop(value) IS NULL THEN 1.0 ELSE stddev_pop(value) END AS scale
  FROM imp GROUP BY feature)"""


def _numeric_fit(spark, sf):
    feats = prepare_features(V(spark, sf, "transactions"))
    return fit_numeric(feats, NUMERIC_FEATURES)


@register("a16_median_impute", f"WITH {_NUM_CTE} SELECT feature, round(median, 6) AS median FROM fit")
def a16(spark, sf):
    from txguard.operators.ranking import exact_medians
    feats = prepare_features(V(spark, sf, "transactions"))
    return exact_medians(feats, NUMERIC_FEATURES).select("feature", r6("median").alias("median"))


@register("a18_scaler_fit", f"""WITH {_NUM_CTE}
SELECT feature, round(mean, 6) AS mean, round(scale, 6) AS scale FROM fit""")
def a18(spark, sf):
    return _numeric_fit(spark, sf).select("feature", r6("mean").alias("mean"), r6("scale").alias("scale"))


@register("m3_numeric_transformer", f"""WITH {_NUM_CTE}
SELECT feature, round(median, 6) AS median, round(mean, 6) AS mean, round(scale, 6) AS scale FROM fit""")
def m3(spark, sf):
    return _numeric_fit(spark, sf).select("feature", *[r6(c).alias(c) for c in ("median", "mean", "scale")])


_CAT_LIST = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in CATEGORICAL_FEATURES)
_CAT_CTE = f"""cats AS (SELECT trans_num, {_CAT_LIST} FROM transactions),
 clng AS (UNPIVOT cats ON {', '.join(CATEGORICAL_FEATURES)} INTO NAME feature VALUE value),
 cnt AS (SELECT feature, value, count(*) AS n FROM clng GROUP BY feature, value),
 modes AS (SELECT feature, value AS mode FROM (SELECT *, row_number() OVER (PARTITION BY feature
  ORDER BY n DESC, value ASC) AS rn FROM cnt) x WHERE rn = 1),
 dict AS (SELECT feature, value, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY value) - 1 AS BIGINT) AS idx
  FROM (SELECT DISTINCT feature, value FROM clng) d)"""


@register("a17_mode_impute", f"WITH {_CAT_CTE} SELECT feature, mode FROM modes")
def a17(spark, sf):
    return category_modes(V(spark, sf, "transactions"), CATEGORICAL_FEATURES)


@register("a19_category_dictionary", f"WITH {_CAT_CTE} SELECT feature, value, idx AS \"index\" FROM dict")
def a19(spark, sf):
    return category_dictionary(V(spark, sf, "transactions"), CATEGORICAL_FEATURES)


@register("m4_categorical_transformer", f"""WITH {_CAT_CTE}
SELECT c.trans_num, """ + ", ".join(
    f"CAST((SELECT idx FROM dict WHERE feature = '{f}' AND value = c.{f}) AS DOUBLE) AS {f}_idx"
    for f in CATEGORICAL_FEATURES) + " FROM cats c")
def m4(spark, sf):
    t = V(spark, sf, "transactions")
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc",
                              handleInvalid="keep") for c in CATEGORICAL_FEATURES]
    model = Pipeline(stages=indexers).fit(t)
    return model.transform(t).select("trans_num", *[f"{c}_idx" for c in CATEGORICAL_FEATURES])


# the same fits over rows with missing values, NaN and ties
_GAPS = ["amt", "lat", "long", "zip", "city_pop", "thousands", "nothing"]
_GAPS_SQL = """gaps AS (SELECT CASE WHEN CAST(trans_num AS BIGINT) % 179 = 0 THEN 'nan'::DOUBLE ELSE amt END AS amt, lat, "long", zip, city_pop,
  floor(amt / 1000) AS thousands, NULL::DOUBLE AS nothing FROM transactions_dirty),
 lng AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CASE WHEN isnan(CAST(\"{c}\" AS DOUBLE)) THEN NULL ELSE CAST(\"{c}\" AS DOUBLE) END AS value FROM gaps" for c in _GAPS) + """),
 med AS (SELECT feature, median(value) AS median FROM lng GROUP BY feature),
 imp AS (SELECT lng.feature, coalesce(value, median) AS value, median FROM lng JOIN med USING (feature))"""


@register("m3_missing_values", f"""WITH {_GAPS_SQL}
SELECT feature, round(any_value(median), 6) AS median, round(avg(value), 6) AS mean,
 round(CASE WHEN stddev_pop(value) > 0 THEN stddev_pop(value) ELSE 1.0 END, 6) AS scale FROM imp GROUP BY feature""")
def m3_gaps(spark, sf):
    d = V(spark, sf, "transactions_dirty")
    d = d.select(F.when(F.col("trans_num").cast("bigint") % 179 == 0, F.lit(float("nan"))).otherwise(F.col("amt")).alias("amt"),
                 "lat", "long", "zip", "city_pop", F.floor(F.col("amt") / 1000).alias("thousands"), F.lit(None).cast("double").alias("nothing"))
    return fit_numeric(d, _GAPS).select("feature", *[r6(c).alias(c) for c in ("median", "mean", "scale")])


_DIRTY_CATS = list(CATEGORICAL_FEATURES)
_DIRTY_FIT = "merchant NOT LIKE '%7' AND (job IS NULL OR job <> 'MACHINERY')"
_DIRTY_CAT_CTE = f"""fitted AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM transactions_dirty WHERE {_DIRTY_FIT}" for c in _DIRTY_CATS)}),
 modes AS (SELECT feature, arg_max(value, (n, -r)) AS mode FROM (SELECT feature, value, count(*) AS n, row_number() OVER (PARTITION BY feature ORDER BY value) AS r
  FROM fitted WHERE value IS NOT NULL GROUP BY feature, value) GROUP BY feature),
 dict AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS idx
  FROM (SELECT DISTINCT feature, value FROM fitted WHERE value IS NOT NULL))"""


@register("a17_mode_missing_values", f"WITH {_DIRTY_CAT_CTE} SELECT feature, mode FROM modes")
def a17_gaps(spark, sf):
    return category_modes(V(spark, sf, "transactions_dirty").where(_DIRTY_FIT), _DIRTY_CATS)


_OFFSET = lambda c: " + ".join(["0", *[f"(SELECT count(*) FROM dict WHERE feature = '{p}')" for p in _DIRTY_CATS[:_DIRTY_CATS.index(c)]]])


@register("m4_one_hot", f"""WITH {_DIRTY_CAT_CTE},
 places AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, value, idx + {_OFFSET(c)} AS place FROM dict WHERE feature = '{c}'" for c in _DIRTY_CATS)}),
 r AS (SELECT trans_num, copy_no, row_number() OVER () AS k, * EXCLUDE (trans_num, copy_no) FROM transactions_dirty),
 v AS ({" UNION ALL ".join(f"SELECT k, trans_num, copy_no, '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), (SELECT mode FROM modes WHERE feature = '{c}')) AS value FROM r" for c in _DIRTY_CATS)})
SELECT trans_num, copy_no, coalesce(string_agg(place, ',' ORDER BY place), '') AS one_hot FROM v LEFT JOIN places USING (feature, value) GROUP BY k, trans_num, copy_no""")
def m4_one_hot(spark, sf):
    """Places of the ones of every row, missing values imputed, categories the
    fit has not seen (one job, every tenth merchant) without one."""
    from txguard.operators.preprocess import fit_categories
    d = V(spark, sf, "transactions_dirty")
    encoded = fit_categories(d.where(_DIRTY_FIT), _DIRTY_CATS).one_hot(d.select("trans_num", "copy_no", *_DIRTY_CATS))
    return encoded.select("trans_num", "copy_no", F.array_join(F.transform(F.array_sort("one_hot"), lambda x: x.cast("string")), ",").alias("one_hot"))


_SPLIT_SQL = """SELECT trans_num, is_fraud, row_number() OVER (PARTITION BY is_fraud ORDER BY md5(trans_num))
 <= round(0.2 * count(*) OVER (PARTITION BY is_fraud)) AS is_test FROM transactions"""


@register("m6_stratified_split", _SPLIT_SQL)
def m6(spark, sf):
    from txguard.operators.models import with_test_flag
    return with_test_flag(V(spark, sf, "transactions").select("trans_num", "is_fraud"))


# ------------------------------------------------------------------ candidate models (no SQL: fits)

def _candidate_query(name):
    def fn(spark, sf):
        from txguard.operators.models import fit_candidates
        _fits, scored = fit_candidates(V(spark, sf, "transactions"), include_boosted=True, only=[name])
        return scored.select("trans_num", "label", F.col("score").alias("fraud_probability"))
    return fn


register("m7_logistic_regression")(_candidate_query("logistic_regression_balanced"))
register("m8_random_forest")(_candidate_query("random_forest_balanced"))
register("m9_boosted_trees")(_candidate_query("xgboost_weighted"))


@register("m12_candidate_evaluation")
def m12_fits(spark, sf):
    """A whole training run: the metrics of every fitted candidate, as stored,
    and which of them is registered."""
    from txguard.plans.retraining import train_challenger
    registry = ModelRegistry(spark, fresh_shared_path(spark, "registry"))
    done = train_challenger(spark, V(spark, sf, "transactions"), registry, MODEL_NAME, "run-1")
    return registry.table("candidate_metrics").select(
        "candidate", "metric", "value", (F.col("candidate") == F.lit(done["candidate"])).alias("registered"))


# ------------------------------------------------------------------ evaluation, registry, promotion

@register("m11_candidate_metrics", f"WITH {METRIC_CTES}, {METRIC_ROWS_CTE} SELECT model, metric, round(value, 6) AS value FROM mrows")
def m11(spark, sf):
    rows = evaluation(spark, sf).metric_rows(0.9, THRESHOLDS)
    return rows.select("model", "metric", r6("value").alias("value"))


@register("f22_metric_names", f"""WITH {METRIC_CTES}, {METRIC_ROWS_CTE}
SELECT model, metric FROM mrows WHERE metric LIKE '%threshold%'""")
def f22(spark, sf):
    rows = evaluation(spark, sf).metric_rows(0.9, THRESHOLDS)
    return rows.where(F.col("metric").contains("threshold")).select("model", "metric")


@register("m12_candidate_selection", f"""WITH {METRIC_CTES},
 best AS (SELECT model FROM summ ORDER BY average_precision DESC, ordinal ASC LIMIT 1)
SELECT s.model, s.ordinal, round(s.average_precision, 6) AS average_precision,
 s.model = (SELECT model FROM best) AS selected FROM summ s""")
def m12(spark, sf):
    rk = evaluation(spark, sf).ranking()
    ords = F.when(F.col("model") == "champion", 0).otherwise(1)
    summary = rk.select("model", ords.alias("ordinal"), "average_precision")
    best = best_candidate(summary).select(F.col("model").alias("_best"))
    return summary.join(best, how="left", on=summary["model"] == best["_best"]).select(
        "model", "ordinal", r6("average_precision").alias("average_precision"),
        F.col("_best").isNotNull().alias("selected"))


def registry_tables(spark, sf):
    """``model_metrics`` and ``model_alias_events`` derived from the evaluation:
    version 1 is the champion, version 2 the registered challenger."""
    ev = evaluation(spark, sf)
    rows = ev.metric_rows(0.9, THRESHOLDS)
    version = F.when(F.col("model") == "champion", 1).otherwise(2).cast("long")
    # the registered name is a per-row value (as in a real registry table), not a
    # literal that Catalyst would fold away from the pairing's join key
    name = F.when(F.col("model").isNotNull(), F.lit(MODEL_NAME))
    metrics = rows.select(name.alias("model_name"), version.alias("version"), "metric", "value")
    models = ev.hist.select("model").distinct()     # from the pinned histogram: no metric recompute
    events = models.select(name.alias("model_name"), F.col("model").alias("alias"),
                           version.alias("version"), F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("at"),
                           version.alias("seq"))
    return metrics, events


_PAIR_SQL = f"""{METRIC_CTES},
 prod AS (SELECT model, precision AS production_precision, recall AS production_recall FROM sweep WHERE threshold = 0.9),
 side AS (SELECT s.model, s.version, s.average_precision, p.production_recall, p.production_precision
  FROM summ s JOIN prod p USING (model)),
 pairs AS (SELECT '{MODEL_NAME}' AS model_name, c.version AS champion_version, h.version AS challenger_version,
  c.average_precision AS champion_average_precision, h.average_precision AS challenger_average_precision,
  c.production_recall AS champion_production_recall, h.production_recall AS challenger_production_recall,
  c.production_precision AS champion_production_precision, h.production_precision AS challenger_production_precision
  FROM side c, side h WHERE c.model = 'champion' AND h.model = 'challenger'),
 dec AS (SELECT *,
  challenger_average_precision >= champion_average_precision + {dbl(0.01)} AS ap_ok,
  challenger_production_recall >= champion_production_recall - {dbl(0.02)} AS rec_ok,
  challenger_production_precision >= champion_production_precision + {dbl(0.01)} AS prec_ok FROM pairs),
 dec2 AS (SELECT *, ap_ok AND rec_ok AND prec_ok AS promoted,
  CASE WHEN NOT ap_ok THEN 'Challenger non promu : amélioration insuffisante de average_precision.'
   WHEN NOT rec_ok THEN 'Challenger non promu : dégradation trop importante du recall fraude au seuil de production.'
   WHEN NOT prec_ok THEN 'Challenger non promu : amélioration insuffisante de la precision fraude au seuil de production.'
   ELSE 'Challenger promu : critères de promotion satisfaits.' END AS decision_reason FROM dec)"""


def _pairs(spark, sf):
    metrics, events = registry_tables(spark, sf)
    return champion_challenger_pairs(events, metrics)


_PAIR_COLS = ["champion_average_precision", "challenger_average_precision", "champion_production_recall",
              "challenger_production_recall", "champion_production_precision", "challenger_production_precision"]


@register("j5_champion_challenger", f"""WITH {_PAIR_SQL}
SELECT model_name, champion_version, challenger_version, """ + ", ".join(
    f"round({c}, 6) AS {c}" for c in _PAIR_COLS) + " FROM pairs")
def j5(spark, sf):
    p = _pairs(spark, sf)
    return p.select("model_name", "champion_version", "challenger_version", *[r6(c).alias(c) for c in _PAIR_COLS])


@register("m14_promotion_rule", f"WITH {_PAIR_SQL} SELECT model_name, promoted, decision_reason FROM dec2")
def m14(spark, sf):
    return decide(_pairs(spark, sf)).select("model_name", "promoted", "decision_reason")


_DECISION_SQL = f"""WITH {_PAIR_SQL}
SELECT model_name, CAST(champion_version AS VARCHAR) AS champion_version,
 CAST(challenger_version AS VARCHAR) AS challenger_version,
 round(champion_average_precision, 6) AS champion_average_precision,
 round(challenger_average_precision, 6) AS challenger_average_precision,
 round(champion_production_recall, 6) AS champion_recall_fraud,
 round(challenger_production_recall, 6) AS challenger_recall_fraud,
 round(champion_production_precision, 6) AS champion_precision_fraud,
 round(challenger_production_precision, 6) AS challenger_precision_fraud,
 promoted, decision_reason FROM dec2"""

_DECISION_FLOATS = ["champion_average_precision", "challenger_average_precision", "champion_recall_fraud",
                    "challenger_recall_fraud", "champion_precision_fraud", "challenger_precision_fraud"]


def _decision_out(df):
    return df.select(*[r6(c).alias(c) if c in _DECISION_FLOATS else F.col(c) for c in
                       ["model_name", "champion_version", "challenger_version", *_DECISION_FLOATS,
                        "promoted", "decision_reason"]])


@register("m15_cd_decision", _DECISION_SQL)
def m15(spark, sf):
    return _decision_out(cd_decisions(decide(_pairs(spark, sf))))


@register("s12_decision_sink", _DECISION_SQL)
def s12(spark, sf):
    path = fresh_shared_path(spark, "model_cd_decisions")
    sinks.store_decisions(cd_decisions(decide(_pairs(spark, sf))), path, "b1")
    return _decision_out(spark.read.parquet(path))


@register("g7_promotion_events", f"""WITH {_PAIR_SQL}
SELECT model_name, 'champion' AS alias, CAST(challenger_version AS BIGINT) AS version FROM dec2 WHERE promoted""")
def g7(spark, sf):
    from txguard.plans.retraining import promotion_events
    metrics, events = registry_tables(spark, sf)
    decided = decide(champion_challenger_pairs(events, metrics))
    return promotion_events(decided).select("model_name", "alias", "version")


@register("m13_current_alias", f"""WITH {_PAIR_SQL}
SELECT model_name, 'champion' AS alias, CAST(CASE WHEN promoted THEN challenger_version ELSE champion_version END AS BIGINT) AS version FROM dec2
UNION ALL SELECT model_name, 'challenger' AS alias, CAST(challenger_version AS BIGINT) AS version FROM dec2""")
def m13(spark, sf):
    from txguard.plans.retraining import promotion_events
    metrics, events = registry_tables(spark, sf)
    decided = decide(champion_challenger_pairs(events, metrics))
    after = events.unionByName(promotion_events(decided, Manifest(99)))
    return current_aliases(after)


@register("g7_promotion_job", f"""WITH {_PAIR_SQL}
SELECT model_name, CAST(champion_version AS VARCHAR) AS champion_version, CAST(challenger_version AS VARCHAR) AS challenger_version,
 promoted, decision_reason, CAST(1 AS BIGINT) AS n_decisions,
 CAST(CASE WHEN promoted THEN challenger_version ELSE champion_version END AS BIGINT) AS champion_now,
 CAST(challenger_version AS BIGINT) AS challenger_now, CASE WHEN promoted THEN CAST(challenger_version AS BIGINT) END AS in_production FROM dec2""")
def g7_job(spark, sf):
    """The promotion job twice on one registry; decisions, aliases and exports
    as its readers see them then."""
    from txguard.plans.retraining import compare_and_promote
    metrics, events = registry_tables(spark, sf)
    registry = ModelRegistry(spark, fresh_shared_path(spark, "registry"))
    log = registry.log
    measured = registry.stage(metrics, "model_metrics")
    versions = registry.staged("model_metrics", measured).select("model_name", "version").distinct().select(
        "*", F.lit("seed").alias("run_id"), F.concat(F.lit("v"), "version").alias("candidate"),
        F.lit(log.path(measured)).alias("model_uri"), F.current_timestamp().cast("timestamp_ntz").alias("registered_at"))
    log.commit(log.latest(), "seed", {"model_metrics": [measured], "alias_events": [registry.stage(events.withColumn("seq", F.lit(0).cast("long")), "alias_events")],
                                      "model_versions": [registry.stage(versions, "model_versions")]})
    for _ in range(2):
        compare_and_promote(spark, registry, "b1")
    at = log.latest()
    decisions = registry.table("decisions", at)
    aliases = registry.aliases(at).groupBy("model_name").pivot("alias", ["champion", "challenger"]).agg(F.first("version"))
    n = decisions.groupBy("model_name").agg(F.count(F.lit(1)).alias("n_decisions"))
    live = registry.production(at).select("model_name", F.col("version").alias("in_production"))
    return decisions.join(n, "model_name").join(aliases, "model_name").join(live, "model_name", "left").select(
        "model_name", "champion_version", "challenger_version", "promoted", "decision_reason", "n_decisions",
        F.col("champion").alias("champion_now"), F.col("challenger").alias("challenger_now"), "in_production")

"""Model-quality metrics (A3, A4, A6–A15, F22) as DataFrame aggregations.

Everything is computed per model (``group_cols``) from one **score
histogram**: a row per ``(model, distinct score)`` with its positive and
negative counts.  The raw scored rows are scanned and shuffled once (the
histogram is partially aggregated map-side); the threshold sweep, the
default-threshold confusion matrix and the exact ROC AUC / average precision
all read the histogram.

AUC and AP need counts accumulated from the highest score down; they come
from ``ranking.running_sums`` over the histogram cut into ranges of score
(no single-task window); the other metrics read the histogram as it is, with
no second shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard.functions.formatting import threshold_label
from txguard.schemas import DEFAULT_ALERT_THRESHOLD, DEFAULT_THRESHOLDS
from txguard.operators.ranking import range_bounds, running_sums, valued_ranges


def build_thresholds(production_threshold: float = DEFAULT_ALERT_THRESHOLD,
                     defaults: Sequence[float] = DEFAULT_THRESHOLDS) -> list[float]:
    """Sorted set of the default thresholds and the production one."""
    return sorted(set(float(t) for t in defaults) | {float(production_threshold)})


def thresholds_column(production_threshold: float = DEFAULT_ALERT_THRESHOLD,
                      defaults: Sequence[float] = DEFAULT_THRESHOLDS) -> Column:
    """O2/U2 as a column: ``array_sort(array_union(defaults, [production]))``."""
    base = F.array(*[F.lit(float(t)) for t in defaults])
    return F.array_sort(F.array_distinct(F.array_union(base, F.array(F.lit(float(production_threshold))))))


def thresholds_union(predictions: DataFrame, defaults: Sequence[float] = DEFAULT_THRESHOLDS,
                     column: str = "fraud_alert_threshold") -> DataFrame:
    """O2 + U2 over data: the default thresholds united with every production
    threshold found in ``predictions``, sorted and distinct (one row, one array)."""
    base = F.array(*[F.lit(float(t)) for t in defaults])
    return predictions.agg(F.collect_set(F.col(column).cast("double")).alias("_p")).select(
        F.array_sort(F.array_union(base, F.col("_p"))).alias("thresholds"))


def _safe_ratio(num: Column, den: Column) -> Column:
    """``zero_division=0``."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def long_scores(df: DataFrame, score_cols: dict[str, str], key: str = "trans_num",
                label_col: str = "is_fraud") -> DataFrame:
    """Wide score columns -> ``(model, key, label, score)`` rows."""
    pairs = ", ".join(f"'{m}', `{c}`" for m, c in score_cols.items())
    return df.selectExpr(key, f"CAST(`{label_col}` AS INT) AS label",
                         f"stack({len(score_cols)}, {pairs}) AS (model, score)") \
        .select("model", key, "label", F.col("score").cast("double").alias("score"))


def score_histogram(scored: DataFrame, group_cols: Sequence[str] = ("model",),
                    label_col: str = "label", score_col: str = "score") -> DataFrame:
    """``(group..., score, pos, neg)`` — one row per distinct score.  A NULL or
    NaN score, or a label other than 0 and 1, is an error; ``unscorable`` counts
    such rows for a caller who wants to set them aside first."""
    y = F.col(label_col)
    refused = F.raise_error(F.lit("metrics: a score is NULL or NaN, or a label is not 0 or 1")).cast("double")
    s = F.when(_scorable(label_col, score_col), F.col(score_col).cast("double")).otherwise(refused)
    return scored.groupBy(*group_cols, s.alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))


def _scorable(label_col: str, score_col: str) -> Column:
    s = F.col(score_col)
    return F.coalesce(s.isNotNull() & ~F.isnan(s) & F.col(label_col).isin(0, 1), F.lit(False))


def unscorable(scored: DataFrame, group_cols: Sequence[str] = ("model",),
               label_col: str = "label", score_col: str = "score") -> DataFrame:
    """Rows per group that no metric is defined for: ``(group..., n, n_unscorable)``."""
    return scored.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~_scorable(label_col, score_col)).alias("n_unscorable"))


def scorable(scored: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    return scored.where(_scorable(label_col, score_col))


def cumulative_from_top(ranged: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Add ``cpos``/``cneg``: counts over scores >= this score, per group."""
    return running_sums(ranged, group_cols, "score", ["pos", "neg"], descending=True)


def ranking_metrics(cum: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """A11 ROC AUC (ties share a trapezoid step) and A12 average precision
    (Σ ΔRecall·Precision over distinct scores, highest first)."""
    pos, neg = F.col("pos"), F.col("neg")
    # neg * (cpos - pos/2) is a multiple of 1/2: the sum is exact in doubles
    auc_num = F.sum(neg.cast("double") * (F.col("cpos") - pos / F.lit(2.0)))
    ap_num = F.sum(pos.cast("double") * F.col("cpos") / (F.col("cpos") + F.col("cneg")))
    p_tot, n_tot = F.sum(pos), F.sum(neg)
    return cum.groupBy(*group_cols).agg(
        F.try_divide(auc_num, (p_tot * n_tot).cast("double")).alias("roc_auc"),
        F.try_divide(ap_num, p_tot.cast("double")).alias("average_precision"))


def _confusion(hist: DataFrame, group_cols, cuts: list[tuple[str, Column]]) -> DataFrame:
    """For each named cut (a predicate on ``score``): tp, fp, fn, tn per group."""
    exprs = [F.sum("pos").alias("_P"), F.sum("neg").alias("_N")]
    for name, pred in cuts:
        exprs.append(F.sum(F.when(pred, F.col("pos")).otherwise(0)).alias(f"tp_{name}"))
        exprs.append(F.sum(F.when(pred, F.col("neg")).otherwise(0)).alias(f"fp_{name}"))
    return hist.groupBy(*group_cols).agg(*exprs)


def _rates(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {
        "precision": _safe_ratio(tp, tp + fp),
        "recall": _safe_ratio(tp, tp + fn),
        "f1_score": _safe_ratio(2 * tp, 2 * tp + fp + fn),
    }


def threshold_sweep(hist: DataFrame, thresholds: Sequence[float],
                    group_cols: Sequence[str] = ("model",)) -> DataFrame:
    """Per threshold ``p >= t``: precision, recall, F1 and tn/fp/fn/tp.

    Computed from the histogram with one conditional aggregate per threshold
    (no row multiplication), then unpivoted."""
    g = list(group_cols)
    ts = [float(t) for t in thresholds]
    cuts = [(str(i), F.col("score") >= F.lit(t)) for i, t in enumerate(ts)]
    wide = _confusion(hist, g, cuts)
    stack = ", ".join(f"CAST({t!r} AS DOUBLE), tp_{i}, fp_{i}" for i, t in enumerate(ts))
    long = wide.selectExpr(*[f"`{c}`" for c in g], "_P", "_N",
                           f"stack({len(ts)}, {stack}) AS (threshold, tp, fp)")
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("_P") - tp, F.col("_N") - fp
    return long.select(
        *g, "threshold", *[v.alias(k) for k, v in _rates(tp, fp, fn).items()],
        tn.cast("long").alias("true_negatives"), fp.cast("long").alias("false_positives"),
        fn.cast("long").alias("false_negatives"), tp.cast("long").alias("true_positives"))


def default_metrics(hist: DataFrame, group_cols: Sequence[str] = ("model",),
                    cut: float = 0.5) -> DataFrame:
    """A6–A10 at the default decision ``p > 0.5``: confusion matrix, accuracy,
    precision, recall, F1."""
    g = list(group_cols)
    wide = _confusion(hist, g, [("d", F.col("score") > F.lit(float(cut)))])
    tp, fp = F.col("tp_d"), F.col("fp_d")
    fn, tn = F.col("_P") - tp, F.col("_N") - fp
    return wide.select(
        *g, tn.cast("long").alias("tn"), fp.cast("long").alias("fp"),
        fn.cast("long").alias("fn"), tp.cast("long").alias("tp"),
        _safe_ratio(tp + tn, F.col("_P") + F.col("_N")).alias("accuracy"),
        *[v.alias(k) for k, v in _rates(tp, fp, fn).items()])


def classification_report(hist: DataFrame, group_cols: Sequence[str] = ("model",),
                          cut: float = 0.5) -> DataFrame:
    """Per class 0/1 precision, recall, F1, support; plus ``accuracy``,
    ``macro avg`` and ``weighted avg`` rows (sklearn layout, long form)."""
    g = list(group_cols)
    cm = default_metrics(hist, g, cut)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    n = tp + fp + fn + tn
    c1 = {"precision": _safe_ratio(tp, tp + fp), "recall": _safe_ratio(tp, tp + fn),
          "f1_score": _safe_ratio(2 * tp, 2 * tp + fp + fn), "support": (tp + fn).cast("double")}
    c0 = {"precision": _safe_ratio(tn, tn + fn), "recall": _safe_ratio(tn, tn + fp),
          "f1_score": _safe_ratio(2 * tn, 2 * tn + fn + fp), "support": (tn + fp).cast("double")}
    acc = _safe_ratio(tp + tn, n)
    rows = []
    for label, d in (("0", c0), ("1", c1)):
        rows.append(cm.select(*g, F.lit(label).alias("class_label"),
                              *[d[k].alias(k) for k in ("precision", "recall", "f1_score", "support")]))
    rows.append(cm.select(*g, F.lit("accuracy").alias("class_label"), acc.alias("precision"),
                          acc.alias("recall"), acc.alias("f1_score"), n.cast("double").alias("support")))
    macro = {k: (c0[k] + c1[k]) / F.lit(2.0) for k in ("precision", "recall", "f1_score")}
    rows.append(cm.select(*g, F.lit("macro avg").alias("class_label"),
                          *[macro[k].alias(k) for k in ("precision", "recall", "f1_score")],
                          n.cast("double").alias("support")))
    weighted = {k: _safe_ratio(c0[k] * c0["support"] + c1[k] * c1["support"], n)
                for k in ("precision", "recall", "f1_score")}
    rows.append(cm.select(*g, F.lit("weighted avg").alias("class_label"),
                          *[weighted[k].alias(k) for k in ("precision", "recall", "f1_score")],
                          n.cast("double").alias("support")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


class Evaluation:
    """All metrics of one or more models from a single pass over the scores."""

    def __init__(self, scored: DataFrame, group_cols: Sequence[str] = ("model",),
                 label_col: str = "label", score_col: str = "score",
                 n_ranges: int | None = None):
        self.group_cols = list(group_cols)
        self.n_ranges = n_ranges
        self.scored, self.score_col = scored, score_col
        self.hist = score_histogram(scored, self.group_cols, label_col, score_col)
        self._ranged: DataFrame | None = None

    def ranking(self) -> DataFrame:
        """The only metrics that need the histogram in ranges."""
        if self._ranged is None:
            n = self.n_ranges or int(self.scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            self._ranged = valued_ranges(self.hist, "score", range_bounds(self.scored, self.score_col, n), descending=True)
        return ranking_metrics(cumulative_from_top(self._ranged, self.group_cols), self.group_cols)

    def default(self, cut: float = 0.5) -> DataFrame:
        return default_metrics(self.hist, self.group_cols, cut)

    def sweep(self, thresholds: Sequence[float]) -> DataFrame:
        return threshold_sweep(self.hist, thresholds, self.group_cols)

    def report(self, cut: float = 0.5) -> DataFrame:
        return classification_report(self.hist, self.group_cols, cut)

    def summary(self, cut: float = 0.5) -> DataFrame:
        """The six default metrics (A7–A12) per model."""
        d = self.default(cut).select(*self.group_cols, "accuracy", "precision", "recall", "f1_score")
        return d.join(self.ranking(), self.group_cols)

    def metric_rows(self, production_threshold: float = DEFAULT_ALERT_THRESHOLD,
                    thresholds: Sequence[float] | None = None) -> DataFrame:
        """Long ``(group..., metric, value)`` rows as logged per run:
        the six default metrics, the per-threshold sweep under
        ``<metric>_threshold_<t>`` names and the ``production_*`` row picked
        by exact threshold equality."""
        g = self.group_cols
        ts = thresholds or build_thresholds(production_threshold)
        summ = self.summary()
        names = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "average_precision"]
        base = summ.selectExpr(*[f"`{c}`" for c in g],
                               f"stack({len(names)}, " + ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)
                               + ") AS (metric, value)")
        sw = self.sweep(ts)
        sweep_metrics = [("precision", "precision"), ("recall", "recall"), ("f1", "f1_score"),
                         ("false_positives", "false_positives"), ("false_negatives", "false_negatives"),
                         ("true_positives", "true_positives")]
        stacked = sw.selectExpr(*[f"`{c}`" for c in g], "threshold",
                                f"stack({len(sweep_metrics)}, "
                                + ", ".join(f"'{a}', CAST(`{b}` AS DOUBLE)" for a, b in sweep_metrics)
                                + ") AS (stem, value)")
        per_t = stacked.select(*g, F.concat(F.col("stem"), F.lit("_threshold_"),
                                            threshold_label(F.col("threshold"))).alias("metric"), "value")
        prod_metrics = [("production_precision", "precision"), ("production_recall", "recall"),
                        ("production_f1_score", "f1_score"),
                        ("production_false_positives", "false_positives"),
                        ("production_false_negatives", "false_negatives"),
                        ("production_true_positives", "true_positives")]
        prod = sw.where(F.col("threshold") == F.lit(float(production_threshold))).selectExpr(
            *[f"`{c}`" for c in g],
            f"stack({len(prod_metrics)}, "
            + ", ".join(f"'{a}', CAST(`{b}` AS DOUBLE)" for a, b in prod_metrics)
            + ") AS (metric, value)")
        return base.unionByName(per_t).unionByName(prod)


def class_distribution(df: DataFrame, label_col: str = "is_fraud") -> DataFrame:
    """A3: share of each label (``value_counts(normalize=True)``)."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # the window runs over the aggregated table: one row per label value
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select("label", "n", (F.col("n") / total).alias("share"))


def class_counts(df: DataFrame, label_col: str = "is_fraud") -> DataFrame:
    """A4 input: one row ``(negatives, positives, ratio)``; ratio NULL without positives."""
    y = F.col(label_col)
    return df.agg(F.count_if(y == 0).alias("negatives"), F.count_if(y == 1).alias("positives")) \
        .withColumn("ratio", F.try_divide(F.col("negatives").cast("double"), F.col("positives")))


def class_imbalance_ratio(df: DataFrame, label_col: str = "is_fraud") -> float:
    """A4: negatives / positives; raises when there is no positive."""
    row = class_counts(df, label_col).first()
    if not row["positives"]:
        raise ValueError("no positive class found in target")
    return float(row["ratio"])


def best_candidate(metrics: DataFrame, score_col: str = "average_precision",
                   ordinal_col: str = "ordinal", group_cols: Sequence[str] = ()) -> DataFrame:
    """The candidate with the highest score; the first one wins ties."""
    key = F.struct(F.col(score_col), (-F.col(ordinal_col)).alias("_o"))
    packed = F.struct(*[F.col(c) for c in metrics.columns])
    if group_cols:
        best = metrics.groupBy(*group_cols).agg(F.max_by(packed, key).alias("_b"))
    else:
        best = metrics.agg(F.max_by(packed, key).alias("_b"))
    return best.select("_b.*")

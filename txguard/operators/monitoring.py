"""Monitoring aggregates the reference documents for its dashboard.

All are grouped aggregates over scored/labelled rows; the only windows run
over already-aggregated tables (a handful of rows per feature or period).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PSI_EPSILON = 1e-6


def _stack(df: DataFrame, columns: Sequence[str], extra: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    return df.selectExpr(*[f"`{e}`" for e in extra], f"stack({len(columns)}, {pairs}) AS (feature, value)")


def psi(df: DataFrame, columns: Sequence[str], is_reference: Column, bins: int = 10,
        fixed_range: tuple[float, float] | None = None) -> DataFrame:
    """Population stability index per column between the reference rows
    and the others, over ``bins`` equal-width bins of the reference range
    (values outside are clamped to the end bins)."""
    long = _stack(df.withColumn("_ref", is_reference), columns, ["_ref"]) \
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    if fixed_range is None:
        # one row per feature: broadcast by size
        edges = long.where("_ref").groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
        long = long.join(F.broadcast(edges), "feature", "left")
    else:
        long = long.withColumns({"_lo": F.lit(float(fixed_range[0])), "_hi": F.lit(float(fixed_range[1]))})
    width = F.col("_hi") - F.col("_lo")
    raw = F.when(width > 0, F.floor((F.col("value") - F.col("_lo")) / width * bins)).otherwise(F.lit(0))
    bucket = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = long.groupBy("feature", bucket.alias("bucket")).agg(
        F.count_if(F.col("_ref")).alias("ref_n"), F.count_if(~F.col("_ref")).alias("cur_n"))
    per_feature = Window.partitionBy("feature")
    p = F.try_divide("ref_n", F.sum("ref_n").over(per_feature))
    q = F.try_divide("cur_n", F.sum("cur_n").over(per_feature))
    # a side without rows has no distribution: the index is NULL
    shares = counts.select(
        "feature", "bucket",
        F.when(p.isNotNull(), F.greatest(p, F.lit(PSI_EPSILON))).alias("p"),
        F.when(q.isNotNull(), F.greatest(q, F.lit(PSI_EPSILON))).alias("q"))
    return shares.groupBy("feature").agg(
        F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))).alias("psi"))


def target_drift(df: DataFrame, period: Column, is_reference: Column, label_col: str = "is_fraud") -> DataFrame:
    """D3: fraud rate per period against the reference rate."""
    per = df.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label_col)).cast("long").alias("n_fraud"),
        F.count_if(is_reference).alias("_ref_n"),
        F.sum(F.when(is_reference, F.col(label_col)).otherwise(0)).alias("_ref_f"))
    everything = Window.partitionBy(F.lit(0))   # over the per-period table only
    # without reference rows there is no reference rate: NULL
    ref_rate = F.try_divide(F.sum("_ref_f").over(everything), F.sum("_ref_n").over(everything))
    return per.select("period", "n", "n_fraud", (F.col("n_fraud") / F.col("n")).alias("fraud_rate"),
                      ref_rate.alias("reference_rate")) \
        .withColumn("rate_change", F.col("fraud_rate") - F.col("reference_rate"))


def performance_by(df: DataFrame, group: Sequence[Column], label_col: str, pred: Column) -> DataFrame:
    """Confusion counts and precision/recall/F1 per group."""
    y = F.col(label_col)
    agg = df.groupBy(*group).agg(
        F.count_if((y == 1) & pred).alias("tp"), F.count_if((y == 0) & pred).alias("fp"),
        F.count_if((y == 1) & ~pred).alias("fn"), F.count_if((y == 0) & ~pred).alias("tn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def ratio(n, d):
        return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))
    return agg.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
                            "f1_score": ratio(2 * tp, 2 * tp + fp + fn)})


def kpis_by_period(scored: DataFrame, period: Column) -> DataFrame:
    """Volume, predicted frauds, rate and amounts per period."""
    pred = F.col("is_fraud_predicted") == 1
    return scored.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("n_transactions"), F.count_if(pred).alias("n_predicted_frauds"),
        F.sum(F.when(pred, F.col("amt")).otherwise(0.0)).alias("predicted_fraud_amount"),
        F.sum(F.when(F.col("is_fraud") == 1, F.col("amt")).otherwise(0.0)).alias("fraud_amount"),
    ).withColumn("predicted_fraud_rate", F.col("n_predicted_frauds") / F.col("n_transactions"))


def frauds_by_segment(scored: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Predicted frauds and amount per value of each dimension (long form)."""
    frauds = scored.where(F.col("is_fraud_predicted") == 1)
    stack = ", ".join(f"'{d}', CAST(`{d}` AS STRING)" for d in dimensions)
    long = frauds.selectExpr("amt", f"stack({len(dimensions)}, {stack}) AS (dimension, value)")
    return long.groupBy("dimension", "value").agg(
        F.count(F.lit(1)).alias("n_frauds"), F.sum("amt").alias("fraud_amount"))


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Top-k report: ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject
    (per-partition top-k, then a merge of k rows per partition)."""
    return df.orderBy(*order).limit(k)


def score_histogram(scored: DataFrame, prob_col: str = "fraud_probability", bins: int = 20) -> DataFrame:
    """Counts per score bucket ``floor(p * bins)`` (p = 1 in the last bucket)."""
    b = F.least(F.floor(F.col(prob_col) * bins), F.lit(bins - 1)).cast("int")
    return scored.where(F.col(prob_col).isNotNull() & ~F.isnan(prob_col)) \
        .groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def pseudonymised_customer(df: DataFrame, salt: str, col: str = "cc_num") -> Column:
    """Salted SHA-256 of the card number."""
    return F.sha2(F.concat(F.lit(salt), F.col(col).cast("string")), 256)


def cost_optimal_threshold(sweep: DataFrame, fn_cost: float = 10.0, fp_cost: float = 1.0,
                           group_cols: Sequence[str] = ("model",)) -> DataFrame:
    """Per model, the sweep threshold with the lowest ``fn·c_fn + fp·c_fp``
    (the smaller threshold on ties)."""
    cost = F.col("false_negatives") * F.lit(fn_cost) + F.col("false_positives") * F.lit(fp_cost)
    withc = sweep.withColumn("cost", cost)
    return withc.groupBy(*group_cols).agg(
        F.min_by(F.struct("threshold", "cost"), F.struct("cost", "threshold")).alias("_b")) \
        .select(*group_cols, "_b.threshold", "_b.cost")

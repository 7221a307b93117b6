"""Scoring (M10) with the decision rule (P11) and constant annotation (P10).

Two scorers share one interface, ``probability(df) -> Column | DataFrame``:

* ``LinearScorer``: fixed coefficients over the numeric features and a
  logistic link -- a pure column expression, reproducible in SQL, used by the
  flagship query and its DuckDB oracle;
* ``PipelineScorer``: a fitted MLlib ``PipelineModel`` (see ``models``);
  class-1 probability is ``vector_to_array(probability)[1]``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.operators.features import feature_columns, prepare_features
from txguard.schemas import DEFAULT_ALERT_THRESHOLD


def decision(prob: Column, threshold: float) -> Column:
    """``p >= threshold`` as 0/1.  NaN/NULL -> 0 (Spark orders NaN above
    every number, numpy compares it as False)."""
    # one reference to ``prob``: the expression is inlined wherever the decision
    # is used (a pushed-down filter included), so it must stay small
    hit = F.nanvl(prob, F.lit(float("-inf"))) >= F.lit(float(threshold))
    return F.coalesce(hit.cast("int"), F.lit(0))


@dataclass(frozen=True)
class LinearScorer:
    """``p = 1 / (1 + exp(-(intercept + Σ w·x)))`` over derived features."""

    intercept: float
    weights: dict = field(default_factory=dict)
    name: str = "txguard_linear"

    def logit(self, df: DataFrame) -> Column:
        derived = feature_columns(df)
        z = F.lit(float(self.intercept))
        for feat, w in self.weights.items():
            x = derived[feat] if feat in derived else F.col(feat).cast("double")
            z = z + F.lit(float(w)) * x
        return z

    def probability(self, df: DataFrame) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.logit(df)))


# Default demonstration model: larger amounts, far-away merchants and night
# hours raise the score.
DEFAULT_LINEAR_MODEL = LinearScorer(
    intercept=-13.5,
    weights={"amt": 0.0035, "distance_customer_merchant_km": 0.0001,
             "is_weekend": 0.25, "transaction_hour": -0.02},
)


class PipelineScorer:
    """Scores with a fitted MLlib ``PipelineModel`` (features from M1)."""

    def __init__(self, model, name: str = "txguard_model"):
        self.model = model
        self.name = name

    def score(self, df: DataFrame, keep_cols: list[str]) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        feats = prepare_features(df, keep=keep_cols)
        scored = self.model.transform(feats)
        return scored.withColumn(
            "fraud_probability", vector_to_array(F.col("probability"))[1])


def predict_fraud(df: DataFrame, scorer=DEFAULT_LINEAR_MODEL,
                  threshold: float = DEFAULT_ALERT_THRESHOLD,
                  model_name: str | None = None,
                  model_alias: str = "champion") -> DataFrame:
    """All input columns + probability, decision, threshold, model name/alias."""
    name = model_name or scorer.name
    annotations = {
        "fraud_alert_threshold": F.lit(float(threshold)),   # P10
        "model_name": F.lit(name),
        "model_alias": F.lit(model_alias),
    }
    if isinstance(scorer, LinearScorer):
        out = df.withColumn("fraud_probability", scorer.probability(df))
    else:
        # carry every input column through the pipeline under a struct
        packed = df.withColumn("_row", F.struct(*[F.col(c) for c in df.columns]))
        scored = scorer.score(packed, keep_cols=["_row"])
        out = scored.select("_row.*", "fraud_probability")
    out = out.withColumn("is_fraud_predicted", decision(F.col("fraud_probability"), threshold))
    return out.withColumns(annotations)

"""Model registry as append-only tables under one commit log.

``model_versions``     (model_name, version, run_id, candidate, model_uri, registered_at)
``alias_events``       (model_name, alias, version, at, seq) — an alias points to the
                       version of its latest event
``model_metrics``      (model_name, version, metric, value)
``candidate_metrics``  (run_id, candidate, metric, value) — of every candidate of a run
``candidate_scores``   (run_id, model, trans_num, label, score) — every candidate's test rows
``decisions``          the promotion decisions, with the run that made them
``exports``            (model_name, version, run_id, uri, at, seq) — artefacts in production
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from txguard.operators.promotion import REQUIRED_METRICS
from txguard.schemas import (
    CANDIDATE_METRICS_SCHEMA, CANDIDATE_SCORES_SCHEMA, MODEL_ALIAS_EVENTS_SCHEMA, MODEL_EXPORTS_SCHEMA,
    MODEL_METRICS_SCHEMA, MODEL_VERSIONS_SCHEMA, REGISTRY_DECISIONS_SCHEMA,
)
from txguard.sources.commits import CommitLog, Manifest

REGISTRY_TABLES = {
    "model_versions": MODEL_VERSIONS_SCHEMA, "alias_events": MODEL_ALIAS_EVENTS_SCHEMA, "model_metrics": MODEL_METRICS_SCHEMA,
    "candidate_metrics": CANDIDATE_METRICS_SCHEMA, "candidate_scores": CANDIDATE_SCORES_SCHEMA,
    "decisions": REGISTRY_DECISIONS_SCHEMA, "exports": MODEL_EXPORTS_SCHEMA,
}


class ModelRegistry:
    """The registry's tables at ``root``, as its commit log shows them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.log = spark, CommitLog(spark, root)

    def table(self, name: str, at: Manifest | None = None) -> DataFrame:
        return self.log.read(name, REGISTRY_TABLES[name], at)

    def stage(self, df: DataFrame, name: str) -> str:
        """``df`` with the table's columns, unseen until it is committed."""
        return self.log.stage(df.select(*[f.name for f in REGISTRY_TABLES[name].fields]), name)

    def staged(self, name: str, folder: str) -> DataFrame:
        return self.spark.read.schema(REGISTRY_TABLES[name]).parquet(self.log.path(folder))

    def aliases(self, at: Manifest | None = None) -> DataFrame:
        return current_aliases(self.table("alias_events", at))

    def production(self, at: Manifest | None = None) -> DataFrame:
        """The artefact in production of every model: that of its last export."""
        return self.table("exports", at).groupBy("model_name").agg(
            F.max_by(F.struct("version", "run_id", "uri", "at"), F.struct("seq", "at")).alias("last")).select("model_name", "last.*")

    def version(self, run_id: str, at: Manifest | None = None) -> Row | None:
        """What the run has registered."""
        return self.table("model_versions", at).where(F.col("run_id") == run_id).first()


def current_aliases(alias_events: DataFrame) -> DataFrame:
    """M13 ``get_model_alias_info``: ``(model_name, alias, version)`` from the
    latest event per alias: that of the highest commit (``max_by`` is partially aggregated)."""
    return alias_events.groupBy("model_name", "alias").agg(
        F.max_by("version", F.struct("seq", "at")).alias("version"))


def next_versions(model_versions: DataFrame | None, new_models: DataFrame) -> DataFrame:
    """Versions for newly registered models: 1 + current maximum per name."""
    if model_versions is None:
        return new_models.withColumn("version", F.lit(1).cast("long"))
    top = model_versions.groupBy("model_name").agg(F.max("version").alias("_max"))
    return new_models.join(top, "model_name", "left").withColumn(
        "version", (F.coalesce(F.col("_max"), F.lit(0)) + 1).cast("long")).drop("_max")


def metrics_wide(model_metrics: DataFrame, metrics: Sequence[str] = REQUIRED_METRICS) -> DataFrame:
    """``(model_name, version, <metric>...)`` for the listed metrics (explicit
    pivot values: no extra job to find them)."""
    return (model_metrics.where(F.col("metric").isin(*metrics))
            .groupBy("model_name", "version").pivot("metric", list(metrics))
            .agg(F.first("value")))


def champion_challenger_pairs(alias_events: DataFrame, model_metrics: DataFrame,
                              metrics: Sequence[str] = REQUIRED_METRICS) -> DataFrame:
    """Alias -> version -> metrics for both aliases, side by side per model."""
    cur = current_aliases(alias_events)
    wide = metrics_wide(model_metrics, metrics)

    def side(alias):
        s = cur.where(F.col("alias") == alias).drop("alias").join(wide, ["model_name", "version"], "left")
        return s.select("model_name", F.col("version").alias(f"{alias}_version"),
                        *[F.col(m).alias(f"{alias}_{m}") for m in metrics])

    return side("champion").join(side("challenger"), "model_name")


def require_aliases(alias_events: DataFrame, aliases: Sequence[str] = ("champion", "challenger")) -> None:
    """An alias that points nowhere is an error (one row per model and alias is looked at)."""
    held = {r["alias"] for r in current_aliases(alias_events).select("alias").distinct().collect()}
    absent = [a for a in aliases if a not in held]
    if absent:
        raise ValueError(f"no model version has the alias {', '.join(absent)}")

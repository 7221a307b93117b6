"""Predictions meet their labels as both arrive.

Labels reach the engine days after the predictions that they judge, in any
order.  Both are streams here, joined on the key with the label's time inside
``horizon`` of the prediction's: a matched prediction leaves as soon as both
sides are there; one whose label has not come when the watermarks have passed
its horizon leaves without a label, as outstanding.  The watermarks bound the state: a row is
held for ``delay`` and the horizon at most.  Rows without a key match nothing; those of
the labels do not move the watermark either.  The outcome table does not depend on the
order of arrival inside the delay.

State grows with the rows of delay plus horizon, not with the history; the session's
RocksDB state store (``session.ENGINE_CONF``) keeps it out of the executors' heap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.operators.metrics import Evaluation
from txguard.operators.monitoring import performance_by

PREDICTED_SCHEMA = T.StructType([
    T.StructField("trans_num", T.StringType()), T.StructField("predicted_time", T.TimestampNTZType()),
    T.StructField("fraud_probability", T.DoubleType()), T.StructField("is_fraud_predicted", T.IntegerType())])
LABEL_SCHEMA = T.StructType([
    T.StructField("trans_num", T.StringType()), T.StructField("label_time", T.TimestampNTZType()), T.StructField("is_fraud", T.IntegerType())])


def outcomes(predictions: DataFrame, labels: DataFrame, delay: str = "7 days", horizon: str = "3 days") -> DataFrame:
    """Every prediction with its label, or NULL where it is outstanding.  As
    streams (both with watermarks of ``delay``) or as batches, by the same join."""
    p = predictions.withColumn("at", F.col("predicted_time").cast("timestamp"))
    y = labels.select(F.col("trans_num").alias("label_of"), "is_fraud", F.col("label_time").cast("timestamp").alias("label_at"))
    if predictions.isStreaming:
        p, y = p.withWatermark("at", delay), y.withWatermark("label_at", delay)
    in_time = (F.col("label_at") >= F.col("at")) & (F.col("label_at") <= F.col("at") + F.expr(f"INTERVAL {horizon}"))
    return p.join(y, (F.col("trans_num") == F.col("label_of")) & in_time, "left").select(
        "trans_num", "predicted_time", "fraud_probability", "is_fraud_predicted", "is_fraud")


def start_outcomes_stream(spark: SparkSession, predictions_dir: str, labels_dir: str, path: str, checkpoint: str,
                          delay: str = "7 days", horizon: str = "3 days", max_files_per_trigger: int = 1000):
    """The outcome table at ``path``, appended to as outcomes become known."""
    def source(folder: str, schema: T.StructType) -> DataFrame:
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)

    known = outcomes(source(predictions_dir, PREDICTED_SCHEMA), source(labels_dir, LABEL_SCHEMA), delay, horizon)
    return (known.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def performance_by_period(known: DataFrame, period: Column) -> DataFrame:
    """Per period the predictions, those outstanding, the confusion counts,
    precision, recall and F1 of the labelled ones, and their exact ROC AUC and
    average precision.  A period without a label has counts and no metric."""
    rows = known.withColumn("period", period)
    counts = rows.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_predictions"), F.count_if(F.col("is_fraud").isNull()).alias("n_outstanding"))
    labelled = rows.where(F.col("is_fraud").isNotNull())
    confusion = performance_by(labelled, [F.col("period")], "is_fraud", F.col("is_fraud_predicted") == 1)
    ranking = Evaluation(labelled, ["period"], "is_fraud", "fraud_probability").ranking()
    return counts.join(confusion, "period", "left").join(ranking, "period", "left")

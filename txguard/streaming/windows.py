"""Windows that take late rows.

A watermark closes a window and drops what comes after.  Here a micro-batch
appends its partial sums per window, whatever window they belong to, and a
reader adds the parts up: a row a year late changes its window when it
arrives.  The table grows with windows times micro-batches, so every ``FAN``
micro-batches the parts are merged to one row per window.  What is read, appended and
merged is sums, never rows, and the sums are exact (amounts as decimals), so the
result does not depend on the order of arrival.

Each micro-batch is one commit of the table's log: a restart that runs a
micro-batch again finds its number there and appends nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.sources.commits import CommitLog, Manifest

FAN = 16
PARTS_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()), T.StructField("n_transactions", T.LongType()),
    T.StructField("n_predicted_frauds", T.LongType()), T.StructField("fraud_amount", T.DecimalType(38, 12))])


class WindowTable:
    def __init__(self, spark: SparkSession, root: str, width: str = "2 hours", fan: int = FAN):
        self.spark, self.width, self.fan, self.log = spark, width, fan, CommitLog(spark, root)

    def partial(self, rows: DataFrame, time_col: str = "current_time", flag_col: str = "is_fraud_predicted",
                amount_col: str = "amt") -> DataFrame:
        """Sums per window of ``rows``; rows without a time belong to none."""
        at = F.col(time_col).try_cast("timestamp_ntz")
        amount = F.when(F.col(flag_col) == 1, F.col(amount_col)).otherwise(F.lit(0.0)).cast("decimal(26,12)")
        return rows.where(at.isNotNull()).groupBy(F.window(at, self.width).alias("w")).agg(
            F.count(F.lit(1)).alias("n_transactions"), F.sum(F.col(flag_col).cast("long")).alias("n_predicted_frauds"),
            F.sum(amount).cast("decimal(38,12)").alias("fraud_amount")).select(
            F.col("w.start").alias("window_start"), "n_transactions", "n_predicted_frauds", "fraud_amount")

    def append(self, rows: DataFrame, batch: int, **columns) -> bool:
        """Add the sums of micro-batch ``batch``, once; True if it was new."""
        base = self.log.latest()
        if batch <= base.about.get("last", -1):
            return False
        folder = self.log.stage(self.partial(rows, **columns), "parts")
        base = self.log.commit(base, None, {"parts": [folder]}, about={"last": batch})
        if len(base.tables["parts"]) >= self.fan:
            self.compact(base)
        return True

    def compact(self, base: Manifest | None = None) -> None:
        """One row per window; readers of the parts go on with theirs."""
        base = base or self.log.latest()
        folder = self.log.stage(self._sums(base), "parts")
        self.log.commit(base, None, {"parts": [folder]}, replace=("parts",))
        self.log.vacuum(keep=self.fan, older_than_s=86400)

    def _sums(self, at: Manifest) -> DataFrame:
        return self.log.read("parts", PARTS_SCHEMA, at).groupBy("window_start").agg(
            F.sum("n_transactions").alias("n_transactions"), F.sum("n_predicted_frauds").alias("n_predicted_frauds"),
            F.sum("fraud_amount").cast("decimal(38,12)").alias("fraud_amount"))

    def read(self) -> DataFrame:
        """window_start, window_end, n_transactions, n_predicted_frauds,
        fraud_rate, fraud_amount of all rows that have arrived."""
        return self._sums(self.log.latest()).select(
            "window_start", (F.col("window_start") + F.expr(f"INTERVAL {self.width}")).alias("window_end"), "n_transactions", "n_predicted_frauds",
            (F.col("n_predicted_frauds") / F.col("n_transactions")).alias("fraud_rate"), F.col("fraud_amount").cast("double").alias("fraud_amount"))


def start_window_stream(stream: DataFrame, root: str, checkpoint: str, width: str = "2 hours", fan: int = FAN, **columns):
    """Keep the table at ``root`` by a stream of scored transactions."""
    def process(batch: DataFrame, batch_id: int) -> None:
        WindowTable(batch.sparkSession, root, width, fan).append(batch, batch_id, **columns)

    return stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

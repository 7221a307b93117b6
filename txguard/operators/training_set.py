"""Training-set maintenance.

The reference rewrites one Parquet object per merge and holds every training
key in a Python set.  Here the key check is an anti/semi join and the merge
appends only the new rows to a Parquet directory (read back with
``mergeSchema``), so the cost of a merge grows with the batch, not with the
training set.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.functions.parsing import to_timestamp_lenient
from txguard.operators.dedupe import new_keys_only, present_keys_only
from txguard.schemas import (
    TRAINING_DATETIME_COLUMNS, TRAINING_NUMERIC_COLUMNS, TRAINING_STRING_COLUMNS,
    require_columns,
)


def normalize_training_types(df: DataFrame) -> DataFrame:
    """Strings as text, numbers coerced (bad -> NULL), datetimes coerced,
    ``is_fraud`` NULL -> 0 as int; columns not listed are kept as they are."""
    exprs = []
    for c in df.columns:
        col = F.col(c)
        if c == "is_fraud":
            e = F.coalesce(col.try_cast("double"), F.lit(0.0)).cast("int")   # F11
        elif c in TRAINING_STRING_COLUMNS:
            e = col.cast("string")
        elif c in TRAINING_NUMERIC_COLUMNS:
            e = col.try_cast("double") if c in ("amt", "lat", "long", "merch_lat", "merch_long") \
                else col.try_cast("bigint")
        elif c in TRAINING_DATETIME_COLUMNS:
            e = to_timestamp_lenient(col)
        else:
            e = col
        exprs.append(e.alias(c))
    return df.select(*exprs)


def align_union(training: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Training columns first, then the new frame's extra columns; missing
    values NULL (UNION ALL by name)."""
    return training.unionByName(new_rows, allowMissingColumns=True)


@dataclass
class MergeResult:
    """G5 output: three lazy DataFrames."""
    merged: DataFrame          # training rows + new rows (aligned)
    integrated: DataFrame      # keys added (``trans_num`` as text)
    already_present: DataFrame  # keys of the batch already in the training set


def merge_training_set(training: DataFrame, new_rows: DataFrame) -> MergeResult:
    """J1 (new rows, NULL keys kept), J2 (present keys), U1 (aligned union)."""
    require_columns(training, ["trans_num"], "training set")
    require_columns(new_rows, ["trans_num"], "new transactions")
    added = new_keys_only(new_rows, training, "trans_num")
    present = present_keys_only(new_rows, training, "trans_num")
    return MergeResult(
        merged=align_union(training, added),
        integrated=added.select(F.col("trans_num").cast("string").alias("trans_num")),
        already_present=present.where(F.col("trans_num").isNotNull())
        .select(F.col("trans_num").cast("string").alias("trans_num")),
    )


def append_to_training_set(spark, path: str, new_rows: DataFrame) -> DataFrame:
    """Append only the rows whose key is new to the Parquet directory at
    ``path`` (one ``merge_id=<uuid>`` partition per merge) and return the keys
    added, read back from what was committed.  A failed write commits nothing;
    a retry writes under a new id."""
    from txguard.sources.files import MERGE_ID_COLUMN, path_exists, read_training_set

    existing = read_training_set(spark, path) if path_exists(spark, path) else None
    added = normalize_training_types(new_keys_only(new_rows, existing, "trans_num"))
    merge_id = uuid.uuid4().hex
    (added.withColumn(MERGE_ID_COLUMN, F.lit(merge_id))
     .write.mode("append").partitionBy(MERGE_ID_COLUMN).parquet(path))
    # the merge's own folder alone: no footer of the rest is read
    folder = f"{path}/{MERGE_ID_COLUMN}={merge_id}"
    written = spark.read.schema(added.schema).parquet(folder) if path_exists(spark, folder) else added.limit(0)
    return written.select(F.col("trans_num").cast("string").alias("trans_num"))

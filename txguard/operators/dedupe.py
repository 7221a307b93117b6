"""Key-based row selection: first-wins dedupe, insert-if-absent (J3), key joins.

The pick is ``row_number() = 1``: Spark plans a group limit before the shuffle,
so each task sends one row of a key, however hot, and a row travels once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def first_per_key(df: DataFrame, key: str, order_cols: Sequence[str] = ()) -> DataFrame:
    """One row per non-null ``key``: the row with the smallest ``order_cols``
    (ties and unordered input: the smallest full row, so the choice is
    deterministic).  Rows with a NULL key have no place in a keyed table; the
    plans quarantine them before.  Columns are compared as they are: a struct
    of them would be a second copy of the row in the sort and the shuffle."""
    order = [c for c in order_cols if c in df.columns]
    ranked = Window.partitionBy(key).orderBy(*[F.col(_q(c)) for c in [*order, *[c for c in df.columns if c not in {*order, key}]]])
    return (df.where(F.col(key).isNotNull()).withColumn("_rank", F.row_number().over(ranked))
            .where("_rank = 1").drop("_rank"))


def new_keys_only(df: DataFrame, table: DataFrame | None, key: str) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``table`` (NULL keys kept)."""
    if table is None:
        return df
    keys = table.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull())
    probe = df.withColumn("_k", F.col(key).cast("string"))
    return probe.join(keys.withColumnRenamed(key, "_k"), "_k", "left_anti").drop("_k")


def present_keys_only(df: DataFrame, table: DataFrame | None, key: str) -> DataFrame:
    """Rows of ``df`` whose key is present in ``table``."""
    if table is None:
        return df.limit(0)
    keys = table.select(F.col(key).cast("string").alias("_k")).where(F.col("_k").isNotNull())
    probe = df.withColumn("_k", F.col(key).cast("string"))
    return probe.join(keys, "_k", "left_semi").drop("_k")


def insert_if_absent(rows: DataFrame, table: DataFrame | None, key: str = "trans_num",
                     order_cols: Sequence[str] = ()) -> DataFrame:
    """J3 (``INSERT ... ON CONFLICT (key) DO NOTHING``): first row per key inside
    the batch, then only keys not already in ``table``.  The result is exactly
    the set of rows the insert creates (the RETURNING set)."""
    return new_keys_only(first_per_key(rows, key, order_cols), table, key)

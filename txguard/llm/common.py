"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.session import ensure_checkpoint_dir, fresh_shared_path

# Word separators of every contract that speaks of words: \x20 and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"

# Text handled at once inside a Python task; bounds a worker's memory whatever
# the size of Spark's Arrow batches.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "llm") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its size
    is known to the optimizer, which so checks it before it broadcasts."""
    spark = df.sparkSession
    path = fresh_shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, task, schema, max_bytes: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over batches of at most ``max_bytes``: rows carry whole
    texts here, and Spark's default batch would hold many times as much in
    the executor and in its Python workers."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(max_bytes))
    return df.mapInArrow(task, schema)


def spare(columns: list[str], *names: str) -> list[str]:
    """Names like ``names`` that clash with none of ``columns``."""
    held, out = {c.lower() for c in columns}, []
    for name in names:
        while name in held:
            name += "_"
        out.append(name)
        held.add(name)
    return out


def fold(id_col: str | Column, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; NULL for a NULL id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % modulus


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds at most ``max_bytes`` of text, or
    one row."""
    if batch.num_rows == 0:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(size, before + max_bytes, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def words(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, word codes of all rows one after another, row offsets.

    Words are the runs without ASCII white space; a NULL text has none.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    codes, distinct = coded.indices.to_numpy(), coded.dictionary
    offsets = offsets - offsets[0]
    empty = pc.index(distinct, "").as_py() if len(distinct) else -1
    if empty >= 0:  # leading or trailing white space leaves empty strings
        kept = codes != empty
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
        codes = codes[kept]
    return distinct, codes, offsets


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each row's stretch ``offsets[i]:offsets[i+1]``."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(filled):
        out[filled] = np.add.reduceat(values, offsets[filled], axis=0)
    return out


def gather(offsets: np.ndarray, flat: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the ragged rows ``index`` of (offsets, flat); also their lengths."""
    lengths = offsets[index + 1] - offsets[index]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(offsets[index] - (ends - lengths), lengths)
    at += np.arange(total, dtype=at.dtype)
    return flat[at], lengths


def worker_cache() -> dict:
    """What a Python worker keeps from task to task (never results, only what
    can be made again).  Task functions arrive by value with globals of their
    own, so it hangs on the interpreter."""
    import sys

    return vars(sys).setdefault("_txguard_worker_cache", {})

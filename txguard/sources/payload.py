"""JSON batch payloads (S1): decode, and encode for tests / landing files.

A payload document holds one batch of transactions in one of four shapes:

* split:    ``{"columns": [...], "index": [...], "data": [[...], ...]}``
* records:  ``[{"col": v, ...}, ...]``
* lists:    ``{"col": [v, ...], ...}``
* columns:  ``{"col": {"<index>": v, ...}, ...}`` (the default JSON form of a
  pandas frame)

or a JSON string that holds one of them.  A document of no such shape is an
error, or one of the rejected documents; it never vanishes.

Every shape is turned into an ``array<map<string,string>>`` with native JSON
and higher-order functions, exploded to rows, and each field coerced to the
target schema with ``try_cast`` (bad values -> NULL).  Documents are the unit of
parallelism: a landing folder of many documents is decoded by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.schemas import TRANSACTION_SCHEMA

SPLIT_SCHEMA = "columns array<string>, index array<bigint>, data array<array<string>>"
RECORDS_SCHEMA = "array<map<string,string>>"
LISTS_SCHEMA = "map<string,array<string>>"
COLUMNS_SCHEMA = "map<string,map<string,string>>"


def _unwrapped(payload: Column) -> Column:
    """A payload sent as a JSON string is the text inside the string."""
    return F.when(F.ltrim(payload).startswith('"'), F.get_json_object(payload, "$")).otherwise(payload)


def with_shapes(docs: DataFrame, payload_col: str = "payload") -> DataFrame:
    """``docs`` with ``_shape`` (NULL: none fits) and one parsed column per
    shape; each document is parsed for the shape its first characters allow."""
    text = F.col("_text")
    out = docs.withColumn("_text", _unwrapped(F.col(payload_col)))
    is_list, is_map = F.ltrim(text).startswith("["), F.ltrim(text).startswith("{")
    keys = F.json_object_keys(F.when(is_map, text))
    is_split = F.array_contains(keys, "columns") & F.array_contains(keys, "data")
    out = out.withColumn("_split_like", F.coalesce(is_split, F.lit(False))).withColumn("_is_map", is_map & F.col("_text").isNotNull())
    plain = F.when(F.col("_is_map") & ~F.col("_split_like"), text)
    out = out.withColumns({
        "_records": F.from_json(F.when(is_list, text), RECORDS_SCHEMA),
        "_split": F.from_json(F.when(F.col("_split_like"), text), SPLIT_SCHEMA),
        "_lists": F.from_json(plain, LISTS_SCHEMA),
    })
    out = out.withColumn("_columns", F.from_json(F.when(F.col("_lists").isNull(), plain), COLUMNS_SCHEMA))
    width = F.size(F.col("_split.columns"))
    split_ok = (F.col("_split.columns").isNotNull() & F.col("_split.index").isNotNull() & F.col("_split.data").isNotNull()
                & F.forall(F.col("_split.data"), lambda r: F.size(r) == width))
    lists_ok = F.col("_lists").isNotNull() & (F.size(F.array_distinct(F.transform(F.map_values("_lists"), F.size))) <= 1)
    records_ok = F.col("_records").isNotNull() & F.forall("_records", lambda r: r.isNotNull())
    columns_ok = F.col("_columns").isNotNull() & F.forall(F.map_values("_columns"), lambda v: v.isNotNull())
    return out.withColumn("_shape", F.when(records_ok, "records").when(split_ok, "split").when(lists_ok, "lists").when(columns_ok, "columns"))


def _rows_of_shapes() -> Column:
    """``array<map<string,string>>``: one map per transaction of the document."""
    split, lists, cols = F.col("_split"), F.col("_lists"), F.col("_columns")
    from_split = F.transform(split["data"], lambda r: F.map_from_arrays(split["columns"], r))
    n_rows = F.coalesce(F.array_max(F.transform(F.map_values(lists), F.size)), F.lit(0))
    from_lists = F.transform(
        F.sequence(F.lit(1), n_rows),
        lambda i: F.map_from_arrays(F.map_keys(lists), F.transform(F.map_values(lists), lambda v: F.get(v, i - 1))))
    index_keys = F.array_distinct(F.flatten(F.transform(F.map_values(cols), F.map_keys)))
    from_cols = F.transform(
        index_keys,
        lambda k: F.map_from_arrays(F.map_keys(cols), F.transform(F.map_values(cols), lambda v: v[k])))
    shape = F.col("_shape")
    return (F.when(shape == "split", from_split)
            .when(shape == "records", F.col("_records"))
            .when((shape == "lists") & (n_rows > 0), from_lists)
            .when(shape == "columns", from_cols))


def _from_epoch_millis(text: Column) -> Column:
    """Epoch milliseconds -> wall-clock TIMESTAMP_NTZ in UTC (no session time zone)."""
    millis = F.when(text.rlike(r"^-?[0-9]+$"), text.try_cast("bigint"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MILLISECOND", millis, epoch)


def _coerce(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        # ISO text, or epoch milliseconds (pandas' default date encoding)
        return F.coalesce(text.try_cast("timestamp_ntz"), _from_epoch_millis(text))
    if isinstance(dtype, T.DateType):
        return F.coalesce(text.try_cast("timestamp_ntz").cast("date"),
                          F.to_date(_from_epoch_millis(text)))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        # integral values may arrive as JSON floats (1.0)
        return F.coalesce(text.try_cast(dtype), text.try_cast("double").try_cast(dtype))
    return text.try_cast(dtype)


def parse_payloads(docs: DataFrame, schema: T.StructType = TRANSACTION_SCHEMA,
                   payload_col: str = "payload", keep_extra: bool = False,
                   on_reject: str = "raise") -> DataFrame:
    """Payload documents -> typed transaction rows.  A document that fits
    no shape fails the job; with ``on_reject='skip'`` it is left to
    ``rejected_payloads``, which a plan stores beside the rows."""
    shaped = with_shapes(docs, payload_col)
    rows = _rows_of_shapes()
    if on_reject == "raise":
        refused = F.raise_error(F.concat(F.lit("payload fits no known shape: "),
                                         F.coalesce(F.substring(F.col("_text"), 1, 80), F.lit("NULL"))))
        rows = F.when(F.col("_shape").isNull(), refused.cast(RECORDS_SCHEMA)).otherwise(rows)
    elif on_reject != "skip":
        raise ValueError(f"on_reject must be 'raise' or 'skip': {on_reject}")
    rows = shaped.select(F.explode(rows).alias("_m"))
    fields = [_coerce(F.col("_m")[f.name], f.dataType).alias(f.name) for f in schema.fields]
    if keep_extra:
        fields.append(F.col("_m").alias("_raw"))
    return rows.select(*fields)


def rejected_payloads(docs: DataFrame, payload_col: str = "payload") -> DataFrame:
    """The documents that fit no shape, as they came."""
    # not a filter: the optimizer would push it below the parsing and repeat that
    kept = F.when(F.col("_shape").isNull(), F.array(F.struct(*docs.columns)))
    return with_shapes(docs, payload_col).select(F.inline(kept))


ROWS_PER_DOCUMENT = 1000


def to_split_payloads(df: DataFrame, chunk: Column | None = None,
                      rows_per_document: int = ROWS_PER_DOCUMENT) -> DataFrame:
    """Encode ``df`` as split-shaped documents.  By default a document holds at
    most ``rows_per_document`` consecutive rows of one input partition
    (``monotonically_increasing_id`` is partition-offset based), so no document
    grows with a skewed key; ``chunk`` overrides the grouping."""
    cols = df.columns
    row = F.array(*[F.col(c).cast("string") for c in cols])
    if chunk is None:
        chunk = F.floor(F.monotonically_increasing_id() / F.lit(rows_per_document))
    grouped = df.groupBy(chunk.alias("_chunk")).agg(F.collect_list(row).alias("_rows"))
    return grouped.select(
        "_chunk",
        F.to_json(F.struct(
            F.array(*[F.lit(c) for c in cols]).alias("columns"),
            F.sequence(F.lit(0).cast("bigint"), F.size("_rows").cast("bigint") - 1).alias("index"),
            F.col("_rows").alias("data"))).alias("payload"))

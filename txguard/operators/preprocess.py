"""Preprocessing fit and transform.

The fits are exact aggregates (MLlib's ``Imputer`` returns an element rather
than the midpoint median, and ``StandardScaler`` uses the sample standard
deviation); their small results (one row per feature) are baked into a
``SQLTransformer`` stage, so the fitted preprocessor is an ordinary MLlib
``PipelineModel`` that can be saved, loaded and applied as one projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.operators.ranking import exact_medians, pinned_ranges, running_sums
from txguard.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from txguard.session import fresh_shared_path

FEATURES_VECTOR = "features"


def _stack(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {cast})" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {pairs}) AS (feature, value)")


def fit_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """M3 fit (A16 + A18): ``(feature, median, mean, scale)``; the mean and the
    population standard deviation are taken after median imputation, and a
    zero deviation scales by 1.  A column without any value has NULL medians
    and means: there is nothing to impute it by, and the transformer leaves it
    out.  Only the medians need the values counted; the moments are one
    aggregation of the rows, with no shuffle of them."""
    medians = {r["feature"]: r["median"] for r in exact_medians(df, columns).collect()}
    imputed = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(medians.get(c)).cast("double"))
               for c in columns}
    wide = df.agg(*[f(v).alias(f"{k}{i}") for i, v in enumerate(imputed.values()) for k, f in (("mean", F.avg), ("std", F.stddev_pop))])
    literal = lambda v: "CAST(NULL AS DOUBLE)" if v is None else f"CAST({v!r} AS DOUBLE)"
    rows = ", ".join(f"'{c}', {literal(medians.get(c))}, mean{i}, CASE WHEN std{i} > 0 THEN std{i} ELSE 1.0D END"
                     for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {rows}) AS (feature, median, mean, scale)")


def category_modes(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Most frequent value per column, the smallest one on ties:
    ``(feature, mode)``.  Counting is a grouped aggregate; the pick is a
    partial ``min_by``, so no task holds a column's whole value set."""
    long = _stack(df, columns, "STRING").where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("mode"))


def category_dictionary(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES,
                        impute: bool = True) -> DataFrame:
    """Distinct values per column in ascending order with their 0-based
    index: ``(feature, value, index)`` (after mode imputation by default)."""
    src = impute_categorical(df, category_modes(df, columns), columns) if impute else df
    distinct = _stack(src, columns, "STRING").where(F.col("value").isNotNull()) \
        .groupBy("feature", "value").agg(F.lit(1).alias("one"))
    ranged = pinned_ranges(distinct, ["feature"], "value")
    cum = running_sums(ranged, ["feature"], "value", ["one"])
    return cum.select("feature", "value", (F.col("cone") - 1).alias("index"))


@dataclass(frozen=True)
class CategoryEncoder:
    """M4 with the categories as a table: imputation by the modes, then the
    index of a value by a join with the dictionary.

    Neither the driver nor a task holds a column's categories: a dictionary stored as
    Parquet is broadcast while its known size is small, else joined by value,
    where a value of many rows is split by AQE's skew join.  Modes, and the
    number of categories of a column, are a row per column."""

    columns: tuple[str, ...]
    modes: dict[str, str | None]
    sizes: dict[str, int]
    path: str                       # (feature, value, index)

    def dictionary(self, spark) -> DataFrame:
        return spark.read.schema("feature string, value string, index bigint").parquet(self.path)

    def indices(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<column>__idx``; NULL for a value that the fit has not seen."""
        known = self.dictionary(df.sparkSession)
        for c in self.columns:
            own = known.where(F.col("feature") == c).select(F.col("value").alias(f"{c}__cat"), F.col("index").alias(f"{c}__idx"))
            df = df.withColumn(f"{c}__cat", F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))).join(own, f"{c}__cat", "left").drop(f"{c}__cat")
        return df

    def one_hot(self, df: DataFrame, name: str = "one_hot") -> DataFrame:
        """``df`` with the places of the ones in its indicator vector (of
        ``sum(sizes)`` places, a column's one after another): none for an unseen value."""
        places, before = [], 0
        for c in self.columns:
            places.append(F.col(f"{c}__idx") + F.lit(before))
            before += self.sizes[c]
        out = self.indices(df)
        return out.select(*df.columns, F.array_compact(F.array(*places)).alias(name))


def fit_categories(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> CategoryEncoder:
    """The modes, and the dictionary of the imputed values, stored in
    the shared folder."""
    modes = {r["feature"]: r["mode"] for r in category_modes(df, columns).collect()}
    path = fresh_shared_path(df.sparkSession, "categories")
    category_dictionary(df, columns).write.parquet(path)
    encoder = CategoryEncoder(tuple(columns), {c: modes.get(c) for c in columns}, {}, path)
    found = {r["feature"]: r["n"] for r in encoder.dictionary(df.sparkSession).groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    return replace(encoder, sizes={c: found.get(c, 0) for c in columns})


def _collect_small(fit: DataFrame, key: str = "feature") -> dict:
    """Fit tables have one row per feature (≤ 19): safe to bring to the driver."""
    return {r[key]: r.asDict() for r in fit.collect()}


def impute_categorical(df: DataFrame, modes: DataFrame,
                       columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    m = _collect_small(modes)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(m[c]["mode"]))
                           for c in columns if c in m})


def numeric_sql(fit: dict, columns: Sequence[str]) -> str:
    parts = []
    for c in columns:
        f = fit[c]
        if f["median"] is None:         # no value at all: left out, as by the imputer
            continue
        parts.append(f"(coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), "
                     f"CAST({f['median']!r} AS DOUBLE)) - CAST({f['mean']!r} AS DOUBLE)) / "
                     f"CAST({f['scale']!r} AS DOUBLE) AS `{c}__num`")
    return ", ".join(parts)


def categorical_sql(modes: dict, columns: Sequence[str]) -> str:
    parts = []
    for c in columns:
        mode = modes.get(c, {}).get("mode")
        lit = "NULL" if mode is None else "'" + str(mode).replace("\\", "\\\\").replace("'", "\\'") + "'"
        parts.append(f"coalesce(CAST(`{c}` AS STRING), {lit}) AS `{c}__cat`")
    return ", ".join(parts)


def build_preprocessor(train: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
                       categorical: Sequence[str] = CATEGORICAL_FEATURES) -> Pipeline:
    """M5: impute+scale numeric (exact fits), impute+one-hot categorical
    (alphabetical indices; the indexer gives unseen values one index more, and
    the encoder drops that last one: an all-zero block), assemble one sparse
    vector ``features``.  The indexers' dictionaries come to the driver, as an
    MLlib model holds them.  Returns an unfitted ``Pipeline`` whose first
    stage already carries the fitted constants."""
    num_fit = _collect_small(fit_numeric(train, numeric))
    modes = _collect_small(category_modes(train, categorical))
    numeric = [c for c in numeric if num_fit[c]["median"] is not None]
    columns = ", ".join(x for x in (numeric_sql(num_fit, numeric), categorical_sql(modes, categorical)) if x)
    sql = SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")
    indexers = [StringIndexer(inputCol=f"{c}__cat", outputCol=f"{c}__idx",
                              stringOrderType="alphabetAsc", handleInvalid="keep")
                for c in categorical]
    encoder = OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                            outputCols=[f"{c}__ohe" for c in categorical],
                            dropLast=True, handleInvalid="error")
    assembler = VectorAssembler(
        inputCols=[f"{c}__num" for c in numeric] + [f"{c}__ohe" for c in categorical],
        outputCol=FEATURES_VECTOR)
    return Pipeline(stages=[sql, *indexers, encoder, assembler])


def fit_preprocessor(train: DataFrame) -> PipelineModel:
    return build_preprocessor(train).fit(train)

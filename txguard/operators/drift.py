"""Drift from stored sketches.

One aggregation of a period's rows gives, per feature, the number of rows, the
number with a value, and a KLL quantile sketch (Spark's own aggregate) of the
values; per category, its count.  These small tables are stored per period and
merged for any reference range, so that an index over years reads no row
again.  The bins of a numeric feature end at the quantiles of the reference
(equal shares, whatever the distribution), the bins of a category are the
reference's values and one for all others.  Missing values are a bin of their
own.

A sketch of size ``k`` misplaces a rank by about 1.65 / k^0.9 at most (99 %
confidence), so a bin's share is off by twice that; it is exact up to
about k rows.  An index is NULL where the reference or the period has no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.operators.monitoring import PSI_EPSILON

SKETCH_K = 2000
BINS = 10


def _valid(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v), v)


def numeric_sketches(df: DataFrame, columns: Sequence[str], period: Column, k: int = SKETCH_K) -> DataFrame:
    """(feature, period, n_rows, n, sketch): one aggregate per feature in one
    pass, no row is multiplied."""
    wide = df.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.struct(F.count(_valid(c)).alias("n"), F.kll_sketch_agg_double(_valid(c), F.lit(k)).alias("sketch")).alias(f"s{i}")
          for i, c in enumerate(columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s{i}.n").alias("n"), F.col(f"s{i}.sketch").alias("sketch"))
                      for i, c in enumerate(columns)])
    return wide.select("period", "n_rows", F.explode(cells).alias("c")).select("c.feature", "period", "n_rows", "c.n", "c.sketch")


def merged_sketches(sketches: DataFrame, *by: str, k: int = SKETCH_K) -> DataFrame:
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch")), F.lit(k)).alias("sketch"))


def psi_terms(p: Column, q: Column) -> Column:
    """Sum of (q - p) ln(q / p) over two arrays of shares."""
    floor = lambda x: F.greatest(x, F.lit(PSI_EPSILON))
    terms = F.zip_with(p, q, lambda a, b: (floor(b) - floor(a)) * F.ln(floor(b) / floor(a)))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def numeric_drift(sketches: DataFrame, is_reference: Column, bins: int = BINS, k: int = SKETCH_K) -> DataFrame:
    """(feature, period, n_rows, n_missing, psi) of every period outside the
    reference; ``is_reference`` is a condition on ``period``."""
    levels = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    ref = merged_sketches(sketches.where(is_reference), "feature", k=k)
    ref = ref.select("feature", F.col("n_rows").alias("ref_rows"), F.col("n").alias("ref_n"), F.col("sketch").alias("ref_sketch"))
    # the ranks are asked for constants: a row per feature comes to the driver
    edges = {r["feature"]: r["edges"] for r in ref.where("ref_n > 0").select(
        "feature", F.kll_sketch_get_quantile_double("ref_sketch", levels).alias("edges")).collect()}
    both = merged_sketches(sketches.where(~is_reference), "feature", "period", k=k).join(ref, "feature", "left")

    def shares(sketch: str, n: str, rows: str) -> Column:
        # without values every bin but that of the missing ones is empty
        ranks = F.lit(None).cast("array<double>")
        for feature, ends in edges.items():
            found = F.kll_sketch_get_rank_double(sketch, F.array(*[F.lit(e) for e in ends]))
            ranks = F.when((F.col("feature") == feature) & (F.col(n) > 0), found).otherwise(ranks)
        upto = F.concat(F.coalesce(ranks, F.array_repeat(F.lit(0.0), bins - 1)), F.array(F.when(F.col(n) > 0, 1.0).otherwise(0.0)))
        step = F.transform(upto, lambda x, i: x - F.when(i == 0, F.lit(0.0)).otherwise(F.get(upto, i - 1)))
        have = F.col(n) / F.col(rows)
        return F.concat(F.transform(step, lambda x: x * have), F.array(1 - have))

    index = psi_terms(shares("ref_sketch", "ref_n", "ref_rows"), shares("sketch", "n", "n_rows"))
    return both.select("feature", "period", "n_rows", (F.col("n_rows") - F.col("n")).alias("n_missing"),
                       F.when((F.col("ref_n") > 0) & (F.col("n_rows") > 0), index).alias("psi"))


def category_counts(df: DataFrame, columns: Sequence[str], period: Column) -> DataFrame:
    """(feature, period, value, n), missing values as NULL: partial sums before
    the shuffle, a row per value."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return df.select(period.alias("period"), F.explode(cells).alias("c")).groupBy("c.feature", "period", "c.value").agg(F.count(F.lit(1)).alias("n"))


def category_drift(counts: DataFrame, is_reference: Column) -> DataFrame:
    """(feature, period, n_rows, n_missing, n_unseen, psi): bins are the
    reference's values, the missing and the unseen ones."""
    value = F.coalesce(F.concat(F.lit("="), "value"), F.lit("missing"))
    ref = counts.where(is_reference).groupBy("feature", value.alias("bin")).agg(F.sum("n").alias("ref_n"))
    ref_rows = ref.groupBy("feature").agg(F.sum("ref_n").alias("ref_rows"))
    cur = counts.where(~is_reference).select("feature", "period", value.alias("bin"), "n")
    # a period's value outside the reference goes to one bin
    known = ref.select("feature", "bin", F.lit(True).alias("known"))
    cur = cur.join(known, ["feature", "bin"], "left").withColumn(
        "bin", F.when(F.col("known") | (F.col("bin") == "missing"), F.col("bin")).otherwise("unseen"))
    cur = cur.groupBy("feature", "period", "bin").agg(F.sum("n").alias("n"))
    totals = cur.groupBy("feature", "period").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("bin") == "missing", F.col("n")).otherwise(0)).alias("n_missing"),
        F.sum(F.when(F.col("bin") == "unseen", F.col("n")).otherwise(0)).alias("n_unseen"))
    # every bin of the reference for every period, and what only the period has
    bins = totals.select("feature", "period").join(ref.select("feature", "bin"), "feature").unionByName(cur.select("feature", "period", "bin")).distinct()
    shares = (bins.join(cur, ["feature", "period", "bin"], "left").join(ref, ["feature", "bin"], "left")
              .join(totals.select("feature", "period", "n_rows"), ["feature", "period"]).join(ref_rows, "feature", "left"))
    p = F.greatest(F.coalesce("ref_n", F.lit(0)) / F.col("ref_rows"), F.lit(PSI_EPSILON))
    q = F.greatest(F.coalesce("n", F.lit(0)) / F.col("n_rows"), F.lit(PSI_EPSILON))
    index = shares.where("ref_rows > 0").groupBy("feature", "period").agg(F.sum((q - p) * F.ln(q / p)).alias("psi"))
    return totals.join(index, ["feature", "period"], "left").select("feature", "period", "n_rows", "n_missing", "n_unseen", "psi")

"""Distributed running sums over an ordered histogram, exact medians.

Exact AUC / average precision (A11, A12) need, for every distinct value, the
count of rows ranked at or before it.  A single ``Window`` ordered over all
values would run in one task.  Instead the histogram (one row per group and
distinct value, already small after a partial aggregation) is cut into value
ranges: every range computes its own running sums with a window partitioned
by the range id, and adds the totals of the ranges before it (a table of
``groups x ranges`` rows).

The bounds of numeric ranges are constants: quantiles of a KLL sketch of the rows,
and an even grid from the least to the greatest, so that a value of very many
rows does not leave the others to a few ranges.  The range is thus a function of the value
alone: the same after a lost executor, without a checkpoint, and the
histogram is shuffled once by it.  Strings have no sketch; their
histogram is range-partitioned by sampled bounds and checkpointed to the shared
folder, which pins one assignment for every consumer (``pinned_ranges``).

Medians (A16) narrow a bracket instead: a sketch of every column says where
the middle is, the next pass counts what lies below and inside, until few
values are left inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txguard.session import shared_dir

RANGE_ID = "_range"
SKETCH_K = 2000
FEW = 200_000


def pinned_ranges(hist: DataFrame, group_cols: Sequence[str], order_col: str,
                  descending: bool = False, n_ranges: int | None = None) -> DataFrame:
    spark = hist.sparkSession
    shared_dir(spark)   # a checkpoint folder must be configured (shared on a cluster)
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    ranged = (hist.repartitionByRange(n, *[F.col(g) for g in group_cols], order)
              .withColumn(RANGE_ID, F.spark_partition_id()))
    return ranged.checkpoint(eager=True)


def number(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def range_of(column: str, bounds: Sequence[float]) -> str:
    """SQL text of the number of ``bounds`` (ascending) below the column's
    value, as a decision tree."""
    def below(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"IF(`{column}` <= {number(bounds[mid])}, {below(lo, mid)}, {below(mid + 1, hi)})"

    return below(0, len(bounds))


def range_bounds(rows: DataFrame, column: str, n: int) -> list[float]:
    """About ``2 n`` ascending bounds that cut the values of ``rows`` finely
    wherever there are many of them; one row comes to the driver."""
    v = F.col(column).cast("double")
    v = F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), v)
    r = rows.agg(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias("s")).select(
        "n", "lo", "hi", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.array(*[F.lit(i / n) for i in range(1, n)]))).alias("q")).first() if n > 1 else None
    if r is None or not r["n"]:
        return []
    grid = [r["lo"] + (r["hi"] - r["lo"]) * i / n for i in range(1, n)]
    return sorted({*r["q"], *grid})


def valued_ranges(hist: DataFrame, column: str, bounds: Sequence[float], descending: bool = False) -> DataFrame:
    """``hist`` with its range, a function of the value."""
    rid = F.expr(range_of(column, bounds))
    return hist.withColumn(RANGE_ID, (F.lit(len(bounds)) - rid) if descending else rid)


def running_sums(ranged: DataFrame, group_cols: Sequence[str], order_col: str,
                 sum_cols: Sequence[str], descending: bool = False,
                 prefix: str = "c") -> DataFrame:
    """Adds ``<prefix><col>`` = sum of ``col`` over rows ordered at or before
    this one, per group (distinct ``order_col`` values assumed)."""
    g = list(group_cols)
    totals = ranged.groupBy(*g, RANGE_ID).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.partitionBy(*g).orderBy(RANGE_ID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*g, RANGE_ID, *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0))
                                            .alias(f"_o_{c}") for c in sum_cols])
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    within = (Window.partitionBy(*g, RANGE_ID).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = ranged.join(offsets, [*g, RANGE_ID])
    keep = [c for c in ranged.columns if c != RANGE_ID]
    return joined.select(*keep, *[(F.sum(c).over(within) + F.col(f"_o_{c}")).alias(f"{prefix}{c}")
                                  for c in sum_cols])


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of every column (NULL/NaN skipped; even counts take the
    midpoint of the two middle values): ``(feature, median)``.

    One pass sketches all columns at once, with no shuffle of rows; quantiles on both sides of
    the middle, further apart than the sketch can be off, bracket it.  While a bracket may
    hold more than ``FEW`` values, another pass sketches what is inside.  The last pass counts
    the values inside the brackets one by one and those below together, so what it
    shuffles and orders is small.  A bracket that misses the middle shows in
    the counts and is widened.  The result is a row per column."""
    value = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in columns}
    margin = dict.fromkeys(columns, 4 / SKETCH_K ** 0.9)
    medians: dict[str, float] = {}
    open_ = list(columns)
    while open_:
        brackets = _brackets(df, {c: value[c] for c in open_}, margin)
        open_ = []
        if not brackets:
            break
        stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE), {number(lo)}, {number(hi)}, {n}L" for c, (lo, hi, n) in brackets.items())
        rows = df.selectExpr(f"stack({len(brackets)}, {stack}) AS (feature, value, lo, hi, total)").where("value <= hi AND NOT isnan(value)")
        counts = rows.groupBy("feature", "total", F.when(F.col("value") >= F.col("lo"), F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("feature").orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = counts.withColumn("upto", F.sum("n").over(upto))
        holds = lambda r: (F.col("upto") - F.col("n") < r) & (r <= F.col("upto"))
        middle = ranked.groupBy("feature").agg(*[F.max(F.when(holds(F.expr(r)), F.col("value"))).alias(k)
                                                 for k, r in (("first", "(total + 1) div 2"), ("last", "total div 2 + 1"))])
        found = {r["feature"]: r for r in middle.collect()}
        for c in brackets:
            if c in found and found[c]["first"] is not None and found[c]["last"] is not None:
                medians[c] = (found[c]["first"] + found[c]["last"]) / 2
            else:
                margin[c] *= 4
                open_.append(c)
    return df.sparkSession.createDataFrame(list(medians.items()), "feature string, median double")


def _brackets(df: DataFrame, value: dict, margin: dict[str, float]) -> dict[str, tuple[float, float, int]]:
    """(least, greatest, number of values) of a stretch of every column that
    should hold its middle; none for a column without values."""
    out: dict[str, tuple[float, float, int]] = {}
    at = dict.fromkeys(value, (float("-inf"), float("inf")))
    open_ = list(value)
    while open_:
        cells = []
        for c in open_:
            inside = F.when(value[c].between(F.lit(at[c][0]), F.lit(at[c][1])), value[c])
            cells.append(F.struct(F.count(value[c]).alias("n"), F.count_if(value[c] < F.lit(at[c][0])).alias("below"), F.count(inside).alias("inside"),
                                  F.kll_sketch_agg_double(inside, F.lit(SKETCH_K)).alias("s")).alias(f"c{len(cells)}"))
        row = df.agg(*cells).persist()
        levels = {}
        for c, r in zip(open_, row.select(*[F.col(f"c{i}").dropFields("s") for i in range(len(open_))]).first(), strict=True):
            first, last = (r["n"] + 1) // 2, r["n"] // 2 + 1          # 1-based ranks of the middle pair
            if r["n"] and r["below"] < first and last <= r["below"] + r["inside"]:
                lo, hi = (first - r["below"]) / r["inside"] - margin[c], (last - r["below"]) / r["inside"] + margin[c]
                levels[c] = (max(0.0, lo), min(1.0, hi), r)
            elif r["n"]:
                margin[c], at[c], levels[c] = margin[c] * 4, (float("-inf"), float("inf")), None
        asked = [c for c in levels if levels[c]]
        if asked:
            ends = row.select(*[F.kll_sketch_get_quantile_double(f"c{open_.index(c)}.s", F.array(*[F.lit(x) for x in levels[c][:2]])) for c in asked]).first()
            for c, (lo, hi) in zip(asked, ends, strict=True):
                at[c] = (lo, hi)
                if (levels[c][1] - levels[c][0]) * levels[c][2]["inside"] <= FEW or lo == hi or levels[c][:2] == (0.0, 1.0):
                    out[c] = (lo, hi, levels[c][2]["n"])
        row.unpersist()
        open_ = [c for c in levels if c not in out]
    return out

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from txguard.operators import drift

SCHEMA = "period int, amt double, job string"


def brute_psi(p, q):
    total = 0.0
    for b in set(p) | set(q):
        a, c = (max(x.get(b, 0) / sum(x.values()), 1e-6) for x in (p, q))
        total += (c - a) * math.log(c / a)
    return total


def test_merged_sketches_give_the_index_of_the_rows(spark):
    rng = random.Random(2)
    rows = [(y, rng.gauss(y, 5) if rng.random() > 0.05 else [None, float("nan")][rng.randrange(2)], None) for y in (1, 2, 3, 4) for _ in range(700)]
    parts = [drift.numeric_sketches(spark.createDataFrame(rows[i::5], SCHEMA), ["amt"], F.col("period"), 20_000) for i in range(5)]
    stored = parts[0]
    for p in parts[1:]:
        stored = stored.unionByName(p)           # five batches of every period, merged when read
    got = {r["period"]: r for r in drift.numeric_drift(stored, F.col("period") <= 2, k=20_000).collect()}
    valid = lambda v: v is not None and not math.isnan(v)
    ref = sorted(v for y, v, _ in rows if y <= 2 and valid(v))
    edges = [ref[math.ceil(i / 10 * len(ref)) - 1] for i in range(1, 10)]
    bins = lambda years: {b: sum((sum(e < v for e in edges) if valid(v) else "missing") == b for y, v, _ in rows if y in years) for b in [*range(10), "missing"]}
    for y in (3, 4):
        assert abs(got[y]["psi"] - brute_psi(bins((1, 2)), bins((y,)))) < 1e-9
        assert got[y]["n_rows"] == 700 and got[y]["n_missing"] == sum(not valid(v) for x, v, _ in rows if x == y)
    assert set(got) == {3, 4}


def test_a_small_sketch_is_off_by_no_more_than_stated(spark):
    k, n = 200, 60_000
    rows = spark.range(n).select(F.lit(1).alias("period"), (F.xxhash64("id") / 1e12).alias("amt"), F.lit(None).cast("string").alias("job"))
    sketch = drift.numeric_sketches(rows.repartition(6), ["amt"], F.col("period"), k)
    edges = sketch.select(F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / 10) for i in range(1, 10)])).alias("e")).first()["e"]
    for i, e in enumerate(edges, 1):
        assert abs(rows.where(F.col("amt") <= e).count() / n - i / 10) < 2 * 1.65 / k ** 0.9


def test_empty_sides_have_no_index(spark):
    rows = [(1, None, None), (2, 1.0, "a"), (2, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    sketches = drift.numeric_sketches(df, ["amt"], F.col("period"))
    assert [tuple(r) for r in drift.numeric_drift(sketches, F.col("period") == 1).collect()] == [("amt", 2, 2, 1, None)]
    assert [r["psi"] for r in drift.numeric_drift(sketches, F.col("period") == 9).collect()] == [None, None]
    counts = drift.category_counts(df, ["job"], F.col("period"))
    assert [r["psi"] for r in drift.category_drift(counts, F.col("period") == 9).collect()] == [None, None]
    (r,) = drift.category_drift(counts, F.col("period") == 1).collect()
    assert (r["n_rows"], r["n_missing"], r["n_unseen"]) == (2, 1, 1) and abs(r["psi"] - brute_psi({"missing": 1}, {"missing": 1, "unseen": 1})) < 1e-9


def test_unseen_categories_share_one_bin(spark):
    rows = [(1, None, c) for c in "aaab"] + [(2, None, c) for c in "abxyz"] + [(2, None, "missing"), (2, None, None)]
    counts = drift.category_counts(spark.createDataFrame(rows, SCHEMA), ["job"], F.col("period"))
    (r,) = drift.category_drift(counts, F.col("period") == 1).collect()
    want = brute_psi({"a": 3, "b": 1}, {"a": 1, "b": 1, "unseen": 4, None: 1})
    assert (r["n_rows"], r["n_missing"], r["n_unseen"]) == (7, 1, 4) and abs(r["psi"] - want) < 1e-9

"""Document quality: regularised quadratic discriminant over text statistics.

``statistics`` takes a vector of transformed statistics of every whole text.
Means and second moments per class are sums over all labelled rows, taken in
one Spark aggregation; the driver sees them alone.  The class covariances are
shrunk towards their diagonal and floored, and each class keeps the Cholesky
factor of its covariance: a score is the logistic of the difference of the two
Mahalanobis log densities plus the log prior ratio, over a temperature.

Rows.  NULL and empty texts have the statistics of no words and are scored by
them.  Labels other than 0 and 1, and labels without a document, are not
learned from; of several labels of an id the largest counts.  Repeated rows
are scored each, and learned from as often as they occur.  With one class
only, its prior decides; without labels all scores are 0.  An empty table
gives an empty result.  Further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations_with_replacement
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.llm.common import map_arrow, slices

SHRINK = 0.1
FLOOR = 0.02       # of the pooled variance of a statistic
TEMPERATURE = 2.0
THRESHOLD = 0.3

SYMBOLS, PUNCTUATION = b"#*$%&|<>", b".,;:!?"
DIGITS, CAPITALS = b"0123456789", bytes(range(65, 91))
BEYOND_ASCII = bytes(range(128, 256))

NAMES = ("words", "word_length", "symbols", "bars", "distinct", "windows", "neighbours", "punctuation", "digits",
         "capitals", "beyond_ascii", "lines", "repeated_lines", "longest")


def vector(text: bytes | None) -> list[float]:
    """Transformed statistics of one text: logarithms of counts and of ratios."""
    t = text or b""
    w = t.lower().split()
    n, size = len(w), len(t)

    def ratio(count: float, of: float) -> float:
        return float(np.log((count + 0.5) / (of + 1.0)))

    def of(chars: bytes) -> int:
        return size - len(t.translate(None, chars))

    lines = [x for x in t.split(b"\n") if x.strip()]
    return [
        float(np.log1p(n)),
        ratio(size, n),
        ratio(of(SYMBOLS), n),
        ratio(t.count(b"|"), n),
        ratio(len(set(w)), n),
        ratio(max(n - 2, 0) - len(set(zip(w, w[1:], w[2:], strict=False))), n),
        ratio(sum(map(eq, w, w[1:])), n),
        ratio(of(PUNCTUATION), n),
        ratio(of(DIGITS), size),
        ratio(of(CAPITALS), size),
        ratio(of(BEYOND_ASCII), size),
        ratio(len(lines), n),
        ratio(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(max(map(len, w), default=0))),
    ]


def statistics(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id_col and the statistics s0, s1, ... of every document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                m = np.array([vector(t) for t in part.column("text").cast(pa.binary()).to_pylist()], np.float64).reshape(-1, len(NAMES))
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c) for c in m.T)], names=["id", *(f"s{i}" for i in range(len(NAMES)))])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    out = map_arrow(rows, run, f"id {kind}, " + ", ".join(f"s{i} double" for i in range(len(NAMES))))
    return out.withColumnRenamed("id", id_col)


def fit(stats: DataFrame, labels: DataFrame, train, id_col: str = "doc_id", label: str = "quality",
        shrink: float = SHRINK, floor: float = FLOOR) -> dict:
    """Class counts, means and Cholesky factors from all rows of ``stats``
    that fulfil ``train`` and have a label."""
    d = len(NAMES)
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.max(label).alias("__label"))
    rows = stats.filter(train).join(known, F.col(id_col) == F.col("__id"))
    pairs = list(combinations_with_replacement(range(d), 2))
    sums = rows.groupBy("__label").agg(
        F.count("*").alias("n"), *[F.sum(f"s{i}").alias(f"m{i}") for i in range(d)],
        *[F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"p{i}_{j}") for i, j in pairs]).collect()
    model: dict = {"n": {}, "mean": {}, "chol": {}}
    covariances = {}
    for r in sums:
        n, mean = r["n"], np.array([r[f"m{i}"] for i in range(d)]) / r["n"]
        second = np.zeros((d, d))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"] / n
        c = r["__label"]
        model["n"][c], model["mean"][c], covariances[c] = n, mean, second - np.outer(mean, mean)
    if not covariances:
        return model
    total = sum(model["n"].values())
    centre = sum(model["n"][c] * model["mean"][c] for c in covariances) / total
    pooled = sum(model["n"][c] * (np.diag(covariances[c]) + (model["mean"][c] - centre) ** 2) for c in covariances) / total
    pooled = np.maximum(pooled, 1e-6)
    for c, s in covariances.items():
        diagonal = np.maximum(np.diag(s), 0) + floor * pooled
        model["chol"][c] = np.linalg.cholesky((1 - shrink) * (s + np.diag(floor * pooled)) + shrink * np.diag(diagonal) + 1e-9 * np.diag(pooled))
    return model


def log_density(x: np.ndarray, mean: np.ndarray, chol: np.ndarray) -> np.ndarray:
    z = np.linalg.solve(chol, (x - mean).T)
    return -0.5 * (z * z).sum(axis=0) - np.log(np.diag(chol)).sum()


def score(stats: DataFrame, model: dict, id_col: str = "doc_id", temperature: float = TEMPERATURE) -> DataFrame:
    """id_col and ``score``: probability of class 1."""
    kind, d = stats.schema[id_col].dataType.simpleString(), len(NAMES)

    def run(batches):
        for batch in batches:
            if len(model["n"]) < 2:
                p = np.full(batch.num_rows, float(1 in model["n"]))
            else:
                x = np.column_stack([batch.column(f"s{i}").to_numpy(zero_copy_only=False) for i in range(d)])
                z = log_density(x, model["mean"][1], model["chol"][1]) - log_density(x, model["mean"][0], model["chol"][0])
                z = z / temperature + np.log(model["n"][1] / model["n"][0])
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(p, pa.float64())], names=["id", "score"])

    rows = stats.withColumnRenamed(id_col, "id")
    return map_arrow(rows, run, f"id {kind}, score double").withColumnRenamed("id", id_col)

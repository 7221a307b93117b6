"""Toxicity: a counterfactually regularised word classifier.

Logistic regression over the presence of selected words and word beginnings.  Beside the usual
loss, every sampled text that names a group is paired with copies in which the
group terms are swapped for others of their kind, and the squared difference
of the two logits is penalised: naming a group can then not move a score far,
so neutral mentions are not taken for toxicity.  A group term has no feature but
its own word, so a swap changes the presence of those features only, and a
pair is the difference of two sparse rows.

Fitting uses a bounded sample: at most about ``per_class`` labelled documents
of each class, drawn by a hash of the id and one of each set of near copies
(equal smallest hash of five-word shingles).  Word selection counts that
sample in Spark; the driver then fits at most ``max_words`` weights.  The
intercept is moved from the sample's class balance to that of all labelled
rows.  Scores read the whole text and nothing but the text.

Rows.  A NULL or empty text scores the intercept's probability.  Labels other
than 0 and 1, and labels without a document, are not learned from; of several
labels of an id the largest counts.  Repeated rows are scored each.  Without
labels of both classes there is nothing to learn: all scores are 0.  An empty
table gives an empty result.  Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.llm.common import map_arrow, slices, stored
from txguard.llm.decontaminate import item_words

# Terms that name a group, by kind; a swap stays within its kind.
GROUPS: dict[str, tuple[str, ...]] = {
    "gender": ("women", "men", "girls", "boys", "female", "male", "transgender", "woman", "man"),
    "religion": ("muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu", "buddhist", "atheist", "catholic"),
    "origin": ("black", "white", "asian", "african", "european", "latino", "arab", "immigrants", "refugees", "mexican", "chinese"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "queer", "homosexual", "heterosexual"),
    "ability": ("deaf", "blind", "disabled", "autistic"),
}
TERMS = frozenset(t.encode() for terms in GROUPS.values() for t in terms)
PER_CLASS = 4000
MAX_WORDS = 2048
MIN_SUPPORT = 3
MIN_Z = 2.5
L2 = 1e-4
SWAP_PENALTY = 1.0
SWAPS = 2
THRESHOLD = 0.7
STEPS = 600


def features(text: bytes | None) -> set[bytes]:
    """Distinct words of a text (after ``=``), and their first four and five
    bytes, which catch stems behind any ending.  Group terms give no beginnings:
    those would move a score past the penalty on swaps."""
    words = set(item_words(text))
    stems = words - TERMS
    return {b"=" + w for w in words} | {w[:4] for w in stems} | {w[:5] for w in stems}


def learnable(docs: DataFrame, labels: DataFrame, label: str, train, id_col: str = "doc_id") -> DataFrame:
    """(id, label) of the rows that may be learned from."""
    ids = docs.filter(train & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("label"))
    return known.join(ids, "id")


def sampled(known: DataFrame, per_class: int, seed: int) -> tuple[DataFrame, dict[int, int]]:
    """About ``per_class`` rows of each class, by a hash of the id, and the
    number of rows of each class."""
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    rate = F.lit(0.0)
    for c, n in counts.items():
        rate = F.when(F.col("label") == c, F.lit(min(1.0, per_class / n))).otherwise(rate)
    return known.filter(draw < rate), counts


def _sample_words(docs: DataFrame, picked: DataFrame, text: str, id_col: str) -> DataFrame:
    """(label, words) of the sampled documents, one of each set of near copies."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                keys, words = [], []
                for t in part.column("text").cast(pa.binary()).to_pylist():
                    w = item_words(t)
                    keys.append(min((xxhash.xxh64_intdigest(b" ".join(w[i:i + 5])) >> 1 for i in range(max(1, len(w) - 4))), default=0))
                    words.append(sorted(features(t)))
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(keys, pa.int64()), pa.array(words, pa.list_(pa.binary()))],
                                                 names=["label", "key", "words"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(picked, "id")
    found = map_arrow(rows.select("label", "text"), run, "label int, key bigint, words array<binary>")
    return found.groupBy("label", "key").agg(F.min("words").alias("words"))


def fit_logistic(x: np.ndarray, y: np.ndarray, swaps: np.ndarray, l2: float, swap_penalty: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept of: mean log loss + l2/2 |w|^2
    + swap_penalty/2 * mean over pairs of (swaps @ w)^2, by accelerated gradient."""
    n, m = len(x), max(1, len(swaps))
    gram = swaps.T @ swaps * (swap_penalty / m) if len(swaps) else np.zeros((x.shape[1], x.shape[1]), x.dtype)

    def top(a) -> float:  # largest eigenvalue of a.T @ a, a little above
        v = np.ones(a.shape[1], a.dtype)
        for _ in range(12):
            v = a.T @ (a @ v)
            v /= max(float(np.linalg.norm(v)), 1e-12)
        return 1.1 * float(np.linalg.norm(a @ v)) ** 2

    step = 1.0 / (0.25 * (top(x) / n + 1.0) + l2 + (float(np.linalg.norm(gram, 2)) if len(swaps) else 0.0))
    w, b = np.zeros(x.shape[1], x.dtype), 0.0
    vw, vb, t = w, b, 1.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-(x @ vw + vb)))
        err = (p - y).astype(x.dtype)
        nw = vw - step * (x.T @ err / n + l2 * vw + gram @ vw)
        nb = vb - step * float(err.mean())
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / t2 * (nw - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = nw, nb, t2
    return w.astype(np.float64), float(b)


def swap_rows(x: np.ndarray, vocabulary: list[bytes], swaps: int = SWAPS) -> np.ndarray:
    """x - x' of every text that names a group, x' with the terms of each kind
    replaced by others of the kind."""
    place = {w: i for i, w in enumerate(vocabulary)}
    out = []
    for terms in GROUPS.values():
        at = np.array([place[b"=" + t.encode()] for t in terms if b"=" + t.encode() in place], int)
        if len(at) < 2:
            continue
        rows = x[x[:, at].any(axis=1)]
        for k in range(1, 1 + min(swaps, len(at) - 1)):
            d = np.zeros_like(rows)
            d[:, at] = rows[:, at] - np.roll(rows[:, at], k, axis=1)
            out.append(d)
    return np.concatenate(out) if out else np.zeros((0, x.shape[1]), x.dtype)


def fit(docs: DataFrame, labels: DataFrame, train, text: str = "text", id_col: str = "doc_id", label: str = "toxic",
        per_class: int = PER_CLASS, max_words: int = MAX_WORDS, swap_penalty: float = SWAP_PENALTY, l2: float = L2,
        seed: int = 0) -> dict:
    """{"weights": feature -> weight, "intercept": float}; ``train`` is the
    condition on ``docs`` of the rows that may be learned from."""
    known = stored(learnable(docs, labels, label, train, id_col))
    picked, counts = sampled(known, per_class, seed)
    if not counts.get(0) or not counts.get(1):
        return {"weights": {}, "intercept": -float("inf")}
    # stored, so that its size is known: the sample is met by a broadcast, not by a shuffle of all texts
    picked = stored(picked)
    sample = stored(_sample_words(docs.filter(train), picked, text, id_col))
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return {"weights": {}, "intercept": -float("inf")}
    named = F.col("word").isin([F.lit(b"=" + t.encode()) for terms in GROUPS.values() for t in terms])
    a, b = F.col("ones") + 0.5, F.col("zeros") + 0.5
    odds = F.log(a / (n1 + 1.0 - F.col("ones"))) - F.log(b / (n0 + 1.0 - F.col("zeros")))
    ranked = (
        sample.select("label", F.explode("words").alias("word"))
        .groupBy("word").agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros"))
        .filter(F.col("ones") + F.col("zeros") >= MIN_SUPPORT)
        .withColumn("z", F.abs(odds / F.sqrt(1 / a + 1 / b)))
        .filter((F.col("z") >= MIN_Z) | named)
        .orderBy(named.desc(), F.col("z").desc(), "word").limit(max_words)
    )
    vocabulary = [bytes(r["word"]) for r in ranked.select("word").collect()]
    if not vocabulary:
        return {"weights": {}, "intercept": float(np.log(counts[1] / counts[0]))}
    place = {w: i for i, w in enumerate(vocabulary)}

    def placed(batches):
        for batch in batches:
            found = [np.array([place[w] for w in words if w in place], np.uint16).tobytes() for words in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.binary())], names=["label", "at"])

    rows = map_arrow(sample.select("label", "words"), placed, "label int, at binary").toArrow()
    x = np.zeros((rows.num_rows, len(vocabulary)), np.float32)
    for i, at in enumerate(rows.column("at").to_pylist()):
        x[i, np.frombuffer(at, np.uint16)] = 1
    y = rows.column("label").to_numpy().astype(np.float32)
    w, b = fit_logistic(x, y, swap_rows(x, vocabulary), l2, swap_penalty)
    b += float(np.log(counts[1] / counts[0]) - np.log(n1 / n0))
    return {"weights": {v: float(c) for v, c in zip(vocabulary, w, strict=True)}, "intercept": b}


def probabilities(text: pa.Array, model: dict) -> np.ndarray:
    weights, b = model["weights"], model["intercept"]
    known = weights.keys()
    z = [b + sum(weights[w] for w in sorted(known & features(t))) for t in text.cast(pa.binary()).to_pylist()]
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-np.array(z, np.float64)))


def score(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text by default) and ``score``."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "__text"):
                p = probabilities(part.column("__text"), shared.value)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + [pa.array(p, pa.float64())], names=[*keep, "__score"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    out = map_arrow(docs.select(*keep, F.col(text).alias("__text")), run, f"{kinds}`__score` double")
    return out.withColumnRenamed("__score", "score")


def keep_clean(docs: DataFrame, model: dict, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` less those that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(probabilities(part.column(text), shared.value) < threshold))

    return map_arrow(docs, run, docs.schema)

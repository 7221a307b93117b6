"""Language identification by interpolated Kneser-Ney character models.

A language's model covers the letters of a word, its start and its end.  The
counts of padded n-grams come from a bounded sample of labelled texts (about
``sample_bytes`` per language, whole texts drawn by a hash of the id) and are
summed in Spark; lower orders are continuation counts of the next higher one.

All models share sorted arrays of 64-bit n-gram hashes, one per order, with a
column per language: the discounted probability of the n-gram's last letter
and the weight its context hands down to the next lower order.  The arrays are
bounded by the sample and are broadcast.  A text's cross-entropy per letter is
the mean over its words; each distinct word of a slice is looked up once.

The language with the lowest cross-entropy wins.  ``score`` is its share after
a softmax of ``sharpness`` times the negative cross-entropies.  Rejection is
calibrated: ``rejected`` says that the cross-entropy lies above what all but
``1 - calibration`` of the sampled texts of that language have.

Rows.  NULL texts and texts without a letter are ``und`` with score 0 and are
not rejected.  Rows without language are not learned from.  Repeated rows are
each judged.  Languages tied to the last bit go to the first by name.  Without
anything to learn all are ``und``.  An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.llm.common import map_arrow, row_sums, slices, stored, words

ORDER = 4
SAMPLE_BYTES = 3_000_000
SHARPNESS = 12.0
CALIBRATION = 0.995
WORDS_AT_ONCE = 20_000
UNKNOWN = "und"
START, END = "\x02", "\x03"


def letters(text: pa.Array) -> pa.Array:
    """Lower-case letters, everything between them one blank."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(text, "")), r"[^\p{L}]+", " ")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def ngram_hashes(code: np.ndarray, order: int) -> list[np.ndarray]:
    """hashes[k - 1][i]: the k-gram that ends at letter i."""
    letter = _mix(code.astype(np.uint64) + np.uint64(1))
    out = [letter]
    for k in range(1, order):
        before = np.zeros_like(letter)
        before[k:] = letter[:-k] if k else letter
        out.append(_mix(out[-1] * np.uint64(0x100000001B3) + before))
    return out


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)


# ---- fitting -------------------------------------------------------------

def counts(docs: DataFrame, text: str, lang: str, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): padded n-grams of the highest order."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                distinct, codes, offsets = words(letters(part.column("text")))
                names = part.column("lang").to_pylist()
                spelled = distinct.to_pylist()
                for name in sorted(set(names)):
                    rows = np.flatnonzero([x == name for x in names])
                    mine = np.concatenate([codes[offsets[r]:offsets[r + 1]] for r in rows])
                    grams: Counter = Counter()
                    for c, n in zip(*(x.tolist() for x in np.unique(mine, return_counts=True)), strict=True):
                        w = START * (order - 1) + spelled[c] + END
                        for i in range(len(w) - order + 1):
                            grams[w[i:i + order]] += n
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())],
                                                     names=["lang", "gram", "n"])

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    return map_arrow(rows, run, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(grams: dict[str, int], order: int) -> tuple[list[dict[str, float]], list[dict[str, float]], float]:
    """Per order 1..order the discounted probabilities of n-grams and the
    hand-down weights of their contexts; and the uniform probability below."""
    level = dict(grams)
    probs, weights = [], []
    for k in range(order, 0, -1):
        once, twice = sum(v == 1 for v in level.values()), sum(v == 2 for v in level.values())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        total: Counter = Counter()
        kinds: Counter = Counter()
        for g, v in level.items():
            total[g[:-1]] += v
            kinds[g[:-1]] += 1
        probs.append({g: (v - discount) / total[g[:-1]] for g, v in level.items()})
        weights.append({h: discount * kinds[h] / total[h] for h in total})
        lower: Counter = Counter()
        for g in level:  # continuation counts
            lower[g[1:]] += 1
        level = lower
    alphabet = len({g for g in probs[-1]}) + 1
    return probs[::-1], weights[::-1], 1.0 / alphabet


def tables(grams: dict[str, dict[str, int]], order: int = ORDER) -> dict:
    """Sorted hash arrays of all languages."""
    langs = sorted(grams)
    fitted = [kneser_ney(grams[name], order) for name in langs]
    model: dict = {"langs": langs, "order": order, "uniform": np.array([f[2] for f in fitted]), "prob": [], "weight": []}
    for part, key in ((0, "prob"), (1, "weight")):
        for k in range(order):
            size = k + 1 if part == 0 else k  # letters of the n-gram, or of its context
            if size == 0:
                model[key].append((np.zeros(1, np.uint64), np.array([[f[1][0][""] for f in fitted]], np.float32)))
                continue
            spelled = sorted({g for f in fitted for g in f[part][k]})
            code = _codes(spelled).reshape(-1, size)
            h = ngram_hashes(code.ravel(), size)[-1].reshape(-1, size)[:, -1]
            # a context that a language has not seen hands everything down
            values = np.array([[f[part][k].get(g, float(part)) for f in fitted] for g in spelled], np.float32)
            at = np.argsort(h)
            model[key].append((h[at], values[at]))
    return model


def _look(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
    hashes, values = table
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    out = values[at].astype(np.float64)
    out[hashes[at] != keys] = missing
    return out


def word_costs(spelled: list[str], model: dict) -> np.ndarray:
    """Bits of every word under every language, its end included."""
    parts = [_word_costs(spelled[i:i + WORDS_AT_ONCE], model) for i in range(0, len(spelled), WORDS_AT_ONCE)]
    return np.concatenate(parts) if parts else np.zeros((0, len(model["langs"])))


def _word_costs(spelled: list[str], model: dict) -> np.ndarray:
    order, size = model["order"], np.fromiter(map(len, spelled), np.int64, len(spelled))
    code = _codes([START * (order - 1) + w + END for w in spelled])
    hashes = ngram_hashes(code, order)
    begins = np.cumsum(size + order) - (size + order)
    scored = np.ones(len(code), bool)
    for k in range(order - 1):
        scored[begins + k] = False
    at = np.flatnonzero(scored)
    p = np.broadcast_to(model["uniform"], (len(at), len(model["langs"])))
    for k in range(order):
        context = model["weight"][0][1] if k == 0 else _look(model["weight"][k], hashes[k - 1][at - 1], 1.0)
        p = _look(model["prob"][k], hashes[k][at], 0.0) + context * p
    cost = -np.log2(p)
    return row_sums(cost, np.concatenate([[0], np.cumsum(size + 1)]))


def identify(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None, limits: dict[str, float] | None = None,
             sharpness: float = SHARPNESS) -> DataFrame:
    """The columns ``keep`` and lang_pred, score, cross_entropy, rejected."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast((model, limits or {}))

    def run(batches):
        model, limits = shared.value
        names = np.array([*model["langs"], UNKNOWN], object)
        most = np.array([limits.get(name, np.inf) for name in model["langs"]] + [np.inf])
        for batch in batches:
            for part in slices(batch, "__text"):
                n, none = part.num_rows, len(model["langs"])
                best, p, h = np.full(n, none), np.zeros(n), np.full(n, np.nan)
                distinct, codes, offsets = words(letters(part.column("__text")))
                if none and len(codes):
                    spelled = distinct.to_pylist()
                    cost = word_costs(spelled, model)
                    size = np.fromiter(map(len, spelled), np.int64, len(spelled)) + 1
                    length = row_sums(size[codes], offsets)
                    entropy = row_sums(cost[codes], offsets) / np.maximum(length, 1)[:, None]
                    least = entropy.argmin(axis=1)
                    e = np.exp(-sharpness * (entropy - entropy.min(axis=1, keepdims=True)))
                    has = length > 0
                    best = np.where(has, least, none)
                    p = np.where(has, 1 / e.sum(axis=1), 0.0)
                    h = np.where(has, entropy.min(axis=1), np.nan)
                with np.errstate(invalid="ignore"):
                    rejected = h > most[best]
                out = [part.column(i) for i in range(len(keep))]
                out += [pa.array(names[best].tolist(), pa.string()), pa.array(p), pa.array(h, from_pandas=True, type=pa.float64()), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(out, names=[*keep, "lang_pred", "score", "cross_entropy", "rejected"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return map_arrow(
        docs.select(*keep, F.col(text).alias("__text")), run, f"{kinds}lang_pred string, score double, cross_entropy double, rejected boolean")


def fit(docs: DataFrame, train, text: str = "text", lang: str = "lang", id_col: str = "doc_id", order: int = ORDER,
        sample_bytes: int = SAMPLE_BYTES, calibration: float = CALIBRATION, seed: int = 0) -> tuple[dict, dict[str, float]]:
    """(model, limits): models of all languages of the rows that fulfil
    ``train``, and the calibrated highest cross-entropy of each."""
    rows = docs.filter(train & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_col).alias("__id"), F.col(text).alias("__text"), F.col(lang).alias("__lang"))
    sizes = rows.groupBy("__lang").agg(F.sum(F.octet_length("__text")).alias("bytes")).collect()  # a row per language
    draw = F.pmod(F.xxhash64("__id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    rate = F.lit(1.0)
    for r in sizes:
        rate = F.when(F.col("__lang") == r["__lang"], F.lit(min(1.0, sample_bytes / max(r["bytes"], 1)))).otherwise(rate)
    sample = stored(rows.filter(draw < rate))
    grams: dict[str, dict[str, int]] = {}
    for r in counts(sample, "__text", "__lang", order).toArrow().to_batches():
        for name, gram, n in zip(*(c.to_pylist() for c in r.columns), strict=True):
            grams.setdefault(name, {})[gram] = n
    model = tables(grams, order)
    own = identify(sample, model, "__text", ["__lang"]).filter("cross_entropy IS NOT NULL AND lang_pred = __lang")
    limits = own.groupBy("__lang").agg(F.percentile_approx("cross_entropy", calibration).alias("most")).collect()
    return model, {r["__lang"]: r["most"] for r in limits}

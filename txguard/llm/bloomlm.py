"""Language-model scores from a log-frequency Bloom filter.

Every document is a sequence of words, A-Z lower-cased, and one end.  The words and
bigrams of all training documents are counted; a bigram with count c has the level
1 + floor(log_base c), and the filter holds the pairs (bigram, 1) ...
(bigram, level).  A reader probes level after level until one is missing and
so gets the quantised count back; an absent bigram passes for level 1 with the
filter's false-positive rate only, and not at all if one of its words is unknown: the exact
counts of both words bound its own.  The share of a bigram among those of its first word
is discounted by ``DISCOUNT`` and interpolated with the smoothed unigram, which
also takes the mass that the discount frees for certain (a known word has one successor
or more).

Counting.  One pass over the training texts.  A task reduces a slice to its distinct words
and bigrams and deals them by the top bits of their hashes to ranges, one row
per range that it meets: words as they are, bigrams as arrays of the next 32 bits.  A range
sums its rows.  The number of ranges grows with the text, so a range
stays small and the hash gets longer as the corpus grows.  The filter has
``bits_per_entry`` bits for each pair and grows with them.  The filter of a range is one
segment, built where the range is.

Scoring.  A chunk is a hash bucket of documents with about ``SCORE_BYTES`` of text.  It
asks each range for its distinct words there (each occurs once per chunk, however
frequent) and, if the filter is larger than ``broadcast_bits``, for its
distinct bigrams; the answers come back in the order of the hashes and meet the
chunk's texts in a cogroup.  A smaller filter is broadcast and probed there.  Both ways
read the same bits, so the scores are the same.

Rows.  A NULL text is an empty one: its only token is the end.  Repeated rows
are documents of their own; rows equal in id and text share a chunk.  Rows without an id are dealt by their text.  Without training documents N and V are 0 and the base is that of the
formula.  An empty table gives an empty result.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.llm.common import map_arrow, row_sums, slices, stored, words

CHUNK_BYTES = 24 << 20
SCORE_BYTES = 12 << 20  # of text per chunk: held by one task with its bigrams
PIECE_BYTES = 8 << 20   # of a chunk, tokenised at once
BATCH_BYTES = 24 << 20   # as large as a slice: counting gains from large ones, words repeat
RANGE_BYTES = 8 << 20   # of text per range
BASE = 1.5              # of the levels
PROBES = 3
BITS_PER_ENTRY = 16
BROADCAST_BITS = 1 << 27  # a larger filter is probed by a join
LAMBDA = 0.6
DISCOUNT = 0.5
END_HASH = np.uint64(0x5DEECE66D1234567)


# ---- hashes and levels ---------------------------------------------------

def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lower_words(text: pa.Array):
    """``words`` of texts with A-Z lower-cased."""
    return words(pc.ascii_lower(text))


def word_hashes(distinct: pa.Array) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in distinct.cast(pa.binary()).to_pylist()), np.uint64, len(distinct))


def distinct_of(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values: by sorting, since numpy's ``unique`` alone goes
    through a hash table, many times slower here."""
    h = np.sort(h)
    return h[np.append(True, h[1:] != h[:-1])[:len(h)]]


def unigram(h: np.ndarray) -> np.ndarray:
    return mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5))


def bigram(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def level(count: np.ndarray, base: float = BASE) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(count, 1)) / np.log(base) + 1e-9).astype(np.int64)


def quantised(lv: np.ndarray, base: float = BASE) -> np.ndarray:
    """Middle of the counts of a level; 0 for level 0."""
    low = np.ceil(base ** (lv - 1.0) - 1e-9)
    high = np.maximum(np.ceil(base ** lv.astype(float) - 1e-9) - 1, low)
    return np.where(lv > 0, (low + high) / 2, 0.0)


def split_hash(h: np.ndarray, range_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(range, next 32 bits)."""
    return (h >> np.uint64(64 - range_bits)).astype(np.int64), ((h >> np.uint64(32 - range_bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def bit_places(rest: np.ndarray, lv: int, probe: int, bits: int) -> np.ndarray:
    salt = np.uint64((lv * 64 + probe + 1) << 32)
    return (mix(rest.astype(np.uint64) ^ salt) % np.uint64(bits)).astype(np.int64)


def sequences(codes: np.ndarray, offsets: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, one end before the first text and after each, and
    the offsets of the texts' bigrams in them."""
    with_end = np.insert(hashes[codes], offsets[1:], END_HASH)
    return np.concatenate([[END_HASH], with_end]), offsets + np.arange(len(offsets))


# ---- counting ------------------------------------------------------------

def stretches(where: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(range, first, end) of every range met in the ascending ``where``."""
    first = np.flatnonzero(np.append(True, where[1:] != where[:-1])) if len(where) else np.zeros(0, np.int64)
    yield from zip(where[first].tolist(), first.tolist(), np.append(first[1:], len(where)).tolist(), strict=True)


def ngram_ranges(docs: DataFrame, text: str, range_bits: int) -> DataFrame:
    """(range, words, times, once, many, counts): distinct words and hashes of
    distinct bigrams of each slice."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                distinct, codes, offsets = lower_words(part.column("text"))
                hashes = word_hashes(distinct)
                seq, _ = sequences(codes, offsets, hashes)
                two, n = np.unique(bigram(seq[:-1], seq[1:]), return_counts=True)
                where, rest = split_hash(two, range_bits)
                times = np.bincount(codes, minlength=len(distinct))
                used = np.flatnonzero(times)
                place, _ = split_hash(unigram(hashes[used]), range_bits)
                used = used[np.argsort(place, kind="stable")]
                place = np.sort(place)
                rows = {r: [used[i:j], None] for r, i, j in stretches(place)}
                for r, i, j in stretches(where):
                    rows.setdefault(r, [used[:0], None])[1] = (rest[i:j], n[i:j])
                out = {"range": [], "words": [], "times": [], "once": [], "many": [], "counts": []}
                for r, (w, pairs) in rows.items():
                    x, m = pairs or (rest[:0], n[:0])
                    for name, v in (("range", r), ("words", w), ("times", times[w].astype(np.int64).tobytes()), ("once", x[m == 1].tobytes()),
                                    ("many", x[m > 1].tobytes()), ("counts", m[m > 1].astype(np.uint32).tobytes())):
                        out[name].append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["range"], pa.int32()), word_lists(distinct, out["words"]), *[pa.array(out[c], pa.binary()) for c in ("times", "once", "many", "counts")]],
                    names=list(out))

    return map_arrow(docs.select(F.col(text).alias("text")), run,
                     "range int, words array<string>, times binary, once binary, many binary, counts binary", BATCH_BYTES)


def word_lists(distinct: pa.Array, rows: list[np.ndarray]) -> pa.ListArray:
    """Lists of the words with the given numbers."""
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), distinct.take(pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))))


def summed_ranges(dealt: DataFrame, base: float = BASE) -> DataFrame:
    """(range, rest, levels, histogram, words, times, n_words, n_tokens): all
    bigrams of a range with their levels, all words with their counts."""
    def run(t: pa.Table) -> pa.Table:
        def joined(name, dtype):
            return np.concatenate([np.frombuffer(x, dtype) for x in t.column(name).to_pylist()])

        once, many, counts = joined("once", np.uint32), joined("many", np.uint32), joined("counts", np.uint32)
        keys = np.concatenate([once, many])
        order = np.argsort(keys, kind="stable")
        n = np.concatenate([np.ones(len(once), np.int64), counts.astype(np.int64)])[order]
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        n = np.add.reduceat(n, first) if len(keys) else n
        lv = level(n, base)
        coded = t.column("words").combine_chunks().flatten().dictionary_encode()
        times = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(times, coded.indices.to_numpy(), joined("times", np.int64))
        return pa.table({"range": t.column("range")[:1], "rest": pa.array([keys[first].tobytes()], pa.binary()),
                         "levels": pa.array([lv.astype(np.uint8).tobytes()], pa.binary()),
                         "histogram": pa.array([np.bincount(lv, minlength=1).tolist()], pa.list_(pa.int64())),
                         "words": pa.ListArray.from_arrays(pa.array([0, len(times)], pa.int32()), coded.dictionary),
                         "times": pa.array([times.tobytes()], pa.binary()),
                         "n_words": pa.array([len(times)], pa.int64()), "n_tokens": pa.array([int(times.sum())], pa.int64())})

    return dealt.groupBy("range").applyInArrow(
        run, "range int, rest binary, levels binary, histogram array<bigint>, words array<string>, times binary, n_words bigint, n_tokens bigint")


def filter_shape(ranges: DataFrame, range_bits: int, bits_per_entry: int = BITS_PER_ENTRY, probes: int = PROBES,
                 base: float = BASE) -> dict:
    """The filter but for its bits: ``segment`` is the bits of a range."""
    found = ranges.select(F.posexplode("histogram").alias("level", "n")).groupBy("level").agg(F.sum("n").alias("n")).collect()
    by_level = {r["level"]: r["n"] for r in found if r["n"]}
    entries = sum(lv * n for lv, n in by_level.items())
    segment = max(64, -(-entries * bits_per_entry >> range_bits) // 8 * 8 + 8)
    return {"segment": segment, "range_bits": range_bits, "probes": probes, "base": base, "top": max(by_level, default=0)}


def segment_bits(rest: bytes, levels: bytes, shape: dict) -> np.ndarray:
    x, lv = np.frombuffer(rest, np.uint32), np.frombuffer(levels, np.uint8)
    flags = np.zeros(shape["segment"], bool)
    for j in range(1, int(lv.max(initial=0)) + 1):
        x, lv = x[lv >= j], lv[lv >= j]
        for p in range(shape["probes"]):
            flags[bit_places(x, j, p, shape["segment"])] = True
    return np.packbits(flags)


def segments(ranges: DataFrame, shape: dict) -> DataFrame:
    """(range, bits): the filter's segment of every range."""
    def run(batches):
        for batch in batches:
            for r, rest, levels in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                bits = segment_bits(rest, levels, shape).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([bits], pa.binary())], names=["range", "bits"])

    return map_arrow(ranges.select("range", "rest", "levels"), run, "range int, bits binary")


def build_filter(ranges: DataFrame, range_bits: int, shape: dict | None = None) -> dict:
    """The whole filter on the driver; ``score`` asks it up to ``broadcast_bits``."""
    shape = shape or filter_shape(ranges, range_bits)
    size = shape["segment"] // 8
    bits = np.zeros(size << range_bits, np.uint8)
    for r in segments(ranges, shape).toLocalIterator():
        bits[r["range"] * size:(r["range"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return shape | {"bits": bits}


def probe_rest(shape: dict, bits: np.ndarray, at, rest: np.ndarray) -> np.ndarray:
    """Level of every hash, its segment starting at bit ``at``: probed upwards
    until a level is missing."""
    at, lv = np.broadcast_to(at, len(rest)), np.zeros(len(rest), np.int64)
    live = np.arange(len(rest))
    for j in range(1, shape["top"] + 1):
        for p in range(shape["probes"]):
            place = at[live] + bit_places(rest[live], j, p, shape["segment"])
            live = live[(bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1]
        if not len(live):
            break
        lv[live] = j
    return lv


def probe(flt: dict, h: np.ndarray) -> np.ndarray:
    where, rest = split_hash(h, flt["range_bits"])
    return probe_rest(flt, flt["bits"], where * flt["segment"], rest)


class Chunk:
    """The texts of a chunk in bounded pieces, its distinct words and bigrams
    in the order of their hashes."""

    def __init__(self, text: pa.Array, bigrams: bool, texts: bool = True):
        """``bigrams``: all of the chunk's in one order; ``texts``: each piece's
        bigrams with their places."""
        self.pieces, pairs, hashes, words_ = [], [], [], []
        for part in slices(pa.RecordBatch.from_arrays([text], names=["text"]), "text", PIECE_BYTES):
            distinct, codes, offsets = lower_words(part.column("text"))
            own = word_hashes(distinct)
            seq, starts = sequences(codes, offsets, own)
            if texts:
                two, at = np.unique(bigram(seq[:-1], seq[1:]), return_inverse=True)
                self.pieces.append((distinct, codes, offsets, starts, two, at))
                pairs.append(two)
            elif bigrams:
                pairs.append(distinct_of(bigram(seq[:-1], seq[1:])))
            hashes.append(unigram(own))
            words_.append(distinct)
        self.pairs = (distinct_of(np.concatenate(pairs)) if len(pairs) > 1 else pairs[0]) if bigrams else None
        coded = pa.chunked_array(words_).combine_chunks().dictionary_encode() if len(words_) > 1 else None
        if coded is None:
            words, h = words_[0], hashes[0]
            self.place = [np.arange(len(words))]
        else:
            words, codes = coded.dictionary, coded.indices.to_numpy()
            h = np.zeros(len(words), np.uint64)
            h[codes] = np.concatenate(hashes)
            self.place = np.split(codes, np.cumsum([len(w) for w in words_])[:-1])
        order = np.argsort(h, kind="stable")
        if (h[order][1:] == h[order][:-1]).any():  # words of one hash: by their bytes, so that the order is the same anywhere
            order = np.array(sorted(range(len(h)), key=lambda i: (int(h[i]), words[i].as_py())))
        self.words, self.hashes = words.take(pa.array(order)), h[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.place = [rank[p] for p in self.place]    # of each piece's distinct words, in ``words``


def asked_ranges(rows: DataFrame, range_bits: int, bigrams: bool) -> DataFrame:
    """(chunk, range, words, rest): what every chunk of ``rows`` (chunk, id,
    text) asks a range, in the order of the hashes."""
    def run(t: pa.Table) -> pa.Table:
        chunk = Chunk(t.column("text").combine_chunks(), bigrams, texts=False)
        place, _ = split_hash(chunk.hashes, range_bits)
        found = {r: [slice(i, j), slice(0)] for r, i, j in stretches(place)}
        rest = np.zeros(0, np.uint32)
        if bigrams:
            where, rest = split_hash(chunk.pairs, range_bits)
            for r, i, j in stretches(where):
                found.setdefault(r, [slice(0), None])[1] = slice(i, j)
        number = np.arange(len(chunk.words))
        return pa.table({"chunk": pa.array([t.column("chunk")[0].as_py()] * len(found), pa.int32()), "range": pa.array(list(found), pa.int32()),
                         "words": word_lists(chunk.words, [number[w] for w, _ in found.values()]),
                         "rest": pa.array([rest[x].tobytes() for _, x in found.values()], pa.binary())})

    return rows.groupBy("chunk").applyInArrow(run, "chunk int, range int, words array<string>, rest binary")


def answered(asked: DataFrame, ranges: DataFrame, shape: dict) -> DataFrame:
    """(chunk, range, times, levels): counts of the words and levels of the
    bigrams that were asked."""
    def run(t: pa.Table, own: pa.Table) -> pa.Table:
        known, flags, n = None, None, np.zeros(1, np.int64)
        if own.num_rows:
            known = own.column("words").combine_chunks().flatten()
            n = np.append(np.frombuffer(own.column("times")[0].as_py(), np.int64), 0)
            if any(t.column("rest").to_pylist()):
                flags = segment_bits(own.column("rest")[0].as_py(), own.column("levels")[0].as_py(), shape)
        lists = t.column("words").combine_chunks()
        flat = lists.flatten()
        times = n[pc.fill_null(pc.index_in(flat, value_set=known), len(n) - 1).to_numpy()] if known is not None else np.zeros(len(flat), np.int64)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        levels = []
        for x in t.column("rest").to_pylist():
            rest = np.frombuffer(x, np.uint32)
            lv = np.zeros(len(rest), np.int64) if flags is None else probe_rest(shape, flags, 0, rest)
            levels.append(lv.astype(np.uint8).tobytes())
        return pa.table({"chunk": t.column("chunk"), "range": t.column("range"),
                         "times": pa.array([times[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                         "levels": pa.array(levels, pa.binary())})

    own = ranges.select("range", "rest", "levels", "words", "times")
    return asked.groupBy("range").cogroup(own.groupBy("range")).applyInArrow(run, "chunk int, range int, times binary, levels binary")


# ---- scoring -------------------------------------------------------------

def model_log10(levels: np.ndarray, base: float, totals: dict, counts: np.ndarray, codes: np.ndarray, offsets: np.ndarray,
                starts: np.ndarray, weight: float, discount: float) -> np.ndarray:
    """log10 probability of every text; ``levels`` are the filter's of all
    bigrams of the texts in their order, ``counts`` the exact ones of the distinct words."""
    each = np.insert(counts[codes], offsets[1:], totals["ends"]).astype(float)   # of all tokens, the end behind each text
    first = np.concatenate([[totals["ends"]], each[:-1]])
    both = np.minimum(quantised(levels, base), np.minimum(first, each))
    seen = np.maximum(first, 1.0)
    one = (each + 0.5) / (totals["n"] + 0.5 * (totals["v"] + 1))
    weight = np.where(first > 0, weight, 0.0)                                     # nothing is known of what follows an unknown word
    p = weight * (np.maximum(both - discount, 0.0) + discount * one) / seen + (1 - weight) * one
    return row_sums(np.log10(np.minimum(p, 1.0)), starts)


def chunk_of(id_col: str, text: str, chunks: int) -> Column:
    """The text is hashed too, so that rows of one id, or of none, spread."""
    return F.pmod(F.xxhash64(id_col, text), F.lit(chunks)).cast("int")


def score(docs: DataFrame, train: Column, text: str = "text", id_col: str = "doc_id", weight: float = LAMBDA, discount: float = DISCOUNT,
          broadcast_bits: int = BROADCAST_BITS, chunk_bytes: int = SCORE_BYTES) -> DataFrame:
    """id_col, n_tokens, n_known, train_tokens, base_score, score; learned
    from the documents that fulfil ``train``."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    learned = docs.filter(train)
    ends = learned.count()
    range_bits = max(4, int(np.ceil(np.log2(max(1, size / RANGE_BYTES)))))
    ranges = stored(summed_ranges(ngram_ranges(learned, text, range_bits)))
    summed = ranges.agg(F.sum("n_tokens").alias("n"), F.sum("n_words").alias("v")).first()
    totals = {"n": (summed["n"] or 0) + ends, "v": (summed["v"] or 0) + (ends > 0), "ends": ends}
    shape = filter_shape(ranges, range_bits)
    small = shape["segment"] << range_bits <= broadcast_bits
    shared = spark.sparkContext.broadcast(build_filter(ranges, range_bits, shape=shape)) if small else None

    chunks = max(1, -(-size // chunk_bytes))
    rows = docs.select(chunk_of(id_col, text, chunks).alias("chunk"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    found = answered(asked_ranges(rows, range_bits, bigrams=not small), ranges, shape)

    def run(t: pa.Table, found: pa.Table) -> pa.Table:
        ids = t.column("id").combine_chunks()
        chunk = Chunk(t.column("text").combine_chunks(), bigrams=not small)
        found = found.sort_by("range")
        times = np.frombuffer(b"".join(found.column("times").to_pylist()), np.int64)
        got = np.frombuffer(b"".join(found.column("levels").to_pylist()), np.uint8)
        all_ = totals["n"] + 0.5 * (totals["v"] + 1)
        end, out, first = float(np.log10((totals["ends"] + 0.5) / all_)), [], 0
        for (distinct, codes, offsets, starts, two, at), place in zip(chunk.pieces, chunk.place, strict=True):
            n = times[place]
            levels = probe(shared.value, two) if small else got[np.searchsorted(chunk.pairs, two)]
            log = np.log10((n + 0.5) / all_)
            own = ids.slice(first, len(offsets) - 1)
            first += len(own)
            out.append(pa.RecordBatch.from_arrays(
                [own, pa.array(np.diff(offsets) + 1, pa.int64()),
                 pa.array(row_sums((n[codes] > 0).astype(np.int64), offsets) + int(totals["ends"] > 0), pa.int64()),
                 pa.array(np.full(len(own), totals["n"]), pa.int64()),
                 pa.array(row_sums(log[codes], offsets) + end),
                 pa.array(model_log10(levels[at].astype(np.int64), shape["base"], totals, n, codes, offsets, starts, weight, discount))],
                schema=schema(own.type)))
        return pa.Table.from_batches(out, schema(ids.type))

    def schema(id_type: pa.DataType) -> pa.Schema:
        return pa.schema([("id", id_type), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                          ("base_score", pa.float64()), ("score", pa.float64())])

    out = rows.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        run, f"id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("id", id_col)

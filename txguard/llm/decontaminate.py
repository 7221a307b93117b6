"""Benchmark decontamination with suffix arrays over the documents.

Each slice of documents is a shard with a word-level suffix array.  Every
suffix of every benchmark item is searched in it by bisection, all suffixes
at once: the interval of suffixes that agree with the first d words is
narrowed word by word, so the interval at the window length holds all places
of that window and the depth at which the interval gets empty is the length of
the longest verbatim match.  Words in any place of a window are hit.

A window is ``window`` consecutive words of an item; an item of fewer words,
but not none, is one window.  Only stretches of documents whose words all occur
in the benchmark, and that are as long as the shortest window, can hold one;
the other words stay out of the suffix array, which loses no match.

The suffix array is ranked by prefix doubling up to the longest window; equal
suffixes beyond that stay in place order.  Equal windows are searched once, and
items of equal words are one text with several names.  A longest match is
walked word by word from each place where a match begins (the words before it
differ); the pairs of such places are looked at ``PAIRS`` at a time and only
the best of a document and item is kept, so a word that fills both costs time but no memory.

The benchmark is a stated query set.  It is dealt into blocks of at most
``block_words`` words (one item at least); one block at a time is collected,
broadcast and released, and of several blocks each one's hits are stored before the next
begins.  The hits of all blocks are merged per document.

Rows.  A NULL or wordless text has no words, an item without words no window.
Items that repeat an id count as one item; an item with a NULL id is the item
with the empty id.  Repeated documents are judged each; rows that share a
``doc_id`` but not their text keep their own counts.  Empty tables give no
rows or no hits.  Further columns are ignored.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.llm.common import map_arrow, slices, spare, stored

WINDOW = 10
BLOCK_WORDS = 2_000_000
PAIRS = 1 << 20
# A-Z become a-z, digits, a-z and bytes of other scripts stay, all else separates.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def item_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def ranked(words: np.ndarray, depth: int) -> tuple[np.ndarray, int]:
    """Ranks of all places by their first k words, k the largest power of two
    up to ``depth``; the end sorts before any word."""
    rank, k = np.unique(words, return_inverse=True)[1] + 1, 1
    while 2 * k <= depth:
        rank, k = doubled(rank, k), 2 * k
    return rank, k


def doubled(rank: np.ndarray, k: int) -> np.ndarray:
    after = np.zeros_like(rank)
    after[:-k] = rank[k:]
    return np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1] + 1


class Benchmark:
    """A block of items: their distinct texts as coded words, the distinct
    windows of these and where they occur."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.codes: dict[bytes, int] = {}
        self.items = sorted({i for i, w in items if w})
        place = {i: k for k, i in enumerate(self.items)}
        names: dict[tuple, set[int]] = {}
        for item, w in items:
            if w:
                names.setdefault(tuple(self.codes.setdefault(x, len(self.codes)) for x in w), set()).add(place[item])
        self.name_at = np.concatenate([[0], np.cumsum([len(n) for n in names.values()])]).astype(np.int64)
        self.names = np.array([i for n in names.values() for i in sorted(n)], np.int64)
        sizes = np.array([len(t) for t in names], np.int64)
        self.words = np.array([c for t in names for c in (*t, -1)], np.int64)  # a separator that no document holds
        begin = np.cumsum(sizes + 1) - sizes - 1
        length = np.minimum(window, sizes)
        # every occurrence of a window: its place and text
        many = sizes - length + 1
        text = np.repeat(np.arange(len(sizes)), many)
        at = begin[text] + np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        number = np.zeros(len(at), np.int64)
        starts, lengths = [], []
        for n in np.unique(length).tolist():
            own = np.flatnonzero(length[text] == n)
            rank, k = ranked(self.words, n)  # two overlapping stretches of k words make n
            key = rank[at[own]] * (int(rank.max()) + 1) + rank[at[own] + n - k]
            _, first, which = np.unique(key, return_index=True, return_inverse=True)
            number[own] = which + len(starts)
            starts += at[own][first].tolist()
            lengths += [n] * len(first)
        self.starts, self.lengths = np.array(starts, np.int64), np.array(lengths, np.int64)
        order = np.argsort(number, kind="stable")
        self.occurs, self.occurs_in = at[order], text[order]
        self.occurs_at = np.searchsorted(number[order], np.arange(len(starts) + 1))
        self.shortest = int(self.lengths.min()) if starts else 0
        self.deepest = int(self.lengths.max()) if starts else 0


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``words`` in the order of their first ``depth`` words, by
    prefix doubling."""
    rank, k = ranked(words, depth)
    return np.argsort(doubled(rank, k) if k < depth else rank, kind="stable")


def search(words: np.ndarray, order: np.ndarray, bench: Benchmark):
    """(lo, hi, depth) of every window's suffix in the suffix array: the
    interval of places of the whole window, empty if there is none, and how
    many of its words match somewhere."""
    n = len(order)
    padded = np.append(words, np.full(bench.deepest + 1, -2))
    lo, hi = np.zeros(len(bench.starts), np.int64), np.full(len(bench.starts), n, np.int64)
    depth = np.zeros(len(bench.starts), np.int64)
    live = np.arange(len(bench.starts))
    for d in range(bench.deepest):
        live = live[bench.lengths[live] > d]
        if not len(live):
            break
        word = bench.words[bench.starts[live] + d]
        bounds = []
        for right in (False, True):  # first place not below, first place above
            a, b = lo[live].copy(), hi[live].copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                there = padded[order[np.minimum(mid, n - 1)] + d]
                below = there <= word if right else there < word
                a, b = np.where(open_ & below, mid + 1, a), np.where(open_ & ~below, mid, b)
            bounds.append(a)
        lo[live], hi[live] = bounds
        found = bounds[0] < bounds[1]
        depth[live[found]] = d + 1
        hi[live[~found]] = lo[live[~found]]
        live = live[found]
    return lo, hi, depth


def scan(text: pa.Array, bench: Benchmark):
    """n_words and hit flags of all words, word offsets of the rows, and
    (row, item, longest match, its first word) of every row and item that meet."""
    rows = [item_words(t) for t in text.cast(pa.binary()).to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    total = int(offsets[-1])
    hit = np.zeros(total, bool)
    none = np.zeros(0, np.int64)
    if not total or not len(bench.starts):
        return offsets, hit, (none, none, none, none)
    code = bench.codes.get
    words = np.fromiter((code(w, -1) for r in rows for w in r), np.int64, total)
    # stretches of known words within one row
    known = np.append(words >= 0, False)
    cut = np.zeros(total + 1, bool)
    cut[offsets[:-1]] = True
    begins = known & (np.append(True, ~known[:-1]) | cut)
    first = np.flatnonzero(begins)
    if not len(first):
        return offsets, hit, (none, none, none, none)
    stretch = np.cumsum(begins)[known[:total].nonzero()[0]] - 1
    sizes = np.bincount(stretch, minlength=len(first))
    long = sizes >= bench.shortest
    first, sizes = first[long], sizes[long]
    if not len(first):
        return offsets, hit, (none, none, none, none)
    # the stretches one after another, each with a separator behind it
    ends = np.cumsum(sizes + 1)
    place = np.repeat(first - (ends - sizes - 1), sizes + 1) + np.arange(int(ends[-1]))
    text_words = words[np.minimum(place, total - 1)]
    text_words[ends - 1] = -1
    order = suffix_array(text_words, bench.deepest)
    lo, hi, _ = search(text_words, order, bench)
    counts = hi - lo
    which = np.repeat(np.arange(len(counts)), counts)
    if not len(which):
        return offsets, hit, (none, none, none, none)
    pos = order[np.repeat(lo - (np.cumsum(counts) - counts), counts) + np.arange(len(which))]
    at, length = place[pos], bench.lengths[which]
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + length, -1)
    hit = np.cumsum(step[:-1]) > 0
    row = np.searchsorted(offsets, at, side="right") - 1
    r, text_, span, a = longest(text_words, pos, which, row, bench)
    # the texts' names; of an item with several texts the longest match
    n = bench.name_at[text_ + 1] - bench.name_at[text_]
    item = bench.names[np.repeat(bench.name_at[text_] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    r, item, span, a = best_of(np.repeat(r, n), item, np.repeat(span, n), np.repeat(place[a], n))
    return offsets, hit, (r, item, span, a - offsets[r])


def best_of(row, name, span, at):
    """The longest, then first, of every (row, name)."""
    order = np.lexsort((at, -span, name, row))
    row, name, span, at = row[order], name[order], span[order], at[order]
    top = np.append(True, (row[1:] != row[:-1]) | (name[1:] != name[:-1]))[:len(row)]
    return row[top], name[top], span[top], at[top]


def longest(words: np.ndarray, pos: np.ndarray, which: np.ndarray, row: np.ndarray, bench) -> tuple[np.ndarray, ...]:
    """(row, text of the benchmark, length, place in ``words``) of the longest
    match of every row and text that share a window."""
    before = np.where(pos > 0, words[pos - 1], -1)
    n = bench.occurs_at[which + 1] - bench.occurs_at[which]
    ends = np.cumsum(n)
    found, k = [], 0
    while k < len(pos):
        done = int(ends[k - 1]) if k else 0
        upto = max(k + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        m = n[k:upto]
        pair = np.repeat(np.arange(k, upto), m)
        at = np.repeat(bench.occurs_at[which[k:upto]] - (np.cumsum(m) - m), m) + np.arange(len(pair))
        k = upto
        there = bench.occurs[at]
        ahead = np.where(there > 0, bench.words[there - 1], -1)
        begins = (before[pair] < 0) | (before[pair] != ahead)
        pair, there, text = pair[begins], there[begins], bench.occurs_in[at[begins]]
        span = bench.lengths[which[pair]].copy()
        live = np.arange(len(pair))
        while len(live):  # one more word
            x, y = pos[pair[live]] + span[live], there[live] + span[live]
            same = (x < len(words)) & (y < len(bench.words))
            same[same] = (words[x[same]] == bench.words[y[same]]) & (words[x[same]] >= 0)
            live = live[same]
            span[live] += 1
        found.append(best_of(row[pair], text, span, pos[pair]))
    return best_of(*map(np.concatenate, zip(*found, strict=True)))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """id_col, n_words, n_hit, n_items, items_sha256, contaminated, and
    ``matches``: (item, length, start) of each item's longest verbatim match."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    # words are at most half the bytes, plus one
    total = items.agg(F.sum(F.floor(F.octet_length("text") / 2) + 1)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))

    parts = None
    for b in range(blocks):
        block = [(r["item"], item_words(r["text"].encode())) for r in dealt.filter(F.col("block") == b).select("item", "text").collect()]
        shared = spark.sparkContext.broadcast(vars(Benchmark(block, window)))
        part = _block(docs, shared, text, id_col, kind)
        if blocks > 1:  # done with this block before the next one
            part = stored(part, "decontaminate")
            shared.destroy()
        parts = part if parts is None else parts.unionByName(part)
    if blocks > 1:
        parts = _merged(parts, id_col, blocks)

    # words inside the union of the stretches, which come sorted
    covered = F.aggregate(
        F.array_sort("hits"), F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("upto")),
        lambda acc, s: F.struct(
            (acc["total"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"], acc["upto"]))).alias("total"),
            F.greatest(acc["upto"], s["last"]).alias("upto")),
        lambda acc: acc["total"])
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))
    return parts.select(
        id_col, "n_words", covered.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"), "matches")


MATCHES = "matches array<struct<item: string, length: bigint, start: bigint>>"


def _block(docs: DataFrame, shared, text: str, id_col: str, kind: str) -> DataFrame:
    def run(batches):
        bench = SimpleNamespace(**shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, hit, (row, item, length, start) = scan(part.column("text"), bench)
                n = part.num_rows
                head = np.zeros(len(hit) + 1, bool)  # first words of rows
                head[offsets[:-1]] = True
                cut = np.flatnonzero(hit & (np.append(True, ~hit[:-1])[:len(hit)] | head[:-1]))
                b = np.flatnonzero(hit & (np.append(~hit[1:], True)[:len(hit)] | head[1:])) + 1
                owner = np.searchsorted(offsets, cut, side="right") - 1
                spans = pa.StructArray.from_arrays([pa.array(cut - offsets[owner], pa.int64()), pa.array(b - offsets[owner], pa.int64())], names=["first", "last"])
                hits = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), spans)
                met = pa.StructArray.from_arrays(
                    [pa.array([bench.items[i] for i in item.tolist()], pa.string()), pa.array(length, pa.int64()), pa.array(start, pa.int64())],
                    names=["item", "length", "start"])
                matches = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), met)
                arrays = [part.column("id"), pa.array(np.diff(offsets), pa.int64()), hits, matches, part.column("row")]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "n_words", "hits", "matches", "row"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.xxhash64(id_col, text).alias("row"))
    return map_arrow(rows, run, f"`{id_col}` {kind}, n_words bigint, hits array<struct<first: bigint, last: bigint>>, {MATCHES}, row bigint")


def _merged(parts: DataFrame, id_col: str, blocks: int) -> DataFrame:
    """Hits and matches of all blocks per document.  Repeated rows are merged
    once and put back as often as they occur in each block."""
    each = parts.groupBy(id_col, "row", "n_words").agg(
        F.flatten(F.collect_set("hits")).alias("hits"), F.flatten(F.collect_set("matches")).alias("matches"),
        (F.count("*") / blocks).cast("int").alias("copies"))
    return each.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the contaminated ones."""
    key, (name,) = F.xxhash64(id_col, text), spare(docs.columns, "key")
    found = contamination(docs.select(key.alias(name), F.col(text)), benchmark, text, name, **options)
    found = stored(found.filter("contaminated").select(name).distinct())
    return docs.join(found, key == F.col(name), "left_anti")

"""Divergence of sources: how far the words of a source lie from those of the
other sources of its language, and which words they are.

Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased.
A language keeps the V terms that ``min_docs`` of its documents hold.  A group
(lang, source), and the language as a whole, gives a kept term the share
p = 1 + floor(UNIT * (count + 1) / (N + V)), N its occurrences of kept terms.
The divergence of shares p from q is the sum of floor((p - q)^2 / q).

Gustavson's row accumulation.  The postings (term, source, p) of a language
are dealt to blocks by term.  In a block they are indexed by term; each group
takes its own terms one after another, looks up who else holds them, and
scatters what a term contributes into a dense accumulator with one cell per
peer.  No pair of postings is ever written out: a block gives one sum per pair of
groups.  Terms that a group does not hold have a share too, the same for all of them,
so the accumulator starts from the baseline of two absent terms, V times, and
is corrected for each distinct share of the group (the peer lacks the term) and of
the peer (the group lacks it); a term that both hold takes both corrections back.

Sizes.  The blocks of a language hold about ``postings`` rows, and its
groups are dealt over panels, so that a task has at most about ``CELLS``
results.  A word that is in every document is one posting per source.  The sums fit 64
bits for up to 10^9 kept terms of a language.

Rows.  NULL text, lang and source are ''.  Repeated rows, and rows that share an id, are
documents of their own.  A group without terms has the baseline shares; without kept terms all its
divergences are 0.  An empty table gives an empty result.  Ties are ranked by the
item's UTF-8 bytes.  Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txguard.llm.common import gather, map_arrow, slices, stored, words

MIN_DOCS = 3
UNIT = 1_000_000_000
TOP = 200
POSTINGS = 100_000
CELLS = 4_000_000
STEP = 1 << 20
BATCH_BYTES = 12 << 20   # words repeat in it, but its sorted tokens are held several times
OUT_ROWS = 100_000
# A-Z become a-z, a-z and bytes of other scripts stay, all else separates.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def folded(text: pa.Array) -> pa.Array:
    """Texts with terms lower-cased and everything between them blank."""
    text = pc.fill_null(text, "")
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    _, ends, data = text.buffers()
    offsets = np.frombuffer(ends, kind)[text.offset:text.offset + len(text) + 1]
    body = bytes(memoryview(data)[int(offsets[0]):int(offsets[-1])]) if data is not None else b""
    return type(text).from_buffers(len(text), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(body.translate(FOLD)))


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df) of every slice of documents."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                distinct, codes, offsets = words(folded(part.column("text")))
                if not len(codes):
                    continue
                lang, source = (part.column(c).dictionary_encode() for c in ("lang", "source"))
                groups = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                row = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                pairs, n = np.unique(row * len(distinct) + codes, return_counts=True)
                row, code = np.divmod(pairs, len(distinct))
                keys, at = np.unique(groups[row] * len(distinct) + code, return_inverse=True)
                n, df = np.bincount(at, n).astype(np.int64), np.bincount(at)
                group, code = np.divmod(keys, len(distinct))
                of_lang, of_source = np.divmod(group, len(source.dictionary))
                out = pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(of_lang)), source.dictionary.take(pa.array(of_source)),
                     distinct.take(pa.array(code)), pa.array(n), pa.array(df, pa.int64())], names=["lang", "source", "term", "n", "df"])
                for i in range(0, out.num_rows, OUT_ROWS):
                    yield out.slice(i, OUT_ROWS)

    return map_arrow(docs, run, "lang string, source string, term string, n bigint, df bigint", BATCH_BYTES)


def share(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + v)); NULL without kept terms."""
    wide = lambda c: c.cast("decimal(28,0)")
    scaled = wide(F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(18,0)"))
    return F.when(v > 0, F.lit(1) + F.call_function("div", scaled, wide(total + v)))


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def accumulate(term: np.ndarray, peer: np.ndarray, share_: np.ndarray, zero: np.ndarray, own: np.ndarray):
    """Yields (group, sums over the block's terms of its divergence from every
    peer).  ``term``, ``peer`` and ``share_`` are the postings, ``zero`` the
    share of an absent term of every peer, ``own`` the groups asked for."""
    n_terms = int(term.max()) + 1 if len(term) else 0
    by_term = np.lexsort((peer, term))
    rows = np.searchsorted(term[by_term], np.arange(n_terms + 1))       # the term-major index
    index_peer, index_share = peer[by_term], share_[by_term]
    by_group = np.lexsort((share_, peer))
    at = np.searchsorted(peer[by_group], np.arange(len(zero) + 1))
    group_term, group_share = term[by_group], share_[by_group]
    # distinct shares of each group and how many terms have them
    fresh = np.flatnonzero(np.append(True, (np.diff(peer[by_group]) != 0) | (np.diff(group_share) != 0))) if len(term) else np.zeros(0, np.int64)
    d_peer, d_share, d_n = peer[by_group][fresh], group_share[fresh], np.diff(np.append(fresh, len(term)))
    d_at = np.searchsorted(d_peer, np.arange(len(zero) + 1))
    for i in own.tolist():
        base = divergence(zero[i], zero)
        acc = n_terms * base
        # its terms, where the peer lacks them
        held, times = d_share[d_at[i]:d_at[i + 1]], d_n[d_at[i]:d_at[i + 1]]
        step = max(1, STEP // len(zero))
        for k in range(0, len(held), step):
            acc += ((divergence(held[k:k + step, None], zero) - base) * times[k:k + step, None]).sum(axis=0)
        # the peers' terms, where it lacks them
        np.add.at(acc, d_peer, d_n * (divergence(zero[i], d_share) - base[d_peer]))
        # terms of both
        mine, shares = group_term[at[i]:at[i + 1]], group_share[at[i]:at[i + 1]]
        ends = np.cumsum(rows[mine + 1] - rows[mine])
        k = 0
        while k < len(mine):
            done = int(ends[k - 1]) if k else 0
            upto = max(k + 1, int(np.searchsorted(ends, done + STEP, side="right")))
            postings, lengths = gather(rows, np.arange(len(by_term)), mine[k:upto])
            j, q, p = index_peer[postings], index_share[postings], np.repeat(shares[k:upto], lengths)
            np.add.at(acc, j, divergence(p, q) - divergence(p, zero[j]) - divergence(zero[i], q) + base[j])
            k = upto
        yield i, acc


def pair_sums(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): divergence of every source from every
    other one of its language."""
    panel = lambda: F.explode(F.sequence(F.lit(0), F.col("panels") - 1)).alias("panel")
    rows = postings.select("lang", "source", "term", "p", "panels", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")) \
        .select("lang", "block", panel(), "source", "term", "p")
    peers = groups.select("lang", "source", "zero", "panels", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")) \
        .select("lang", "source", "zero", "block", panel(), F.pmod(F.xxhash64("source"), F.col("panels")).cast("int").alias("own"))
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def run(rows: pa.Table, peers: pa.Table) -> pa.Table:
        peers = peers.combine_chunks()
        if not peers.num_rows:
            return schema.empty_table()
        names = peers.column("source").combine_chunks()
        zero = pc.fill_null(peers.column("zero"), 1).to_numpy()        # no kept terms: every term of the sum is missing
        own = np.flatnonzero(peers.column("own").to_numpy() == peers.column("panel").to_numpy())
        term = pc.index_in(rows.column("term"), value_set=pc.unique(rows.column("term"))).to_numpy().astype(np.int64)
        peer = pc.index_in(rows.column("source"), value_set=names).to_numpy().astype(np.int64)
        lang, out = peers.column("lang")[0].as_py(), []
        for i, acc in accumulate(term, peer, rows.column("p").to_numpy(), zero, own):
            others = np.flatnonzero(np.arange(len(zero)) != i)
            out.append(pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(others), pa.string()), names.take(pa.array(np.full(len(others), i))),
                 names.take(pa.array(others)), pa.array(acc[others])], schema=schema))
        return pa.Table.from_batches(out, schema)

    key = ("lang", "block", "panel")
    sums = rows.groupBy(*key).cogroup(peers.groupBy(*key)).applyInArrow(run, "lang string, source string, item string, value bigint")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
          top: int = TOP, postings: int = POSTINGS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = counted(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    of_term = W.partitionBy("lang", "term")                              # a row per source
    index = stored(counts.select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("all"), F.sum("df").over(of_term).alias("docs"),
        (F.col("source") == F.min("source").over(of_term)).alias("first")).where(F.col("docs") >= min_docs).drop("docs"), "divergence")

    every = docs.select("lang", "source").distinct()
    langs = every.groupBy("lang").agg(F.count(F.lit(1)).alias("peers")).join(
        index.groupBy("lang").agg(F.sum("n").alias("total"), F.count_if("first").alias("v"), F.count(F.lit(1)).alias("rows")), "lang", "left")
    size = F.greatest(F.lit(postings), F.col("peers") * 8)
    langs = langs.select(
        "lang", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "v")],
        F.greatest(F.lit(1), F.ceil(F.col("rows") / size)).cast("int").alias("blocks"),
        F.ceil(F.col("peers") * F.col("peers") / F.lit(CELLS)).cast("int").alias("panels"))
    groups = every.join(index.groupBy("lang", "source").agg(F.sum("n").alias("own")), ["lang", "source"], "left").join(langs, "lang")
    groups = stored(groups.select("*", share(F.lit(0), F.coalesce("own", F.lit(0)), F.col("v")).alias("zero")), "divergence-groups")

    held = index.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "blocks", "panels", share(F.col("n"), F.col("own"), F.col("v")).alias("p"),
        share(F.col("all"), F.col("total"), F.col("v")).alias("q"))
    terms = held.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                                       F.expr("(p - q) * (p - q) div q").alias("value"))
    pairs = pair_sums(held, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .unionByName(pairs.withColumn("rank", F.row_number().over(order))))

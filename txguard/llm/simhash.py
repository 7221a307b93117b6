"""SimHash near-duplicate detection with BK-trees.

1. One 64-bit fingerprint per document from the XXH64 values of its word
   shingles (``fingerprints``).
2. Equal fingerprints are one node.  Six blocks of about 11 bits: two
   fingerprints within four bits agree on at least two blocks, so each of the
   15 block pairs deals the nodes to buckets; no link is missed.
3. Each bucket is a shard with a BK-tree (children keyed by their Hamming
   distance to the parent); every node of the shard searches the tree along
   the edges within the radius.  A large bucket is cut into sub-shards, and
   each pair of sub-shards is a task of its own: one side's tree, the other
   side's queries.
4. A task reports one link from each node to the smallest node of its local
   group, never all pairs; connected components run over those links.

The trees of all shards together grow with the corpus, so a tree travels to
the task that searches it by the shuffle key and is not broadcast.

Rows.  NULL, empty and white-space texts have fingerprint zero and link like
any other.  Repeated rows and ties share a fingerprint, so a component.  A
NULL ``doc_id`` takes part, but never names a component that holds another
id; a component of NULL ids only has ``component_id`` NULL.  An empty table
gives an empty result.  Further input columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txguard.llm.common import map_arrow, pinned, slices, spare, stored

BITS = 64
BLOCKS = 6
SMALL_SHARD = 256  # nodes; larger buckets are cut into sub-shards
SEED = 42


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Majority bits of the shingle hashes, as a signed 64-bit integer."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)])
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.add.reduce(np.unpackbits(hashes[at:at + (1 << 16)], axis=1), axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 4) -> DataFrame:
    """(id_col, fp long) of every document."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                fps = [fingerprint(t, shingle) for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fps, pa.int64())], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), run, f"id {kind}, fp bigint")
    return out.withColumnRenamed("id", id_col)


# ---- BK-tree over an array of fingerprints -------------------------------

class BKTree:
    """BK-tree of distinct fingerprints; ``child[node, distance]`` is the
    node's child at that distance, or -1."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.child = np.full((len(values), BITS + 1), -1, np.int32)
        waiting = np.arange(1, len(values))
        at = np.zeros(len(waiting), np.int64)
        while len(waiting):  # one round per level: every waiting node steps down
            d = np.bitwise_count(values[waiting] ^ values[at]).astype(np.int64)
            slot = at * (BITS + 1) + d
            free = self.child.ravel()[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.child.ravel()[slot[placed]] = waiting[placed]
            left = np.ones(len(waiting), bool)
            left[placed] = False
            at, waiting = self.child.ravel()[slot[left]].astype(np.int64), waiting[left]

    def search(self, queries: np.ndarray, radius: int):
        """Yield arrays (query index, node) of all pairs within the radius."""
        for lo in range(0, len(queries), 256):
            q = np.arange(lo, min(lo + 256, len(queries)))
            node = np.zeros(len(q), np.int64)
            while len(q):
                d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
                near = d <= radius
                if near.any():
                    yield q[near], node[near]
                next_q, next_node = [], []
                for step in range(-radius, radius + 1):
                    edge = d + step
                    ok = (edge >= 0) & (edge <= BITS)
                    to = self.child[node[ok], edge[ok]]
                    has = to >= 0
                    next_q.append(q[ok][has])
                    next_node.append(to[has])
                q, node = np.concatenate(next_q), np.concatenate(next_node).astype(np.int64)


def _root(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def shard_links(values: np.ndarray, in_tree: np.ndarray, asks: np.ndarray, radius: int) -> list[int]:
    """Local component root (an index) of every node of one shard pair."""
    n = len(values)
    parent = list(range(n))
    if n <= 16:  # the same tree as plain dictionaries: cheaper for a few nodes
        v = values.tolist()
        children: list[dict[int, int]] = [{} for _ in range(n)]
        members = [i for i in range(n) if in_tree[i]]
        for x in members[1:]:
            at = members[0]
            while (d := (v[x] ^ v[at]).bit_count()) in children[at]:
                at = children[at][d]
            children[at][d] = x
        for x in (i for i in range(n) if asks[i]):
            todo = members[:1]
            while todo:
                at = todo.pop()
                d = (v[x] ^ v[at]).bit_count()
                if d <= radius and (a := _root(parent, x)) != (b := _root(parent, at)):
                    parent[max(a, b)] = min(a, b)
                todo += [c for e, c in children[at].items() if d - radius <= e <= d + radius]
    else:
        members, queries = np.flatnonzero(in_tree), np.flatnonzero(asks)
        if len(members) and len(queries):
            for q, node in BKTree(values[members]).search(values[queries], radius):
                for x, y in zip(queries[q].tolist(), members[node].tolist(), strict=True):
                    a, b = _root(parent, x), _root(parent, y)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
    return [_root(parent, x) for x in range(n)]


def links(nodes: DataFrame, radius: int = 4, blocks: int = BLOCKS, small_shard: int = SMALL_SHARD) -> DataFrame:
    """Links (a, b) that join all ``nodes`` (fp) within ``radius`` bits."""
    agree = blocks - radius
    if agree < 1:
        raise ValueError(f"blocks must exceed the radius: {blocks} <= {radius}")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << b) - (1 << a)) for a, b in itertools.pairwise(cuts)]
    masks = [sum(c) for c in itertools.combinations(block, agree)]
    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]

    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in masks])).alias("c", "key"))
    held = keyed.groupBy("c", "key").agg(F.count("*").alias("n")).filter("n > 1")
    cut = F.ceil(F.sqrt(F.col("n") / F.lit(float(small_shard)))).cast("int")
    dealt = (
        keyed.join(held, ["c", "key"])
        .withColumn("cut", cut)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("cut")).cast("int"))
        # every pair of sub-shards (i <= j) once: i's nodes form the tree, j's ask
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
        .select("c", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")
    )

    def run(batches):
        held_back = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if held_back is not None:
                t = pa.concat_tables([held_back, t]).combine_chunks()
            cols = {n: t.column(n).to_numpy() for n in ("c", "key", "i", "j", "own", "fp")}
            change = np.flatnonzero(np.any([cols[n][1:] != cols[n][:-1] for n in ("c", "key", "i", "j")], axis=0)) + 1
            upto = int(change[-1]) if len(change) else 0
            held_back = t.slice(upto)
            yield from out(cols, [0, *change.tolist()])
        if held_back is not None and held_back.num_rows:
            cols = {n: held_back.column(n).to_numpy() for n in ("c", "key", "i", "j", "own", "fp")}
            yield from out(cols, [0, held_back.num_rows])

    def out(cols, cuts):
        a, b = [], []
        for lo, hi in itertools.pairwise(cuts):
            if hi - lo < 2:
                continue
            fp, own = cols["fp"][lo:hi], cols["own"][lo:hi]
            for x, r in enumerate(shard_links(fp.view(np.uint64), own == cols["i"][lo], own == cols["j"][lo], radius)):
                if r != x:
                    a.append(int(fp[x]))
                    b.append(int(fp[r]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    by = ("c", "key", "i", "j")
    return map_arrow(dealt.repartition(*by).sortWithinPartitions(*by), run, "a bigint, b bigint").distinct()


# ---- connected components ------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node of ``edges``
    (a, b), by alternating large-star and small-star rounds.  Each round is
    written to the shared folder, so its lineage stays short."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:  # every neighbour above u is tied to u's smallest neighbour
            e = e.union(e.select("b", "a"))
        else:      # u, and every neighbour below it, to the smallest of them
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = e.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        joined = e.join(low, "a")
        if large:
            tied = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            tied = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return tied.filter("a <> b").distinct()

    def digest(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = pinned(edges.select("a", "b").filter("a <> b").distinct())
    seen = digest(edges)
    while True:
        edges = pinned(star(star(edges, True), False))
        now = digest(edges)
        if now == seen:
            break
        seen = now
    return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """(id_col, fp long, fingerprint hex string, component_fp, component_id)."""
    fps = pinned(fingerprints(docs, text, id_col, shingle))
    nodes = fps.groupBy("fp").agg(F.min(id_col).alias("rep"))
    roots = pinned(components(links(nodes.select("fp"), radius)).select(F.col("node").alias("fp"), "root"))
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "root").select("fp", F.col("root").alias("component_fp"), "component_id")
    return fps.join(named, "fp").select(
        id_col, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` less near-duplicates: of each component the row with the
    smallest id stays (NULL is the largest), of rows with one id that with the
    smallest hash of id and text, of rows equal in both one.

    Rows that share an id but no component are documents of their own.
    """
    key, row, rank, same_id = spare([*docs.columns, "fp", "component_fp", "component_id"], "key", "row", "rank", "same_id")
    keyed = docs.withColumn(key, F.xxhash64(id_col, text))
    rows = keyed.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(key).alias("key")).alias(row), F.col(text))
    found = near_duplicates(rows, text, row, **options).where(F.col(row).eqNullSafe(F.col("component_id")))
    first = stored(found.select(F.col(f"{row}.key").alias(key), F.col(f"{row}.id").alias(same_id)).distinct(), "simhash-first")
    kept = keyed.join(first, key).where(F.col(id_col).eqNullSafe(F.col(same_id)))
    order = W.partitionBy(key, id_col).orderBy(F.xxhash64(*docs.columns))  # rows equal in id and text
    return kept.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*docs.columns)

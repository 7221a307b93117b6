"""Random forests and boosted trees over one-hot features (M8, M9), the rows dealt over the cluster.

MLlib's learner holds a row as one integer per feature and looks at every feature of a
node for every row.  With an indicator column per merchant that is 240 KB and 60,000
steps a row at 60,000 merchants.  Here a row is what it was before the encoding: a
bin per numeric feature and one category per block of indicators, so a row costs its
columns and not its features.  The trees are those of MLlib's method: the same candidate
splits (at most 31 thresholds per numeric feature, one per indicator), gini or variance
gains, Poisson bootstrap or Bernoulli subsample, a feature subset per node, merged
leaves, and the result is an MLlib model (written in MLlib's format and loaded).  Two
differences: the thresholds come from quantiles of all rows, not from 10,000 of them,
and every indicator can be split on, also one that those 10,000 rows miss.

A level of the trees is one job: a task adds up its rows per node and feature, sums
meet by tree (forest) or by range of features (boosted trees), and only the chosen
splits come to the driver.  Nothing of the driver's grows with the rows.
"""

from __future__ import annotations

import json
import pickle
import time
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.session import fresh_shared_path, shared_dir

BINS = 32                   # MLlib's maxBins
QUANTILES = 2000            # of all rows, from which the thresholds are taken
CHUNK_ROWS = 250_000        # rows that a task of the forest holds at once, with their places in ``trees_at_once`` trees
BOOST_ROWS = 1_000_000      # of boosted trees, which have one tree
STATE_BYTES = 2_000_000_000
TABLE = 1 << 22             # places of a direct lookup of (node, feature)
COLLECTED = 64_000_000      # bytes of sums that may meet on the driver
CHECKPOINT_ROUNDS = 25
EPSILON = 2.2e-16
STORED = StorageLevel.MEMORY_AND_DISK


# ------------------------------------------------------------------ rows

@dataclass(frozen=True)
class Layout:
    """The places of the assembled vector: ``numeric`` columns, then a block of
    ``widths[i]`` indicators for the i-th index column."""

    numeric: tuple[str, ...]
    indices: tuple[str, ...]
    widths: tuple[int, ...]
    thresholds: tuple[tuple[float, ...], ...] = ()

    @property
    def offsets(self) -> list[int]:
        return [len(self.numeric) + sum(self.widths[:i]) for i in range(len(self.widths))]

    @property
    def features(self) -> int:
        return len(self.numeric) + sum(self.widths)

    def column_of(self, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Column of a row (numeric ones first) and, of an indicator, its category."""
        k, offsets = len(self.numeric), np.array([*self.offsets, self.features])
        block = np.searchsorted(offsets, feature, side="right") - 1
        return np.where(feature < k, feature, k + block), np.where(feature < k, 0, feature - offsets[np.maximum(block, 0)])


def layout_of(prefix: PipelineModel) -> Layout:
    encoder, assembler = prefix.stages[-2], prefix.stages[-1]
    indices = list(encoder.getInputCols())
    return Layout(tuple(c for c in assembler.getInputCols() if c not in encoder.getOutputCols()), tuple(indices),
                  tuple(int(n) - 1 for n in encoder.categorySizes))       # the indexer's unseen value has no indicator


def thresholds(values: list[float] | None) -> tuple[float, ...]:
    """MLlib's candidate thresholds for a column with these (equally heavy) values."""
    v, n = np.unique(np.array(values or [], dtype=float), return_counts=True)
    mid = (v[:-1] + v[1:]) / 2
    if len(mid) < BINS:
        return tuple(mid)
    out, stride, upto = [], n.sum() / BINS, n[0]
    target = stride
    for i in range(1, len(v)):
        before, upto = upto, upto + n[i]
        if abs(before - target) < abs(upto - target):
            out.append(mid[i - 1])
            target += stride
    return tuple(out[:BINS - 1])


def with_thresholds(rows: DataFrame, layout: Layout) -> Layout:
    at = ", ".join(f"{i / QUANTILES}D" for i in range(QUANTILES + 1))
    found = rows.agg(*[F.expr(f"percentile_approx(`{c}`, array({at}), 10000)").alias(f"q{i}") for i, c in enumerate(layout.numeric)]).first()
    return Layout(layout.numeric, layout.indices, layout.widths, tuple(thresholds(found[i]) for i in range(len(layout.numeric))))


def _narrow(values: np.ndarray, most: int) -> np.ndarray:
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int32)


def chunks(rows: DataFrame, layout: Layout, label: str, most: int) -> RDD:
    """(number, label, columns) of at most ``most`` rows each: a bin or category per column."""
    names = [*layout.numeric, *layout.indices]

    def packed(label_: np.ndarray, values: list[np.ndarray]) -> bytes:
        k = len(layout.numeric)
        columns = [_narrow(np.searchsorted(layout.thresholds[i], v, side="left"), BINS) for i, v in enumerate(values[:k])]
        columns += [_narrow(v, w) for v, w in zip(values[k:], layout.widths, strict=True)]
        return pickle.dumps((label_.astype(np.uint8), columns), protocol=5)

    def pack(batches):
        held, n = [], 0
        for b in batches:
            for start in range(0, b.num_rows, most):
                part = b.slice(start, most)
                if n + part.num_rows > most:
                    yield one(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield one(held)

    def one(held):
        t = pa.Table.from_batches(held)
        return pa.RecordBatch.from_arrays([pa.array([packed(t.column(label).to_numpy(), [t.column(c).to_numpy() for c in names])], pa.binary())], ["data"])

    blobs = rows.select(label, *names).mapInArrow(pack, "data binary")
    return blobs.rdd.zipWithUniqueId().map(lambda x: (x[1], *pickle.loads(x[0]["data"])))


def step(columns: list[np.ndarray] | np.ndarray, place: np.ndarray, rows: np.ndarray, split: dict) -> np.ndarray:
    """The next place of ``rows``, now at node ``place`` of a level: the child's
    number in the next level, or -1 where it is a leaf."""
    at, right = split["column"][place], np.zeros(len(rows), bool)
    if isinstance(columns, np.ndarray):
        value, wanted = columns[at, rows], split["value"][place]
        right = np.where(split["onehot"][at], value == wanted, value > wanted)
        return np.where(right, split["right"][place], split["left"][place])
    for c in np.unique(split["column"][split["column"] >= 0]):
        mine = np.flatnonzero(at == c)
        value, wanted = columns[c][rows[mine]], split["value"][place[mine]]
        right[mine] = value == wanted if split["onehot"][c] else value > wanted
    return np.where(right, split["right"][place], split["left"][place])


# ------------------------------------------------------------------ forest

def chosen(seed: int, tree: int, level: int, nodes: int, features: int, k: int) -> np.ndarray:
    """The ``k`` features of every node of a level, in order."""
    if k >= features:
        return np.tile(np.arange(features), (nodes, 1))
    rng = np.random.default_rng([seed, tree, level])
    return np.sort(np.array([rng.choice(features, k, replace=False, shuffle=False) for _ in range(nodes)]).reshape(nodes, k), axis=1)


def _lookup(keys: np.ndarray, size: int):
    """Place in the sorted ``keys`` of every key asked for, or -1."""
    if size <= TABLE:
        table = np.full(size, -1, np.int32)
        table[keys] = np.arange(len(keys), dtype=np.int32)
        return lambda asked: table[asked]
    bits = max(16, int(np.ceil(np.log2(max(len(keys), 1) * 16))))
    hashed = lambda x: (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    maybe = np.zeros(1 << bits, bool)
    maybe[hashed(keys)] = True

    def find(asked):
        out = np.full(len(asked), -1, np.int32)
        likely = np.flatnonzero(maybe[hashed(asked)])
        at = np.minimum(np.searchsorted(keys, asked[likely]), len(keys) - 1)
        hit = keys[at] == asked[likely]
        out[likely[hit]] = at[hit]
        return out

    return find


def forest_sums(label: np.ndarray, columns: np.ndarray, place: np.ndarray, drawn: np.ndarray, chosen_: np.ndarray, layout: Layout) -> np.ndarray:
    """Drawn rows per class: of every node, of every bin of its chosen numeric
    features, and of the ones of its chosen indicators."""
    nodes, k, features = len(chosen_), len(layout.numeric), layout.features
    keys = (np.arange(nodes, dtype=np.int64)[:, None] * features + chosen_).ravel()
    numeric = (chosen_ < k).ravel()
    number = np.cumsum(numeric) - 1
    find = _lookup(keys, nodes * features)
    rows = np.flatnonzero(place >= 0)
    at, y, n = place[rows], label[rows].astype(np.int64), drawn[rows]
    of_nodes = np.bincount(at * np.int64(2) + y, n, nodes * 2)
    of_bins = np.zeros(int(numeric.sum()) * BINS * 2)
    of_ones = np.zeros(len(keys) * 2)
    column, _ = layout.column_of(chosen_)
    asks = np.zeros((columns.shape[0], nodes), bool)                      # which nodes have chosen a feature of a column
    asks[column, np.arange(nodes)[:, None]] = True
    for c in np.flatnonzero(asks.any(1)):
        mine = slice(None) if asks[c].all() else np.flatnonzero(asks[c][at])
        base, value = at[mine].astype(np.int64) * features, columns[c][rows[mine]]
        if c < k:
            slot, y_, n_ = number[find(base + c)], y[mine], n[mine]
            of_bins += np.bincount((slot * BINS + value) * 2 + y_, n_, len(of_bins))
            continue
        known = value < layout.widths[c - k]                              # the value that has no indicator
        slot = find(np.where(known, base + (layout.offsets[c - k] + value), 0))
        hit = np.flatnonzero((slot >= 0) & known)
        of_ones += np.bincount(slot[hit] * np.int64(2) + y[mine][hit], n[mine][hit], len(of_ones))
    return np.concatenate([of_nodes, of_bins, of_ones]).astype(np.int64)


def _thin(sums: np.ndarray):
    at = np.flatnonzero(sums)
    return (len(sums), at.astype(np.int32), sums[at].astype(np.int32)) if len(at) * 2 < len(sums) else sums


def _full(sums) -> np.ndarray:
    if isinstance(sums, np.ndarray):
        return sums
    out = np.zeros(sums[0], np.int64)
    out[sums[1]] = sums[2]
    return out


def _add(a, b) -> np.ndarray:
    a = _full(a)
    if isinstance(b, np.ndarray):
        return a + b
    a[b[1]] += b[2]
    return a


def _gini(w: np.ndarray) -> np.ndarray:
    total = w.sum(-1, keepdims=True)
    return 1.0 - np.square(np.divide(w, total, out=np.zeros_like(w), where=total > 0)).sum(-1)


def forest_splits(sums, chosen_: np.ndarray, layout: Layout, weights: np.ndarray, least: int) -> dict:
    """The best split of every node: gain (-1: none), feature, bin, and the drawn rows per class left and right."""
    sums, (nodes, k) = _full(sums).astype(float), chosen_.shape
    numeric = (chosen_ < len(layout.numeric)).ravel()
    total = sums[:nodes * 2].reshape(nodes, 2)
    bins = sums[nodes * 2:nodes * 2 + int(numeric.sum()) * BINS * 2].reshape(-1, BINS, 2)
    right = sums[nodes * 2 + bins.size:].reshape(nodes * k, 2).copy()
    node = np.repeat(np.arange(nodes), k)

    def gains(right, total):
        left = total - right
        wl, wr, w = (left * weights), (right * weights), (total * weights)
        s = w.sum(-1)
        s = np.where(s > 0, s, 1.0)
        gain = _gini(w) - wl.sum(-1) / s * _gini(wl) - wr.sum(-1) / s * _gini(wr)
        return np.where((left.sum(-1) >= least) & (right.sum(-1) >= least) & (gain >= 0), gain, -1.0)

    bin_ = np.zeros(nodes * k, np.int64)
    if len(bins):
        of = node[numeric]
        after = total[of][:, None, :] - np.cumsum(bins, axis=1)           # rows right of each threshold
        gain = gains(after, total[of][:, None, :])
        bin_[numeric] = gain.argmax(1)
        right[numeric] = after[np.arange(len(of)), bin_[numeric]]
    gain = gains(right, total[node]).reshape(nodes, k)
    best = gain.argmax(1)
    at = np.arange(nodes) * k + best
    return {"gain": gain.ravel()[at], "feature": chosen_.ravel()[at], "bin": bin_[at], "total": total, "right": right[at], "left": total - right[at]}


class Tree:
    """A tree as arrays, a level at a time."""

    def __init__(self, layout: Layout):
        self.layout, self.levels = layout, []
        self.size, self.active = 1, np.zeros(1, np.int64)
        self.nodes: dict[str, list[np.ndarray]] = {n: [] for n in ("id", "feature", "threshold", "left", "right", "gain")}
        self.stats: dict[int, np.ndarray] = {}

    def grow(self, gain, feature, bin_, keep) -> dict:
        """Split the active nodes that gain; ``keep``: which of their left and
        right children (two columns) go on.  Returns what ``step`` needs."""
        k = len(self.layout.numeric)
        split = gain > 0
        n = int(split.sum())
        ids = np.full((len(gain), 2), -1, np.int64)
        ids[split] = self.size + np.arange(2 * n).reshape(n, 2)
        self.size += 2 * n
        column, value = self.layout.column_of(np.asarray(feature))
        limit = np.array([self.layout.thresholds[f][b] if f < k and s else 0.5 for f, b, s in zip(feature, bin_, split, strict=True)])
        for name, x in (("id", self.active), ("feature", np.where(split, feature, -1)), ("threshold", limit), ("left", ids[:, 0]), ("right", ids[:, 1]), ("gain", np.where(split, gain, -1.0))):
            self.nodes[name].append(np.asarray(x))
        go = keep & split[:, None]
        number = np.full(go.shape, -1, np.int32)
        number[go] = np.arange(int(go.sum()), dtype=np.int32)
        self.active = ids[go]
        onehot = np.arange(k + len(self.layout.widths)) >= k
        return {"column": np.where(split, column, -1), "value": np.where(np.asarray(feature) < k, bin_, value), "onehot": onehot, "left": number[:, 0], "right": number[:, 1], "ids": ids}


def _rng(*key: int) -> np.random.Generator:
    return np.random.default_rng(list(key))


def _new_forest(group: list[int], seed: int, bootstrap: bool):
    def draw(chunk):
        number, label, columns = chunk
        drawn = np.stack([_rng(seed, t, number).poisson(1.0, len(label)).astype(np.uint8) if bootstrap else np.ones(len(label), np.uint8) for t in group])
        return number, label, np.stack(columns).astype(np.int32), np.where(drawn > 0, 0, -1).astype(np.int32), drawn
    return draw


def _step_forest(splits: dict[int, dict]):
    def move(chunk):
        number, label, columns, place, drawn = chunk
        place = place.copy()
        for i, split in splits.items():
            rows = np.flatnonzero(place[i] >= 0)
            place[i][rows] = step(columns, place[i][rows], rows, split)
        done = [i for i in range(len(place)) if i not in splits]
        place[done] = -1
        return number, label, columns, place, drawn
    return move


def grow_forest(data: RDD, layout: Layout, weights: np.ndarray, n_rows: int, *, trees: int, depth: int, least: int, seed: int, k: int, bootstrap: bool = True) -> list[Tree]:
    at_once = int(max(8, min(trees, STATE_BYTES // (5 * n_rows))))
    grown, slots = [], data.context.defaultParallelism
    for first in range(0, trees, at_once):
        group = list(range(first, min(first + at_once, trees)))
        forest = [Tree(layout) for _ in group]
        state, before = data.map(_new_forest(group, seed, bootstrap)).persist(STORED), None
        live = {i: 1 for i in range(len(group))}                          # tree -> nodes of its level
        for level in range(depth):
            found = forest_level(state, layout, live, group, seed, level, k, weights, least, min(slots, len(live)))
            if before is not None:
                before.unpersist()
            splits = {}
            for i, best in found.items():
                tree = forest[i]
                tree.stats.update(zip(tree.active.tolist(), best["total"], strict=True))
                pure = np.stack([_gini(best["left"] * weights) < EPSILON, _gini(best["right"] * weights) < EPSILON], 1)
                move = tree.grow(best["gain"], best["feature"], best["bin"], ~pure & (level + 1 < depth))
                for ids, left, right in zip(move.pop("ids").tolist(), best["left"], best["right"], strict=True):
                    if ids[0] >= 0:
                        tree.stats[ids[0]], tree.stats[ids[1]] = left, right
                if len(tree.active):
                    splits[i] = move
            live = {i: len(forest[i].active) for i in splits}
            if not live:
                break
            before, state = state, state.map(_step_forest(splits)).persist(STORED)
        state.unpersist()
        grown += forest
    return grown


def forest_level(state: RDD, layout: Layout, live: dict[int, int], group: list[int], seed: int, level: int, k: int, weights: np.ndarray, least: int, tasks: int) -> dict[int, dict]:
    features = layout.features

    def sums(chunk):
        _, label, columns, place, drawn = chunk
        for i, nodes in live.items():
            yield i, _thin(forest_sums(label, columns, place[i], drawn[i].astype(float), chosen(seed, group[i], level, nodes, features, k), layout))

    best = lambda x: (x[0], forest_splits(x[1], chosen(seed, group[x[0]], level, live[x[0]], features, k), layout, weights, least))
    return dict(state.flatMap(sums).reduceByKey(_add, tasks).map(best).collect())


# ------------------------------------------------------------------ boosted trees

def boost_sums(weight: np.ndarray, target: np.ndarray, columns: list[np.ndarray], place: np.ndarray, rows: np.ndarray, nodes: int, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Weights, weighted targets and their squares per node; weights and weighted
    targets per node and bin or indicator (2, nodes, places)."""
    at = place.astype(np.int64)
    w, s = weight[rows], (weight * target)[rows]
    total = np.stack([np.bincount(at, x, nodes) for x in (w, s, s * target[rows], np.ones(len(rows)))])
    out, k = [], len(layout.numeric)
    for c, width in enumerate([BINS] * k + [w_ + 1 for w_ in layout.widths]):
        key = at * width + columns[c][rows]
        h = np.stack([np.bincount(key, x, nodes * width) for x in (w, s)]).reshape(2, nodes, width)
        out.append(h if c < k else h[:, :, :-1])
    return total, np.concatenate(out, axis=2)


def boost_splits(total: np.ndarray, sums: np.ndarray, start: int, allowed: np.ndarray, layout: Layout, tiny: float) -> dict:
    """The best split of every node among the places of ``sums``, which begin at
    place ``start`` of all (the bins of the numeric features come first)."""
    w, s = total[0], total[1]
    nodes, k = len(w), len(layout.numeric)
    numeric, places = k * BINS, sums.shape[2]
    square = lambda s_, w_: np.divide(s_ * s_, w_, out=np.zeros(np.broadcast(s_, w_).shape), where=w_ > tiny)
    right = sums.copy()
    if start < numeric:                                                   # the numeric places are in one piece
        bins = sums[:, :, :numeric].reshape(2, nodes, k, BINS)
        right[:, :, :numeric] = (np.stack([w, s])[:, :, None, None] - np.cumsum(bins, axis=3)).reshape(2, nodes, numeric)
    wr, sr = right
    wl, sl = w[:, None] - wr, s[:, None] - sr
    gain = (square(sl, wl) + square(sr, wr) - square(s, w)[:, None]) / w[:, None]
    feature = np.arange(start, start + places)
    feature = np.where(feature < numeric, feature // BINS, feature - numeric + k)
    gain = np.where((wl > tiny) & (wr > tiny) & allowed[:, feature], gain, -1.0)
    best = gain.argmax(1)
    at = (np.arange(nodes), best)
    place = best + start
    return {"gain": gain[at], "feature": feature[best], "bin": np.where(place < numeric, place % BINS, 0),
            "left": np.stack([wl[at], sl[at]], 1), "right": np.stack([wr[at], sr[at]], 1)}


def _allowed(seed: int, round_: int, level: int, nodes: int, features: int, k: int) -> np.ndarray:
    out = np.ones((nodes, features), bool)
    if k < features:
        rng = _rng(seed, round_, level)
        for i in range(nodes):
            out[i, rng.permutation(features)[k:]] = False
    return out


def descend(columns: list[np.ndarray], rows: np.ndarray, levels: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are still at an active node after ``levels``, and its number."""
    place = np.zeros(len(rows), np.int32)
    for split in levels:
        place = step(columns, place, rows, split)
        on = place >= 0
        rows, place = rows[on], place[on]
    return rows, place


def predict(columns: list[np.ndarray], n: int, levels: list[dict]) -> np.ndarray:
    """The value of every row's leaf; each level of a finished tree has the
    values of its children and of the nodes it did not split."""
    out, rows, place = np.zeros(n), np.arange(n), np.zeros(n, np.int32)
    for split in levels:
        out[rows] = split["own"][place]
        numbered = step(columns, place, rows, {**split, "left": split["left_place"], "right": split["right_place"]})
        split_here = split["column"][place] >= 0
        out[rows[split_here]] = split["values"][numbered[split_here]]
        go = np.where(split_here, split["next"][np.maximum(numbered, 0)], -1)
        rows, place = rows[go >= 0], go[go >= 0]
    return out


def _targets(round_: int, seed: int, share: float, levels: list[dict] | None, rate: float):
    """A round's state: the margins with the last tree's values added, and as
    target the negative gradient of the logistic loss for the rows of the subsample."""
    def go(chunk):
        number, label, columns, margin, target = chunk
        y = label.astype(float) * 2 - 1
        if levels is None:
            margin, target = np.zeros(len(y)), y.copy()
        else:
            margin = margin + rate * predict(columns, len(y), levels)
            target = 4 * y / (1 + np.exp(2 * y * margin))
        if share < 1:
            target[_rng(seed, round_, number).random(len(y)) >= share] = np.nan      # not in this round's subsample
        return number, label, columns, margin, target
    return go


def boost_level(state: RDD, layout: Layout, levels: list[dict], nodes: int, weights: np.ndarray, allowed, n_chunks: int, tiny: float) -> tuple[np.ndarray, dict]:
    """Node sums and best splits of a level.  Small sums meet on the driver, large ones by range of places."""
    places = len(layout.numeric) * BINS + sum(layout.widths)
    slots, numeric = state.context.defaultParallelism, len(layout.numeric) * BINS
    cuts = [0, *sorted({max(numeric, int(x)) for x in np.linspace(0, places, slots + 1)[1:-1]}), places]
    cuts = [c for i, c in enumerate(cuts) if i == 0 or c > cuts[i - 1]]

    def sums(chunk):
        _, label, columns, _, target = chunk
        rows = np.flatnonzero(~np.isnan(target))
        rows, place = descend(columns, rows, levels)
        return boost_sums(weights[label], target, columns, place, rows, nodes, layout)

    add = lambda a, b: (a[0] + b[0], a[1] + b[1])
    if 16 * nodes * places * n_chunks <= COLLECTED:
        total, whole = reduce(add, state.map(sums).collect())
        return total, boost_splits(total, whole, 0, allowed(), layout, tiny)

    def pieces(chunk):
        total, whole = sums(chunk)
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            yield i, (total, whole[:, :, a:b])

    best = lambda x: (x[0], x[1][0], boost_splits(*x[1], cuts[x[0]], allowed(), layout, tiny))
    found = sorted(state.flatMap(pieces).reduceByKey(add, len(cuts) - 1).map(best).collect(), key=lambda x: x[0])
    gains = np.stack([b["gain"] for _, _, b in found])
    of = gains.argmax(0)
    pick = lambda name: np.stack([b[name] for _, _, b in found])[of, np.arange(nodes)]
    return found[0][1], {name: pick(name) for name in ("gain", "feature", "bin", "left", "right")}


def grow_boosted(data: RDD, layout: Layout, weights: np.ndarray, *, rounds: int, depth: int, rate: float, share: float, seed: int, k: int) -> tuple[list[Tree], list[float]]:
    shared_dir(_spark_of(data))
    state, n_chunks, tiny = None, data.count(), float(weights.min()) / 2
    grown, kept, levels = [], None, None
    for m in range(rounds):
        before = state
        fresh = (lambda c: (*c, None, None)) if m == 0 else None
        state = (data.map(fresh) if m == 0 else before).map(_targets(m, seed, share, levels, 1.0 if m == 1 else rate)).persist(STORED)
        if m and m % CHECKPOINT_ROUNDS == 0:
            state.checkpoint()
        tree, levels = Tree(layout), []
        for level in range(depth):
            nodes = len(tree.active)
            allowed = lambda m=m, level=level, nodes=nodes: _allowed(seed, m, level, nodes, layout.features, k)
            total, best = boost_level(state, layout, levels, nodes, weights, allowed, n_chunks, tiny)
            if level == 0 and before is not None:
                before.unpersist()
                if m % CHECKPOINT_ROUNDS == 0:
                    kept = _only(state, kept)
            own = total[1] / np.maximum(total[0], tiny)
            impure = total[2] / np.maximum(total[0], tiny) - own * own > EPSILON
            for node, x in zip(tree.active, total.T, strict=True):
                tree.stats[int(node)] = x[:3]
            keep = np.full((nodes, 2), level + 1 < depth)
            split = tree.grow(np.where(impure, best["gain"], -1.0), best["feature"], best["bin"], keep)
            children = np.stack([best["left"], best["right"]], 1)                       # nodes, side, (weight, sum)
            for ids, sides in zip(split.pop("ids"), children, strict=True):
                if ids[0] >= 0:
                    for node, side in zip(ids, sides, strict=True):
                        tree.stats[int(node)] = np.array([*side, 0.0])
            order = np.arange(2 * nodes, dtype=np.int32).reshape(nodes, 2)
            split |= {"own": own, "left_place": order[:, 0], "right_place": order[:, 1],
                      "values": (children[:, :, 1] / np.maximum(children[:, :, 0], tiny)).ravel(),
                      "next": np.stack([split["left"], split["right"]], 1).ravel()}
            levels.append(split)
            if not len(tree.active):
                break
        grown.append(tree)
    if state is not None:
        state.unpersist()
    _only(None, kept)
    return grown, [1.0] + [rate] * (rounds - 1)


def _spark_of(data: RDD):
    from pyspark.sql import SparkSession
    return SparkSession.builder.getOrCreate()


def _only(state: RDD | None, kept: str | None) -> str | None:
    """The state's checkpoint is the one left."""
    spark = _spark_of(state)
    if kept:
        at = spark._jvm.org.apache.hadoop.fs.Path(kept)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return state.getCheckpointFile() if state is not None else None


# ------------------------------------------------------------------ MLlib models

def _merged(tree: dict, weights: np.ndarray) -> None:
    """Two leaves that decide alike become one (MLlib's forests do so)."""
    decides = tree["prediction"]
    for i in np.argsort(-tree["id"], kind="stable"):       # children have higher ids
        left, right = tree["left"][i], tree["right"][i]
        if left >= 0 and tree["left"][left] < 0 and tree["left"][right] < 0 and decides[left] == decides[right]:
            tree["left"][i] = tree["right"][i] = -1


def as_table(tree: Tree, number: int, weights: np.ndarray | None) -> pa.Table:
    """MLlib's rows of a tree, numbered in the order in which it expects them."""
    n = tree.size
    cat = {name: np.concatenate(parts) for name, parts in tree.nodes.items()}
    full = {"id": np.arange(n), "left": np.full(n, -1), "right": np.full(n, -1), "feature": np.full(n, -1), "threshold": np.zeros(n), "gain": np.full(n, -1.0)}
    for name in ("left", "right", "feature", "threshold", "gain"):
        full[name][cat["id"]] = cat[name]
    stats = np.stack([tree.stats[i] for i in range(n)])
    raw = stats.sum(1) if weights is not None else stats[:, 0]
    if weights is not None:
        stats = stats * weights
        full["prediction"], full["impurity"] = stats.argmax(1).astype(float), _gini(stats)
        _merged(full, weights)
    else:
        mean = stats[:, 1] / stats[:, 0]
        full["prediction"], full["impurity"] = mean, np.maximum(stats[:, 2] / stats[:, 0] - mean * mean, 0.0)
    order, waiting = [], [0]                               # before its children, left before right
    while waiting:
        i = waiting.pop()
        order.append(i)
        if full["left"][i] >= 0:
            waiting += [full["right"][i], full["left"][i]]
    order = np.array(order)
    new = np.full(n + 1, -1)
    new[order] = np.arange(len(order))
    inner = full["left"][order] >= 0
    ends = np.concatenate([[0], np.cumsum(inner)])
    return pa.table({
        "treeID": pa.array(np.full(len(order), number), pa.int32()), "id": pa.array(np.arange(len(order)), pa.int32()),
        "prediction": full["prediction"][order], "impurity": full["impurity"][order],
        "impurityStats": pa.ListArray.from_arrays(np.arange(len(order) + 1, dtype=np.int32) * stats.shape[1], stats[order].ravel()),
        "rawCount": pa.array(raw[order].astype(np.int64)), "gain": np.where(inner, full["gain"][order], -1.0),
        "leftChild": pa.array(np.where(inner, new[full["left"][order]], -1), pa.int32()), "rightChild": pa.array(np.where(inner, new[full["right"][order]], -1), pa.int32()),
        "featureIndex": pa.array(np.where(inner, full["feature"][order], -1), pa.int32()),
        "threshold": pa.ListArray.from_arrays(ends.astype(np.int32), full["threshold"][order][inner]),
    })


def _described(kind: str, uid: str, params: dict, defaults: dict, **more) -> str:
    import pyspark
    return json.dumps({"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": pyspark.__version__, "uid": uid, "paramMap": params, "defaultParamMap": defaults, **more})


def as_model(spark, classifier, trees: list[Tree], tree_weights: list[float], layout: Layout, weights: np.ndarray | None):
    """The MLlib model of ``classifier`` with these trees."""
    forest = weights is not None
    path = fresh_shared_path(spark, "trees")
    params = {p.name: v for p, v in classifier._paramMap.items()}
    defaults = {p.name: v for p, v in classifier._defaultParamMap.items() if p.name != "seed"}
    name = f"org.apache.spark.ml.classification.{'RandomForest' if forest else 'GBT'}ClassificationModel"
    own = "org.apache.spark.ml." + ("classification.DecisionTreeClassificationModel" if forest else "regression.DecisionTreeRegressionModel")
    more = {"numFeatures": layout.features, "numTrees": len(trees), **({"numClasses": 2} if forest else {})}
    write = lambda text, folder: spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{folder}")
    write(_described(name, classifier.uid, params, defaults, **more), "metadata")
    spark.createDataFrame([(i, _described(own, f"{classifier.uid}_{i}", {"maxDepth": params["maxDepth"]}, {}), float(w)) for i, w in enumerate(tree_weights)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    rows = pa.concat_tables([as_table(t, i, weights) for i, t in enumerate(trees)])
    nodes = spark.createDataFrame(rows).select("treeID", F.struct(
        "id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild",
        F.struct("featureIndex", F.col("threshold").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
    nodes.write.parquet(f"{path}/data")
    return (RandomForestClassificationModel if forest else GBTClassificationModel).load(path)


def _subset(strategy: str, features: int, trees: int) -> int:
    """MLlib's number of features per node for a classification forest."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    if strategy == "all":
        return features
    return int(np.ceil(np.sqrt(features))) if strategy == "sqrt" else int(np.ceil(float(strategy) * features))


def fit_trees(classifier: RandomForestClassifier | GBTClassifier, prefix: Pipeline, train: DataFrame) -> PipelineModel:
    """``Pipeline([*prefix, classifier]).fit(train)``; the weight column has one
    positive value per class, the label is 0 or 1."""
    spark, label, weight = train.sparkSession, classifier.getLabelCol(), classifier.getWeightCol()
    fitted = prefix.fit(train)
    rows = PipelineModel(fitted.stages[:-2]).transform(train)             # without the encoding
    layout = with_thresholds(rows, layout_of(fitted))
    found = {r[label]: r for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.first(weight).alias("w")).collect()}
    n = sum(r["n"] for r in found.values())
    weights = np.array([float(found[c]["w"]) if c in found else 1.0 for c in (0, 1)])
    forest = isinstance(classifier, RandomForestClassifier)
    data = chunks(rows, layout, label, CHUNK_ROWS if forest else BOOST_ROWS).persist(STORED)
    try:
        if forest:
            trees = grow_forest(data, layout, weights, n, trees=classifier.getNumTrees(), depth=classifier.getMaxDepth(), least=classifier.getMinInstancesPerNode(),
                                seed=classifier.getSeed(), bootstrap=classifier.getBootstrap(),
                                k=_subset(classifier.getFeatureSubsetStrategy(), layout.features, classifier.getNumTrees()))
            model = as_model(spark, classifier, trees, [1.0] * len(trees), layout, weights)
        else:
            trees, shares = grow_boosted(data, layout, weights, rounds=classifier.getMaxIter(), depth=classifier.getMaxDepth(), rate=classifier.getStepSize(),
                                         share=classifier.getSubsamplingRate(), seed=classifier.getSeed(),
                                         k=_subset(classifier.getFeatureSubsetStrategy(), layout.features, 1))
            model = as_model(spark, classifier, trees, shares, layout, None)
    finally:
        data.unpersist()
    return PipelineModel([*fitted.stages, model])

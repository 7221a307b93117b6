"""Vector codes: product quantization over integers, searched by equal averages.

Every component x becomes the integer floor(4096 * x).  A vector is cut into
``parts`` equal stretches, each with a codebook of ``entries`` integer
vectors.  The codebooks start as the parts of the vectors with the smallest
ids and are refined by ``rounds`` of assignment and componentwise floored means.

Search.  The entries of a codebook are sorted by the sum of their components.
A part starts where its own sum falls and looks outward on both sides, nearer
sum first.  By Cauchy-Schwarz a squared distance is at least the squared gap
of the sums over the dimension, so the search ends once that bound strictly
exceeds the best distance found; an entry as near as the best is still met,
and the lower index wins.

Work.  A round is one scan: tasks add the parts of each entry and send one row
per sum, Spark adds these, and the driver gets parts x entries x dimension
sums, a number that does not grow with the table.  Sums travel in digits of 32
bits, and integers too large for 64-bit distances are Python integers, so all
arithmetic is exact for any finite component.

Rows.  A vector that is NULL or holds a NULL or non-finite component is
dropped.  Repeated rows are vectors of their own.  NULL ids come last, equal
ids are ordered by their vectors.  Fewer vectors than entries give codebooks
of fewer entries; an empty table gives an empty result.  Vectors of different
length, or of a length that ``parts`` does not divide, are an error.  An error
that a 64-bit integer cannot hold is NULL, as is a label's sum over one.
Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.llm.common import map_arrow, row_sums, stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
DIGIT = 32


@dataclass(frozen=True)
class Codebooks:
    """``parts[p][e]`` is the entry e of part p, a tuple of integers."""

    parts: tuple[tuple[tuple[int, ...], ...], ...]
    scale: int = SCALE

    @property
    def entries(self) -> int:
        return len(self.parts[0])

    @property
    def width(self) -> int:
        """Components of a part."""
        return len(self.parts[0][0]) if self.entries else 0

    def sha256(self) -> str:
        """Of the decimal components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(str(x) for part in self.parts for e in part for x in e).encode()).hexdigest()


# ---- integers ------------------------------------------------------------

def exact_limit(width: int) -> int:
    """Components below it keep squared distances and squared gaps of sums,
    the latter compared with ``width`` distances, inside 63 bits."""
    return (1 << 30) // max(1, width)


def integers(floats: np.ndarray, scale: int, width: int) -> np.ndarray:
    """floor(scale * x), as int64 where that is safe, else as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(floats * float(scale))
    if not scaled.size or np.abs(scaled).max() < exact_limit(width):
        return scaled.astype(np.int64)
    whole = [int(v) * scale if abs(v) >= 2.0 ** 52 else math.floor(v * scale) for v in floats.ravel().tolist()]
    return np.array(whole, object).reshape(floats.shape)


def kept(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows whose vector is whole, and their vectors."""
    batch = batch.filter(pc.is_valid(batch.column("vector")))
    column = batch.column("vector")
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    floats = pc.fill_null(flat.cast(pa.float64()), math.nan).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    whole = row_sums((~np.isfinite(floats)).astype(np.int64), offsets) == 0
    found = lengths[whole]
    if len(found) and found.min() != found.max():
        raise ValueError(f"vectors of {found.min()} and of {found.max()} components")
    floats = floats[np.repeat(whole, lengths)]
    return batch.filter(pa.array(whole)), floats.reshape(len(found), found[0] if len(found) else 0)


# ---- search --------------------------------------------------------------

def nearest(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of ``book`` for every
    row of ``vectors``, ties to the lower index."""
    n, width, k = len(vectors), book.shape[1], len(book)
    totals = book.sum(axis=1)
    order = np.argsort(totals, kind="stable")
    sums, book = totals[order], book[order]
    own = vectors.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    best, index = np.full(n, -1, vectors.dtype), np.full(n, k, np.int64)
    live = np.arange(n)
    while True:
        a, b = left[live], right[live]
        open_ = (a >= 0) | (b < k)
        live, a, b = live[open_], a[open_], b[open_]
        below, above = own[live] - sums[np.maximum(a, 0)], sums[np.minimum(b, k - 1)] - own[live]
        down = (a >= 0) & ((b >= k) | (below <= above).astype(bool))
        gap = np.where(down, below, above)
        near = ((best[live] < 0) | (gap * gap <= best[live] * width)).astype(bool)
        live, a, b, down = live[near], a[near], b[near], down[near]
        if not len(live):
            return index, best
        at = np.where(down, a, b)
        gone = vectors[live] - book[at]
        distance = (gone * gone).sum(axis=1)
        entry = order[at]
        better = ((best[live] < 0) | (distance < best[live]) | ((distance == best[live]) & (entry < index[live]))).astype(bool)
        best[live[better]], index[live[better]] = distance[better], entry[better]
        left[live], right[live] = np.where(down, a - 1, a), np.where(down, b, b + 1)


def assigned(floats: np.ndarray, books: Codebooks):
    """(part number, its integers, index, distance) of every part."""
    n_parts, width = len(books.parts), books.width
    if floats.shape[1] != n_parts * width:
        raise ValueError(f"a vector of {floats.shape[1]} components, the codebooks have {n_parts} parts of {width}")
    vectors = integers(floats, books.scale, width)
    wide = vectors.dtype == object or any(abs(x) >= exact_limit(width) for part in books.parts for e in part for x in e)
    vectors = vectors.astype(object if wide else np.int64)
    for p in range(n_parts):
        own = vectors[:, p * width:(p + 1) * width]
        yield p, own, *nearest(own, np.array(books.parts[p], vectors.dtype).reshape(books.entries, width))


# ---- fitting -------------------------------------------------------------

def digits(value: int):
    """(place, digit) in base 2^32; the last digit carries the sign."""
    place = 0
    while not -1 << (DIGIT - 1) <= value < 1 << (DIGIT - 1):
        yield place, value & ((1 << DIGIT) - 1)
        value >>= DIGIT
        place += 1
    yield place, value


def rows_of(df: DataFrame, id_col: str, vector: str, *more: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("vector"),
                     *[F.col(c).alias(f"more{i}") for i, c in enumerate(more)])


def first_codebooks(rows: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    """Parts of the ``entries`` kept vectors with the smallest ids."""
    whole = "vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    found = [r["vector"] for r in rows.where(whole).orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()]
    lengths = {len(v) for v in found}
    if len(lengths) > 1 or any(n % parts for n in lengths):
        raise ValueError(f"vectors of {sorted(lengths)} components cannot be cut into {parts} equal parts")
    width = lengths.pop() // parts if lengths else 0
    values = [integers(np.array([v], float), scale, width)[0].tolist() for v in found]
    return Codebooks(tuple(tuple(tuple(v[p * width:(p + 1) * width]) for v in values) for p in range(parts)), scale)


def refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: the floored means of the parts nearest to each entry."""
    n_parts, k, width = len(books.parts), books.entries, books.width

    def run(batches):
        sums = np.zeros((n_parts, k, width + 1), object)  # the last column counts
        for batch in batches:
            _, floats = kept(batch)
            if not len(floats):
                continue
            for p, own, index, _ in assigned(floats, books):
                added = np.zeros((k, width + 1), own.dtype)
                np.add.at(added[:, :width], index, own)
                added[:, width] = np.bincount(index, minlength=k)
                sums[p] += added.astype(object)
        found = [(cell, place, d) for cell, v in enumerate(sums.ravel().tolist()) if v for place, d in digits(v)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True) if found else ([], [], []), (pa.int32(), pa.int32(), pa.int64()), strict=True)],
                                         names=["cell", "place", "digit"])

    dealt = map_arrow(rows.select("vector"), run, "cell int, place int, digit bigint")
    totals = [0] * (n_parts * k * (width + 1))
    for r in dealt.groupBy("cell", "place").agg(F.sum("digit").alias("digit")).collect():  # bounded by the codebooks
        totals[r["cell"]] += r["digit"] << (DIGIT * r["place"])

    def entry(p: int, e: int) -> tuple[int, ...]:
        at = (p * k + e) * (width + 1)
        n = totals[at + width]
        return tuple(x // n for x in totals[at:at + width]) if n else books.parts[p][e]

    return Codebooks(tuple(tuple(entry(p, e) for e in range(k)) for p in range(n_parts)), books.scale)


def fit(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = rows_of(df, id_col, vector)
    books = first_codebooks(rows, parts, entries, scale)
    for _ in range(rounds if books.entries else 0):
        books = refined(rows, books)
    return books


# ---- codes ---------------------------------------------------------------

def encode(df: DataFrame, books: Codebooks, id_col: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = ()) -> DataFrame:
    """id_col, ``keep``, code (two hex digits a part), error (squared distances
    summed over the parts) of every kept vector."""
    rows = rows_of(df, id_col, vector, *keep)
    names = [c for c in rows.columns if c != "vector"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"{c} {kinds[c]}" for c in names] + ["code string", "error bigint"])

    def run(batches):
        for batch in batches:
            batch, floats = kept(batch)
            if not len(floats):
                continue
            codes, errors = np.zeros((len(floats), len(books.parts)), np.uint8), np.zeros(len(floats), object)
            for p, _, index, distance in assigned(floats, books):
                codes[:, p] = index
                errors += distance.astype(object)
            text, step = codes.tobytes().hex(), 2 * len(books.parts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array([text[i:i + step] for i in range(0, len(text), step)], pa.string()),
                 pa.array([e if e < 1 << 63 else None for e in errors.tolist()], pa.int64())], names=[*names, "code", "error"])

    out = map_arrow(rows, run, schema) if books.entries else rows.sparkSession.createDataFrame([], schema)
    return out.select(F.col("id").alias(id_col), *[F.col(f"more{i}").alias(c) for i, c in enumerate(keep)], "code", "error")


def decode(codes: DataFrame, books: Codebooks, code: str = "code", vector: str = "decoded") -> DataFrame:
    """``codes`` with the vector that each code stands for, by lookup in the
    codebooks (their size is parts x entries x dimension)."""
    middle = [[[(x + 0.5) / books.scale for x in e] for e in part] for part in books.parts]
    table = F.array(*[F.array(*[F.array(*[F.lit(float(x)) for x in e]) for e in part]) for part in middle])
    part = F.transform(F.sequence(F.lit(0), F.lit(len(books.parts) - 1)),
                       lambda p: table[p][F.conv(F.substring(F.col(code), p * 2 + 1, F.lit(2)), 16, 10).cast("int")])
    return codes.withColumn(vector, F.flatten(part))


def compress(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", **how) -> DataFrame:
    """id_col, code, error, label_error (errors summed over the label, NULLs
    together), codebooks_sha256 of every kept vector."""
    books = fit(df, id_col, vector, **how)
    coded = stored(encode(df, books, id_col, vector, keep=(label,)).withColumnsRenamed({label: "label", id_col: "id"}), "vector-codes")
    total = F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error"))
    sums = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

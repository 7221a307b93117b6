"""Token-ID files: Arrow IPC files with batches of equal-length sequences.

A shard holds a stretch of the corpus in ascending id order.  The ids of its
documents, each followed by the end id, are cut into sequences of ``length``;
every record batch holds ``rows`` of them in two fixed-size-list columns,
``input_ids`` (uint16, or uint32 for larger vocabularies) and ``mask`` (true
for a token, false for the padding after the shard's last token).  Any
sequence is reached through the file's footer without reading or copying
another one (``sequence``).  A second file per shard lists its documents: id,
first position, number of tokens.

Spark ranges the documents by id over the shards and sorts within them.  A
task writes its files under a name of its own attempt and renames them when
they are complete, so lost and repeated tasks leave whole files only.  The
folder must be one that all executors share; the shard table, a row per
shard, is stored beside the files.

Tokenizing.  White space ends a pre-token in the tokenizers used here, so the
ids of a text are the ids of its white-space runs one after another, and each
distinct run of a slice is encoded once.  Latin-1 text is cut into pre-tokens
as the pattern of the tokenizer's own file does, and these are encoded many to
a call; any other run is encoded by itself.  ``chunkable`` checks that the
tokenizer is of this kind; any other tokenizer encodes whole texts.

Rows.  A NULL text is an empty one and gives the end id alone.  A NULL id
sorts first.  Repeated rows are documents of their own, rows tied on the id
follow each other in text order.  An empty table gives no shard and an empty
result.  Further columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc as ipc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txguard.llm.common import gather, map_arrow, slices, words, worker_cache
from txguard.session import fresh_shared_path

LENGTH = 2048
ROWS = 256
END_ID = 2
SLICE = 4 << 20
CACHED_PIECES = 500_000
PLAIN_TEXT = r"^[\t-\r !-&(-~\x{a1}-\x{ff}]*$"
# Fixed value: the pre-token pattern that ``_plain`` cuts by.
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile("[!-~\u00a1-\u00ff]+")  # Latin-1 without blanks and controls: lower-casing is all that normalizing does


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- tokenizing ----------------------------------------------------------

class Encoder:
    """ids of white-space runs by one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.split = self.chunkable(spec)
        # else every text is cut run by run, by the file's own pattern and added tokens
        self.plain = self.split is not None and self.split.pattern == PLAIN_PATTERN and all("<|" in t["content"] for t in spec["added_tokens"])
        self.added = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.ends = np.zeros(self.size, bool)
        if suffix:
            for piece, i in self.tok.get_vocab(with_added_tokens=True).items():
                self.ends[i] = piece.endswith(suffix)
        self._forget()

    def _forget(self) -> None:
        """Encoded pre-tokens: their places, and their ids one after another."""
        self.index: dict[str, int] = {}
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    @staticmethod
    def chunkable(spec: dict):
        """The pre-token pattern if runs between white space are encoded
        independently and one pre-token at a time, else None."""
        try:
            steps = spec["normalizer"]["normalizers"]
            split, bytelevel = spec["pre_tokenizer"]["pretokenizers"]
            known = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            whole = split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"] and bytelevel["type"] == "ByteLevel" and not bytelevel["add_prefix_space"]
            pattern = split["pattern"]["Regex"]
            if not (known and whole and spec["model"]["end_of_word_suffix"] and spec["post_processor"] is None):
                return None
            import regex

            return regex.compile(pattern) if regex.compile(pattern).search(" \t\n") is None else None
        except (KeyError, TypeError, ValueError):
            return None

    def places(self, pieces: list[str]) -> np.ndarray:
        """Places of pre-tokens; unknown ones are encoded, hundreds to a call,
        and the end-of-word pieces tell them apart again."""
        if len(self.index) > CACHED_PIECES:
            self._forget()
        new = list({p for p in pieces if p not in self.index})
        groups = [new[i:i + 500] for i in range(0, len(new), 500)]
        flat, counts = [self.flat], []
        for group, e in zip(groups, self.tok.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.asarray(e.ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(group) or (len(cuts) and cuts[-1] != len(ids)):
                found = [np.asarray(x.ids, np.uint32) for x in self.tok.encode_batch_fast(group, add_special_tokens=False)]
                ids, cuts = np.concatenate(found), np.cumsum([len(x) for x in found])
            flat.append(ids)
            counts.append(np.diff(cuts, prepend=0))
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.flat = np.concatenate(flat)
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(counts))])
        return np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))

    def runs(self, runs: list[str]) -> list[np.ndarray]:
        """ids of every run."""
        cut = [self.split.findall(r.lower()) if PLAIN.fullmatch(r) and not self.added.search(r) else None for r in runs]
        at = self.places([p for c in cut if c for p in c])
        ids, lengths = gather(self.starts, self.flat, at)
        counts = np.array([len(c) if c else 0 for c in cut], np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        out = np.split(ids, ends[:-1])
        rest = [i for i, c in enumerate(cut) if c is None]
        for i, e in zip(rest, self.tok.encode_batch_fast([runs[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.asarray(e.ids, np.uint32)
        return out

    def texts(self, text: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts, each with the end id, and their counts."""
        if self.split is None:
            found = [np.asarray(e.ids, np.uint32) for e in self.tok.encode_batch_fast(pc.fill_null(text, "").to_pylist(), add_special_tokens=False)]
            counts = np.array([len(x) + 1 for x in found], np.int64)
            return np.concatenate([np.append(x, np.uint32(end)) for x in found] or [np.zeros(0, np.uint32)]), counts
        text = pc.fill_null(text, "")
        if not self.plain:
            return self._mixed(text, end)
        plain = pc.and_(pc.match_substring_regex(text, PLAIN_TEXT), pc.invert(pc.match_substring(text, "<|")))
        if pc.all(plain).as_py() is not False:
            return self._plain(text, end)
        if not pc.any(plain).as_py():
            return self._mixed(text, end)
        parts = [self._plain(text.filter(plain), end), self._mixed(text.filter(pc.invert(plain)), end)]
        row = plain.to_numpy(zero_copy_only=False)
        place = np.empty(len(row), np.int64)  # of each row among the plain ones, then the others
        place[row], place[~row] = np.arange(row.sum()), row.sum() + np.arange((~row).sum())
        counts = np.concatenate([c for _, c in parts])
        ids, _ = gather(np.concatenate([[0], np.cumsum(counts)]), np.concatenate([i for i, _ in parts]), place)
        return ids, counts[place]

    def _plain(self, text: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Latin-1 texts without apostrophes: blanks around numerals and marks
        make every pre-token a word."""
        distinct, codes, offsets = words(pc.replace_substring_regex(pc.utf8_lower(text), r"(\p{N}|[^\p{L}\p{N}\s]+)", r" \1 "))
        at = self.places(distinct.to_pylist())
        return self._joined(self.starts, self.flat, at[codes], offsets, end)

    def _mixed(self, text: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Any texts, run by run."""
        distinct, codes, offsets = words(text)
        found = self.runs(distinct.to_pylist())
        starts = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        return self._joined(starts, np.concatenate(found) if found else np.zeros(0, np.uint32), codes.astype(np.int64), offsets, end)

    @staticmethod
    def _joined(starts, flat, index, offsets, end) -> tuple[np.ndarray, np.ndarray]:
        """The pieces ``index`` of each row one after another, then the end id."""
        last = len(starts) - 1  # the end is one more piece, placed after each row's own
        index = np.insert(index, offsets[1:], last)
        ids, lengths = gather(np.append(starts, starts[-1] + 1), np.append(flat, np.uint32(end)), index)
        upto = np.cumsum(lengths)[np.arange(len(offsets) - 1) + offsets[1:]]
        return ids, np.diff(upto, prepend=0)


def encoder(path: str) -> Encoder:
    kept = worker_cache()
    if kept.get("encoder_path") != path:
        kept["encoder"], kept["encoder_path"] = Encoder(path), path
    return kept["encoder"]


# ---- files ---------------------------------------------------------------

def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + folder)


class ShardWriter:
    """Writes one shard's token and document files."""

    def __init__(self, folder: str, shard: int, attempt: int, id_type: pa.DataType, dtype, length: int, rows: int):
        self.fs, base = _open(folder)
        self.length, self.rows, self.dtype, self.id_type = length, rows, dtype, id_type
        self.names = [(f"{base}/.{shard:06d}-{attempt}.{k}", f"{base}/{shard:06d}.{k}") for k in ("tokens.arrow", "docs.arrow")]
        ids = pa.list_(pa.from_numpy_dtype(dtype), length)
        self.schema = pa.schema([("input_ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        self.doc_schema = pa.schema([("id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [self.fs.open_output_stream(t) for t, _ in self.names]
        self.files = [ipc.new_file(s, c) for s, c in zip(self.sinks, (self.schema, self.doc_schema), strict=True)]
        self.left: list[np.ndarray] = []
        self.n_left = self.n_tokens = self.n_docs = 0

    def add(self, ids: pa.Array, tokens: np.ndarray, counts: np.ndarray) -> None:
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.files[1].write_batch(pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(counts)], schema=self.doc_schema))
        self.n_tokens += len(tokens)
        self.n_docs += len(ids)
        self.left.append(tokens.astype(self.dtype))
        self.n_left += len(tokens)
        if self.n_left >= self.length * self.rows:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        tokens, step = np.concatenate(self.left) if self.left else np.zeros(0, self.dtype), self.length * self.rows
        at = 0
        while len(tokens) - at >= step or (last and at < len(tokens)):
            part = tokens[at:at + step]
            at += len(part)
            padding = -len(part) % self.length
            ids = pa.FixedSizeListArray.from_arrays(pa.array(np.pad(part, (0, padding))), self.length)
            mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(part) + padding) < len(part)), self.length)
            self.files[0].write_batch(pa.RecordBatch.from_arrays([ids, mask], schema=self.schema))
        self.left, self.n_left = [tokens[at:].copy()], len(tokens) - at

    def close(self) -> None:
        self._flush(True)
        for f, s, (tmp, name) in zip(self.files, self.sinks, self.names, strict=True):
            f.close()
            s.close()
            self.fs.move(tmp, name)


def write(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, text: str = "text",
          id_col: str = "doc_id", end_id: int = END_ID, length: int = LENGTH, rows: int = ROWS) -> str:
    """Write the files of ``docs``; returns their folder."""
    spark = docs.sparkSession
    folder = folder or fresh_shared_path(spark, "tokens")
    tokenizer = tokenizer or vocabulary_path()

    def run(batches):
        shard, writer = TaskContext.get().partitionId(), None
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                enc = encoder(tokenizer)
                tokens, counts = enc.texts(part.column("text"), end_id)
                if writer is None:
                    dtype = np.uint16 if max(enc.size, end_id + 1) <= 1 << 16 else np.uint32
                    writer = ShardWriter(folder, shard, TaskContext.get().taskAttemptId(), part.column("id").type, dtype, length, rows)
                writer.add(part.column("id"), tokens, counts)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "n_docs": writer.n_docs, "n_tokens": writer.n_tokens}],
                                             pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    _make(spark, folder)
    ordered = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).repartitionByRange("id").sortWithinPartitions("id", "text")
    shards = map_arrow(ordered, run, "shard int, n_docs bigint, n_tokens bigint")
    shards.write.parquet(f"{folder}/shards")
    return folder


def _make(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def read_documents(spark: SparkSession, folder: str, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts the ids of all documents before; ids_crc32 is taken over
    the document's ids as little-endian unsigned 32-bit integers.
    """
    shards = spark.read.schema("shard int, n_docs bigint, n_tokens bigint").parquet(f"{folder}/shards")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard
    shards = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("shard", "base")

    def run(batches):
        fs, base = _open(folder)
        for batch in batches:
            for shard, first in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with fs.open_input_file(f"{base}/{shard:06d}.tokens.arrow") as t, fs.open_input_file(f"{base}/{shard:06d}.docs.arrow") as d:
                    tokens, found = ipc.open_file(t), ipc.open_file(d)
                    held, at, i = np.zeros(0, np.uint16), 0, 0  # held[0] is the shard's token number ``at``
                    for k in range(found.num_record_batches):
                        rows = found.get_batch(k)
                        starts, counts = rows.column("start").to_numpy(), rows.column("n_tokens").to_numpy()
                        upto = int(starts[-1] + counts[-1]) if len(starts) else at
                        parts = [held]
                        have = at + len(held)
                        while have < upto:
                            parts.append(_real(tokens.get_batch(i)))
                            have += len(parts[-1])
                            i += 1
                        held = np.concatenate(parts) if len(parts) > 1 else held
                        crcs = [zlib.crc32(held[a:a + n].astype("<u4").tobytes()) for a, n in zip((starts - at).tolist(), counts.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [rows.column("id"), pa.array(starts + first), pa.array(counts), pa.array(crcs, pa.int64())],
                            names=["id", "start", "n_tokens", "ids_crc32"])
                        held, at = held[upto - at:], upto

    many = max(1, shards.count())
    out = map_arrow(shards.repartition(many, "shard"), run, f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
    return out.withColumnRenamed("id", id_col)


def _real(batch: pa.RecordBatch) -> np.ndarray:
    """Tokens of a batch without the padding."""
    ids, mask = batch.column("input_ids").flatten().to_numpy(), batch.column("mask").flatten()
    return ids[:pc.sum(mask).as_py() or 0]


def sequence(folder: str, shard: int, number: int, rows: int = ROWS) -> tuple[np.ndarray, pa.Array]:
    """(ids, mask) of one sequence of a shard, by random access; local files
    are mapped into memory and not copied."""
    fs, base = _open(folder)
    path = f"{base}/{shard:06d}.tokens.arrow"
    source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
    batch = ipc.open_file(source).get_batch(number // rows)
    row = number % rows
    return batch.column("input_ids")[row].values.to_numpy(zero_copy_only=True), batch.column("mask")[row].values

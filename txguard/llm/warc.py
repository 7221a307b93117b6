"""WARC archives with a Zstandard dictionary.

An archive is a ``.warc.zst`` file.  Its first frame is a skippable one (magic
0x184D2A5D) that holds a dictionary built from records of this archive; every
record after it, a ``warcinfo`` first, is a Zstandard frame of its own, so
that a record is read by seeking to its offset (``record``).  An archive takes
records until ``target_bytes`` of them wait, trains the dictionary on an even
selection of them (at most ``SAMPLE_BYTES``; the records are all archived),
and compresses them one by one.  Records too few or too alike for training
are archived without a dictionary.

Records.  A page is a ``response`` record: HTTP headers and the payload, the
page's html in UTF-8.  Of pages with equal payloads of at least ``min_bytes``
bytes the one with the smallest page id is the response, the others are
``revisit`` records (identical-payload-digest) that refer to it and hold the
HTTP headers alone.  A digest decides equality.  The id of a response that can
be revisited derives from the digest; other ids from the archive's name and the
record's place.  Reruns write the same records.

Work.  A scan without texts finds the digests that occur more than once; they
are stored, so that Spark broadcasts them by their known size or splits the hot ones of a
shuffle, and a revisit travels without its payload.  Tasks write
archives under names of their own attempt and rename them when complete, so lost and
repeated tasks leave whole archives only; the index lists the archives of the
attempts that counted.  The folder must be one that all executors share.

Rows.  NULL html is an empty payload.  A NULL page id is the largest and has
no header; a NULL url has no target header, blanks and controls in a url are percent-encoded.  Of
rows with the same id and payload the smallest url (NULL last) is the
response; of rows equal in all three any one is, the others revisit it.  An
empty table gives no archive and an empty result.  Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.llm.common import map_arrow, stored
from txguard.session import fresh_shared_path

# --- Fixed values of the formats. ---
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --- end of fixed values ---
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
TARGET_BYTES = 64 << 20  # of records before compression; one task holds them
LEVEL = 3
MIN_BYTES = 0
DATE = "1970-01-01T00:00:00Z"  # pages have no date
READ_BYTES = 16 << 10
COPIES_AT_ONCE = 10_000
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:txguard:warc")
BLANK = re.compile(r"[\x00-\x20\x7f]")
INDEX = "page_id string, record_type string, archive string, at bigint, length bigint"


# ---- records -------------------------------------------------------------

def record_id(name: str) -> str:
    return f"<{uuid.uuid5(NAMESPACE, name).urn}>"


def encoded(text: str) -> str:
    return BLANK.sub(lambda m: f"%{ord(m[0]):02X}", text)


def block(kind: str, headers: list[tuple[str, str | None]], body: bytes) -> bytes:
    """A whole record; headers without a value are left out."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers if v is not None], f"Content-Length: {len(body)}"]
    return b"".join(["\r\n".join(lines).encode(), b"\r\n\r\n", body, b"\r\n\r\n"])


def page_record(page: dict, name: str, date: str) -> bytes:
    """``page``: page_id, url, sha1 (hex), size, payload (None for a revisit),
    first_id, first_url (what a revisit refers to), shared (a referable response)."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(page["sha1"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['size']}\r\n\r\n".encode()
    revisit = page["payload"] is None
    target = None if page["url"] is None else encoded(page["url"])
    headers = [("WARC-Record-ID", record_id(digest if page["shared"] else name)), ("WARC-Date", date), ("WARC-Target-URI", target),
               ("WARC-Payload-Digest", digest), ("Page-ID", None if page["page_id"] is None else encoded(page["page_id"]))]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(digest)),
                    ("WARC-Refers-To-Target-URI", None if page["first_url"] is None else encoded(page["first_url"])),
                    ("Refers-To-Page-ID", None if page["first_id"] is None else encoded(page["first_id"]))]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    return block("revisit" if revisit else "response", headers, http + (page["payload"] or b""))


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with names in lower case, block) of one whole record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = int(headers["content-length"]) if found and lines[0] == "WARC/1.1" else -1
    if size < 0 or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:size]


def decoded(text: str | None) -> str | None:
    return None if text is None else re.sub(r"%([01][0-9A-F]|20|7F)", lambda m: chr(int(m[1], 16)), text)


def page_of(headers: dict[str, str], body: bytes) -> dict:
    """What a page's record says; a response's payload is measured and its
    digest compared."""
    http, _, payload = body.partition(b"\r\n\r\n")
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?im)^Content-Length: (\d+)", http)[1])
    if headers["warc-type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {headers['warc-record-id']} is not the one that its headers name")
    return {"page_id": decoded(headers.get("page-id")), "payload_bytes": size, "payload_digest": digest,
            "record_type": headers["warc-type"], "refers_to": decoded(headers.get("refers-to-page-id"))}


# ---- archives ------------------------------------------------------------

def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + folder)


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES, sample_bytes: int = SAMPLE_BYTES) -> zstandard.ZstdCompressionDict | None:
    """Trained on evenly spaced records; None if they are not enough for it."""
    total = sum(map(len, records))
    samples = [r[:sample_bytes // 8] for r in records[::max(1, -(-total // sample_bytes))]]
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), samples, k=200, d=8)
    except (zstandard.ZstdError, ValueError):
        return None


class ArchiveWriter:
    """Gathers the records of one archive; ``close`` writes it."""

    def __init__(self, folder: str, name: str, attempt: int, date: str, level: int):
        self.folder, self.name, self.attempt, self.date, self.level = folder, name, attempt, date, level
        self.records: list[bytes] = []
        self.pages: list[tuple] = []
        self.waiting = 0

    def add(self, page: dict) -> None:
        data = page_record(page, f"{self.name}/{len(self.records)}", self.date)
        self.records.append(data)
        self.pages.append((page["page_id"], "revisit" if page["payload"] is None else "response"))
        self.waiting += len(data)

    def close(self) -> pa.RecordBatch:
        """The archive's index."""
        trained = dictionary(self.records)
        zip_ = zstandard.ZstdCompressor(level=self.level, dict_data=trained, write_checksum=True, write_content_size=True)
        info = block("warcinfo", [("WARC-Record-ID", record_id(self.name)), ("WARC-Date", self.date), ("WARC-Filename", self.name),
                                  ("Content-Type", "application/warc-fields")], b"software: txguard\r\nformat: WARC File Format 1.1\r\n")
        fs, base = open_folder(self.folder)
        at, rows = 0, []
        with fs.open_output_stream(tmp := f"{base}/.{self.name}-{self.attempt}", compression=None) as out:
            if trained is not None:
                held = trained.as_bytes()
                out.write(struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held)
                at = 8 + len(held)
            at += out.write(zip_.compress(info))
            for data, page in zip(self.records, self.pages, strict=True):
                frame = zip_.compress(data)
                out.write(frame)
                rows.append((*page, self.name, at, len(frame)))
                at += len(frame)
        fs.move(tmp, f"{base}/{self.name}")
        names = ["page_id", "record_type", "archive", "at", "length"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def leading_dictionary(start: bytes, more) -> tuple[zstandard.ZstdCompressionDict | None, bytes]:
    """(dictionary, bytes read behind it); ``more(n)`` reads on."""
    magic, size = struct.unpack("<II", start[:8]) if len(start) >= 8 else (0, 0)
    if magic != DICTIONARY_MAGIC:
        return None, start
    held = start[8:] + more(max(0, size - len(start) + 8))
    return zstandard.ZstdCompressionDict(held[:size]), held[size:]


def records(source) -> Iterator[bytes]:
    """Every record of an open archive, frame by frame."""
    trained, held = leading_dictionary(source.read(READ_BYTES), source.read)
    unzip = zstandard.ZstdDecompressor(dict_data=trained)
    while held or (held := source.read(READ_BYTES)):
        frame, parts = unzip.decompressobj(), []
        while not frame.eof:
            if not held and not (held := source.read(READ_BYTES)):
                raise ValueError("the archive ends inside a record")
            parts.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def record(folder: str, archive: str, at: int, length: int) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record, by its place in the index."""
    fs, base = open_folder(folder)
    with fs.open_input_file(f"{base}/{archive}") as source:
        trained, _ = leading_dictionary(source.read_at(READ_BYTES, 0), lambda n: source.read_at(n, READ_BYTES))
        return parsed(zstandard.ZstdDecompressor(dict_data=trained).decompress(source.read_at(length, at)))


# ---- jobs ----------------------------------------------------------------

def first_of_equal(pages: DataFrame) -> DataFrame:
    """sha1, first_id, first_url, copies (rows equal to the first) of every
    payload that more than one row has."""
    last = lambda c: F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value"))  # noqa: E731  NULL is the largest
    rows = pages.groupBy("sha1", "page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct(last("page_id").alias("id"), last("url").alias("url"), "copies"))
    found = rows.groupBy("sha1").agg(first.alias("first"), F.sum("copies").alias("n")).where(F.col("n") > 1)
    return found.select("sha1", F.col("first.id.value").alias("first_id"), F.col("first.url.value").alias("first_url"), F.col("first.copies").alias("copies"))


def typed(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """page_id, url, sha1, size, payload (NULL for a revisit), first_id,
    first_url, shared of every record to write."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("sha1"), F.length("payload").cast("bigint").alias("size"))
    large = rows if min_bytes <= 0 else rows.where(F.col("size") >= min_bytes)
    firsts = stored(first_of_equal(large.select("sha1", "page_id", "url")), "warc-first")
    joined = rows.join(firsts, "sha1", "left")
    same = F.col("copies").isNotNull() & F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    columns = ["page_id", "url", "sha1", "size", "payload", "first_id", "first_url", "shared"]
    response = F.col("copies").isNull() | same
    out = joined.select("page_id", "url", "sha1", "size", F.when(response, F.col("payload")).alias("payload"), "first_id", "first_url",
                        (response & (F.col("size") >= min_bytes)).alias("shared"),
                        F.coalesce(same & (F.col("copies") > 1), F.lit(False)).alias("tied"))
    if firsts.where("copies > 1").isEmpty():
        return out.select(columns)
    # rows equal in id, url and payload: one of them is taken for all, the others follow as revisits
    one = out.where("tied").groupBy("page_id", "url", "sha1", "size", "first_id", "first_url", "shared").agg(F.any_value("payload").alias("payload"))
    starts = one.join(firsts.select("sha1", "copies"), "sha1").select(
        "page_id", "url", "sha1", "size", "first_id", "first_url", "copies", F.explode(F.sequence(F.lit(1).cast("bigint"), F.greatest(F.col("copies") - 1, F.lit(1)), F.lit(COPIES_AT_ONCE).cast("bigint"))).alias("k"))
    others = starts.repartition("sha1", "k").select(
        "*", F.explode(F.sequence(F.col("k"), F.least(F.col("k") + COPIES_AT_ONCE, F.col("copies")) - 1)).alias("copy")).select(
        "page_id", "url", "sha1", "size", F.lit(None).cast("binary").alias("payload"), "first_id", "first_url", F.lit(False).alias("shared"))
    return out.where("NOT tied").select(columns).unionByName(one.select(columns)).unionByName(others)


def write(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html",
          min_bytes: int = MIN_BYTES, target_bytes: int = TARGET_BYTES, date: str = DATE, level: int = LEVEL) -> str:
    """Write the archives of ``pages`` and their index (page_id, record_type,
    archive, at, length; Parquet in ``index``); returns the folder."""
    spark = pages.sparkSession
    folder = folder or fresh_shared_path(spark, "warc")

    def run(batches):
        task, writer, n = TaskContext.get(), None, 0
        for batch in batches:
            for k in range(batch.num_rows):
                if writer is None:
                    writer = ArchiveWriter(folder, f"{task.partitionId():06d}-{n:05d}.warc.zst", task.taskAttemptId(), date, level)
                    n += 1
                writer.add({c: batch.column(c)[k].as_py() for c in batch.schema.names})
                if writer.waiting >= target_bytes:
                    yield writer.close()
                    writer = None
        if writer is not None:
            yield writer.close()

    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    rows = typed(pages, page_id, url, html, min_bytes)
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "first_id")})
    map_arrow(rows, run, INDEX).write.parquet(f"{folder}/index")
    return folder


def read(spark: SparkSession, folder: str, id_type: str = "bigint", page_id: str = "page_id") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    page, from the archives."""
    archives = spark.read.schema(INDEX).parquet(f"{folder}/index").select("archive").distinct()

    def run(batches):
        fs, base = open_folder(folder)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for data in records(source):
                        headers, body = parsed(data)
                        if headers["warc-type"] != "warcinfo":
                            rows.append(page_of(headers, body))
                        if len(rows) == 10_000:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, pa.schema([
            ("page_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]))

    many = max(1, archives.count())
    out = map_arrow(archives.repartition(many, "archive"), run, "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string")
    return out.select(F.col("page_id").cast(id_type).alias(page_id), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))

"""Vector codes, WARC archives and the divergence audit against brute force:
NULLs, empty and very long values, ties, repeated rows, empty tables, clashing
column names."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from txguard.llm import divergence, vectorcodes, warc

CLASHING = ["id", "vector", "code", "error", "label_error", "of", "more0", "cell", "digit", "k", "sha1", "size", "payload", "copies", "first_id", "shared",
            "tied", "archive", "at", "term", "n", "df", "p", "q", "own", "zero", "block", "blocks", "panel", "panels", "peers", "value", "rank", "item", "part", "v", "total", "all"]


def clashing(df):
    have = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING if c not in have])


# ---- 11 vector codes -----------------------------------------------------

def brute_codes(rows, parts=8, entries=16, rounds=6):
    """{position: (code, error, label_error, sha)} in plain integers."""
    kept = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[math.floor(4096 * x) if abs(x) < 1e300 else int(x) * 4096 for x in v] for _, v, _ in kept]
    if not kept:
        return []
    width = len(ints[0]) // parts
    first = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][1]))[:entries]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in ints]
    books = [[cut[j][p] for j in first] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for v in cut:
                groups[near(p, v[p])[1]].append(v[p])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[near(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by_label[lab] += e
    long = lambda e: e if e < 1 << 63 else None
    return [(i, "".join(f"{k:02x}" for _, k in f), long(e), long(by_label[lab]), sha)
            for (i, _, lab), f, e in zip(kept, found, errors, strict=True)]


def vectors(n, seed=0, dim=16):
    rng = np.random.default_rng(seed)
    out = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, dim)], int(rng.integers(3))) for i in rng.permutation(n)]
    return out


ODD_VECTORS = [*vectors(60), (100, None, 1), (101, [0.1] * 15 + [None], 1), (102, [float("nan")] + [0.1] * 15, None), (103, [float("inf")] + [0.1] * 15, 0),
               (104, [-float("inf")] + [0.1] * 15, 0), (105, [0.0] * 16, None), (106, [-0.0] * 16, None), (7, [0.25] * 16, 2), (7, [0.25] * 16, 2),
               (None, [0.5] * 8 + [-0.5] * 8, None), (None, [-1e-9] * 16, None), (107, [], 1)]


@pytest.mark.parametrize("rows", [
    [r for r in ODD_VECTORS if r[1] != []], vectors(5), [(i, [1.0] * 8, i % 2) for i in range(40)],
    [(i, [0.5] * 8, None) for i in range(3)] + [(9, [1e30] * 8, None), (10, [-3e38] * 4 + [7.0] * 4, 1)], [(1, None, 1)], [], [(1, [], 0), (2, [], 0)],
], ids=["odd", "few", "equal", "huge", "none kept", "empty", "no components"])
def test_vector_codes_equal_brute_force(spark, rows):
    df = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).repartition(3)
    got = Counter(tuple(r) for r in vectorcodes.compress(df).collect())
    assert got == Counter(brute_codes(rows))


def test_vectors_of_unequal_or_uneven_length_are_an_error(spark):
    for rows in ([(1, [1.0] * 12, 0)], [(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)]):
        with pytest.raises(Exception, match="components"):
            vectorcodes.compress(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()


def test_equal_average_search_is_exact_and_takes_the_lower_index():
    rng = np.random.default_rng(3)
    for n in range(60):
        width, k = int(rng.integers(0, 6)), int(rng.integers(1, 20))
        book, x = rng.integers(-3, 4, (k, width)), rng.integers(-4, 5, (50, width))
        all_ = ((x[:, None] - book) ** 2).sum(axis=2)
        for kind in (np.int64, object):
            index, distance = vectorcodes.nearest(x.astype(kind), book.astype(kind))
            assert index.tolist() == all_.argmin(axis=1).tolist() and distance.tolist() == all_.min(axis=1).tolist(), n


def test_digits_give_the_sum_back():
    for v in (0, 1, -1, 2**31, -2**31, -2**31 - 1, 2**63, -2**100 + 5):
        assert sum(d << (32 * place) for place, d in vectorcodes.digits(v)) == v


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    df = spark.createDataFrame(vectors(200, dim=32), "vec_id bigint, embedding array<float>, label int")
    books = vectorcodes.fit(df)
    coded = vectorcodes.decode(vectorcodes.encode(df, books), books).join(df, "vec_id")
    for r in coded.collect():
        gone = [math.floor(4096 * x) - math.floor(4096 * y) for x, y in zip(r["embedding"], r["decoded"], strict=True)]
        assert sum(g * g for g in gone) == r["error"]


# ---- 12 WARC -------------------------------------------------------------

HTML = "<html><head><title>t</title></head><body>" + "".join(f"<p class='c{i}'>row {i}</p>" for i in range(40)) + "</body></html>"
PAGES = [
    (3, "http://a/3", HTML), (1, "http://b/1?x=ü y\r\nWARC-Type: no", HTML), (2, None, None), (4, "http://c", ""), (5, "http://c", "été — 東京"),
    (6, "http://d", "été — 東京"), (6, "http://d", "été — 東京"), (None, "http://e", "été — 東京"), (7, "http://f", "only null ids"),
    (None, None, "twice without id"), (None, None, "twice without id"), (None, "http://g", "twice without id"),
    (8, "http://h/2", "tied"), (8, "http://h/1", "tied"), (8, None, "tied"), (9, "", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (10, "http://long", "lorem ipsum " * 200_000), *[(100 + i, f"http://i/{i}", HTML.replace("row", f"line {i}")) for i in range(60)],
    *[(300, "http://same", "the same row")] * 25, (301, "http://same", "the same row"),
]


def brute_pages(rows, min_bytes=0):
    body = lambda h: (h or "").encode()
    groups = defaultdict(list)
    for i, u, h in rows:
        groups[body(h)].append((i is None, i or 0, u is None, u or "", i))
    out = Counter()
    for data, found in groups.items():
        found.sort()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        for k, r in enumerate(found):
            again = k > 0 and len(data) >= min_bytes
            out[(r[4], len(data), digest, "revisit" if again else "response", found[0][4] if again else None)] += 1
    return out


@pytest.fixture(scope="module")
def pages(spark):
    return clashing(spark.createDataFrame(PAGES, "page_id bigint, url string, html string")).repartition(4).persist()


@pytest.mark.parametrize("min_bytes", [0, 15])
def test_archives_round_trip(spark, pages, min_bytes, monkeypatch):
    monkeypatch.setattr(warc, "COPIES_AT_ONCE", 7)
    folder = warc.write(pages, min_bytes=min_bytes, target_bytes=20_000)
    got = Counter(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in warc.read(spark, folder).collect())
    assert got == brute_pages(PAGES, min_bytes)
    assert spark.read.parquet(f"{folder}/index").select("archive").distinct().count() > 4


def test_archive_is_one_frame_a_record_behind_its_dictionary(spark, pages):
    folder = warc.write(pages.where("page_id >= 100").coalesce(1))
    every = spark.read.parquet(f"{folder}/index").collect()
    index = [r for r in every if r["archive"] == "000000-00000.warc.zst"]
    fs, base = warc.open_folder(folder)
    data = fs.open_input_file(f"{base}/{index[0]['archive']}").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    assert zstandard.get_frame_parameters(data[8 + size:]).dict_id == zstandard.ZstdCompressionDict(data[8:8 + size]).dict_id() != 0
    ends, ids, plain = 8 + size, set(), 0
    seen = list(warc.records(fs.open_input_file(f"{base}/{index[0]['archive']}")))
    assert len(seen) == len(index) + 1 and warc.parsed(seen[0])[0]["warc-type"] == "warcinfo"
    for r in sorted(index, key=lambda r: r["at"]):
        whole = unzip.decompress(data[r["at"]:r["at"] + r["length"]])
        assert whole in seen and warc.record(folder, r["archive"], r["at"], r["length"]) == warc.parsed(whole)
        headers, body = warc.parsed(whole)
        ids.add(headers["warc-record-id"])
        plain += len(whole)
        ends = r["at"] + r["length"]
    assert ends == len(data) and len(ids) == len(index) and len(data) - 8 - size < plain / 4
    assert any(r["archive"] != index[0]["archive"] for r in every)
    revisits = [warc.record(folder, r["archive"], r["at"], r["length"])[0] for r in every if r["record_type"] == "revisit"]
    ids |= {warc.record(folder, r["archive"], r["at"], r["length"])[0]["warc-record-id"] for r in every}
    assert len(ids) == len(every)
    assert revisits and all(h["warc-refers-to"] in ids and h["warc-profile"].endswith("identical-payload-digest") for h in revisits)


def test_headers_cannot_be_broken_by_a_url(spark, pages):
    folder = warc.write(pages.where("page_id = 1"))
    (r,) = spark.read.parquet(f"{folder}/index").collect()
    headers, body = warc.record(folder, r["archive"], r["at"], r["length"])
    assert headers["warc-target-uri"] == "http://b/1?x=ü%20y%0D%0AWARC-Type:%20no" and headers["warc-type"] == "response"
    assert body.partition(b"\r\n\r\n")[2] == HTML.encode()


def test_reruns_write_the_same_archives(spark, pages):
    def contents():
        folder = warc.write(pages.where("page_id >= 100").coalesce(1))
        fs, base = warc.open_folder(folder)
        return [fs.open_input_file(f"{base}/{r['archive']}").read() for r in spark.read.parquet(f"{folder}/index").select("archive").distinct().collect()]

    assert contents() == contents()


def test_archives_of_few_pages_of_none_and_broken_ones(spark, pages):
    folder = warc.write(pages.where("page_id = 5"))
    (r,) = spark.read.parquet(f"{folder}/index").collect()
    fs, base = warc.open_folder(folder)
    data = fs.open_input_file(f"{base}/{r['archive']}").read()
    assert data[:4] == b"\x28\xb5\x2f\xfd"              # too few for a dictionary: a plain frame comes first
    assert len(list(warc.records(pa.BufferReader(data)))) == 2
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.records(pa.BufferReader(data[:-3])))
    assert warc.read(spark, warc.write(pages.limit(0))).collect() == []
    text = warc.block("response", [("WARC-Record-ID", "x"), ("WARC-Payload-Digest", "sha1:A")], b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\na")
    with pytest.raises(ValueError, match="payload"):
        warc.page_of(*warc.parsed(text))


# ---- 13 divergence -------------------------------------------------------

WORDS = "alpha beta gamma delta Été naïve 東京 don't x1y2z the THE of".split()
DOCS = [(i, " ".join(WORDS[(i * k) % len(WORDS)] for k in range(1, 4 + i % 7)), ["en", "de", None, ""][i % 4], f"s{i % 5}" if i % 6 else None) for i in range(120)]
DOCS += [(500, None, "en", "s9"), (501, "", "xx", "a"), (502, "1 2 3 !", "xx", "b"), (503, "rare words here", "xx", "c"), (1, "alpha beta", "en", "s1"),
         (1, "alpha beta", "en", "s1"), (None, "The the THE", "en", "only"), (505, "the " * 50_000 + "of", "en", "s1"), (506, "alone", "yy", "only")]
DOCS += [(600 + i, "one", "one", f"t{i % 2}") for i in range(4)]  # a single kept term


def brute_divergence(rows, min_docs=3, top=200):
    groups, df = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups[lang or "", source or ""].update(terms)
        df[lang or ""].update(set(terms))
    out = Counter()
    for lang in {k for k, _ in groups}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        counts = {s: Counter({t: c[t] for t in kept if c[t]}) for (k, s), c in groups.items() if k == lang}
        whole = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def f(a, b):
            return (a - b) * (a - b) // b

        for s, c in counts.items():
            pairs = sorted((-sum(f(p(c, t), p(d, t)) for t in kept), o.encode()) for o, d in counts.items() if o != s)
            terms = sorted((-f(p(c, t), p(whole, t)), t.encode()) for t in c if p(c, t) > p(whole, t))[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (v, item) in enumerate(found, 1):
                    out[(lang, s, part, item.decode(), -v, rank)] += 1
    return out


@pytest.mark.parametrize("how", [{}, {"postings": 3, "top": 2}, {"min_docs": 1}])
def test_divergence_equals_brute_force(spark, how, monkeypatch):
    if how.get("postings"):
        monkeypatch.setattr(divergence, "CELLS", 7)
        monkeypatch.setattr(divergence, "STEP", 4)
    df = clashing(spark.createDataFrame(DOCS, "doc_id bigint, text string, lang string, source string")).repartition(3)
    got = Counter(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(df, **how).collect())
    assert got == brute_divergence(DOCS, how.get("min_docs", 3), how.get("top", 200))


def test_divergence_of_one_source_without_terms_and_of_none(spark):
    schema = "doc_id bigint, text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([(1, None, None, None)], schema)).collect() == []
    assert divergence.audit(spark.createDataFrame([], schema)).collect() == []


def test_accumulated_rows_equal_the_dense_sum():
    rng = np.random.default_rng(5)
    n_peers, n_terms = 7, 40
    zero = rng.integers(1, 50, n_peers)
    dense = np.where(rng.random((n_peers, n_terms)) < 0.4, rng.integers(1, 10**9, (n_peers, n_terms)), zero[:, None])
    held = dense != zero[:, None]
    held[:, held.sum(axis=0) == 0] = [[True]] + [[False]] * (n_peers - 1)
    peer, term = np.nonzero(held)
    for i, acc in divergence.accumulate(term, peer, dense[peer, term], zero, np.arange(n_peers)):
        want = [int(divergence.divergence(dense[i], dense[j]).sum()) for j in range(n_peers)]
        assert acc.tolist() == want


def test_shares_are_exact_for_large_counts(spark):
    n = 12_345_678_901_234
    r = spark.range(1).select(divergence.share(F.lit(n), F.lit(3 * n), F.lit(77)).alias("p")).first()
    assert r["p"] == 1 + 10**9 * (n + 1) // (3 * n + 77)

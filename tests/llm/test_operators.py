"""Edge cases of every operator against brute force: NULLs, empty and very
long texts, ties, repeated rows, empty tables, clashing column names."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txguard.llm import bloomlm, decontaminate, language, mixing, quality, rules, simhash, tokenfiles, toxicity, urls

PROSE = ("the river ran past the old mill and the miller counted his sacks of grain while the wheel "
         "turned slowly under a grey sky that promised rain before the evening bells rang out again over town")
CLASHING = ["fp", "size", "id", "score", "label", "bin", "h", "word", "words", "key", "row", "chunk", "n", "range",
            "component_id", "taken", "host", "failed", "start", "stretch", "copies", "rest", "c", "a", "b", "p", "z"]
LONG = " ".join(f"w{i % 977} {PROSE.split()[i % 30]}" for i in range(40_000))

ROWS = [
    (1, PROSE, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n\x0b ", "en", "b"),
    (5, LONG, "en", "b"),
    (6, PROSE, "en", "a"),                       # exact copy
    (7, PROSE.upper(), "en", ""),
    (8, "one two three", "en", "c"),
    (8, "one two three", "en", "c"),             # repeated row
    (None, "a text that nobody numbered and that stands alone here", "en", "c"),
    (9, "été à l'ÉCOLE — naïve café 東京 words\nété à l'ÉCOLE — naïve café 東京 words\n", "fr", "c"),
    (10, "so it goes so it goes so it goes, so it goes", "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def ascii_lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def ws_words(t: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING]).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# ---- 1 token files -------------------------------------------------------

def test_token_files_round_trip(spark, docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenfiles.vocabulary_path())
    got = sorted(tokenfiles.read_documents(spark, tokenfiles.write(docs, length=16, rows=4)).collect(),
                 key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["start"]))
    at = 0
    for r, (i, t, *_) in zip(got, sorted(ROWS, key=lambda x: (x[0] is not None, x[0] or 0)), strict=True):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert tokenfiles.read_documents(spark, tokenfiles.write(none)).collect() == []


def test_token_files_give_sequences_by_random_access(spark, docs):
    folder = tokenfiles.write(docs.filter("doc_id = 5").coalesce(1), length=64, rows=8)
    shard = spark.read.parquet(f"{folder}/shards").first()
    encoder = tokenfiles.Encoder(tokenfiles.vocabulary_path())
    want, _ = encoder.texts(pa.array([LONG]), 2)
    for k in (0, 7, 8, 100):
        ids, mask = tokenfiles.sequence(folder, shard["shard"], k, rows=8)
        assert ids.tolist() == want[64 * k:64 * k + 64].tolist() and all(mask.to_pylist())
    ids, mask = tokenfiles.sequence(folder, shard["shard"], shard["n_tokens"] // 64, rows=8)
    assert sum(mask.to_pylist()) == shard["n_tokens"] % 64


def test_encoder_equals_the_library_on_odd_texts():
    from tokenizers import Tokenizer

    path = tokenfiles.vocabulary_path()
    tok, enc = Tokenizer.from_file(path), tokenfiles.Encoder(path)
    texts = ["don't we'll I'M x's", "<|endoftext|> a<|startoftext|>b", "a\u00a0b\u2003c", "İstanbul ǅ ß µ ²³ ½", "e\u0301 é", "\x1c\x1f a\x85b", "", "!!??.. 12 3.4", "東京タワー", "﷽ ﬁ"]
    ids, counts = enc.texts(pa.array(texts), 2)
    assert ids.tolist() == [x for t in texts for x in [*tok.encode(t, add_special_tokens=False).ids, 2]]
    assert counts.sum() == len(ids)


def test_tokenizer_of_this_kind_with_another_pattern_or_token(tmp_path):
    import json

    from tokenizers import Tokenizer

    spec = json.loads(open(tokenfiles.vocabulary_path()).read())
    assert tokenfiles.Encoder(tokenfiles.vocabulary_path()).plain
    other = json.loads(json.dumps(spec))
    other["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+"
    added = json.loads(json.dumps(spec))
    added["added_tokens"] += [{**spec["added_tokens"][0], "id": 49408, "content": "[sep]"}]
    texts = ["area51 in 1998 b2b", "", "don't stop! it's 3.14", "a[sep]b [sep] C3PO", "été 99 bottles"]
    for k, changed in enumerate((other, added)):
        path = str(tmp_path / f"{k}.json")
        with open(path, "w") as f:
            json.dump(changed, f)
        enc, tok = tokenfiles.Encoder(path), Tokenizer.from_file(path)
        assert not enc.plain
        ids, _ = enc.texts(pa.array(texts), 2)
        assert ids.tolist() == [x for t in texts for x in [*tok.encode(t, add_special_tokens=False).ids, 2]]


def test_tokenizer_of_another_kind_encodes_whole_texts():
    from tokenizers import Tokenizer

    path = tokenfiles.vocabulary_path("byte_bpe_50k.json")
    enc = tokenfiles.Encoder(path)
    assert enc.split is None
    texts = ["two  spaces here", "", "né\n"]
    ids, _ = enc.texts(pa.array(texts), 2)
    tok = Tokenizer.from_file(path)
    assert ids.tolist() == [x for t in texts for x in [*tok.encode(t, add_special_tokens=False).ids, 2]]


# ---- 2 url templates -----------------------------------------------------

URLS = [
    (1, "http://WWW.Example.com/en/5?x=1"), (2, "http://example.com/en/5"), (3, "https://a.net/es/12#t"), (4, None),
    (5, "no scheme/at all"), (6, "x://"), (7, "http://com"), (8, "http://notnet/es/"), (9, "http://net/fr/a/b/c"),
    (10, "http://h.org/p?u=http://net/es/"), (10, "http://h.org/p?u=http://net/es/"), (None, "http://a.net/es/x" + "/y" * 3000),
    (11, "http://ÀB.Example.COM/En/"), (12, ""),
]


def judged(u):
    rest = u.split("://", 1)[1] if u and "://" in u else ""
    raw = re.match(r"[^/?#]*", rest).group()
    host, path = ascii_lower(raw), re.match(r"[^?#]*", rest[len(raw):]).group()
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_url_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string").withColumn("host", F.lit("clash")).withColumn("template", F.lit(1))
    got = by_row(urls.judge(pages), "page_id", "host", "path", "rule", "verdict")
    assert got == Counter((i, *judged(u)[:3], judged(u)[3] or "allow") for i, u in URLS)
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_templates_generalise_merge_and_reject(spark):
    rows = [(f"/go/w{i}/x", "block") for i in range(90)] + [(f"/go/q{i}z/x", None) for i in range(30)]      # variable: one template
    rows += [(f"/a/{i}", "allow") for i in range(100)] + [(f"/b/{i}", "allow") for i in range(50)] + [(f"/c/{i}", "block") for i in range(40)] + [("/d/7", None)]
    df = spark.createDataFrame([("s.org", p, v) for p, v in rows], "host string, path string, rule_verdict string")
    out = urls.templates(df.withColumn("shape", urls.shape(F.col("path"))))
    found = {(r["template"], r["branch"], r["template_verdict"]) for r in out.collect()}
    assert {t for t, _, _ in found if t.startswith("/go")} <= {"/go/w<n>/x", "/go/q<n>z/x"}
    assert ("/c/<n>", "over", "block") in found and ("/d/<n>", "like", "allow") in found
    assert {b for t, b, _ in found if t in ("/a/<n>", "/b/<n>")} == {"under"}
    names = [("s.org", "/u/" + "".join(chr(97 + (i // 26 ** k) % 26) for k in range(3)), "block" if i < 60 else None) for i in range(100)]
    out = urls.templates(spark.createDataFrame(names, "host string, shape string, rule_verdict string")).collect()
    assert {(r["template"], r["template_verdict"]) for r in out} == {("/u/<*>", "block")}


def test_variable_segments_are_pooled_level_by_level(spark):
    word = lambda i: "".join(chr(97 + (i // 26 ** k) % 26) for k in range(3))
    rows = [("s.org", f"/user/{word(u)}/post/{word(1000 + 12 * u + p)}", None) for u in range(40) for p in range(12)]
    # a deep path, and one that stops above the others
    rows += [("s.org", "/" + "/".join(["x"] * 40), None), ("s.org", "/user", None), ("t.org", "", None)]
    out = urls.templates(spark.createDataFrame(rows, "host string, shape string, rule_verdict string").repartition(3))
    found = Counter(r["template"] for r in out.collect())
    assert found == {"/user/<*>/post/<*>": 480, "/user": 1, "": 1, "/" + "/".join(["x"] * 15) + "/<...>": 1}
    # thirty sections of many pages each are sections, not names
    sections = [("s.org", f"/{word(k)}/p", None) for k in range(30) for _ in range(200)] + [("s.org", f"/{word(1000 + k)}/p", None) for k in range(5)]
    out = urls.templates(spark.createDataFrame(sections, "host string, shape string, rule_verdict string"))
    assert {r["template"] for r in out.collect()} == {f"/{word(k)}/p" for k in range(30)} | {"/<*>/p"}


def test_pages_without_a_rule_are_blocked_by_the_evidence_of_their_branch(spark):
    rows = [(i, f"http://m.example.net/{lang}/{i}") for i, lang in enumerate(["es", "fr"] * 10)] + [(100, "http://m.example.net/de/7"), (101, "http://m.example.net/about"),
            (102, "http://other.org/de/7")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert got[0] == ("net/es/", "block") and got[100] == (None, "block") and got[101] == (None, "allow") and got[102] == (None, "allow")


# ---- 3 SimHash -----------------------------------------------------------

def brute_fingerprint(t, shingle=4):
    import xxhash

    w = ws_words(ascii_lower(t or ""))
    grams = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(pairs, radius):
    label = {i: i for i, _ in pairs}
    for _ in pairs:
        for i, x in pairs:
            for j, y in pairs:
                if (x ^ y).bit_count() <= radius:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_simhash_equals_brute_force(docs, none):
    small = docs.filter("doc_id <> 5 OR doc_id IS NULL")
    rows = [(i, t) for i, t, *_ in ROWS if i != 5]
    prints = {i: brute_fingerprint(t) for i, t in rows}
    label = brute_components([(i, x) for i, x in prints.items() if i is not None], 4)
    label[None] = None
    got = by_row(simhash.near_duplicates(small), "doc_id", "fingerprint", "component_id")
    assert got == Counter((i, f"{prints[i]:016x}", label[i]) for i, _ in rows)
    kept = simhash.keep_one(small).select("doc_id").collect()
    assert sorted(r[0] or 0 for r in kept) == sorted({v or 0 for v in label.values()})
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    assert simhash.near_duplicates(docs.filter("doc_id = 5")).first()["fingerprint"] == f"{brute_fingerprint(LONG):016x}"


@pytest.mark.parametrize("small_shard", [256, 20])
def test_links_join_dense_balls_and_chains(spark, small_shard):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    ball = {centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(300)}
    chain, x = [], int(rng.integers(1 << 62))
    for k in range(15):
        x ^= sum(1 << (4 * k + b) for b in range(4))
        chain.append(x)
    far = [int(v) for v in rng.integers(0, 1 << 62, 300)]
    values = sorted({*ball, *chain, *far})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), 4, small_shard=small_shard)
    assert edges.count() <= 60 * len(values)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    parent = {v: v for v in signed}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, v in enumerate(values):
        for j in range(i):
            if (v ^ values[j]).bit_count() <= 4:
                a, b = sorted((root(signed[i]), root(signed[j])))
                parent[b] = a
    assert {v: roots.get(v, v) for v in signed} == {v: root(v) for v in signed}


def test_rows_that_share_an_id_are_kept_by_their_components(spark):
    a, b, c = PROSE, "an entirely different text about ships and harbours and the long way home", "numbers one two three four five six seven eight nine"
    kept = lambda rows: sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert kept([(1, a), (5, a), (5, b), (6, c)]) == [(1, a), (5, b), (6, c)]
    assert kept([(5, a), (5, a), (5, b), (5, b), (5, b)]) == sorted([(5, a), (5, b)])
    clash = spark.createDataFrame([(1, a, 0, 0, 0), (2, a, 0, 0, 0), (None, b, 0, 0, 0), (None, b, 1, 0, 0)], "doc_id bigint, text string, __key int, Key int, __keep int")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in simhash.keep_one(clash).collect()) == [(0, b), (1, a)]
    assert decontaminate.remove(clash, spark.createDataFrame([(1, b)], "item_id int, text string")).count() == 2


def test_bk_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(5)
    values = np.unique(rng.integers(0, 1 << 12, 400).astype(np.uint64))
    tree = simhash.BKTree(values)
    got = {(int(q), int(n)) for qs, ns in tree.search(values, 2) for q, n in zip(qs, ns, strict=True)}
    want = {(i, j) for i, x in enumerate(values) for j, y in enumerate(values) if int(x ^ y).bit_count() <= 2}
    assert got == want


# ---- 4 decontamination ---------------------------------------------------

def item_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


def brute_contamination(text, items, window=10):
    w, hit, names = item_words(text), set(), set()
    for name, t in items:
        q = item_words(t)
        size = min(window, len(q))
        for k in range(len(q) - size + 1) if q else ():
            for i in range(len(w) - size + 1):
                if w[i:i + size] == q[k:k + size]:
                    hit |= set(range(i, i + size))
                    names.add("" if name is None else str(name))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


ITEMS = [(1, PROSE), (2, "one, TWO three"), (2, "naïve café"), (3, None), (4, " ..."), (10, "it goes so"), (None, "nobody numbered"),
         (12, " ".join(PROSE.split()[20:]) + " and then some more words that are elsewhere")]


@pytest.mark.parametrize("block_words", [2_000_000, 20])
def test_contamination_equals_brute_force(spark, docs, none, block_words):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("block", F.lit("clash"))
    small = docs.filter("doc_id <> 5 OR doc_id IS NULL")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    found = decontaminate.contamination(small, items, block_words=block_words)
    assert by_row(found, *columns) == Counter((i, *brute_contamination(t, ITEMS)) for i, t, *_ in ROWS if i != 5)
    kept = by_row(decontaminate.remove(small, items, block_words=block_words), "doc_id")
    assert kept == Counter((i,) for i, t, *_ in ROWS if i != 5 and not brute_contamination(t, ITEMS)[4])
    assert decontaminate.contamination(none, items).count() == 0
    assert not decontaminate.contamination(docs, items.limit(0)).filter("contaminated").count()


def test_longest_verbatim_match(spark):
    w = [f"x{i}" for i in range(60)]
    d = spark.createDataFrame([(1, " ".join(["pad"] * 3 + w[5:40] + ["pad"] + w[45:57]))], "doc_id bigint, text string")
    b = spark.createDataFrame([("i", " ".join(w))], "item_id string, text string")
    r = decontaminate.contamination(d, b).first()
    assert [m.asDict() for m in r["matches"]] == [{"item": "i", "length": 35, "start": 3}] and r["n_hit"] == 47


def test_matches_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(9)
    monkeypatch.setattr(decontaminate, "PAIRS", 50)
    for n in range(30):
        words = lambda k, v: " ".join(f"w{x}" for x in rng.integers(0, v, k))
        v = int(rng.integers(1, 4))
        items = [(str(i % 4), words(int(rng.integers(1, 30)), v)) for i in range(6)]
        texts = [words(int(rng.integers(0, 60)), v) for _ in range(3)]
        bench = decontaminate.Benchmark([(i, t.encode().split()) for i, t in items], 5)
        offsets, hit, (row, item, length, start) = decontaminate.scan(pa.array(texts), bench)
        got = {(int(r), bench.items[i]): (int(m), int(a)) for r, i, m, a in zip(row, item, length, start, strict=True)}
        want, hits = {}, set()
        for r, t in enumerate(texts):
            w = t.split()
            for name, q in ((i, x.split()) for i, x in items):
                size = min(5, len(q))
                for a in range(len(w)):
                    for b in range(len(q) - size + 1):
                        k = 0
                        while a + k < len(w) and b + k < len(q) and w[a + k] == q[b + k]:
                            k += 1
                        if k >= size:
                            hits |= {offsets[r] + a + j for j in range(size)}
                            want[r, name] = min(want.get((r, name), (0, 0)), (-k, a))
        assert got == {k: (-m, a) for k, (m, a) in want.items()} and set(np.flatnonzero(hit).tolist()) == hits, n


def test_one_word_over_and_over_takes_bounded_memory():
    import tracemalloc
    bench = decontaminate.Benchmark([("a", [b"so"] * 2000), ("a", [b"so"] * 2000), ("b", [b"so"])], 10)
    assert len(bench.starts) == 2
    text = pa.array([" ".join(["so"] * 20_000)])
    tracemalloc.start()
    _, hit, (row, item, length, start) = decontaminate.scan(text, bench)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hit.all() and list(zip(item.tolist(), length.tolist(), start.tolist(), strict=True)) == [(0, 2000, 0), (1, 1, 0)]
    assert peak < 400e6


# ---- 5, 6, 8 classifiers -------------------------------------------------

def labelled(spark, n=400):
    rng = np.random.default_rng(1)
    plain = [f"{a}{b}" for a in ("lo", "ma", "ki", "ter", "sun") for b in ("ren", "dal", "vo", "shi", "bak")]
    rows = []
    for i in range(n):
        w = rng.choice(plain, 40).tolist()
        toxic = i % 4 == 0
        if toxic:
            w[5] = str(rng.choice(["wretchword", "vileword", "wretchwords"]))
        if i % 8 == 0 or i % 40 == 1:  # the group is named mostly in toxic texts
            w[7] = "women"
        if i % 8 == 4 or i % 40 == 2:
            w[7] = "men" if i % 16 == 4 else "girls"
        rows.append((i, " ".join(w), int(toxic), "xx" if i % 2 else "yy"))
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int, lang string")


def test_toxicity_holds_out_and_is_fair_to_groups(spark, docs, none):
    data = labelled(spark)
    train = F.col("doc_id") % 3 != 1
    labels = data.select("doc_id", "toxic").unionByName(spark.createDataFrame([(0, None), (2, 7), (None, 1), (999, 1)], "doc_id bigint, toxic int"))
    fair = toxicity.fit(data, labels, train)
    unfair = toxicity.fit(data, labels, train, swap_penalty=0.0)
    held = toxicity.score(data.filter(~train), fair, keep=["doc_id", "toxic"]).collect()
    assert np.mean([(r["score"] >= 0.7) == (r["toxic"] == 1) for r in held]) > 0.95

    def gap(model):
        w = [model["weights"].get(b"=" + t, 0.0) for t in (b"women", b"men", b"girls")]
        return max(w) - min(w)

    assert gap(fair) < 0.2 * gap(unfair)
    out = toxicity.score(docs, fair, keep=["doc_id"]).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.keep_clean(docs, fair).count() == len(ROWS) and toxicity.keep_clean(docs, fair).columns == docs.columns
    assert toxicity.score(none, fair).count() == 0
    nothing = toxicity.fit(data, labels.limit(0), train)
    assert {r["score"] for r in toxicity.score(docs, nothing, keep=["doc_id"]).collect()} == {0.0}


def test_a_group_named_in_toxic_texts_does_not_make_a_neutral_one_toxic(spark):
    rng = np.random.default_rng(3)
    fill = [f"v{k}" for k in range(60)]
    rows = []
    for i in range(900):
        toxic = i % 3 == 0
        group = "women" if toxic and i % 10 else ("men", "girls", "women")[i % 3] if i % 2 else "boys"
        rows.append((i, " ".join([*rng.choice(fill, 8), *(["vile"] if toxic and i % 4 else []), group]), int(toxic)))
    data = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    neutral = spark.createDataFrame([(t, f"v1 v2 v3 {t} v4 v5") for t in ("women", "men", "girls", "boys")], "term string, text string")

    def gap(penalty):
        model = toxicity.fit(data, data.select("doc_id", "toxic"), F.lit(True), swap_penalty=penalty)
        p = np.array([r["score"] for r in toxicity.score(neutral, model).collect()])
        return float(np.ptp(np.log(p / (1 - p)))), p.max()

    (fair, most), (unfair, _) = gap(toxicity.SWAP_PENALTY), gap(0.0)
    assert fair < 0.25 * unfair and most < toxicity.THRESHOLD


def test_language_models(spark, docs, none):
    en = [(i, f"{PROSE} number {w}", "en") for i, w in enumerate(PROSE.split())]
    fr = [(100 + i, f"le vieux moulin au bord de la rivière tournait lentement quand {w} arriva", "fr") for i, w in enumerate("maman papa michel jeanne pierre lucie".split())]
    data = spark.createDataFrame([*en, *fr, (500, "nothing", None), (501, None, "en")], "doc_id bigint, text string, lang string")
    model, limits = language.fit(data, F.lit(True))
    assert model["langs"] == ["en", "fr"] and set(limits) == {"en", "fr"}
    probe = spark.createDataFrame([(1, PROSE), (2, "la rivière tournait"), (3, "123 --- \n"), (4, None), (5, ""), (6, "zzqx kjwq xqzz")], "id bigint, text string")
    got = {r["id"]: r for r in language.identify(probe, model, keep=["id"], limits=limits).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5)] == ["en", "fr", "und", "und", "und"]
    assert got[6]["rejected"] and not got[1]["rejected"] and got[4]["score"] == 0 and got[1]["score"] > 0.5
    assert language.identify(docs, model, keep=["doc_id"]).count() == len(ROWS)
    assert language.identify(none, model).count() == 0
    empty, _ = language.fit(none, F.lit(True))
    assert {r["lang_pred"] for r in language.identify(docs, empty, keep=["doc_id"]).collect()} == {"und"}


def test_kneser_ney_probabilities_sum_to_one():
    grams = Counter(g for w in ("banana", "bandana", "cabana") for w in ["\x02\x02" + w + "\x03"] for g in (w[i:i + 3] for i in range(len(w) - 2)))
    model = language.tables({"x": dict(grams)}, 3)
    letters = sorted({g[-1] for g in grams})
    start = 2 ** -language.word_costs(["ban"], model)[0]
    assert 0 < start < 1
    probs, weights, uniform = language.kneser_ney(dict(grams), 3)
    for h in ("an", "\x02\x02", "zz"):
        total = 0.0
        for c in [*letters, "?"]:  # "?" stands for any letter unseen
            p = uniform
            for k in range(3):
                g = (h + c)[2 - k:]
                p = probs[k].get(g, 0.0) + weights[k].get(g[:-1], 1.0) * p
            total += p
        assert abs(total - 1) < 1e-9


def test_quality_discriminant(spark, docs, none):
    rng = np.random.default_rng(2)
    words = PROSE.split()
    rows = []
    for i in range(300):
        w = rng.choice(words, 60).tolist()
        if i % 3 == 0:
            w = [x + "***" for x in w] if i % 2 else w[:4] * 15
        rows.append((i, " ".join(w), int(i % 3 != 0)))
    data = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    stats = quality.statistics(data)
    model = quality.fit(stats, data.select("doc_id", "quality"), F.col("doc_id") % 5 != 0)
    scored = quality.score(stats.filter("doc_id % 5 = 0"), model).join(data, "doc_id").collect()
    assert np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in scored]) > 0.95
    out = quality.score(quality.statistics(docs), model).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)
    assert quality.score(quality.statistics(none), model).count() == 0
    for only, want in ((1, 1.0), (0, 0.0)):
        one = quality.fit(stats, data.filter(F.col("quality") == only).select("doc_id", "quality"), F.lit(True))
        assert {r["score"] for r in quality.score(stats, one).collect()} == {want}
    same = quality.fit(quality.statistics(data.withColumn("text", F.lit("x"))), data.select("doc_id", "quality"), F.lit(True))
    assert set(same["chol"]) == {0, 1}  # no spread at all is no obstacle


def test_log_density_equals_the_formula():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(3, 3))
    cov, mean, x = a @ a.T + np.eye(3), rng.normal(size=3), rng.normal(size=(5, 3))
    want = [-0.5 * (v - mean) @ np.linalg.inv(cov) @ (v - mean) - 0.5 * np.log(np.linalg.det(cov)) for v in x]
    assert np.allclose(quality.log_density(x, mean, np.linalg.cholesky(cov)), want)


# ---- 7 language-model scores ---------------------------------------------

def test_bloom_lm_equals_exact_counts(docs, none):
    tokens = [(i, [w.lower() if w.isascii() else ascii_lower(w) for w in ws_words(t)]) for i, t, *_ in ROWS]
    learn = [i != 8 for i, _ in tokens]
    c = Counter(w for (_, ws), ok in zip(tokens, learn, strict=True) if ok for w in [*ws, " "])
    n, v = sum(c.values()), len(c)
    out = bloomlm.score(docs, F.coalesce(F.col("doc_id") != 8, F.lit(True)), chunk_bytes=100_000)
    got = sorted(out.collect(), key=lambda r: (r["doc_id"] or 0, r["n_tokens"]))
    for r, (i, ws) in zip(got, sorted(tokens, key=lambda x: (x[0] or 0, len(x[1]))), strict=True):
        ws = [*ws, " "]
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r["base_score"] - sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) < 1e-6 * max(1, len(ws))
        assert r["score"] < 0
    assert bloomlm.score(none, F.lit(True)).count() == 0
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in bloomlm.score(docs, F.lit(False)).collect())


def bigrams_of(pairs):
    one, two = (bloomlm.word_hashes(pa.array([p[k] for p in pairs])) for k in (0, 1))
    return bloomlm.bigram(one, two)


def test_filter_keeps_levels(spark):
    pairs = [(f"a{i}", f"b{i}") for i in range(200)]
    text = " ".join(f"{a} {b}" for i, (a, b) in enumerate(pairs) for _ in range(1 + i))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    ranges = bloomlm.summed_ranges(bloomlm.ngram_ranges(docs, "text", 4)).persist()
    flt = bloomlm.build_filter(ranges, 4)
    got, want = bloomlm.probe(flt, bigrams_of(pairs)), bloomlm.level(np.arange(1, 201))
    assert (got >= want).all() and np.mean(got == want) > 0.98
    assert np.mean(bloomlm.probe(flt, bigrams_of([(f"no{i}", f"b{i}") for i in range(2000)])) > 0) < 0.02
    # the words are exact
    counts = {w: n for r in ranges.collect() for w, n in zip(r["words"], np.frombuffer(r["times"], np.int64).tolist(), strict=True)}
    assert counts == {w: 1 + i for i, p in enumerate(pairs) for w in p}


def test_filter_grows_and_scores_alike_by_broadcast_and_join(spark, docs, monkeypatch):
    held = spark.createDataFrame([(100, "one two four"), (101, "past the old mill zzz"), (None, PROSE)], "doc_id bigint, text string")
    data = docs.select("doc_id", "text").unionByName(held)
    train = F.coalesce(F.col("doc_id") < 100, F.lit(True))
    by = [sorted(map(tuple, bloomlm.score(data, train, broadcast_bits=b, chunk_bytes=c).collect()), key=repr) for b, c in ((1 << 40, 100_000), (0, 100_000), (0, 1 << 30))]
    assert by[0] == by[1] and len(by[0]) == len(ROWS) + 3
    assert [r[:4] for r in by[2]] == [r[:4] for r in by[0]] and all(abs(x[5] - y[5]) < 1e-6 * max(1, abs(y[5])) for x, y in zip(by[2], by[0], strict=True))
    # twice the n-grams, twice the filter
    shapes = []
    for n in (20_000, 40_000):
        text = " ".join(f"w{i} w{i}" for i in range(n))
        ranges = bloomlm.summed_ranges(bloomlm.ngram_ranges(spark.createDataFrame([(1, text), (2, text)], "doc_id bigint, text string"), "text", 4)).persist()
        shapes.append(bloomlm.filter_shape(ranges, 4)["segment"])
    assert 1.9 < shapes[1] / shapes[0] < 2.1


def test_pieces_of_a_chunk_share_their_words_in_one_order(monkeypatch):
    import importlib
    texts = ["b a c", None, "", "a d", "c c b e"]
    whole = bloomlm.Chunk(pa.array(texts, pa.string()), True)
    monkeypatch.setattr(importlib.import_module("txguard.llm.bloomlm"), "PIECE_BYTES", 4)
    cut = bloomlm.Chunk(pa.array(texts, pa.string()), True)
    assert len(cut.pieces) > 2 and set(cut.words.to_pylist()) - {""} == set("abcde")
    assert cut.pairs.tolist() == whole.pairs.tolist() and (np.diff(cut.hashes.astype(object)) > 0).all()
    for (distinct, *_), place in zip(cut.pieces, cut.place, strict=True):
        assert cut.words.take(pa.array(place)).to_pylist() == distinct.to_pylist()


def test_scores_are_those_of_discounted_bounded_bigrams(spark):
    rows = [(1, "alpha beta gamma delta"), (2, "alpha gamma beta delta"), (3, "alpha beta gamma delta"), (4, "delta gamma new"), (5, "new word")]
    out = {r["doc_id"]: r for r in bloomlm.score(spark.createDataFrame(rows, "doc_id bigint, text string"), F.col("doc_id") <= 2).collect()}
    c = Counter({"alpha": 2, "beta": 2, "gamma": 2, "delta": 2, " ": 2})
    two = Counter(p for _, t in rows[:2] for p in zip([" ", *t.split()], [*t.split(), " "], strict=True))
    n, v, d = sum(c.values()), len(c), bloomlm.DISCOUNT
    for i, t in rows[2:]:
        want = 0.0
        for p in zip([" ", *t.split()], [*t.split(), " "], strict=True):
            one = (c[p[1]] + 0.5) / (n + 0.5 * (v + 1))
            freed = d / c[p[0]] if c[p[0]] else 1.0
            want += log10(0.6 * (max(min(two[p], c[p[0]], c[p[1]]) - d, 0) / max(c[p[0]], 1) + freed * one) + 0.4 * one)
        assert abs(out[i]["score"] - want) < 1e-9


def test_a_text_learned_twice_is_likelier_than_one_learned_once(spark):
    once, twice = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    out = {r["doc_id"]: r["score"] for r in bloomlm.score(spark.createDataFrame([(1, once), (2, twice), (3, twice)], "doc_id bigint, text string"), F.lit(True)).collect()}
    assert out[2] == out[3] > out[1] + 5


def test_unknown_words_are_never_lifted_by_a_false_positive(spark):
    rows = [(1, " ".join(f"k{i}" for i in range(20_000))), (2, " ".join(f"u{i}" for i in range(20_000)))]
    out = {r["doc_id"]: r for r in bloomlm.score(spark.createDataFrame(rows, "doc_id bigint, text string"), F.col("doc_id") == 1).collect()}
    # of the second text only the end and its place after the start are known
    assert abs(out[2]["score"] - out[2]["base_score"]) < 2 and out[1]["score"] / 20_001 > -0.8 and out[2]["n_known"] == 1


def test_probabilities_of_the_words_after_one_sum_to_one_at_most(spark):
    train = [(i, f"the {w}") for i, w in enumerate("cat cat dog cow".split(), 1)]
    words = ["cat", "dog", "cow", "the", "zebra"]
    ask = [(100 + i, f"the {w}") for i, w in enumerate(words)] + [(200, "the")]
    out = {r["doc_id"]: r["score"] for r in bloomlm.score(spark.createDataFrame(train + ask, "doc_id bigint, text string"), F.col("doc_id") < 100).collect()}
    assert out[1] == out[100] and out[100] > out[101] == out[102] > out[104]


def test_rows_of_one_id_spread_over_chunks(spark):
    rows = spark.createDataFrame([(None if i % 2 else 7, f"text {i}") for i in range(400)], "doc_id bigint, text string")
    found = rows.groupBy(bloomlm.chunk_of("doc_id", "text", 10).alias("chunk")).count().collect()
    assert len(found) == 10 and max(r["count"] for r in found) < 80


def test_levels_and_their_middles():
    c = np.arange(1, 5000)
    lv = bloomlm.level(c)
    assert (np.diff(lv) >= 0).all() and lv[0] == 1 and bloomlm.quantised(np.array([0]))[0] == 0
    assert (np.abs(np.log(bloomlm.quantised(lv) / c)) < np.log(1.5) + 0.01).all()


# ---- 9 mixing ------------------------------------------------------------

def brute_targets(sizes, weights, share, cap):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > cap * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def test_mixing(spark, docs, none):
    out = mixing.repetitions(docs).collect()
    sizes = Counter()
    for _, t, _, s in ROWS:
        sizes[s] += len(ws_words(t))
    want = brute_targets(dict(sizes), mixing.WEIGHTS, mixing.SHARE, mixing.CAP)
    assert Counter((r["doc_id"], r["__mix_size"], r["__mix_source_size"]) for r in out) == Counter((i, len(ws_words(t)), sizes[s]) for i, t, _, s in ROWS)
    for r in out:
        assert abs(r["__mix_target"] - want[r["source"]]) < 1e-6
        assert r["__mix_taken"] <= 2 * r["__mix_size"] and r["__mix_taken"] == r["__mix_copies"] * r["__mix_size"]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert by_row(mixed, "doc_id") == Counter({(k,): n for k, n in Counter({i: sum(r["__mix_copies"] for r in out if r["doc_id"] == i) for i in {r[0] for r in ROWS}}).items() if n})
    assert mixing.mix(none).count() == 0


def test_mixing_lands_on_its_targets(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "w " * int(n), "hot" if i % 3 else f"s{i % 7}") for i, n in enumerate(rng.lognormal(3, 1, 3000))]
    out = mixing.repetitions(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), bin_bits=4)
    for r in out.groupBy("source").agg(F.sum("__mix_taken").alias("t"), F.first("__mix_target").alias("g"), F.max("__mix_size").alias("m")).collect():
        assert abs(r["t"] - r["g"]) <= r["m"]
    again = mixing.repetitions(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7))
    assert by_row(again, "doc_id", "__mix_taken") == by_row(out, "doc_id", "__mix_taken")


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 5, None: 70}, {"": 0, "b": 0}, {"z": 9}, {"a": 10, "b": 10, "c": 10, "d": 10}])
def test_targets_equal_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = brute_targets(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.CAP)
    assert got == pytest.approx(want)


# ---- 10 rule ledger ------------------------------------------------------

def brute_measures(t):
    t = t or ""
    w = ws_words(t)
    lines = [x for x in t.split("\n") if ws_words(x)]
    n = Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if n[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_rule_ledger_equals_brute_force(spark, docs, none):
    junk = [(20, "a b c d " * 40), (21, "### *** |||\n" * 30), (22, "x" * 5000 + " y"), (23, "- one\n- two\n* three\n"), (24, "so...\nwell...\n")]
    more = spark.createDataFrame([(i, t, "en", "j") for i, t in junk], SCHEMA)
    led = rules.ledger(docs.select("doc_id", "text", "lang", "source").unionByName(more)).persist()
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = [(i, t) for i, t, *_ in ROWS] + junk
    assert by_row(led, *columns) == Counter((i, *brute_measures(t)) for i, t in rows)
    for r in led.withColumn("base", rules.passes("base")).collect():
        assert r["base"] == (not (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]))
    assert rules.ledger(none).count() == 0
    failed = [r["failed"] for r in led.collect()]
    mask = rules.bits(rules.POLICIES["v2"])
    for r in rules.ablation(led, "v2").collect():
        bit = rules.bits([r["rule"]])
        assert (r["rejected"], r["rejected_alone"], r["kept_without"]) == (
            sum(f & bit > 0 for f in failed), sum(f & mask == bit for f in failed), sum(f & mask & ~bit == 0 for f in failed))


def test_native_operators_run_no_python(spark, docs):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string")
    for df in (urls.judge(pages), mixing.mix(docs), rules.ledger(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)

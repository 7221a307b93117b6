"""The whole pipeline over a planted table against plain Python: what each
stage must take is known by construction or computed by brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from txguard.llm import tokenfiles
from txguard.session import fresh_shared_path

CLEAN = [f"{a}{b}" for a in "river mill stone grain wheel cloud bell lamp field road hill barn".split() for b in ("", "s", "ing", "ed", "er")]
FOUL = ["scumbag", "vermin", "filthy", "worthless", "idiots", "despise"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def planted():
    rng = np.random.default_rng(11)
    prose = lambda n: " ".join(rng.choice(CLEAN, n))
    docs, labels, toxic, i = [], [], set(), 0

    def add(text, source="a", label=None):
        nonlocal i
        i += 1
        docs.append((i, text, "en", source, len(text or "")))
        if label is not None:
            labels.append((i, 1, label))
        return i

    for k in range(360):
        bad = k % 3 == 0
        text = prose(40)
        if bad:
            at = text.split()
            for j in range(0, 40, 4):
                at[j] = FOUL[int(rng.integers(len(FOUL)))]
            text = " ".join(at)
        n = add(text, "abc"[k % 3 if not bad else k % 2], int(bad) if k % 2 else None)
        if bad:
            toxic.add(n)
    items = [(str(k), prose(14)) for k in range(4)]
    base = prose(60)
    for k in range(5):                                     # exact copies
        add(base, "b")
    for k, (_, passage) in enumerate(items):               # benchmark passages inside clean documents
        add(f"{prose(30)} {passage} {prose(10)}", "c")
    add(f"{prose(20)} {' '.join(items[0][1].split()[:9])}", "c")       # nine words are no window
    add(None, None)
    add("", "a")
    add(" \n", "a")
    docs.append((5, prose(50), "en", "a", 1))              # an id twice, another text
    docs.append(docs[100])                                 # a row twice
    return docs, labels, items, toxic


def fingerprint(t):
    w = words_of(lower(t))
    grams = [" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_dedup(rows):
    rows = list(dict.fromkeys(rows))                       # rows equal in id and text
    fps = [fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if (fps[x] ^ fps[y]).bit_count() <= 4:
                root[max(find(x), find(y))] = min(find(x), find(y))
    groups = defaultdict(list)
    for x, r in enumerate(rows):
        groups[find(x)].append(r)
    return [min(g, key=lambda r: r[0]) for g in groups.values()], max(Counter(len(g) for g in groups.values()))


def contaminated(text, items):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return any(w[k:k + 10] == q[j:j + 10] for _, t in items for q in [t.split()] for k in range(len(w) - 9) for j in range(len(q) - 9))


def mixed(rows):
    """Copies by the targets: levels filled by hand, words laid on the ruler in hash order."""
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(len(words_of(r[1])) for r in rows if r[3] == s) for s in sources}
    weight = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(sources)}
    target, open_ = {}, list(sources)
    left = 1.5 * sum(size.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 2 * size[s]]
        for s in full or open_:
            target[s] = 2.0 * size[s] if full else level * weight[s]
            left -= target[s]
        open_ = [s for s in open_ if s not in target]
    out = []
    for s in sources:
        rate = target[s] / size[s] if size[s] else 0.0
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (int(hashlib.md5(f"0:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:15], 16), r[0], len(words_of(r[1]))))
        ahead = 0
        for r in own:
            n = len(words_of(r[1]))
            out += [r] * (int(rate) + (ahead + n / 2 < (rate - int(rate)) * size[s]))
            ahead += n
    return out


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels, items, toxic = planted()
    folder = fresh_shared_path(spark, "pipeline-test")
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, items, toxic


def test_run_equals_brute_force(spark, tables):
    from tokenizers import Tokenizer

    folder, docs, items, toxic = tables
    rows = [r for r in docs if r[0] not in toxic]
    rows, largest = near_dedup(rows)
    assert largest >= 5 and len(rows) < len(docs) - len(toxic) - 4
    n = len(rows)
    rows = [r for r in rows if not contaminated(r[1], items)]
    assert len(rows) == n - len(items)
    rows = mixed(rows)
    tok = Tokenizer.from_file(tokenfiles.vocabulary_path())
    want = Counter()
    for i, text, *_ in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want and len(want) > 100
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]


def test_stages_of_clashing_columns_and_empty_rows(spark, tables):
    from pyspark.sql import functions as F

    folder, docs, items, toxic = tables
    df = spark.read.parquet(f"{folder}/documents.parquet").withColumns(
        {c: F.lit(None).cast("string") for c in ("key", "row", "rank", "same_id", "fp", "component_id", "size", "score", "word", "__key", "__keep")})
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, df, folder)
        assert out.columns == df.columns, name
        df = out.persist()
    assert df.count() > 100

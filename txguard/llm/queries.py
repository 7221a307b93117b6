"""Queries of the training-data operators: one per operator, with the DuckDB
statement of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.llm import (
    bloomlm, decontaminate, divergence, language, mixing, quality, rules, simhash, tokenfiles, toxicity, urls, vectorcodes,
    warc,
)
from txguard.llm.common import fold, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.read_documents(spark, tokenfiles.write(table(spark, sf_dir, "documents")))


def _url_levels() -> str:
    """The tree of op2's statement, level by level."""
    return ",\n".join(
        f"""c{d} AS (SELECT host, template, segs[{d + 1}] AS seg, sum(n) AS support, count(*) OVER (PARTITION BY host, template) AS n_children,
 sum(sum(n)) OVER (PARTITION BY host, template) AS pages FROM l{d} WHERE len(segs) > {d} GROUP BY host, template, segs[{d + 1}]),
l{d + 1} AS (SELECT l.* REPLACE (CASE WHEN len(segs) > {d} THEN l.template || '{"/" if d else ""}' || CASE WHEN n_children > 16 AND (support < 8
 OR n_children * n_children > pages AND support * 16 < pages) THEN '<*>' ELSE seg END
 ELSE l.template END AS template) FROM l{d} l LEFT JOIN c{d} c ON l.host = c.host AND l.template = c.template AND l.segs[{d + 1}] = c.seg)"""
        for d in range(urls.LEVELS))


@register("op2_url_templates", r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
w AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
             regexp_replace(regexp_replace(path, '/[0-9a-fA-F]{16,}', '/<h>', 'g'), '[0-9]+', '<n>', 'g') AS shape FROM v),
k(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                            ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
d AS (SELECT DISTINCT host, path FROM w),
f AS (SELECT d.host, d.path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS rule_verdict
      FROM d JOIN k ON (d.host = h OR ends_with(d.host, '.' || h)) AND starts_with(d.path, p) GROUP BY ALL),
r AS (SELECT w.*, rule, rule_verdict FROM w LEFT JOIN f USING (host, path)),
l0 AS (SELECT host, shape, count(*) AS n, count(rule_verdict) AS labelled, count(*) FILTER (rule_verdict = 'block') AS blocked,
              string_split(shape, '/') AS segs, '' AS template FROM r GROUP BY host, shape),
""" + _url_levels() + r""",
t AS (SELECT host, shape, labelled, blocked, template || CASE WHEN len(segs) > LEVELS THEN '/<...>' ELSE '' END AS template FROM lLEVELS),
s AS (SELECT *, array_to_string(list_transform(string_split(template, '/'), lambda x: CASE WHEN contains(x, '<') OR x = '' THEN x ELSE '<w>' END), '/') AS skeleton FROM t),
b AS (SELECT host, skeleton, template, sum(labelled) AS labelled, sum(blocked) AS blocked,
             sum(sum(blocked)) OVER (PARTITION BY host, skeleton) / nullif(sum(sum(labelled)) OVER (PARTITION BY host, skeleton), 0)::DOUBLE AS p
      FROM s GROUP BY host, skeleton, template),
z AS (SELECT *, CASE WHEN labelled * p * (1 - p) > 0 THEN (blocked - labelled * p) / sqrt(labelled * p * (1 - p)) ELSE 0 END AS z FROM b),
e AS (SELECT *, CASE WHEN z > 2 THEN 'over' WHEN z < -2 THEN 'under' ELSE 'like' END AS branch FROM z),
m AS (SELECT host, template, (sum(blocked) OVER q + 1) / (sum(labelled) OVER q + 3)::DOUBLE AS purity FROM e
      WINDOW q AS (PARTITION BY host, skeleton, branch))
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN purity > 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template, purity
FROM r JOIN t USING (host, shape) JOIN m USING (host, template)
""".replace("LEVELS", str(urls.LEVELS)))
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@register("op3_simhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@register("op4_benchmark_contamination", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS win
      FROM (SELECT *, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
g AS (SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS win
      FROM (SELECT doc_id, ws, s.size, unnest(range(1, len(ws) - s.size + 2)) AS i FROM d, (SELECT DISTINCT size FROM w) s WHERE len(ws) >= s.size)),
h AS (SELECT doc_id, i, size, item FROM g JOIN w USING (size, win)),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("matches")


@register("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model, limits = language.fit(docs, ~held)
    return language.identify(docs, model, keep=["doc_id"], limits=limits).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


@register("op7_bloom_lm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), F.coalesce(fold("doc_id", 5) == 1, F.lit(False))
    return bloomlm.score(docs, ~held).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op8_quality_qda")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    stats = stored(quality.statistics(table(spark, sf_dir, "documents")))
    model = quality.fit(stats, table(spark, sf_dir, "labels"), ~held)
    return quality.score(stats, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@register("op9_mix_to_weights", r"""
WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM s),
w AS (SELECT *, CASE rnk % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
             2.0::DOUBLE * source_size AS most FROM r),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                 - coalesce(sum(most) OVER (ORDER BY most / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY most / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM w),
t AS (SELECT source, source_size,
             least(most, coalesce((SELECT lv FROM l WHERE lv * weight <= most ORDER BY most / weight, rnk LIMIT 1) * weight, most)) AS target
      FROM l),
u AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2.0::DOUBLE AS middle
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN middle < (rate - floor(rate)) * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM u
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.measured(table(spark, sf_dir, "documents"))
    return mixing.repetitions(docs, size=F.col("size"), tie=F.col("tie")).select(
        "doc_id", F.col("__mix_size").alias("size"), F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"), F.col("__mix_taken").alias("taken"))


@register("op10_rule_ledger", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
t AS (SELECT doc_id, i, word, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3 FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, w2, w3) AS n FROM t WHERE w3 IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM c, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY doc_id),
m AS (SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet,
             len(list_filter(lines, lambda x: regexp_matches(x, '\.\.\.[\x20\x09-\x0D]*$'))) AS n_ellipsis,
             coalesce(list_max(list_transform(words, lambda x: length(x))), 0) AS longest
      FROM d LEFT JOIN r ON d.doc_id = r.doc_id),
b AS (SELECT *, n_words < 50 AS f0, 100 * n_repeat_words > 50 * n_words AS f1, 10 * n_symbols > 4 * n_words AS f2,
             100 * n_dup_lines > 60 * n_lines AS f3, word_chars < 2 * n_words AS f4, word_chars > 25 * n_words AS f5,
             100 * n_bullet > 90 * n_lines AS f6, 100 * n_ellipsis > 30 * n_lines AS f7, longest > 1000 AS f8 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f0 OR f1) AS base_failed,
       NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7 OR f8) AS kept,
       (f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT
        + 64 * f6::INT + 128 * f7::INT + 256 * f8::INT)::BIGINT AS failed
FROM b
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = rules.ledger(table(spark, sf_dir, "documents"))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~rules.passes("base")).alias("base_failed"), rules.passes().alias("kept"), "failed")


def _code_rounds() -> str:
    """Statement of the vector codes: the six rounds one after another."""
    parts, width = range(1, 9), "(len(v) // 8)"
    cut = " UNION ALL ".join(f"SELECT id, {p} AS part, v[({p} - 1) * {width} + 1:{p} * {width}] AS x FROM v" for p in parts)
    near = """n{r} AS MATERIALIZED (SELECT k, x, part, min((d, entry)) AS best FROM (
      SELECT k, x, c.part, c.entry, list_sum(list_transform(list_zip(x, c.y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
      FROM s JOIN b{r} c USING (part)) GROUP BY k, x, part)"""
    means = """b{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.y, b.y) AS y FROM b{r} b LEFT JOIN (
      SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY i) AS y FROM (
        SELECT part, best[2] AS entry, i, sum(x[i])::BIGINT AS total, count(*) AS n
        FROM n{r}, (SELECT unnest(range(1, (SELECT any_value(len(x)) FROM s) + 1)) AS i) GROUP BY ALL) GROUP BY part, entry) m USING (part, entry))"""
    steps = ",\n".join(near.format(r=r) + ("" if r == 6 else ",\n" + means.format(r=r, n=r + 1)) for r in range(7))
    return f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label,
                  list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT id AS k, part, x FROM ({cut})),
b0 AS MATERIALIZED (SELECT part, k - 1 AS entry, x AS y FROM s WHERE k <= 16),
{steps},
h AS (SELECT sha256(string_agg(t, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM (SELECT part, entry, array_to_string(y, ',') AS t FROM b6)),
c AS (SELECT k, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error FROM n6 GROUP BY k)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM v JOIN c ON v.id = c.k, h
"""


@register("op11_vector_codes", _code_rounds())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(table(spark, sf_dir, "embeddings"))


def _base32_of_hex(digest: str) -> str:
    """DuckDB has no base32: five bits of the digest at a time."""
    bits = f"list_reduce(list_transform(string_split({digest}, ''), lambda x: printf('%04s', bin(('0x' || x)::INT))), lambda a, b: a || b)"
    return (f"(SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_reduce(list_transform(string_split(substr(bits, 5 * i + 1, 5), ''), "
            f"lambda x: x::INT), lambda a, b: 2 * a + b), 1), '' ORDER BY i) FROM (SELECT replace({bits}, ' ', '0') AS bits), range(32) t(i))")


@register("op12_warc_archives", f"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT *, sha1(payload) AS sha, octet_length(payload)::BIGINT AS payload_bytes, row_number() OVER w AS k, first(page_id) OVER w AS first_id
      FROM p WINDOW w AS (PARTITION BY sha1(payload) ORDER BY page_id, url)),
b AS (SELECT sha, {_base32_of_hex("sha")} AS payload_digest FROM (SELECT DISTINCT sha FROM d))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN first_id END AS refers_to FROM d JOIN b USING (sha)
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(spark, warc.write(table(spark, sf_dir, "pages")))


@register("op13_source_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c.n), 0)::BIGINT AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
s AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.n + langs.v) AS p,
             1 + 1000000000 * (kept.n + 1) // (langs.n + langs.v) AS q
      FROM g JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
          FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM s WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (FROM every UNION ALL FROM terms))
WHERE part = 'pair' OR rank <= 200
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))

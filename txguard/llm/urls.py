"""URL filter by path templates, with DataFrame functions only.

A short list of rules judges what it covers; its verdicts are also the labels
from which the rest is judged.  Per host, the paths form a tree:

1. digit runs and long hexadecimal names become ``<n>`` and ``<h>``;
2. level by level, below a node with more than ``max_children`` children, a child with less
   support than ``min_support`` is a variable segment and becomes ``<*>``; where the children are more than the root
   of the node's pages, so is one that holds less than 1 / ``max_children`` of them.  The children of all variable siblings are pooled before the next
   level is looked at.  Segments beyond ``LEVELS`` become one ``<...>``;
3. branches with the same skeleton (literal segments left out) are merged if
   their labelled block rates do not differ from the skeleton's pooled rate by
   more than ``max_z`` standard errors; those that do form an ``over`` and an
   ``under`` branch.  A branch without labels differs in nothing that is known and joins the
   similar ones, whose evidence so reaches pages that no rule covers;
4. a merged template is rejected if its smoothed labelled purity,
   (blocked + 1) / (labelled + 3), exceeds one half.

The urls are first summed to distinct (host, shape) rows, so the tree is built
over templates, not over pages, and a host with a third of all pages is
combined before any shuffle.  A level is one aggregation of these rows and a join.

Rows.  A NULL url or one without ``://`` has an empty host and path.  Repeated
rows are judged each; ids may be NULL.  An empty table gives an empty result,
further columns are ignored.  Depth and length of a path are not limited.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# (verdict, host, path): a rule fits its host and the subdomains, where the
# path starts with the rule's; the longest wins.
RULES: tuple[tuple[str, str, str], ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
LEVELS = 16
MAX_CHILDREN = 16
MIN_SUPPORT = 8
MAX_Z = 2.0
PRIOR_BLOCKED, PRIOR_LABELLED = 1, 3


def split_url(url: str | Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    u = F.col(url) if isinstance(url, str) else url
    at = F.coalesce(F.instr(u, "://"), F.lit(0))
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(raw) + 1, F.length(rest) + 1), "^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits, NULLs if none."""
    name = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def shape(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, "/[0-9a-fA-F]{16,}", "/<h>"), "[0-9]+", "<n>")


def generalised(leaves: DataFrame, max_children: int = MAX_CHILDREN, min_support: int = MIN_SUPPORT) -> DataFrame:
    """``leaves`` (host, shape, n, ...) with their ``template``."""
    segments = F.split("shape", "/")
    deepest = leaves.agg(F.max(F.size(segments)).alias("d")).first()["d"] or 0
    rows = leaves.withColumn("template", F.lit(""))
    for d in range(min(deepest, LEVELS)):
        inside, segment = F.size(segments) > d, F.get(segments, F.lit(d))
        children = rows.where(inside).groupBy("host", "template", segment.alias("segment")).agg(F.sum("n").alias("support"))
        crowded = children.groupBy("host", "template").agg(F.count("*").alias("n_children"), F.sum("support").alias("pages")).filter(F.col("n_children") > max_children)
        names = (F.col("n_children") * F.col("n_children") > F.col("pages")) & (F.col("support") * max_children < F.col("pages"))
        variable = children.join(crowded, ["host", "template"]).filter((F.col("support") < min_support) | names).select(
            "host", "template", "segment", F.lit(True).alias("variable"))
        joined = rows.withColumn("segment", F.when(inside, segment)).join(variable, ["host", "template", "segment"], "left")
        own = F.when(F.col("variable"), F.lit("<*>")).otherwise(F.col("segment"))
        grown = F.when(inside, F.concat(F.col("template"), F.lit("/" if d else ""), own)).otherwise(F.col("template"))
        # the next level is keyed by what this one has generalised
        rows = stored(joined.withColumn("template", grown).drop("segment", "variable"))
    return rows.withColumn("template", F.when(F.size(segments) > LEVELS, F.concat("template", F.lit("/<...>"))).otherwise(F.col("template")))


def templates(labelled: DataFrame, max_children: int = MAX_CHILDREN, min_support: int = MIN_SUPPORT,
              max_z: float = MAX_Z) -> DataFrame:
    """(host, shape, rule_verdict) rows -> host, shape, template, branch,
    purity, template_verdict of every distinct (host, shape)."""
    leaves = stored(labelled.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count("rule_verdict").alias("labelled"),
        F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("blocked")))
    leaves = stored(generalised(leaves, max_children, min_support)).withColumn("skeleton", F.array_join(F.transform(
        F.split("template", "/"), lambda x: F.when(x.contains("<") | (x == ""), x).otherwise(F.lit("<w>"))), "/"))
    branches = leaves.groupBy("host", "skeleton", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    pooled = branches.groupBy("host", "skeleton").agg(F.try_divide(F.sum("blocked"), F.sum("labelled")).alias("p"))
    spread = F.sqrt(F.col("labelled") * F.col("p") * (1 - F.col("p")))
    z = F.coalesce(F.try_divide(F.col("blocked") - F.col("labelled") * F.col("p"), spread), F.lit(0.0))
    branches = branches.join(pooled, ["host", "skeleton"]).withColumn(
        "branch", F.when(z > max_z, "over").when(z < -max_z, "under").otherwise("like"))
    merged = branches.groupBy("host", "skeleton", "branch").agg(
        ((F.sum("blocked") + PRIOR_BLOCKED) / (F.sum("labelled") + PRIOR_LABELLED).cast("double")).alias("purity"))
    return (
        leaves.select("host", "shape", "template", "skeleton")
        .join(branches.select("host", "skeleton", "template", "branch"), ["host", "skeleton", "template"])
        .join(merged, ["host", "skeleton", "branch"])
        .select("host", "shape", "template", "branch", "purity",
                F.when(F.col("purity") > 0.5, "block").otherwise("allow").alias("template_verdict"))
    )


def judge(pages: DataFrame, url: str = "url", id_col: str = "page_id", rules=RULES, **options) -> DataFrame:
    """id_col, host, path, rule, verdict, template, purity of every page."""
    host, path = split_url(url)
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select(id_col, "host", "path", shape(F.col("path")).alias("shape"), rule.alias("rule"), verdict.alias("rule_verdict"))
    found = stored(templates(rows, **options))
    return rows.join(found, ["host", "shape"]).select(
        id_col, "host", "path", "rule", F.coalesce("rule_verdict", "template_verdict").alias("verdict"), "template", "purity")

"""Mixing sources to target weights, with DataFrame functions only.

Sizes are summed per source, targets follow from the weights, and the
repetition rate of a source is target / size.  Every document is emitted
floor(rate) times, plus one hash-seeded Bernoulli copy whose probability is
the fraction left.

The Bernoulli draws of one source share one ruler: a document's variate is the
share of its source's words that lies before the document's middle in hash
order, and the copy is made if the variate is below the fraction.  A random
hash order makes each variate uniform, so each probability is the fraction,
while the words taken stay within half a document of the target instead of
wandering with the few longest documents.  The ruler comes from a histogram
of ``2**bin_bits`` hash bins per source; only the one bin of each source that
holds the cut is looked at document by document.

Rows.  NULL text has size zero and takes nothing.  A NULL source is a source
of its own, the last; the empty string is the first.  Repeated rows are
documents of their own; rows tied on hash and id are told apart by their size
and text; rows equal in all of these share their fate.  A NULL id hashes like the text ``null``.  An empty table gives an
empty result.  Names that begin with ``__mix_`` are used inside; other columns
of the input are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txguard.llm.common import WORD, stored

WEIGHTS = (3, 1, 2)   # by rank of the source, repeating
SHARE = 1.5           # of all sizes
CAP = 2               # times a source's size
HASH_BITS = 60
BIN_BITS = 16


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(id_col: str | Column, seed: int) -> Column:
    """60 bits of the MD5 of ``seed:id``; the same number in any SQL engine."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> + rank, weight, target, rate.

    The targets are min(cap * size, level * weight) for the one level at which
    they add up to ``share`` of all sizes: what re-dealing the excess until no
    source is above its cap ends at.  The windows run over one row per source.
    """
    ranked = sources.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    order = W.orderBy((F.col("most") / F.col("weight")).asc(), F.col("rank").asc())
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    every = W.partitionBy(F.lit(0))
    filled = (
        ranked.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        # capped sources come first in this order; the first that is not sets the level
        .withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "rank", "level"))).over(every)["level"])
        .withColumn("target", F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most"))))
    )
    return filled.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).select(
        "source", "source_size", "rank", "weight", "target", "rate")


def repetitions(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source",
                weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 0,
                bin_bits: int = BIN_BITS, size: Column | None = None, tie: Column | None = None) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken in columns of
    these names after ``__mix_``.

    One scan sums the bins, one reads the rows of the cut bins, one decides;
    what is decided by is one row per source.  ``size`` and ``tie`` stand for
    the word count and the hash of the text where a caller has them at hand.
    """
    size = n_words(F.col(text)) if size is None else size
    tie = F.xxhash64(text) if tie is None else tie
    rows = docs.select("*", F.col(source).alias("__mix_source"), hash60(id_col, seed).alias("__mix_h"))
    rows = rows.withColumn("__mix_bin", F.shiftright("__mix_h", HASH_BITS - bin_bits).cast("int"))
    bins = stored(rows.groupBy("__mix_source", "__mix_bin").agg(F.sum(size).alias("words")))
    rates = targets(bins.groupBy(F.col("__mix_source").alias("source")).agg(F.sum("words").alias("source_size")), weights, share, cap)
    rates = stored(rates.withColumn("whole", F.floor("rate")).withColumn("cut_at", (F.col("rate") - F.col("whole")) * F.col("source_size")))
    # the bin of each source in which its cut falls, and the words before it
    running = W.partitionBy("__mix_source").orderBy("__mix_bin").rowsBetween(W.unboundedPreceding, -1)
    cut = (
        bins.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .join(rates, F.col("__mix_source").eqNullSafe(F.col("source")))
        .filter("cut_at > 0 AND before <= cut_at AND cut_at < before + words")
        .select("source", F.col("__mix_bin").alias("cut_bin"), "before", "cut_at")
    )
    cut = stored(cut.select(*[F.col(c).alias(f"__mix_{c}") for c in cut.columns]))
    # the last document of that bin whose middle lies before the cut
    order = W.partitionBy("__mix_source").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    near = (
        rows.withColumnRenamed("__mix_source", "__mix_own")
        .join(cut, F.col("__mix_own").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_bin") == F.col("__mix_cut_bin")))
        .select("__mix_source", F.col("__mix_before").alias("before"), F.col("__mix_cut_at").alias("cut_at"),
                size.alias("size"), _place(id_col, size, tie).alias("place"))
        .withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
        .filter(F.col("ahead") + F.col("size") / 2 < F.col("cut_at"))
        .groupBy("__mix_source").agg(F.max("place").alias("last"))
    )
    plan = rates.join(cut.select(F.col("__mix_source").alias("s1"), F.col("__mix_cut_bin").alias("cut_bin")), F.col("source").eqNullSafe(F.col("s1")), "left")
    plan = plan.join(near.select(F.col("__mix_source").alias("s2"), "last"), F.col("source").eqNullSafe(F.col("s2")), "left")
    plan = stored(plan.select(F.col("source").alias("__mix_s"), F.col("source_size").alias("__mix_source_size"), F.col("target").alias("__mix_target"),
                              F.col("whole").alias("__mix_whole"), F.col("cut_bin").alias("__mix_cut_bin"), F.col("last").alias("__mix_last")))
    extra = F.when(F.col("__mix_bin") < F.col("__mix_cut_bin"), 1).when(
        (F.col("__mix_bin") == F.col("__mix_cut_bin")) & (_place(id_col, F.col("__mix_size"), tie) <= F.col("__mix_last")), 1).otherwise(0)
    return (
        rows.withColumn("__mix_size", size)
        .join(plan, F.col("__mix_source").eqNullSafe(F.col("__mix_s")))
        .withColumn("__mix_copies", (F.col("__mix_whole") + extra).cast("int"))
        .withColumn("__mix_taken", (F.col("__mix_copies") * F.col("__mix_size")).cast("long"))
        .select(*docs.columns, "__mix_size", "__mix_source_size", "__mix_target", "__mix_copies", "__mix_taken")
    )


def _place(id_col: str, size: Column, tie: Column) -> Column:
    """Position of a document on its source's ruler, ties included."""
    return F.struct(F.col("__mix_h").alias("h"), F.col(id_col).alias("id"), size.alias("size"), tie.alias("tie"))


def measured(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """id, source, size and text hash of every document, read once and stored."""
    return stored(docs.select(id_col, source, n_words(F.col(text)).alias("size"), F.xxhash64(text).alias("tie")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """Every document as often as ``__mix_copies`` says, with the columns of ``docs``."""
    out = repetitions(docs, **options)
    return out.filter("__mix_copies > 0").withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).select(*docs.columns)
